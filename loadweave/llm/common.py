"""What the operators share: words, batches, stored intermediate tables, pickling by value."""

from __future__ import annotations

import functools
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadweave.session import scratch_path

#: A word is a run of code points other than these six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of one Arrow batch handed to Python; one longer text still makes a batch of its own.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 4096


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches and send this subpackage's functions by value."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    package = sys.modules[__package__]
    if package.__name__ not in cloudpickle.list_registry_pickle_by_value():
        cloudpickle.register_pickle_by_value(package)
    return spark


def shipped(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcasts ``value``, also one of this subpackage's own classes, to workers that need
    not have the subpackage; returns a function that gives it there, opened once per worker."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def opened() -> object:
        if not hasattr(sent, "opened"):  # a worker keeps one such object for all its tasks
            sent.opened = cloudpickle.loads(sent.value)
        return sent.opened

    return opened


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: it survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, object]], schema: str
) -> DataFrame:
    """Apply ``fn`` to every Arrow batch; it returns columns by name, in schema order."""
    kinds = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], f.type) for f in kinds], schema=kinds
                )

    return df.mapInArrow(run, schema)


def sealed(docs: DataFrame):
    """``docs`` under names of its own, so that none clashes with an inner column; the new
    name of each column; and the way back to the old names."""
    inner = docs.toDF(*[f"sealed_{i}_" for i in range(len(docs.columns))])
    names = dict(zip(docs.columns, inner.columns))

    def back(df: DataFrame) -> DataFrame:
        return df.select(*inner.columns).toDF(*docs.columns)

    return inner, names, back


def append_columns(
    df: DataFrame, text_col: str, fn: Callable[[list[bytes]], dict[str, object]], schema: str
) -> DataFrame:
    """All columns of ``df`` unchanged, and those that ``fn`` makes from the texts."""
    kinds = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(byte_texts(batch.column(text_col)))
                made = [pa.array(out[f.name], f.type) for f in kinds]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *made], names=[*batch.schema.names, *kinds.names]
                )

    return df.mapInArrow(run, _schema_ddl(df, schema))


def _schema_ddl(df: DataFrame, more: str):
    from pyspark.sql.types import StructType

    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


@functools.lru_cache(maxsize=None)
def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def arrow_schema(ddl: str) -> pa.Schema:
    return _arrow_schema(ddl)


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; a null is empty."""
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return [x if x is not None else "" for x in column.to_pylist()]


_CHARS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def ascii_words(raw: bytes) -> list[bytes]:
    """Words of digits, letters and all code points above ASCII, with A-Z in lower case."""
    return raw.translate(_CHARS).split()


_CHARS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def ascii_words(raw: bytes) -> list[bytes]:
    """Words of digits, letters and all code points above ASCII, with A-Z in lower case."""
    return raw.translate(_CHARS).split()


def n_words(text):
    """Number of words of a text column; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def range_cuts(ids: DataFrame, col: str, parts: int) -> list:
    """At most ``parts`` - 1 increasing cuts that deal the values of ``col`` out evenly.

    Only that one column is read; nulls are left to the last range.
    """
    steps = [i / parts for i in range(1, parts)]
    if not steps:
        return []
    cuts = ids.select(
        F.percentile_approx(col, steps, 20 * parts).alias("cuts")
    ).first()["cuts"]
    return sorted(set(cuts or []))


def bucket_of(col: str, cuts: list):
    """Number of the range of ``col``: how many cuts lie below it; nulls go last."""
    if not cuts:
        return F.lit(0)
    kind = "bigint"
    found = F.size(F.filter(F.lit(cuts).cast(f"array<{kind}>"), lambda c: c < F.col(col)))
    return F.when(F.col(col).isNull(), F.lit(len(cuts))).otherwise(found)

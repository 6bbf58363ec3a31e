"""Document fingerprints that can be subtracted: invertible Bloom lookup tables.

A text's paragraphs (lines, long ones cut after sentences) are hashed to 64-bit digests; a paragraph
that comes again gets its number mixed in, so repeats count. Each digest is added to three
cells, one in each third of the table: a count, the XOR of the digests and the XOR of their
check values. Subtracting two tables leaves what differs; a cell with one digest (count 1
or -1, check value right) gives it up, which frees other cells, until the table is empty.
If it does not empty, both tables are built again with twice the cells, so every
difference is recovered in the end, whatever its size.

The fingerprint is the number of digests and a table of ``CELLS`` cells, in hex. Likeness is
what both have over what either has (1 for two texts without paragraphs).

Rules: a null text is empty; equal texts have equal fingerprints; the next document is the
next row in descending id (nulls last), rows of one id ordered by text; a single row is its
own next; an empty table gives no rows. Texts are never cut.
"""

from __future__ import annotations

import hashlib
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import arrow_schema, bucket_of, mix, prepare, range_cuts, texts

CELLS = 48
HASHES = 3
#: A paragraph ends with its line, or after 80 letters with the next mark that ends a sentence.
PARAGRAPH = re.compile(r"[^\n]{80,}?[.!?](?=\s)|[^\n]+")
SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)

THIRDS = np.arange(HASHES, dtype=np.uint64)[:, None]


def digests(text: str) -> np.ndarray:
    """Distinct 64-bit digests of the paragraphs; the n-th repeat has a digest of its own."""
    import xxhash

    seen: dict[str, int] = {}
    out = []
    for part in PARAGRAPH.findall(text):
        part = part.strip()
        if part:
            k = seen.get(part, 0)
            seen[part] = k + 1
            out.append(xxhash.xxh64_intdigest(part.encode(), k))
    return np.array(out, np.uint64)


class Table:
    """Counts, XOR of digests and XOR of check values of ``size`` cells."""

    def __init__(self, keys: np.ndarray, size: int):
        self.size = size
        self.count = np.zeros(size, np.int32)
        self.keys = np.zeros(size, np.uint64)
        self.checks = np.zeros(size, np.uint64)
        if len(keys):
            cells = places(keys, size).ravel()
            order = np.argsort(cells, kind="stable")
            at = cells[order]
            start = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            every = np.tile(keys, HASHES)[order]
            self.count[at[start]] = np.diff(np.append(start, len(at)))
            self.keys[at[start]] = np.bitwise_xor.reduceat(every, start)
            self.checks[at[start]] = np.bitwise_xor.reduceat(check(every), start)

    def minus(self, other: Table) -> Table:
        out = Table(np.zeros(0, np.uint64), self.size)
        out.count = self.count - other.count
        out.keys = self.keys ^ other.keys
        out.checks = self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray] | None:
        """(digests only in the first, only in the second); None if cells are left over."""
        count, keys, checks = self.count.copy(), self.keys.copy(), self.checks.copy()
        mine, theirs = [], []
        while True:
            pure = np.flatnonzero(np.abs(count) == 1)
            pure = pure[check(keys[pure]) == checks[pure]]
            if not pure.size:
                break
            found, first = np.unique(keys[pure], return_index=True)
            sign = count[pure[first]]
            mine.append(found[sign > 0])
            theirs.append(found[sign < 0])
            cells = places(found, self.size).ravel()
            np.subtract.at(count, cells, np.tile(sign, HASHES))
            np.bitwise_xor.at(keys, cells, np.tile(found, HASHES))
            np.bitwise_xor.at(checks, cells, np.tile(check(found), HASHES))
        if count.any() or keys.any() or checks.any():
            return None
        none = np.zeros(0, np.uint64)
        return np.concatenate([none, *mine]), np.concatenate([none, *theirs])

    def text(self, n: int) -> str:
        body = self.count.astype("<i4").tobytes() + self.keys.astype("<u8").tobytes() + self.checks.astype("<u8").tobytes()
        return (struct.pack("<II", n, self.size) + body).hex()


def check(keys: np.ndarray) -> np.ndarray:
    return mix(keys ^ SALTS[3])


def places(keys: np.ndarray, size: int) -> np.ndarray:
    """[hash, key]: one cell in each third of the table."""
    third = np.uint64(size // HASHES)
    return (mix(keys[None, :] + SALTS[:HASHES, None]) % third + THIRDS * third).astype(np.int64)


def difference(a: np.ndarray, b: np.ndarray, first: tuple[Table, Table] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Digests only in a and only in b, by tables that grow until they can be peeled.

    The counts left in a table too small to peel tell about how many digests differ (the sum
    of their squares is near HASHES for each), and so which size to try next.
    """
    one, other = first or (Table(a, CELLS), Table(b, CELLS))
    while True:
        left = one.minus(other)
        about = int((left.count.astype(np.int64) ** 2).sum()) // HASHES
        if about <= left.size and (peeled := left.peel()) is not None:
            return peeled
        size = 2 * left.size
        while size < min(1.3 * about, 1.6 * (len(a) + len(b))):
            size *= 2
        one, other = Table(a, size), Table(b, size)


def likeness(a: np.ndarray, b: np.ndarray, first: tuple[Table, Table] | None = None) -> float:
    only_a, only_b = difference(a, b, first)
    common = len(a) - len(only_a)
    either = common + len(only_a) + len(only_b)
    return common / either if either else 1.0


def fingerprint(keys: np.ndarray) -> tuple[Table, str]:
    made = Table(keys, CELLS)
    return made, made.text(len(keys))


def edited(text: str, other: str) -> str:
    """The last third of the text replaced by as many first letters of the other."""
    k = len(text) // 3
    return text[: len(text) - k] + other[:k]


def in_order_with_next(docs: DataFrame, id_col: str, text_col: str, fn, schema: str) -> DataFrame:
    """``fn`` over (id, text, next text) of all rows in descending order of id.

    Rows are dealt to ranges of ids and sorted there. The first row of a range is also sent
    to the range before it, to stand behind its last row; the very first goes to the last.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = range_cuts(docs, id_col, parts)
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # ranges in descending order; nulls come last
    last = len(cuts) + 1
    own = F.when(F.col("_id").isNull(), F.lit(last)).otherwise(F.lit(len(cuts)) - bucket_of("_id", cuts)).cast("int")
    tops = {
        r["_range"]: r["_id"]
        for r in rows.select("_id").withColumn("_range", own).groupBy("_range").agg(F.max("_id").alias("_id")).collect()
    }  # the largest id of each range
    used = sorted(tops)
    before = dict(zip(used, [used[-1], *used[:-1]])) if used else {}
    # a copy of the range's first id goes to the range before; of several, the first by text counts
    copied = F.create_map(*[F.lit(x) for r in used for x in (r, before[r])]) if used else None
    dealt = rows.withColumn("_range", own)
    if used:
        top = F.create_map(*[x for r in used for x in (F.lit(r), F.lit(tops[r]).cast(kind))])
        extra = F.when(F.col("_id").eqNullSafe(top[F.col("_range")]), F.array(F.struct(F.lit(True).alias("c"), copied[F.col("_range")].alias("r"))))
        mine = F.array(F.struct(F.lit(False).alias("c"), F.col("_range").alias("r")))
        dealt = dealt.select("_id", "_text", F.explode(F.concat(mine, F.coalesce(extra, F.array().cast("array<struct<c:boolean,r:int>>")))).alias("_to"))
        dealt = dealt.select("_id", "_text", F.col("_to.c").alias("_copy"), F.col("_to.r").alias("_range"))
    else:
        dealt = dealt.withColumn("_copy", F.lit(False)).select("_id", "_text", "_copy", "_range")
    kinds = arrow_schema(schema)

    def run(batches):
        held = None  # the row whose next one has not come yet
        closed = False  # a copy has closed the range; its other rows of that id are not needed
        for batch in batches:
            out = []
            for doc, text, copy in zip(batch.column(0).to_pylist(), texts(batch.column(1)), batch.column(2).to_pylist()):
                if copy and closed:
                    continue
                if held is not None:
                    out.append((*held, text))
                held = None if copy else (doc, text)
                closed = copy
            if out:
                yield from fn(out, kinds)

    return (
        dealt.repartitionById(last + 1, "_range")
        .sortWithinPartitions("_copy", F.desc_nulls_last("_id"), F.asc_nulls_first("_text"))
        .select("_id", "_text", "_copy")
        .mapInArrow(run, schema)
    )


def _marked(text: str) -> tuple[np.ndarray, Table, str]:
    keys = digests(text)
    return keys, *fingerprint(keys)


def version_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit with the next document, and how alike the
    text's is to that of the edit and of the next document."""
    prepare(docs.sparkSession)
    schema = (
        f"`{id_col}` {dict(docs.dtypes)[id_col]}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )

    def rows(found, kinds):
        out, known = [], (None,)
        for doc, text, following in found:
            keys, table, mark = known[1:] if known[0] is text else _marked(text)
            known = following, *_marked(following)
            changed = edited(text, following)
            other, other_table, other_mark = _marked(changed)
            sha = hashlib.sha256(changed.encode()).hexdigest()
            near = likeness(keys, other, (table, other_table)), likeness(keys, known[1], (table, known[2]))
            out.append((doc, len(text), sha, mark, other_mark, *near))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds.types)], schema=kinds)

    return in_order_with_next(docs, id_col, text_col, rows, schema)

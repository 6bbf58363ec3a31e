"""Whitening embeddings by a covariance over distinct vectors, each with a weight.

Vectors are put on a grid of whole numbers (``floor(scale * c)``). Spark groups identical grid
vectors first, so a vector that a third of all rows share is fitted and whitened once. Sums of
the distinct vectors are exact whole numbers; the covariance is a matrix product of the centred
vectors of every task, weighted by one or by the number of copies, and the tasks' products are
added by matrix row. Only the matrix (its size hangs on the dimension, not on the rows) comes to
the driver, for its eigenvectors. Every distinct vector is whitened once and joined back to the
rows that hold it; the few vectors with more than a ``HOT``-th of the rows (so at most ``HOT`` of
them, which bounds their broadcast) are joined in pieces.

Rules: a null vector, and one with a null, NaN or infinite entry, is left out; so is an empty
vector. Grid numbers stop at the ends of a long. Rows with the same key or the same vector all
stay, and a null key is kept. Directions without spread (eigenvalue zero but for rounding) have
no component, so one distinct vector alone gives no rows, as an empty table does. ``deviation``
is null where it does not fit into a long. Vectors of different lengths are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import arrow_schema, prepare, stored

SCALE = 256
COMPONENTS = 4
#: A vector with more than this part of all rows is joined back in pieces.
HOT = 1000
#: Rows of distinct vectors in one matrix product.
BLOCK = 4096
MADE = (
    "component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)
_LONG = 1 << 63


def grid(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * c) of every entry, as longs; null where the vector cannot be used."""
    finite = F.forall(
        vector,
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))),
    )
    cells = F.transform(
        vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long")
    )
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & finite, cells)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls as rows of a matrix."""
    lengths = np.diff(column.offsets.to_numpy())
    if lengths.min() != lengths.max():
        raise ValueError("vectors have different lengths")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _largest(x: np.ndarray) -> int:
    return int(np.abs(x.astype(np.float64)).max())


def exact_sums(x: np.ndarray, weight: np.ndarray) -> list[int]:
    """Weighted column sums without overflow."""
    if _largest(x) * int(weight.sum()) < _LONG // 2:
        return [int(v) for v in weight @ x]
    return [int(v) for v in weight.astype(object) @ x.astype(object)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * x - S)^2, exactly; None beyond a long."""
    reach = n * _largest(x) + max(map(abs, sums))
    if reach * reach * x.shape[1] < _LONG // 2:
        far = n * x - np.array(sums, dtype=np.int64)
        return [int(v) for v in (far * far).sum(axis=1)]
    found = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return [v if v < _LONG else None for v in found]


def _per_task(df: DataFrame, start, add, finish, schema: str) -> DataFrame:
    """One pass over a task's Arrow batches with a running result, emitted at the end."""
    kinds = arrow_schema(schema)

    def run(batches):
        state = start()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                state = add(state, batch.slice(at, BLOCK))
        out = finish(state)
        if out is not None:
            arrays = [pa.array(out[f.name], f.type) for f in kinds]
            yield pa.RecordBatch.from_arrays(arrays, schema=kinds)

    return df.mapInArrow(run, schema)


def fit_sums(distinct: DataFrame) -> tuple[int, list[int]]:
    """Weight of all distinct vectors, and the exact weighted sum of each dimension."""

    def add(state, batch):
        weight = batch.column("w").to_numpy()
        more = exact_sums(matrix(batch.column("x")), weight)
        total, sums = state
        if sums is not None and len(sums) != len(more):
            raise ValueError("vectors have different lengths")
        return total + int(weight.sum()), more if sums is None else [a + b for a, b in zip(sums, more)]

    def finish(state):
        total, sums = state
        if sums is None:
            return None
        # dimension -1 carries the weight
        return {"dim": [-1, *range(len(sums))], "s": [str(total), *map(str, sums)]}

    parts = _per_task(distinct, lambda: (0, None), add, finish, "dim int, s string")
    added = parts.groupBy("dim").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("tasks")
    )
    found = sorted((r["dim"], int(r["s"]), r["tasks"]) for r in added.collect())
    if not found:
        return 0, []
    if any(tasks != found[0][2] for _, _, tasks in found):
        raise ValueError("vectors have different lengths")
    return found[0][1], [s for _, s, _ in found[1:]]


def covariance(distinct: DataFrame, total: int, sums: list[int]) -> np.ndarray:
    """Weighted covariance with divisor ``total``; vectors are centred before multiplying."""
    mean, dims = np.array([s / total for s in sums]), len(sums)
    schema = "i int, part array<double>"

    def add(state, batch):
        z = matrix(batch.column("x")).astype(np.float64) - mean
        return state + (z * batch.column("w").to_numpy()[:, None]).T @ z

    def gather(state, batch):
        for i, part in zip(batch.column("i").to_pylist(), matrix(batch.column("part"))):
            state[i] = state[i] + part if i in state else part.copy()
        return state

    parts = _per_task(
        distinct,
        lambda: np.zeros((dims, dims)),
        add,
        lambda state: {"i": list(range(dims)), "part": list(state)},
        schema,
    )
    added = _per_task(
        parts.repartition("i"),
        dict,
        gather,
        lambda state: {"i": list(state), "part": list(state.values())} if state else None,
        schema,
    )
    v = np.zeros((dims, dims))
    for r in added.collect():
        v[r["i"]] = r["part"]
    v /= total
    return (v + v.T) / 2


def principal(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues above rounding, and their unit vectors as columns."""
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    kept = values > max(np.trace(v), 0.0) * len(v) * np.finfo(float).eps
    return values[kept], vectors[:, kept]


def identity_error(white: DataFrame, total: int, k: int) -> float:
    """Largest entry, in size, of the whitened fit list's covariance less the identity."""
    w, cells = F.col("w"), [F.col("a")[i] for i in range(k)]
    means = white.agg(*[F.sum(w * c) / F.lit(total) for c in cells]).first()
    far = [c - F.lit(m) for c, m in zip(cells, means)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = white.agg(*[F.sum(w * far[i] * far[j]) / F.lit(total) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


def whiten(
    df: DataFrame,
    vector: str = "embedding",
    keep: tuple[str, ...] = ("vec_id",),
    scale: int = SCALE,
    components: int = COMPONENTS,
    weights: str = "one",
) -> DataFrame:
    """A row for every usable row and component: the ``keep`` columns and those of ``MADE``.

    ``weights``: ``one`` fits every distinct vector once, ``count`` as often as it occurs; n is
    the sum of the weights. ``identity_error`` is measured on the whitened distinct vectors.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights must be 'one' or 'count'")
    prepare(df.sparkSession)
    names = [f"kept_{i}_" for i in range(len(keep))]
    cells = grid(F.col(vector), scale).alias("x")
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], cells).filter("x is not null")
    weight = F.lit(1).cast("long") if weights == "one" else F.col("copies")
    counted = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    distinct = stored(counted.withColumn("w", weight), "distinct-vectors")
    made = [c.split() for c in MADE.split(", ")]
    nothing = df.filter("false").select(*keep, *[F.lit(None).cast(t).alias(c) for c, t in made])

    total, sums = fit_sums(distinct.select("x", "w"))
    if not total:
        return nothing
    v = covariance(distinct.select("x", "w"), total, sums)
    values, vectors = principal(v, components)
    if not len(values):
        return nothing
    mean, turn = np.array([s / total for s in sums]), vectors / np.sqrt(values)
    schema = "x array<long>, copies long, w long, deviation long, a array<double>"
    kinds = arrow_schema(schema)

    def project(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = matrix(part.column("x"))
                far = pa.array(deviations(x, total, sums), pa.int64())
                turned = pa.array(list((x - mean) @ turn), pa.list_(pa.float64()))
                columns = [c.cast(f.type) for c, f in zip([*part.columns, far, turned], kinds)]
                yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    white = stored(distinct.mapInArrow(project, schema), "whitened-vectors")
    error = identity_error(white, total, len(values))
    piece = white.agg(F.sum("copies")).first()[0] // HOT + 1

    # a hot vector's rows are dealt to pieces; its one whitened row goes to each of them
    pieces = F.call_function("div", F.col("copies"), F.lit(piece)) + F.lit(1)
    hot = white.filter(F.col("copies") > piece).select("x", pieces.alias("pieces"))
    placed = rows.withColumn("_row", F.monotonically_increasing_id())
    dealt = placed.join(F.broadcast(hot), "x", "left").withColumn(
        "part", F.pmod("_row", F.coalesce("pieces", F.lit(1)))
    )
    last = F.when(F.col("copies") > piece, pieces - 1).otherwise(F.lit(0))
    sides = white.select("x", "deviation", "a", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part"))
    shares = F.array(*[F.lit(float(e / np.trace(v))) for e in values])
    joined = dealt.join(sides, ["x", "part"]).select(
        *names, "deviation", F.posexplode("a").alias("at", "whitened")
    )
    return joined.select(
        *[F.col(n).alias(c) for c, n in zip(keep, names)],
        (F.col("at") + 1).alias("component"),
        F.lit(total).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )

"""Ordered windows that never put one whole group into one task.

A window ``partitionBy(panel).orderBy(ts)`` sends every row of a panel to one task.
That is right while panels are short. ``lay_out`` keeps that plan when the longest
group is known (or counted) to be short, and otherwise cuts long groups into chunks
of bounded size along their order:

1. count rows per group; only groups above ``rows_per_chunk`` go on;
2. cut those into leaves by value ranges of the order columns, and cut again every
   leaf that is still too full, until each holds few rows (so dense stretches and
   equal timestamps are handled, not only evenly spread ones);
3. running sums over the leaf counts give every leaf its exact row offset;
4. whole leaves are gathered into chunks. The leaves just before a chunk are copied
   into it as history, the one just after it as look-ahead.

The data itself is shuffled once, on (group, chunk). Counting reads only the key and
order columns. The leaf table has at most about 2 rows per ``leaf`` data rows and
the chunk size grows with the data, so it stays small; its size is checked before
it is broadcast. Everything is a function of the data alone: retried tasks get the
same chunks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from loadweave.functions.expressions import micros
from loadweave.plans.joins import attach
from loadweave.session import checkpointed

CHUNK, CORE, BASE = "_chunk", "_core", "_base"
MIN_CHUNK_ROWS = 131_072
MAX_CHUNK_ROWS = 8_388_608
TARGET_CHUNKS = 32_768
LEAVES_PER_CHUNK = 8
MAX_FAN_OUT = 65_536
#: Rows of one task where ``spread`` deals them out.
TASK_ROWS = 262_144
_NULL_KEY = -(2**62)


@dataclass(frozen=True)
class Layout:
    """Rows arranged for ordered windows; ``window`` is the one to use on ``df``."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    split: bool
    sizes: DataFrame | None = None
    n_groups: int | None = None
    n_chunks: int | None = None

    @property
    def group(self) -> list[str]:
        return [*self.keys, CHUNK] if self.split else list(self.keys)

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.group).orderBy(*self.order)

    def position(self) -> Column:
        """0-based position of a row inside its whole group."""
        local = F.row_number().over(self.window).cast("long") - F.lit(1)
        return local + F.col(BASE) if self.split else local

    def core(self, df: DataFrame) -> DataFrame:
        """Drop the copied rows and the helper columns."""
        if not self.split:
            return df
        return df.filter(F.col(CORE)).drop(CHUNK, CORE, BASE)

    def with_size(self, df: DataFrame, name: str = "_n") -> DataFrame:
        """Add the row count of the whole group."""
        if not self.split:
            whole = Window.partitionBy(*self.keys)
            return df.withColumn(name, F.count(F.lit(1)).over(whole))
        return attach(
            df, self.sizes.withColumnRenamed("_size", name), self.keys, self.n_groups
        )


def spread(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df`` dealt out by ``keys``, so that about ``TASK_ROWS`` of ``rows`` rows fall to a task.

    Adaptive execution merges partitions by their compressed bytes, which say little about rows
    that a task has yet to fill in or that are nearly empty: its tasks, and the memory of their
    sorts, would grow with the data. ``rows`` need not be exact. Few rows are left to it.
    """
    parts = -(-rows // TASK_ROWS)
    if parts <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(parts, *keys)


def lay_out(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    back: int = 0,
    ahead: int = 0,
    max_rows: int | None = None,
    rows_per_chunk: int | None = None,
) -> Layout:
    """Arrange ``df`` so that windows over (keys, order) reach ``back`` rows before
    and ``ahead`` (0 or 1) rows after each row.

    ``max_rows``: a proven bound on the rows of any group, for example the number of
    calendar steps. When it fits one chunk nothing is counted. The order columns
    (timestamps, dates or whole numbers) must identify a row within its group.
    """
    if ahead not in (0, 1):
        raise ValueError("ahead must be 0 or 1")
    keys, order = tuple(keys), tuple(order)
    if max_rows is not None and max_rows <= (rows_per_chunk or MIN_CHUNK_ROWS):
        return Layout(df, keys, order, split=False)

    extents = []
    for i, name in enumerate(order):
        value = _order_value(df, name)
        extents += [F.min(value).alias(f"_min{i}"), F.max(value).alias(f"_max{i}")]
    ranges = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"), *extents)
    sizes = ranges.select(*keys, "_size")
    total, longest, groups = sizes.agg(
        F.sum("_size"), F.max("_size"), F.count(F.lit(1))
    ).first()
    if not total:
        return Layout(df, keys, order, split=False)
    chunk_rows = rows_per_chunk or min(
        MAX_CHUNK_ROWS, max(MIN_CHUNK_ROWS, total // TARGET_CHUNKS)
    )
    if longest <= chunk_rows:
        return Layout(df, keys, order, split=False, sizes=sizes, n_groups=groups)

    long_groups = ranges.filter(F.col("_size") > chunk_rows)
    leaf_rows = max(1, chunk_rows // LEAVES_PER_CHUNK)
    cuts, leaves = _cut(df, keys, order, long_groups, total // chunk_rows, leaf_rows)
    members = checkpointed(_members(leaves, keys, order, chunk_rows, back, ahead))
    rows = attach(
        _with_leaf(df, keys, order, cuts), members, [*keys, *_marks(order)], members.count()
    )
    rows = (
        rows.withColumn(CHUNK, F.coalesce(CHUNK, F.lit(0).cast("long")))
        .withColumn(CORE, F.coalesce(CORE, F.lit(True)))
        .withColumn(BASE, F.coalesce(BASE, F.lit(0).cast("long")))
        .drop(*_marks(order))
    )
    return Layout(
        rows,
        keys,
        order,
        split=True,
        sizes=sizes,
        n_groups=groups,
        n_chunks=2 * total // chunk_rows + groups,
    )


def running(
    layout: Layout, df: DataFrame, values: dict[str, str], kind: str = "sum"
) -> DataFrame:
    """Running sums or maxima from the first row of the group to each row.

    ``values`` maps new columns to the columns they run over; ``df`` is ``layout.df``
    with more columns. With chunks: one partial aggregate per chunk, a running
    aggregate over that small table, then the local scan on top.
    """
    aggregate = {"sum": F.sum, "max": F.max}[kind]
    frame = layout.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if layout.split:  # rows of the neighbouring chunk were counted there
        values = {out: F.when(F.col(CORE), _column(value)) for out, value in values.items()}
    local = df.withColumns({out: aggregate(value).over(frame) for out, value in values.items()})
    if not layout.split:
        return local
    before = (
        Window.partitionBy(*layout.keys)
        .orderBy(CHUNK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = (
        df.filter(F.col(CORE))
        .groupBy(*layout.group)
        .agg(*[aggregate(value).alias(f"_part_{out}") for out, value in values.items()])
    )
    totals = parts.select(
        *layout.group,
        *[aggregate(f"_part_{out}").over(before).alias(f"_before_{out}") for out in values],
    )
    whole = {}
    for out in values:
        earlier = F.col(f"_before_{out}")
        if kind == "sum":
            whole[out] = F.col(out) + F.coalesce(earlier, F.lit(0))
        else:
            whole[out] = F.greatest(F.col(out), earlier)
    joined = attach(local, totals, layout.group, layout.n_chunks)
    return joined.withColumns(whole).drop(*[f"_before_{out}" for out in values])


def _column(value):
    return F.col(value) if isinstance(value, str) else value


def _marks(order: Sequence[str]) -> list[str]:
    return [f"_leaf{i}" for i in range(len(order))]


def _order_value(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        col = micros(col)
    elif isinstance(kind, T.DateType):
        col = F.datediff(col, F.lit("1970-01-01").cast("date")).cast("long")
    elif isinstance(kind, T.IntegralType):
        col = col.cast("long")
    else:
        raise TypeError(f"cannot cut along {name}: {kind.simpleString()}")
    return F.coalesce(col, F.lit(_NULL_KEY))


def _cut(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ranges: DataFrame,
    n_ranges: int,
    leaf_rows: int,
) -> tuple[list[tuple[DataFrame, int]], DataFrame]:
    """Cut long groups into leaves. Returns the cuts, level by level, and the leaves."""
    marks = _marks(order)
    for mark in marks:
        ranges = ranges.withColumn(mark, F.lit(0).cast("long"))
    ranges = checkpointed(ranges)
    rows = attach(
        _with_marks(df.select(*keys, *order), order),
        ranges.select(*keys),
        keys,
        n_ranges,
        "inner",
    )
    cuts: list[tuple[DataFrame, int]] = []
    leaves: DataFrame | None = None
    while True:
        axis = F.lit(None).cast("int")
        low = high = F.lit(None).cast("long")
        for i in reversed(range(len(order))):
            wide = F.col(f"_max{i}") > F.col(f"_min{i}")
            axis = F.when(wide, F.lit(i)).otherwise(axis)
            low = F.when(wide, F.col(f"_min{i}")).otherwise(low)
            high = F.when(wide, F.col(f"_max{i}")).otherwise(high)
        fan_out = F.least(
            F.ceil(F.lit(2.0) * F.col("_size") / F.lit(float(leaf_rows))).cast("long"),
            F.lit(MAX_FAN_OUT).cast("long"),
        )
        full = (F.col("_size") > leaf_rows) & axis.isNotNull()
        done = ranges.filter(~full).select(*keys, *marks, "_size")
        leaves = done if leaves is None else leaves.unionByName(done)
        cut = ranges.filter(full).select(
            *keys,
            *marks,
            axis.alias("_axis"),
            low.alias("_lo"),
            (F.call_function("div", high - low, fan_out) + F.lit(1)).alias("_width"),
        )
        n_cut = cut.count()
        if n_cut == 0:
            return cuts, leaves
        cuts.append((cut, n_cut))
        rows = _refine(rows, cut, n_cut, keys, order, "inner")
        extents = []
        for i, name in enumerate(order):
            value = _order_value(rows, name)
            extents += [F.min(value).alias(f"_min{i}"), F.max(value).alias(f"_max{i}")]
        ranges = checkpointed(
            rows.groupBy(*keys, *marks).agg(F.count(F.lit(1)).alias("_size"), *extents)
        )


def _with_marks(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    for mark in _marks(order):
        rows = rows.withColumn(mark, F.lit(0).cast("long"))
    return rows


def _with_leaf(df: DataFrame, keys, order, cuts: list[tuple[DataFrame, int]]) -> DataFrame:
    rows = _with_marks(df, order)
    for cut, n_cut in cuts:
        rows = _refine(rows, cut, n_cut, keys, order, "left")
    return rows


def _refine(rows: DataFrame, cut: DataFrame, n_cut: int, keys, order, how: str) -> DataFrame:
    """Move the rows of every cut leaf to the finer leaf they fall in.

    A leaf is named by the lowest order values it can hold, so names sort in row order.
    """
    marks = _marks(order)
    rows = attach(rows, cut, [*keys, *marks], n_cut, how)
    for i, name in enumerate(order):
        steps = F.call_function("div", _order_value(rows, name) - F.col("_lo"), F.col("_width"))
        finer = F.col("_lo") + steps * F.col("_width")
        rows = rows.withColumn(
            marks[i], F.when(F.col("_axis") == i, finer).otherwise(F.col(marks[i]))
        )
    return rows.drop("_axis", "_lo", "_width")


def _members(leaves: DataFrame, keys, order, chunk_rows: int, back: int, ahead: int) -> DataFrame:
    """One row per (leaf, chunk it is placed in), with the chunk's first row offset."""
    marks = _marks(order)
    along = Window.partitionBy(*keys).orderBy(*marks)
    size = F.lit(chunk_rows).cast("long")
    placed = leaves.withColumn(
        "_off",
        F.coalesce(
            F.sum("_size").over(along.rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0).cast("long"),
        ),
    ).withColumn("_home", F.call_function("div", F.col("_off"), size))
    reach = F.col("_home")
    if back:
        last = F.col("_off") + F.col("_size") + F.lit(back - 1).cast("long")
        reach = F.call_function("div", last, size)
    homes = F.sequence(F.col("_home"), reach)
    if ahead:
        before = F.lag("_home").over(along)
        placed = placed.withColumn("_prior", F.when(before < F.col("_home"), before))
        homes = F.array_compact(F.array_append(homes, F.col("_prior")))
    in_chunk = Window.partitionBy(*keys, CHUNK)
    return (
        placed.withColumn(CHUNK, F.explode(homes))
        .withColumn(CORE, F.col(CHUNK) == F.col("_home"))
        .withColumn(BASE, F.min("_off").over(in_chunk))
        .withColumn("_live", F.max(CORE).over(in_chunk))
        .filter("_live")
        .select(*keys, *marks, CHUNK, CORE, BASE)
    )

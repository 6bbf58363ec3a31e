"""Row positions, chronological split, walk-forward folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.plans.layout import lay_out


def row_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "row_index",
    with_size: str | None = None,
    max_rows: int | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """0-based position of each row within its group, optionally with the group size."""
    layout = lay_out(df, keys, order, max_rows=max_rows, rows_per_chunk=rows_per_chunk)
    out = layout.df.withColumn(name, layout.position())
    if with_size:
        out = layout.with_size(out, with_size)
    return layout.core(out)


def chrono_split(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    train_ratio: float = 0.8,
    max_rows: int | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """``split`` is train for the first int(n * ratio) rows of a group, else stream.

    ``split_index`` counts from 0 within each part.
    """
    rows = row_index(df, keys, order, "_pos", "_n", max_rows, rows_per_chunk)
    cut = F.floor(F.col("_n") * F.lit(float(train_ratio)))
    first = F.col("_pos") < cut
    return rows.select(
        *df.columns,
        F.when(first, F.lit("train")).otherwise(F.lit("stream")).alias("split"),
        F.when(first, F.col("_pos")).otherwise(F.col("_pos") - cut).alias("split_index"),
    )


def walk_forward_folds(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n_folds: int = 5,
    embargo: int = 0,
    max_rows: int | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """One row per (row, fold it takes part in) with ``fold`` and ``role``.

    Fold f of 1..n_folds-1 trains on the first f blocks, less the last ``embargo``
    rows, and validates on the next block; the last block takes the remainder. The
    few folds of a row come from one literal array, not from a join.
    """
    rows = row_index(df, keys, order, "row_index", "_n", max_rows, rows_per_chunk)
    pos, n = F.col("row_index"), F.col("_n")
    block = F.call_function("div", n, F.lit(n_folds))
    parts = []
    for f in range(1, n_folds):
        start = block * F.lit(f)
        end = n if f == n_folds - 1 else block * F.lit(f + 1)
        role = F.when(pos < start - F.lit(embargo), F.lit("train")).when(
            (pos >= start) & (pos < end), F.lit("validate")
        )
        parts.append(F.struct(F.lit(f).alias("fold"), role.alias("role")))
    taken = F.filter(F.array(*parts), lambda part: part["role"].isNotNull())
    return rows.select(*df.columns, "row_index", F.inline(taken))

"""Joining small side tables: broadcast only what is known to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000


def attach(
    df: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    side_rows: int | None = None,
    how: str = "left",
) -> DataFrame:
    """Equi-join ``side`` onto ``df``.

    ``side_rows`` is an upper bound on the rows of ``side``. Below the limit the
    side is broadcast, so the big side keeps its place and its partitioning. With a
    larger or unknown bound the choice is left to adaptive execution, which also
    splits skewed keys.
    """
    if side_rows is not None and side_rows <= BROADCAST_ROWS:
        side = F.broadcast(side)
    return df.join(side, list(keys), how)

"""Window expressions by name, so that each is planned and evaluated once.

Several features use the same lag or the same count; Spark evaluates every window
expression it is given, equal or not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

BLOCK = 24
_STATS = {
    "count": F.count,
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
}


class WindowColumns:
    """Collects window columns over one order; ``onto`` adds them to a frame.

    Stage 0 are trailing frames over the data, stage 1 projections of them, stage 2
    lags of both. All share one partitioning and sort. Lags come last because they
    make rows wide, and because Spark walks the rows once per distinct offset: lags of
    the data and of the frames then share that walk.
    """

    def __init__(self, window: WindowSpec) -> None:
        self.window = window
        self.stages: list[dict[str, Column]] = [{}, {}, {}]

    def _put(self, stage: int, name: str, col: Column) -> Column:
        self.stages[stage].setdefault(name, col)
        return F.col(name)

    def onto(self, df: DataFrame) -> DataFrame:
        for stage in self.stages:
            if stage:
                df = df.withColumns(stage)
        return df

    def lag(self, name: str, k: int) -> Column:
        if k == 0:
            return F.col(name)
        return self._put(2, f"_w_{name}_lag_{k}", F.lag(name, k).over(self.window))

    def lead(self, name: str, k: int = 1) -> Column:
        return self._put(2, f"_w_{name}_lead_{k}", F.lead(name, k).over(self.window))

    def _framed(self, stat: str, name: str, first: int, last: int) -> Column:
        frame = self.window.rowsBetween(first, last)
        alias = f"_w_{name}_{stat}_{-first}_{-last}"
        return self._put(0, alias, _STATS[stat](name).over(frame))

    def full(self, stat: str, name: str, rows: int, last: int = -1) -> Column:
        """A statistic of ``rows`` rows ending at offset ``last``; NULL until all are
        there and known."""
        if stat in ("mean", "std") and rows > BLOCK and rows % BLOCK == 0 and last == -1:
            return self._from_blocks(stat, name, rows // BLOCK)
        first = last - rows + 1
        whole = self._framed("count", name, first, last) == rows
        return F.when(whole, self._framed(stat, name, first, last))

    def _from_blocks(self, stat: str, name: str, blocks: int) -> Column:
        """Mean or sample deviation of several blocks of 24 rows out of theirs.

        A frame of n rows costs n updates per row; the blocks cost 24 and a few lags.
        Squares are combined around the common mean, so nothing cancels.
        """
        mean = self._put(1, f"_w_{name}_block_mean", self.full("mean", name, BLOCK))
        means = [mean] + [
            self._put(
                2,
                f"_w_{name}_block_mean_{j}",
                F.lag(f"_w_{name}_block_mean", BLOCK * j).over(self.window),
            )
            for j in range(1, blocks)
        ]
        common = _total(means) / F.lit(float(blocks))
        if stat == "mean":
            return common
        spread = self.full("std", name, BLOCK)
        square = self._put(
            1, f"_w_{name}_block_square", spread * spread * F.lit(float(BLOCK - 1))
        )
        squares = [square] + [
            self._put(
                2,
                f"_w_{name}_block_square_{j}",
                F.lag(f"_w_{name}_block_square", BLOCK * j).over(self.window),
            )
            for j in range(1, blocks)
        ]
        between = _total([(m - common) * (m - common) for m in means])
        rows = BLOCK * blocks
        return F.sqrt(
            (_total(squares) + F.lit(float(BLOCK)) * between) / F.lit(float(rows - 1))
        )


def _total(cols: list[Column]) -> Column:
    out = cols[0]
    for col in cols[1:]:
        out = out + col
    return out

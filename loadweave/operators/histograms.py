"""Boosted regression trees from histograms of binned columns, for many rows.

The trees are those of Spark ML's ``DecisionTreeRegressor``: up to ``BINS`` bins a feature with
bounds at equal counts of a drawn ``DRAWN`` rows (all of fewer), grown level by level by the
greatest loss of variance, least rows 1. What differs is the work for them: the rows are read and binned once for
all fits, into blocks of one byte a value, and a level is one pass over a fit's blocks, whose tasks
hand a histogram each to the driver. Spark ML would read and bin the rows anew for every tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from loadweave.session import checkpointed, ship_package

#: As Spark ML has them.
BINS, DRAWN = 32, 10_000
PURE = 2.0**-52
KNOWN, HELD = 0, 1
NAMES = ("n_known", "n", "bins", "target", "so_far")
BLOCK_SCHEMA = "n_known_{i} int, n_{i} int, bins_{i} binary, target_{i} binary, so_far_{i} binary"


@dataclass(frozen=True)
class Tree:
    """Nodes by number, the root first. A row goes ``left`` if its value of ``feature`` is at most
    ``bound``, that is if its bin is at most ``code``; a leaf leads to itself."""

    n_features: int
    feature: tuple[int, ...]
    bound: tuple[float, ...]
    code: tuple[int, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    value: tuple[float, ...]
    gain: tuple[float, ...]
    depth: int

    @property
    def featureImportances(self) -> DenseVector:
        """Normalised gain per feature, as of Spark's trees."""
        total = np.zeros(self.n_features)
        for node, gain in enumerate(self.gain):
            if self.left[node] != node:
                total[self.feature[node]] += gain
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def sql(self, features: Sequence[str], node: int = 0) -> str:
        """The tree as a nested CASE over the expressions of its features."""
        if self.left[node] == node:
            return f"{self.value[node]!r}D"
        below, above = (self.sql(features, n) for n in (self.left[node], self.right[node]))
        test = f"{features[self.feature[node]]} <= {self.bound[node]!r}D"
        return f"CASE WHEN {test} THEN {below} ELSE {above} END"

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The node each row (a column of ``bins``) ends in."""
        rows, at = np.arange(bins.shape[1]), np.zeros(bins.shape[1], dtype=np.intp)
        feature, code, left, right = map(np.array, (self.feature, self.code, self.left, self.right))
        for _ in range(self.depth):
            at = np.where(bins[feature[at], rows] <= code[at], left[at], right[at])
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.places(bins)]


class Growing:
    """A tree in the making; ``open`` are the nodes of its last level that may yet be split."""

    def __init__(self, bounds: Sequence[np.ndarray]) -> None:
        self.bounds = bounds
        self.rows: list[list] = []  # feature, bound, code, left, right, value, gain
        self.open = [self._leaf(0.0)]
        self.depth = 0

    def _leaf(self, value: float) -> int:
        n = len(self.rows)
        self.rows.append([0, 0.0, BINS, n, n, value, 0.0])
        return n

    def split(self, counts: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> None:
        """Takes the histograms (feature, open node, bin) and the sums of squares of the open
        nodes; splits each node where that pays, the first of equal splits."""
        below, low = counts.cumsum(axis=2)[:, :, :-1], sums.cumsum(axis=2)[:, :, :-1]
        n, s = counts.sum(axis=2)[:, :, None], sums.sum(axis=2)[:, :, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = low**2 / below + (s - low) ** 2 / (n - below) - s**2 / n
        there = np.arange(BINS - 1) < np.array([len(b) for b in self.bounds])[:, None]
        gain[(below < 1) | (n - below < 1) | ~there[:, None, :]] = -np.inf
        opened = []
        for i, node in enumerate(self.open):
            rows, total = n[0, i, 0], s[0, i, 0]
            if not rows:
                continue
            self.rows[node][5] = float(total / rows)
            spread = squares[i] / rows - (total / rows) ** 2
            f, code = np.unravel_index(np.argmax(gain[:, i, :]), gain[:, i, :].shape)
            best = gain[f, i, code]
            if not best > 0 or abs(spread) < PURE:
                continue
            ends = [low[f, i, code] / below[f, i, code]]
            ends.append((total - low[f, i, code]) / (rows - below[f, i, code]))
            left, right = (self._leaf(float(v)) for v in ends)
            bound = float(self.bounds[f][code])
            self.rows[node] = [int(f), bound, int(code), left, right, self.rows[node][5], float(best)]
            opened += [left, right]
        self.open = opened
        self.depth += 1

    def tree(self) -> Tree:
        return Tree(len(self.bounds), *map(tuple, zip(*self.rows)), self.depth)

    def pruned(self) -> Tree:
        """Two leaves of the same value are one."""
        for at, row in reversed([*enumerate(self.rows)]):
            left, right = (self.rows[n] for n in row[3:5])
            leaves = left[3] == left[4] and right[3] == right[4]
            if row[3] != row[4] and leaves and left[5] == right[5]:
                row[:] = [0, 0.0, BINS, at, at, left[5], 0.0]
        return self.tree()


def bounds_of(values: np.ndarray) -> np.ndarray:
    """Up to ``BINS - 1`` values between distinct ones, at equal counts, as Spark ML finds them."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) < BINS:
        return middles
    stride = len(values) / BINS
    upto, aim, taken = np.cumsum(counts), stride, []
    for i in range(len(middles)):
        if abs(upto[i] - aim) < abs(upto[i + 1] - aim):
            taken.append(i)
            aim += stride
    return middles[taken]


@dataclass(frozen=True)
class Fit:
    """The rows of one fit: blocks of bins, the number and mean of those not held out, and the
    bounds of each feature's bins."""

    blocks: DataFrame
    n: int
    base: float
    bounds: tuple[np.ndarray, ...]


def fits_of(
    rows: DataFrame, names: Sequence[str], roles: Sequence[Column], draw: Column
) -> tuple[DataFrame, list[Fit]]:
    """The rows of several fits, binned in one pass and kept; also the frame to unpersist.

    ``rows``: the features ``names`` and ``target``. A fit's role of a row is ``KNOWN``, ``HELD`` or
    another number for none. Bounds are cut from the fit's known rows alone, ``DRAWN`` of them by
    the hash ``draw``.
    """
    ship_package(rows.sparkSession)
    taken = [F.coalesce(role.cast("int"), F.lit(-1)) for role in roles]
    known = [role == F.lit(KNOWN) for role in taken]
    told = [F.struct(F.count_if(k), F.avg(F.when(k, F.col("target")))) for k in known]
    told = [(int(n), float(base or 0.0)) for n, base in rows.agg(*told).first()]
    shares = [int(min(1.0, DRAWN / n if n else 1.0) * 2**32) for n, _ in told]
    drawn = [k & (F.pmod(draw, F.lit(2**32)) < F.lit(share)) for k, share in zip(known, shares)]
    any_of = drawn[0]
    for d in drawn[1:]:
        any_of = any_of | d
    values = F.array(*names).alias("x")
    sample = rows.filter(any_of).select(values, F.array(*drawn).alias("in")).toArrow().combine_chunks()
    matrix = _matrix(sample["x"].combine_chunks(), len(names))
    within = _matrix(sample["in"].combine_chunks(), len(roles)).astype(bool)
    bounds = [tuple(bounds_of(column[chosen]) for column in matrix) for chosen in within]
    bases = [base for _, base in told]
    packed = rows.select(values, F.col("target").cast("double"), F.array(*taken).alias("roles"))
    schema = ", ".join(BLOCK_SCHEMA.format(i=i) for i in range(len(roles)))
    blocks = packed.mapInArrow(_packed(len(names), bounds, bases), schema)
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    fits = []
    for i, (n, base) in enumerate(told):
        own = [F.col(f"{name}_{i}").alias(name) for name in NAMES]
        fits.append(Fit(blocks.select(*own).filter("n > 0"), n, base, bounds[i]))
    return blocks, fits


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of ``width`` values, one line per place in them."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(-1, width).T)


def _packed(
    n_features: int, bounds: Sequence[Sequence[np.ndarray]], bases: Sequence[float]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A block per batch and fit: a byte a value, feature by feature, known rows first."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _matrix(batch.column(0), n_features)
            target = batch.column(1).to_numpy(zero_copy_only=False)
            cells, names = [], []
            for i, roles in enumerate(_matrix(batch.column(2), len(bases))):
                known, held = np.flatnonzero(roles == KNOWN), np.flatnonzero(roles == HELD)
                rows = np.concatenate([known, held])
                bins = np.empty((n_features, len(rows)), dtype=np.uint8)
                for f, column in enumerate(values):
                    bins[f] = np.searchsorted(bounds[i][f], column[rows])
                cells += [pa.array([len(known)], pa.int32()), pa.array([len(rows)], pa.int32())]
                for part in (bins, target[rows], np.full(len(rows), bases[i])):
                    cells.append(pa.array([_squeezed(part)], pa.binary()))
                names += [f"{name}_{i}" for name in NAMES]
            yield pa.RecordBatch.from_arrays(cells, names=names)

    return pack


def _squeezed(part: np.ndarray) -> bytes:
    return pa.compress(part.tobytes(), codec="lz4", asbytes=True)


def _blocks(batch: pa.RecordBatch, n_features: int) -> Iterator[tuple]:
    """The blocks of a batch: number of known rows, bins, target, running forecast."""
    for known, n, bins, *cells in zip(*[c.to_pylist() for c in batch.columns]):
        bins = np.frombuffer(pa.decompress(bins, n_features * n, codec="lz4"), dtype=np.uint8)
        target, so_far = (np.frombuffer(pa.decompress(c, 8 * n, codec="lz4")) for c in cells)
        yield known, bins.reshape(n_features, n), target, so_far


def _moved(so_far: np.ndarray, bins: np.ndarray, trees: Sequence[Tree], rate: float) -> np.ndarray:
    for tree in trees:
        so_far = so_far + rate * tree.predict(bins)
    return so_far


def _level(
    n_features: int, trees: Sequence[Tree], rate: float, growing: Tree, open_nodes: Sequence[int]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One pass: per task the histograms of what ``trees`` leave in the open nodes of ``growing``
    (count and sum of every bin), the nodes' sums of squares, and the absolute errors of ``trees``
    on the rows held out with their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = len(open_nodes) + 1  # one more for rows in leaves
        slot = np.full(len(growing.feature), len(open_nodes), dtype=np.intp)
        slot[list(open_nodes)] = np.arange(len(open_nodes))
        counts, sums = np.zeros((2, n_features, wide * BINS))
        squares, missed = np.zeros(wide), np.zeros(2)
        for batch in batches:
            for known, bins, target, so_far in _blocks(batch, n_features):
                left = target - _moved(so_far, bins, trees, rate)
                missed += [np.abs(left[known:]).sum(), len(left) - known]
                if not known:
                    continue
                bins, left = bins[:, :known], left[:known]
                at = slot[growing.places(bins)]
                squares += np.bincount(at, weights=left * left, minlength=wide)
                base = at * BINS
                for f in range(n_features):
                    place = base + bins[f]
                    counts[f] += np.bincount(place, minlength=wide * BINS)
                    sums[f] += np.bincount(place, weights=left, minlength=wide * BINS)
        found = np.concatenate([counts.ravel(), sums.ravel(), squares, missed])
        yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], names=["found"])

    return count


def boost_binned(
    fit: Fit,
    rounds: int,
    patience: int | None,
    depth: int,
    rate: float,
    stop: Callable[[Sequence[float], int], bool],
    checkpoint_every: int,
) -> tuple[list[Tree], list[float]]:
    """Up to ``rounds`` trees on what the mean and the trees before leave, and the mean absolute
    error on the held-out rows after each; fitting ends when ``stop(errors, patience)``."""
    blocks, bounds, n_features = fit.blocks, fit.bounds, len(fit.bounds)
    parallel = 2 * blocks.sparkSession.sparkContext.defaultParallelism
    trees, errors, recent = [], [], []

    def level(growing: Growing) -> tuple:
        """(counts, sums, squares) of the open nodes and (errors, their number) of the trees."""
        work = _level(n_features, list(recent), rate, growing.tree(), growing.open)
        wide = len(growing.open) + 1
        total = 0.0
        for (part,) in blocks.coalesce(parallel).mapInArrow(work, "found binary").collect():
            total = total + np.frombuffer(part, dtype=np.float64)
        size = n_features * wide * BINS
        counts, sums = (total[i * size : (i + 1) * size].reshape(n_features, wide, BINS) for i in (0, 1))
        squares, missed = total[2 * size : 2 * size + wide], total[-2:]
        return (counts[:, :-1], sums[:, :-1], squares[:-1]), missed

    try:
        growing = Growing(bounds)
        found, _ = level(growing)
        while len(trees) < rounds:
            growing.split(*found)
            while growing.open and growing.depth < depth:
                growing.split(*level(growing)[0])
            trees.append(growing.pruned())
            recent.append(trees[-1])
            if patience is None and len(trees) == rounds:
                break
            growing = Growing(bounds)
            found, (miss, held) = level(growing)  # the error so far and the next tree's first level
            if patience is not None:
                errors.append(float(miss / held) if held else None)
                if stop(errors, patience):
                    break
            if len(recent) == checkpoint_every:
                after = checkpointed(_carried(blocks, n_features, list(recent), rate))
                if blocks is not fit.blocks:
                    blocks.unpersist()
                blocks, recent = after.persist(StorageLevel.MEMORY_AND_DISK), []
    finally:
        if blocks is not fit.blocks:
            blocks.unpersist()
    return trees, errors


def _carried(blocks: DataFrame, n_features: int, trees: Sequence[Tree], rate: float) -> DataFrame:
    """The blocks with their running forecast moved on by ``trees``."""

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moved = [_squeezed(_moved(s, b, trees, rate)) for _, b, _, s in _blocks(batch, n_features)]
            columns = [*batch.columns[:-1], pa.array(moved, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    return blocks.mapInArrow(carry, blocks.schema)

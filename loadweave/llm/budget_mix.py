"""Mixing sources to target weights: an exact budget in words, met by a subset sum.

Spark counts the documents of every source by exact length. A source whose target is at
least its size takes every document once; what is left of the target is the remaining
budget. (Where long documents leave a gap, all copies are planned together instead.) Of each length the budget's share is taken first (rounded down), then the longest
lengths that still fit, until at most ``TABLE`` words are left; those are met by a bounded
knapsack over the documents not yet taken (and, to be able to hit the sum, over some that
are given back). The plan of a source is a table of at most one row per length: about the
square root of twice its words in the worst case.

Which documents of a length are taken is decided by a seeded hash of the row. Lengths with
many documents are first split by the hash, so no window sees more than a piece of them.
Targets are found in a table of the sources, of which the driver sees sums alone.

Rules: a null or empty text has size 0 and is never repeated; the null source is a source
of its own and weighs last; rows that share everything are interchangeable; sizes that a
sum cannot meet leave a gap below the target, never above; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadweave.llm.common import n_words, prepare, sealed, stored

#: Words that the knapsack table covers, and documents of one length dealt to one piece.
TABLE = 1 << 16
PIECE = 2000


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float = 2.0) -> DataFrame:
    """Adds ``_target`` to ``sizes`` (_source, _source_size): ``share`` times all words, by weight,
    none above ``most`` times its size.

    Sources are ordered by code point with the null source last; the weights repeat. What
    a full source cannot take is shared again among the others by weight. Every round is one
    sum over the sources, of which there may be any number; full sources stay full.
    """
    repeated = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(repeated, (F.col("_at") % len(weights) + 1).cast("int"))
    rows = stored(_numbered(sizes).withColumn("_weight", weight), "mix-sources")
    total = share * (rows.agg(F.sum("_source_size")).first()[0] or 0)
    limit = F.lit(float(most)) * F.col("_source_size")
    full, n_full = F.lit(False), 0
    while True:
        sums = rows.agg(F.sum(F.when(full, F.col("_source_size"))), F.sum(F.when(~full, F.col("_weight")))).first()
        left, others = total - most * (sums[0] or 0), sums[1]
        if not others:  # all are full, or there is none
            part = F.lit(0.0)
            break
        part = F.lit(float(left)) * F.col("_weight") / F.lit(float(others))
        more = full | (part > limit)
        n_more = rows.where(more).count()
        if n_more == n_full:
            break
        full, n_full = more, n_more
    return rows.select("_source", "_source_size", F.when(full, limit).otherwise(part).alias("_target"))


def _numbered(sizes: DataFrame) -> DataFrame:
    """``sizes`` with the place of each source in the order (_at): its place in its range, after
    the sources of the ranges before."""
    order = [F.col("_source").isNull(), F.col("_source")]
    ranged = stored(sizes.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "mix-ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = offsets.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.join(offsets, "_part").select("_source", "_source_size", (F.col("_before") + within).alias("_at"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that the sum is as near ``budget``
    from below as the lengths allow; none beyond its count."""
    total = int((lengths * counts).sum())
    taken = np.zeros_like(counts)
    if budget <= 0 or not total:
        return taken
    if budget >= total:
        return counts.copy()
    taken = np.array([int(c) * budget // total for c in counts.tolist()], np.int64)
    left = budget - int((lengths * taken).sum())
    order = np.argsort(-lengths, kind="stable")
    for i in order:
        if left <= TABLE // 2:
            break
        if lengths[i]:
            more = min(int(counts[i] - taken[i]), max(0, left - TABLE // 4) // int(lengths[i]))
            taken[i] += more
            left -= more * int(lengths[i])
    # some documents of ordinary length are given back, so that the table has choices
    for i in order[::-1]:
        if left > TABLE // 2:
            break
        if lengths[i] and lengths[i] <= TABLE // 8:
            back = min(int(taken[i]), 2)
            taken[i] -= back
            left += back * int(lengths[i])
    return taken + knapsack(lengths, counts - taken, left)


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset sum: the largest sum within ``budget``, by reachable-sum bit tables.

    Each step offers one power-of-two share of a length's documents; the table of every
    step is kept (at most until the budget itself is reachable) to walk back.
    """
    taken = np.zeros_like(counts)
    steps, reach = [], 1
    mask, goal = (1 << budget + 1) - 1, 1 << budget
    for i in np.argsort(lengths, kind="stable"):
        size, free = int(lengths[i]), int(min(counts[i], budget // lengths[i] if lengths[i] else 0))
        share = 1
        while free > 0 and not reach & goal:
            use = min(share, free)
            steps.append((i, use, size * use, reach))
            reach |= (reach << size * use) & mask
            free -= use
            share *= 2
        if reach & goal:
            break
    at = reach.bit_length() - 1
    for i, use, words, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += use
            at -= words
    return taken


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep_hash: bool = False,
) -> DataFrame:
    """id, source, size, source_size, target and taken (whole copies of the row, in words)."""
    prepare(docs.sparkSession)
    text = F.col(text_col)
    rows = stored(
        docs.select(
            F.col(id_col).alias("_id"),
            F.col(source_col).cast("string").alias("_source"),
            n_words(text).alias("_size"),
            F.xxhash64(F.lit(seed), F.col(id_col), text).alias("_hash"),
        ),
        "mix-sizes",
    )
    by_length = stored(rows.groupBy("_source", "_size").agg(F.count("*").alias("_count")), "mix-lengths")
    words = F.sum(F.col("_size") * F.col("_count")).alias("_source_size")
    listed = targets(by_length.groupBy("_source").agg(words), weights, share, most).withColumnRenamed("_source", "_of")

    def plan(group: pd.DataFrame) -> pd.DataFrame:
        lengths, counts = group["_size"].to_numpy(np.int64), group["_count"].to_numpy(np.int64)
        target, size = int(group["_target"].iloc[0]), int((lengths * counts).sum())
        every, rest = divmod(target, size) if size else (0, 0)
        more = fit(lengths, counts, rest)
        gap = rest - int((lengths * more).sum())
        copies = int(most)
        if gap > 0.001 * target and every < copies:
            # few long documents: let second copies of short ones fill what they leave open
            free = fit(lengths, copies * counts, target)
            if target - int((lengths * free).sum()) < gap:
                every, more = free // counts, free % counts
        return group.assign(_every=every, _more=more)

    plans = (
        by_length.join(listed, F.col("_source").eqNullSafe(F.col("_of")))
        .select("_source", "_size", "_count", "_source_size", "_target")
        .groupBy("_source")
        .applyInPandas(
            plan,
            "_source string, _size long, _count long, _source_size long, _target double, _every long, _more long",
        )
    )
    plans = stored(plans, "mix-plans")
    return _select(rows, plans).select(
        F.col("_id").alias(id_col),
        F.col("_source").alias(source_col),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * (F.col("_every") + F.col("_extra"))).alias("taken"),
        *([(F.col("_every") + F.col("_extra")).alias("times"), F.col("_hash")] if keep_hash else []),
    )


def mixed_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **settings,
) -> DataFrame:
    """The rows of ``docs`` (all columns), each as often as the mix takes it.

    A row of size 0 is taken as an even share would take it: once if its source is taken
    whole, else not. Rows that share id, source and text hash share what is taken of them.
    """
    docs, names, back = sealed(docs)
    id_col, text_col, source_col = names[id_col], names[text_col], names[source_col]
    taken = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, keep_hash=True, **settings)
    counts = stored(
        taken.groupBy(F.col(id_col).alias("_i"), F.col("_hash").alias("_h")).agg(
            F.sum("times").alias("_times"), F.count("*").alias("_same")
        ),
        "mix-times",
    )
    own = F.xxhash64(F.lit(settings.get("seed", 42)), docs[id_col], docs[text_col])
    same = docs[id_col].eqNullSafe(counts["_i"]) & (own == counts["_h"])
    joined = docs.join(counts, same)
    if counts.where("_same > 1").limit(1).count():
        # rows alike in id and text: the times taken are dealt to them in turn
        turn = Window.partitionBy("_i", "_h").orderBy(*[F.col(c) for c in docs.columns if c != text_col])
        k = F.row_number().over(turn) - 1
        joined = joined.withColumn("_times", F.floor((F.col("_times") + F.col("_same") - 1 - k) / F.col("_same")))
    every = F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))
    return back(joined.where("_times > 0").withColumn("_times", every))


def _select(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Every row with ``_extra``: 1 for the ``_more`` rows of its length that come first."""
    key = [F.coalesce(F.col("_source"), F.lit("")), F.col("_source").isNull(), F.col("_size")]
    plans = plans.withColumns({"_k": F.struct(*key)}).select("_k", "_source_size", "_target", "_every", "_more", "_count")
    all_rows = rows.withColumn("_k", F.struct(*key)).join(plans, "_k")
    whole = (F.col("_more") == 0) | (F.col("_more") == F.col("_count"))
    split = F.when(whole, F.lit(-1)).otherwise(
        F.pmod(F.shiftrightunsigned("_hash", 12), F.ceil(F.col("_count") / PIECE))
    )
    dealt = all_rows.withColumn("_piece", split)
    pieces = dealt.where("_piece >= 0").groupBy("_k", "_piece").agg(F.count("*").alias("_n"), F.first("_more").alias("_goal"))
    before = Window.partitionBy("_k").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_left", F.col("_goal") - F.coalesce(F.sum("_n").over(before), F.lit(0))).select(
        "_k", "_piece", "_n", "_left"
    )
    dealt = dealt.join(pieces, ["_k", "_piece"], "left")
    cut = F.expr("_left > 0 and _left < _n")
    ranked = dealt.where(cut).withColumn(
        "_row", F.row_number().over(Window.partitionBy("_k", "_piece").orderBy("_hash", "_id"))
    )
    clear = dealt.where(~F.coalesce(cut, F.lit(False)))
    kept = ["_id", "_source", "_size", "_source_size", "_target", "_every", "_hash"]
    first = ranked.select(*kept, (F.col("_row") <= F.col("_left")).cast("long").alias("_extra"))
    rest = clear.select(
        *kept,
        F.when(F.col("_piece") < 0, (F.col("_more") > 0).cast("long"))
        .otherwise((F.col("_left") >= F.col("_n")).cast("long"))
        .alias("_extra"),
    )
    return first.unionByName(rest)

"""SimHash near-duplicates, found by the generalised pigeonhole principle.

Distinct fingerprints are compared, not documents. Bits that go together are grouped into
the same of m partitions. Two fingerprints within ``BITS`` differing bits differ, for any
thresholds t that sum to BITS - m + 1, by at most t[i] bits in some partition i; a threshold
of -1 leaves the partition out. The thresholds, and m itself, come from dynamic programming
on the expected number of candidates, estimated on at most ``SAMPLE`` fingerprints (those of
the least hash). The estimate only moves work about: results do not depend on it.

Every fingerprint is probed under its partition's value and the values up to t[i] bits
away. Keys met once are dropped; a key with more than ``CHUNK`` fingerprints is cut into
chunks, and every pair of chunks is a task of its own. A task verifies all its candidates
but emits only a spanning forest of the links, never the pairs of a dense group.

Rules: a null text is empty; texts without a word have fingerprint 0 and are linked like
any other; repeated rows share a fingerprint; a null id never names a component unless all
ids of it are null; an empty table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import append_columns, byte_texts, map_batches, prepare, sealed, stored
from loadweave.llm.components import components

WORDS = 4
SEED = 42
BITS = 4
SAMPLE = 2048
CHUNK = 2048
#: Groups of up to this many fingerprints are compared by shifts, larger ones as matrices.
SMALL = 16
#: Relative costs of one probe row and of one verified pair.
PROBE_COST, PAIR_COST = 3.0, 0.006
SHINGLES_AT_ONCE = 1 << 18


def fingerprint(text: bytes) -> int:
    """64 majority bits of the hashes of a text's word shingles, repeats included."""
    import xxhash

    words = text.lower().split()  # of bytes: only A-Z are lowered, only ASCII spaces part
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size) - 1
    starts = ends - size + 1
    k = min(WORDS, len(words))
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(starts), SHINGLES_AT_ONCE):
        pairs = zip(starts[i : i + SHINGLES_AT_ONCE], ends[i : i + SHINGLES_AT_ONCE])
        h = np.array([digest(joined[a:b], SEED) for a, b in pairs], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id and _fp (the 64 bits as a signed integer) of every row."""
    kind = dict(docs.dtypes)[id_col]
    return map_batches(
        docs.select(id_col, text_col),
        lambda b: {"_id": b.column(0), "_fp": _signed([fingerprint(t) for t in byte_texts(b.column(1))])},
        f"_id {kind}, _fp long",
    )


def bit_counts(points: DataFrame) -> np.ndarray:
    """How often bits i and j are both set, over all fingerprints: one 64 x 64 table."""

    def run(batches):
        total = np.zeros((64, 64), np.int64)
        for batch in batches:
            fp = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False))
            bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += np.rint(bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"cell": np.arange(4096), "n": total.ravel()})

    summed = points.select("_fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(4096)
    for row in summed.collect():  # 4096 rows
        out[row["cell"]] = row["n"]
    return out.reshape(64, 64)


def group_bits(both: np.ndarray, n: int, m: int) -> list[list[int]]:
    """m partitions of the 64 bits; each is grown by the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    free, out = list(range(64)), []
    for k in range(m):
        room = len(free) // (m - k)
        first = max(free, key=lambda b: (corr[b, free].sum(), -b))
        group = [first]
        free.remove(first)
        while len(group) < room:
            best = max(free, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        out.append(sorted(group))
    return out


def ball(width: int, radius: int) -> int:
    return sum(comb(width, r) for r in range(radius + 1)) if radius >= 0 else 0


def allocate(groups: list[list[int]], sample: np.ndarray, n: int) -> tuple[float, list[int]]:
    """(cost, threshold per partition) of least cost, by dynamic programming."""
    m, most = len(groups), BITS
    pairs = max(1, len(sample) * (len(sample) - 1) // 2)
    cost = []
    for bits in groups:
        mask = np.uint64(sum(1 << b for b in bits))
        own, near = sample & mask, np.zeros(most + 1)
        for i in range(len(own) - 1):
            d = np.bitwise_count(own[i + 1 :] ^ own[i])
            near += [(d <= t).sum() for t in range(most + 1)]
        row = [0.0]
        for t in range(most + 1):
            part = max(near[t] / pairs, ball(len(bits), t) / 2.0 ** len(bits))
            row.append(PROBE_COST * n * ball(len(bits), t) + PAIR_COST * part * n * n / 2)
        cost.append(row)
    # best[s]: least cost of the partitions so far whose thresholds, each one up, sum to s
    goal = BITS + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        after: dict[int, tuple[float, list[int]]] = {}
        for s, (c, chosen) in best.items():
            for up, more in enumerate(row):
                if s + up <= goal and (s + up not in after or c + more < after[s + up][0]):
                    after[s + up] = c + more, [*chosen, up - 1]
        best = after
    return best[goal] if m else (0.0, [])


def plan(points: DataFrame, n: int) -> list[tuple[int, int, list[int]]]:
    """(partition, mask, flips) for each partition that is probed."""
    sample = points.orderBy(F.xxhash64("_fp"), "_fp").limit(SAMPLE).select("_fp").collect()
    drawn = np.array([r["_fp"] for r in sample], np.int64).view(np.uint64)
    both = bit_counts(points)
    choices = []
    for m in range(2, BITS + 2):
        groups = group_bits(both, n, m)
        choices.append((*allocate(groups, drawn, n), groups))
    _, thresholds, groups = min(choices, key=lambda c: c[0])
    out = []
    for i, (bits, t) in enumerate(zip(groups, thresholds)):
        if t >= 0:
            flips = [sum(1 << b for b in some) for r in range(t + 1) for some in combinations(bits, r)]
            out.append((i, sum(1 << b for b in bits), flips))
    return out


def _long(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def probes(points: DataFrame, parts: list[tuple[int, int, list[int]]]) -> DataFrame:
    """part, key, _fp: the value of each fingerprint in each partition, and those near it."""
    def of(part: int, mask: int, flips: list[int]):
        # the lambda takes one argument: a second one would be given the place in the array
        value = F.col("_fp").bitwiseAND(F.lit(_long(mask)))
        listed = F.lit([_long(f) for f in flips]).cast("array<bigint>")
        return F.transform(
            listed, lambda f: F.struct(F.lit(part).alias("part"), value.bitwiseXOR(f).alias("key"))
        )

    rows = [of(*p) for p in parts]
    every = rows[0] if len(rows) == 1 else F.concat(*rows)
    return points.select("_fp", F.explode(every).alias("_at")).select("_at.part", "_at.key", "_fp")


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a symmetric table of links."""
    free, out = np.ones(len(near), bool), []
    for root in range(len(near)):
        if not free[root]:
            continue
        free[root] = False
        queue = [root]
        while queue:
            i = queue.pop()
            found = np.flatnonzero(near[i] & free)
            free[found] = False
            out += [(i, j) for j in found.tolist()]
            queue += found.tolist()
    return out


def links_of(fp: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among the fingerprints of each group; ``start`` has the groups' first rows."""
    size = np.diff(np.append(start, len(fp)))
    group = np.repeat(np.arange(len(start)), size)
    small = np.repeat(size <= SMALL, size)
    a, b = [], []
    for k in range(1, SMALL):
        left = np.flatnonzero((group[k:] == group[:-k]) & small[k:])
        if not left.size:
            break
        left = left[np.bitwise_count(fp[left] ^ fp[left + k]) <= BITS]
        a.append(fp[left])
        b.append(fp[left + k])
    for s, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist()):
        own = fp[s : s + n]
        near = np.empty((n, n), bool)
        for i in range(0, n, 256):
            near[i : i + 256] = np.bitwise_count(own[i : i + 256, None] ^ own[None, :]) <= BITS
        found = np.array(forest(near), np.int64).reshape(-1, 2)
        a.append(own[found[:, 0]])
        b.append(own[found[:, 1]])
    if not a:
        return fp[:0], fp[:0]
    return np.concatenate(a), np.concatenate(b)


def verified(rows: DataFrame, partitions: int) -> DataFrame:
    """(a, b): links among rows of the same key; rows come as key columns and _fp."""
    keys = [c for c in rows.columns if c != "_fp"]

    def run(batches):
        """Groups arrive sorted; the last group of a batch waits for the next batch."""
        held: list[np.ndarray] = []

        def flush(table: np.ndarray):
            start = np.flatnonzero(np.append(True, (table[1:, :-1] != table[:-1, :-1]).any(1)))
            a, b = links_of(np.ascontiguousarray(table[:, -1]).view(np.uint64), start)
            return pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64)})

        for batch in batches:
            table = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], 1)
            if not len(table):
                continue
            last = int(np.flatnonzero((table[:, :-1] == table[-1, :-1]).all(1))[0])
            if held and (held[-1][-1, :-1] == table[-1, :-1]).all():
                held.append(table)
                continue
            yield flush(np.concatenate([*held, table[:last]])) if held or last else flush(table[:0])
            held = [table[last:]]
        if held:
            yield flush(np.concatenate(held))

    return (
        rows.select(*keys, "_fp")
        .repartition(partitions, *keys)
        .sortWithinPartitions(*keys, "_fp")
        .mapInArrow(run, "a long, b long")
    )


def links(points: DataFrame) -> DataFrame:
    """(a, b): enough links between distinct fingerprints to connect all that are near."""
    spark = points.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = points.count()
    parts = plan(points, n)
    probed = probes(points, parts)
    met = stored(
        probed.groupBy("part", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-keys"
    )
    # a key's chunks: every pair of them is one task, so no task sees more than two chunks
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("_fp"), chunks).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), chunks - 1),
        lambda o: F.struct(F.least(o, own).alias("x"), F.greatest(o, own).alias("y")),
    )
    rows = (
        probed.join(met, ["part", "key"])
        .select("part", "key", "_fp", F.explode(others).alias("_pair"))
        .select("part", "key", "_pair.x", "_pair.y", "_fp")
    )
    return verified(rows, partitions).distinct()


def near_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, _fp and component_id (the smallest id reachable over links) of every row."""
    prepare(docs.sparkSession)
    marked = stored(fingerprints(docs, id_col, text_col), "simhash")
    roots = component_of(marked)
    return marked.join(roots, "_fp").select(F.col("_id").alias(id_col), "_fp", "component_id")


def component_of(marked: DataFrame) -> DataFrame:
    """_fp, _root and component_id of every distinct fingerprint of (_id, _fp)."""
    points = stored(marked.groupBy("_fp").agg(F.min("_id").alias("_rep")), "fingerprints")
    joined = components(links(points))
    rooted = stored(
        points.join(joined, points["_fp"] == joined["node"], "left").select(
            "_fp", "_rep", F.coalesce("root", "_fp").alias("_root")
        ),
        "simhash-roots",
    )
    least = stored(rooted.groupBy("_root").agg(F.min("_rep").alias("component_id")), "simhash-least")
    return stored(rooted.join(least, "_root").select("_fp", "_root", "component_id"), "simhash-components")


def hex_fingerprint(column):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) whose id names their component, one for each.

    Where rows repeat that id, one with the component's least fingerprint stays, any of
    those that share it. A component without an id keeps one row by the same rule.
    """
    prepare(docs.sparkSession)
    docs, names, back = sealed(docs)
    id_col, text_col = names[id_col], names[text_col]
    marked = append_columns(
        docs, text_col, lambda t: {"_fp": _signed([fingerprint(x) for x in t])}, "_fp long"
    )
    slim = stored(marked.select(F.col(id_col).alias("_id"), "_fp"), "simhash")
    named = slim.join(component_of(slim), "_fp").where(F.col("_id").eqNullSafe(F.col("component_id")))
    chosen = stored(
        named.groupBy("_root").agg(F.min("_fp").alias("_kept_fp"), F.first("_id").alias("_kept")),
        "simhash-kept",
    )
    if slim.groupBy("_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() == 0:
        return back(docs.join(chosen, docs[id_col].eqNullSafe(chosen["_kept"]), "left_semi"))
    same = marked[id_col].eqNullSafe(chosen["_kept"]) & (marked["_fp"] == chosen["_kept_fp"])
    return back(marked.join(chosen, same).dropDuplicates(["_root"]))

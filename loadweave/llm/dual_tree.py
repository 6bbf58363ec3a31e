"""Ranked lexical search by two trees: one over the items, one over the documents.

Items come in blocks of bounded size (``BLOCK_BYTES`` of text and ``BLOCK_ITEMS`` items on
average, dealt by hash; an item above that size is a block of its own), so what is sent to the
tasks does not grow with the items. For a block, one pass over the whole
texts keeps of every document its length and how often it holds the terms of the block; Spark
counts documents, lengths and document frequencies. A document is then a sparse vector of what
each of its terms would add to a score, an item a vector of zeros and ones.

Documents are sorted by their strongest term, so that like ones lie together, and each task
builds trees over up to ``TREE`` of them: a leaf holds ``LEAF`` documents, an inner node
``FAN`` leaves, and both hold the coordinate maxima of the vectors below. The items of the
block form a tree as well (sorted the same way), whose nodes hold the union of their terms.
The product of an item node and a document node bounds every score between them. A pair of
nodes is dropped when its bound is below the weakest kth score of the items below; pairs that
are left go down both trees, and at the leaves scores are exact whole numbers. Only a bound
strictly below a kth score drops anything, so ties are kept and the result is exact.

The kth scores are first those of a part of the documents (one in ``FIRST``, by hash), which
bound the final ones from below; the other documents then start with them. At most ``k`` rows
an item and tree leave a task, and Spark ranks them.

Rules: a null text has no terms and such documents and items have no rows; a null doc_id ranks
last among equal scores, and rows with the same doc_id are documents of their own. Repeated
terms of an item count once. Items that are repeated rows each get their rows. Empty tables
give no rows. Scores that would pass 2^63 are not expected: one term adds at most 45 * 10^9.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadweave.llm.common import arrow_schema, ascii_words, byte_texts, prepare, stored

K = 10
#: Bytes of item text, and items, that make a block, on average.
BLOCK_BYTES, BLOCK_ITEMS = 128 << 10, 256
#: Documents of a leaf, leaves of an inner node, documents of one tree, items of an item node.
LEAF, FAN, TREE = 64, 8, 4096
ITEM_LEAF = 16
#: One document in so many (by hash) goes first, to give the others a kth score to begin with.
FIRST = 16


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def gains(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term with ``tf`` occurrences adds to a score."""
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def length_terms(n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """m of documents of ``n`` terms; exact also where products pass 2^63."""
    if int(n.max(initial=0)) * 90 * n_docs < 1 << 62:
        return 10 + (90 * n * n_docs) // length
    return np.array([10 + 90 * int(x) * n_docs // length for x in n], dtype=np.int64)


class Block:
    """The item side: the tree over the items of a block and their terms."""

    def __init__(self, items: list[tuple[int, np.ndarray]], n_terms: int, weights: np.ndarray):
        """``items``: number and term ids of each; sorted by strongest term for the tree."""
        order = sorted(items, key=lambda it: (int(it[1][np.argmax(weights[it[1]])]), it[0]))
        self.number = np.array([it[0] for it in order], dtype=np.int64)
        self.holds = np.zeros((len(order), n_terms), dtype=np.float64)
        for row, (_, terms) in enumerate(order):
            self.holds[row, terms] = 1.0
        self.first = np.arange(0, len(order), ITEM_LEAF)
        self.nodes = np.maximum.reduceat(self.holds, self.first, axis=0)
        self.node_of = np.arange(len(order)) // ITEM_LEAF


class Best:
    """The k best (score, place of the document) of every item, with its kth score."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.copy()
        self.scores: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(floors)
        self.places: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(floors)

    def add(self, item: int, scores: np.ndarray, places: np.ndarray) -> None:
        """``places`` number the documents in ascending order of their id."""
        good = (scores >= self.floors[item]) & (scores > 0)
        if not good.any():
            return
        scores = np.concatenate([self.scores[item], scores[good]])
        places = np.concatenate([self.places[item], places[good]])
        order = np.lexsort((places, -scores))[: self.k]
        self.scores[item], self.places[item] = scores[order], places[order]
        if len(order) == self.k:
            self.floors[item] = max(self.floors[item], scores[order[-1]])


class DocumentTree:
    """Sparse document vectors in leaves and inner nodes with coordinate maxima."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, adds: np.ndarray):
        """Document d has the coordinates ``terms[starts[d]:starts[d + 1]]``."""
        self.starts, self.adds = starts, adds
        self.columns, self.terms = np.unique(terms, return_inverse=True)
        docs = len(starts) - 1
        self.doc_of = np.repeat(np.arange(docs), np.diff(starts))
        leaves = -(-docs // LEAF)
        self.leaf_max = np.zeros((leaves, len(self.columns)))
        np.maximum.at(self.leaf_max, (self.doc_of // LEAF, self.terms), adds)
        self.node_max = np.maximum.reduceat(self.leaf_max, np.arange(0, leaves, FAN), axis=0)

    def leaf(self, number: int) -> tuple[int, np.ndarray, np.ndarray]:
        """First document, columns in use and dense vectors of a leaf."""
        first = number * LEAF
        a, b = self.starts[first], self.starts[min(first + LEAF, len(self.starts) - 1)]
        used, at = np.unique(self.terms[a:b], return_inverse=True)
        dense = np.zeros((min(LEAF, len(self.starts) - 1 - first), len(used)))
        dense[self.doc_of[a:b] - first, at] = self.adds[a:b]
        return first, used, dense


def search(tree: DocumentTree, places: np.ndarray, block: Block, best: Best) -> int:
    """Puts the tree's documents into ``best``; returns how many leaves had to be scored.

    Doubles hold the sums exactly: a score is a whole number far below 2^53.
    """
    holds = block.holds[:, tree.columns]
    nodes = block.nodes[:, tree.columns]
    node_bound = nodes @ tree.node_max.T
    live = (node_bound >= weakest(block, best)[:, None]) & (node_bound > 0)
    scored = 0
    todo: list[tuple[float, int]] = []
    for node in np.flatnonzero(live.any(axis=0)):
        leaves = np.arange(node * FAN, min((node + 1) * FAN, len(tree.leaf_max)))
        bound = nodes[live[:, node]] @ tree.leaf_max[leaves].T
        todo += [(float(b), int(leaf)) for b, leaf in zip(bound.max(axis=0), leaves)]
    for _, leaf in sorted(todo, reverse=True):  # likely leaves first: they lift the kth scores
        near = (nodes @ tree.leaf_max[leaf] >= weakest(block, best)) & live[:, leaf // FAN]
        items = np.flatnonzero(near[block.node_of])
        if len(items):
            bound = holds[items] @ tree.leaf_max[leaf]
            items = items[(bound >= best.floors[items]) & (bound > 0)]
        if not len(items):
            continue
        scored += 1
        first, used, dense = tree.leaf(leaf)
        scores = np.rint(holds[np.ix_(items, used)] @ dense.T).astype(np.int64)
        hopeful = (scores.max(axis=1) >= best.floors[items]) & (scores.max(axis=1) > 0)
        for item, line in zip(items[hopeful], scores[hopeful]):
            best.add(int(item), line, places[first : first + len(line)])
    return scored


def weakest(block: Block, best: Best) -> np.ndarray:
    """Per item node, the least kth score of its items."""
    return np.minimum.reduceat(best.floors, block.first)


def doc_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms), terms and tfs (those of the vocabulary) of documents with terms."""
    words = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = "doc_id long, n long, terms array<int>, tfs array<long>"
    kinds = arrow_schema(schema)

    def run(batches):
        known = words.value
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text"))):
                found = ascii_words(text)
                if found:
                    held = {known[t]: c for t, c in Counter(found).items() if t in known}
                    rows.append((doc, len(found), list(held), list(held.values())))
            columns = zip(*rows) if rows else [()] * 4
            arrays = [pa.array(list(c), f.type) for c, f in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, schema=kinds)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def tree_rows(
    index: DataFrame,
    items: list[tuple[int, list[int]]],
    weights: list[int],
    floors: list[int],
    n_docs: int,
    length: int,
    k: int,
) -> DataFrame:
    """The best rows of every tree: item number, doc_id, score."""
    given = index.sparkSession.sparkContext.broadcast((items, weights, floors))
    schema = "number long, doc_id long, score long"
    kinds = arrow_schema(schema)

    def run(batches):
        items, weights, floors = given.value
        w = np.array(weights, dtype=np.int64)
        block = Block([(i, np.array(t, dtype=np.int64)) for i, t in items], len(w), w)
        lows = dict(zip((i for i, _ in items), floors))
        best = Best(np.array([lows[i] for i in block.number], dtype=np.int64), k)
        ids: list = []
        # the block's k best are kept over all trees of a task, by place in rising doc_id
        held: dict[int, list[tuple[int, object]]] = {}

        def finish(part: pa.Table) -> None:
            docs = part.column("doc_id").to_pylist()
            rank = sorted(range(len(docs)), key=lambda i: (docs[i] is None, docs[i] or 0))
            place = np.empty(len(docs), dtype=np.int64)
            place[rank] = np.arange(len(docs))
            terms = part.column("terms").combine_chunks()
            sizes = np.diff(terms.offsets.to_numpy())
            flat = terms.flatten().to_numpy().astype(np.int64)
            tf = part.column("tfs").combine_chunks().flatten().to_numpy()
            m = length_terms(part.column("n").to_numpy(), n_docs, length)
            adds = gains(w[flat], tf, np.repeat(m, sizes))
            starts = np.concatenate([[0], np.cumsum(sizes)])
            local = Best(best.floors, k)
            search(DocumentTree(starts, flat, adds), place, block, local)
            best.floors = local.floors
            for item in range(len(block.number)):
                if len(local.scores[item]):
                    more = [(int(s), docs[rank[p]]) for s, p in zip(local.scores[item], local.places[item])]
                    both = held.get(item, []) + more
                    both.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
                    held[item] = both[:k]
                    if len(held[item]) == k:
                        best.floors[item] = max(best.floors[item], held[item][-1][0])

        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, TREE - rows)
                at, rows = at + part.num_rows, rows + part.num_rows
                waiting.append(part)
                if rows == TREE:
                    finish(pa.Table.from_batches(waiting))
                    waiting, rows = [], 0
        if rows:
            finish(pa.Table.from_batches(waiting))
        out = [(int(block.number[item]), doc, score) for item, found in held.items() for score, doc in found]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(zip(*out), kinds)], schema=kinds
            )

    return index.select("doc_id", "n", "terms", "tfs").mapInArrow(run, schema)


def clustered(index: DataFrame, weights: list[int]) -> DataFrame:
    """Documents that hold a term of the block, like ones together: dealt by ranges of their
    strongest term, a common one's documents by hash to several ranges."""
    given = index.sparkSession.sparkContext.broadcast(weights)
    schema = "doc_id long, n long, terms array<int>, tfs array<long>, strongest int"
    kinds = arrow_schema(schema)

    def run(batches):
        w = np.array(given.value, dtype=np.int64)
        for batch in batches:
            sizes = np.diff(batch.column("terms").offsets.to_numpy())
            flat = batch.column("terms").flatten().to_numpy()
            gain = w[flat] * np.log1p(batch.column("tfs").flatten().to_numpy())
            doc = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((flat, -gain, doc))
            strongest = flat[order][np.cumsum(sizes) - sizes]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(strongest, pa.int32())], schema=kinds
            )

    holding = index.select("doc_id", "n", "terms", "tfs").filter(F.size("terms") > 0)
    return (
        holding.mapInArrow(run, schema)
        .withColumn("spread", F.xxhash64("doc_id", "n", "terms"))
        .repartitionByRange("strongest", "spread")
        .sortWithinPartitions("strongest", "n", "spread")
    )


def best_of(rows: DataFrame, k: int) -> DataFrame:
    """Rank 1..k per item by score, then doc_id (null last)."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def search_block(docs: DataFrame, items: list[tuple[int, list[bytes]]], k: int) -> DataFrame | None:
    """number, doc_id, score, rank of a block's items; None where there is nothing to find."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, ts in items for t in ts}))}
    if not vocabulary:
        return None
    index = stored(doc_terms(docs, vocabulary), "term-index")
    n_docs, length = index.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    counted = index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    held = {r["t"]: r["df"] for r in counted.collect()}  # no more than the block's terms
    weights = [weight(n_docs, held.get(i, 0)) for i in range(len(vocabulary))]
    wanted = [(i, [vocabulary[t] for t in ts]) for i, ts in items if ts]
    ready = stored(clustered(index, weights), "clustered-index")
    early = F.pmod(F.xxhash64("terms", "n", "doc_id"), F.lit(FIRST)) == 0
    floors = [0] * len(wanted)
    found = []
    for part in (ready.filter(early), ready.filter(~early)):
        rows = tree_rows(part, wanted, weights, floors, n_docs, length, k)
        found.append(stored(best_of(rows, k), "tree-rows"))
        kth = found[-1].filter(F.col("rank") == k).select("number", "score").collect()
        lows = {r["number"]: r["score"] for r in kth}
        floors = [lows.get(i, 0) for i, _ in wanted]
    both = found[0].unionByName(found[1]).drop("rank")
    return best_of(both, k)


def search_items(
    docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """item_id, rank, doc_id, score: every item's ``k`` best documents with a score above 0."""
    spark = prepare(docs.sparkSession)
    text = F.coalesce("text", F.lit("")).alias("text")
    numbered = stored(
        items.select("item_id", text).withColumn("number", F.monotonically_increasing_id()),
        "search-items",
    )
    size = F.octet_length("text")
    long = size > block_bytes
    count, total = numbered.agg(F.count_if(~long), F.sum(F.when(~long, size))).first()
    blocks = max((total or 0) // block_bytes, count // BLOCK_ITEMS) + 1
    number = F.pmod(F.xxhash64("number"), F.lit(blocks))
    dealt = [numbered.filter(~long & (number == b)) for b in range(blocks)]
    own = [r["number"] for r in numbered.filter(long).select("number").collect()]
    dealt += [numbered.filter(F.col("number") == n) for n in own]
    found = None
    for block in dealt:
        rows = block.select("number", "text").collect()  # bounded, see the head
        raw = [(r["number"], r["text"].encode("utf-8", "replace")) for r in rows]
        part = search_block(docs, [(n, sorted(set(ascii_words(t)))) for n, t in raw], k)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found.join(numbered.select("number", "item_id"), "number").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
    )


#: DuckDB SQL of the whole search, without any pruning.
SEARCH_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL),
docs AS (SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n, terms FROM words WHERE len(terms) > 0),
totals AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM docs),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (SELECT item_id, r, doc_id, CAST(sum(
    CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll)))) AS BIGINT) AS score
  FROM wanted JOIN tf USING (term) JOIN df USING (term) CROSS JOIN totals GROUP BY ALL),
ranked AS (SELECT item_id, doc_id, score,
    CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

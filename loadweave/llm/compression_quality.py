"""A quality classifier from compression: which of two dictionaries shortens a text more.

A bounded, seeded sample of labelled rows (at most ``ROWS`` of each class; a dictionary
holds at most ``DICTIONARY`` bytes, ``PASSAGE`` of each text) gives one zstandard dictionary
of good and one of bad text. A text is compressed with both, whole, in blocks of ``UNIT``
bytes. The difference of the compressed sizes over their sum, the same over the text's
size, and how far the text shrinks at all, are calibrated to a probability by logistic
regression on sampled rows that gave no dictionary. The score of a text depends on its
bytes alone.

Rules: a null text is empty; an empty text scores the calibrated share of label 1; rows with a
null id are not held out; labels that are null or lack a document are not learnt from;
with no rows of one class every text scores the share of label 1 (1/2 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import byte_texts, map_batches, prepare, shipped

ROWS = 6000
DICTIONARY = 512 << 10
PASSAGE = 2000
UNIT = 4096
LEVEL = 3
THRESHOLD = 0.3
FOLDS = 5


@dataclass(frozen=True)
class Dictionaries:
    good: bytes
    bad: bytes


class _OfProcess(dict):
    """What a process keeps for itself: it is sent to others empty."""

    def __reduce__(self):
        return type(self), ()


_COMPRESSORS = _OfProcess()


def compressors(pair: Dictionaries) -> tuple:
    """Both compressors, built once per worker."""
    import zstandard

    key = hash(pair)
    if key not in _COMPRESSORS:
        made = []
        for content in (pair.good, pair.bad):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            made.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )
        _COMPRESSORS.clear()
        _COMPRESSORS[key] = tuple(made)
    return _COMPRESSORS[key]


def features(texts: list[bytes], pair: Dictionaries) -> np.ndarray:
    """Row per text: normalised size differences, and the shares it shrinks to."""
    good, bad = compressors(pair)
    out = np.zeros((len(texts), 4))
    for i, text in enumerate(texts):
        if not text:
            continue
        g = b = 0
        for at in range(0, len(text), UNIT):
            block = text[at : at + UNIT]
            g += len(good.compress(block))
            b += len(bad.compress(block))
        share = (g + b) / (2 * len(text))
        out[i] = (b - g) / (g + b), (b - g) / len(text), min(share, 1.5), min(share, 1.5) ** 2
    return out


@dataclass(frozen=True)
class Model:
    pair: Dictionaries
    weights: tuple[float, ...]
    mean: tuple[float, ...]
    spread: tuple[float, ...]
    share: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.share)
        x = (features(texts, self.pair) - self.mean) / self.spread
        z = self.weights[0] + x @ np.array(self.weights[1:])
        score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return np.where([bool(t) for t in texts], score, self.share)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights (intercept first) by Newton steps on the penalised likelihood."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (p - y) + ridge * len(y) * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(y) * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def held_out(id_col):
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> Model:
    """Learn from labelled rows that are not held out; no more than ROWS of each class.

    Of documents that share a drawn id the least text counts, once.
    """
    prepare(docs.sparkSession)
    seeded = F.xxhash64(F.lit(7), F.col(id_col))
    known = labels.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), seeded.alias("_order"))
    counts = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    total = counts.get(0, 0) + counts.get(1, 0)
    share = counts.get(1, 0) / total if total else 0.5
    if not counts.get(0) or not counts.get(1):
        return Model(Dictionaries(b"", b""), (), (), (), share)
    drawn = known.where("_label = 0").orderBy("_order", "_id").limit(ROWS).unionByName(
        known.where("_label = 1").orderBy("_order", "_id").limit(ROWS)
    )
    # at most two times ROWS ids go to every task
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).join(
        F.broadcast(drawn), F.col("_doc") == F.col("_id")
    )
    # one text for each drawn id, the least if the id repeats: what is collected below is bounded
    texts = texts.groupBy("_id", "_label", "_order").agg(F.min("_text").alias("_text"))
    for_words = F.pmod("_order", F.lit(2)) == 0
    place = F.pmod(F.shiftrightunsigned("_order", 8), F.greatest(F.length("_text") - PASSAGE, F.lit(1))).cast("int") + 1
    per_class = DICTIONARY // PASSAGE
    passages = texts.where(for_words & (F.length("_text") > 0)).select("_label", "_order", F.substring(F.col("_text"), place, PASSAGE).alias("_passage"))
    content = {}
    for label in (0, 1):
        rows = passages.where(F.col("_label") == label).orderBy("_order", "_passage").limit(4 * per_class).collect()
        content[label] = b"\n".join(r["_passage"].encode()[:PASSAGE] for r in rows)[:DICTIONARY]
    pair = Dictionaries(content[1], content[0])
    rest = map_batches(
        texts.where(~for_words).select("_text", "_label"),
        lambda b: dict(zip("abcd", features(byte_texts(b.column(0)), pair).T)) | {"y": b.column(1)},
        "a double, b double, c double, d double, y int",
    )
    table = np.array([tuple(r) for r in rest.collect()], float).reshape(-1, 5)  # at most 2 ROWS
    x, y = table[:, :4], table[:, 4]
    if not (0 < y.sum() < len(y)):
        return Model(pair, (), (), (), share)
    # rows count so that the classes have their true shares
    order = np.lexsort(table.T)
    x, y = x[order], y[order]
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-9)
    w = logistic((x - mean) / spread, y)
    shift = np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    w[0] += shift
    return Model(pair, tuple(w), tuple(mean), tuple(spread), share)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted of every row."""
    spark = prepare(docs.sparkSession)
    shared = shipped(spark, model)
    kind = dict(docs.dtypes)[id_col]
    scored = map_batches(
        docs.select(id_col, text_col),
        lambda b: {id_col: b.column(0), "score": shared().score(byte_texts(b.column(1)))},
        f"`{id_col}` {kind}, score double",
    )
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", predicted.alias("predicted"))

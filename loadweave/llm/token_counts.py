"""Token counts by a map-side lookup in two tiers; no pre-token is ever shuffled.

A pre-token is a run of word-start marks with what follows up to the next mark or line
feed: no vocabulary piece crosses such a place, so the counts of a text's pre-tokens add
up. First every partition summarises its own pre-tokens in at most ``SUMMARY`` counters
(frequent ones cannot be missed, rare ones fall out) and Spark adds the summaries up. The
``TABLE`` most frequent are encoded once and broadcast as a compact table (bounded by
``TABLE`` entries of at most ``LONGEST`` characters). Everything else is encoded where it
occurs and kept in the worker's cache. The table only saves work: counts do not depend on it.

Rules: null and empty texts have 0 tokens; ``n_bytes`` counts UTF-8 bytes; rows are counted
one by one, repeated or not; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import arrow_schema, prepare, texts

MARK = "▁"
PRE_TOKEN = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")
SUMMARY = 4096
TABLE = 32_768
LONGEST = 32
CACHE = 400_000

_MODELS: dict[str, object] = {}
_CACHES: dict[str, dict[str, int]] = {}


def pieces(text: str) -> list[str]:
    return PRE_TOKEN.findall(MARK + text.replace(" ", MARK)) if text else []


def load(name: str):
    import public_tokenizers
    import sentencepiece

    if name not in _MODELS:
        _MODELS[name] = sentencepiece.SentencePieceProcessor(
            model_file=public_tokenizers.path(name)
        )
    return _MODELS[name]


def encode_lengths(model, tokens: list[str]) -> list[int]:
    """Tokens of each pre-token. The model puts one mark in front of whatever it is given:
    a pre-token that starts with marks is given without its first, any other behind a line
    feed, whose two extra tokens (mark and line feed) are taken off again."""
    asked = [t[1:] if t[0] == MARK else "\n" + t for t in tokens]
    lengths = [len(x) for x in model.encode(asked, num_threads=1)]
    return [
        1 if t == MARK else n if t[0] == MARK else n - 2
        for t, n in zip(tokens, lengths)
    ]


def summarise(docs: DataFrame, text_col: str) -> DataFrame:
    """(token, n): per partition at most SUMMARY counters, by the rule of Misra and Gries."""

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for text in texts(batch.column(0)):
                held.update(t for t in pieces(text) if len(t) <= LONGEST)
                if len(held) > 16 * SUMMARY:
                    held = _reduced(held)
        held = _reduced(held)
        yield pa.RecordBatch.from_pydict(
            {"token": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())}
        )

    return docs.select(text_col).mapInArrow(run, "token string, n long")


def _reduced(held: Counter) -> Counter:
    if len(held) <= SUMMARY:
        return held
    cut = sorted(held.values(), reverse=True)[SUMMARY]
    return Counter({t: n - cut for t, n in held.items() if n > cut})


def frequent_table(docs: DataFrame, name: str, text_col: str = "text") -> tuple[bytes, bytes]:
    """The broadcast table: joined pre-tokens and their lengths, at most TABLE of them."""
    top = (
        summarise(docs, text_col)
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token")
        .limit(TABLE)
    )
    tokens = [r["token"] for r in top.select("token").collect()]
    # a line feed is a pre-token of its own, so it can part the others; its length is 1
    tokens = [t for t in tokens if t != "\n"]
    lengths = encode_lengths(load(name), tokens) if tokens else []
    return "\n".join(tokens).encode(), np.array(lengths, "<u2").tobytes()


def count_tokens(
    docs: DataFrame,
    name: str,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, n_bytes, n_tokens and whether the text is longer than ``limit`` tokens."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(frequent_table(docs, name, text_col))
    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, n_bytes long, n_tokens long, over_limit boolean"
    kinds = arrow_schema(schema)

    def run(batches):
        model = load(name)
        joined, sizes = shared.value
        first = dict(zip(joined.decode().split("\n"), np.frombuffer(sizes, "<u2").tolist()))
        first["\n"] = 1
        first.pop("", None)
        second = _CACHES.setdefault(name, {})
        for batch in batches:
            own = texts(batch.column(1))
            cut = [pieces(t) for t in own]
            missed = {t for p in cut for t in p if t not in first and t not in second}
            fresh = sorted(missed)
            now = dict(zip(fresh, encode_lengths(model, fresh))) if fresh else {}
            totals = []
            for p in cut:
                total = 0
                for t in p:
                    n = first.get(t)
                    if n is None:
                        n = second.get(t)
                        if n is None:
                            n = now[t]
                    total += n
                totals.append(total)
            if len(second) > CACHE:
                second.clear()
            second.update((t, n) for t, n in now.items() if len(t) <= LONGEST)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(kinds.types[0]),
                    pa.array([len(t.encode()) for t in own], pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array([n > limit for n in totals], pa.bool_()),
                ],
                schema=kinds,
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)

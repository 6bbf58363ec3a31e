"""The registered query of every operator, over the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loadweave.llm import (
    bloom_sketch,
    bpe,
    budget_mix,
    compression_quality,
    dac,
    dual_tree,
    license_notices,
    perplexity,
    simhash_links,
    suffix_dedup,
    token_counts,
    whitening,
    wrappers,
)
from loadweave.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_dedup(spark, sf):
    return suffix_dedup.dedup_digests(table(spark, sf, "documents"))


@query
def op2_quality_rules(spark, sf):
    found = perplexity.judged(table(spark, sf, "documents"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(*base, "base_failed", "kept", "log_perplexity")


@query
def op3_compression_quality(spark, sf):
    docs = table(spark, sf, "documents")
    return compression_quality.score(docs, compression_quality.fit(docs, table(spark, sf, "labels")))


@query
def op4_bpe_codec(spark, sf):
    return bpe.token_digests(table(spark, sf, "documents"), "word_bpe_49k.json")


@query
def op5_token_counts(spark, sf):
    return token_counts.count_tokens(table(spark, sf, "documents"), "piece_bpe_32k.model")


@query
def op6_version_sketch(spark, sf):
    return bloom_sketch.version_fingerprints(table(spark, sf, "documents"))


@query
def op7_token_file(spark, sf):
    return dac.token_file_digests(table(spark, sf, "documents"), "byte_bpe_50k.json", end_id=2)


@query
def op8_budget_mix(spark, sf):
    mixed = budget_mix.mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_page_articles(spark, sf):
    return wrappers.extract(table(spark, sf, "pages"))


@query
def op10_simhash_components(spark, sf):
    found = simhash_links.near_components(table(spark, sf, "documents"))
    fingerprint = simhash_links.hex_fingerprint("_fp").alias("fingerprint")
    return found.select("doc_id", fingerprint, "component_id")


@query
def op11_whitened_vectors(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings"))


@query
def op12_license_notices(spark, sf):
    return license_notices.notice_digests(table(spark, sf, "documents"))


@query
def op13_dual_tree_search(spark, sf):
    return dual_tree.search_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


ORACLE["op13_dual_tree_search"] = dual_tree.SEARCH_SQL


def _pipeline(spark, sf):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES["pipeline"] = _pipeline

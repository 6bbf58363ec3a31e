"""From raw documents to tokens: five stages, each written as Parquet and read by the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of documents; what a stage decides is done to the rows it returns. An empty table goes
through every stage as an empty table. All but the last keep columns beside those of
documents, whatever their names; a null in a column that a stage does not read changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadweave.llm import bpe, budget_mix, perplexity, simhash_links, suffix_dedup
from loadweave.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go.

    A null or empty text fails the base rules and goes. Repeated rows are judged alike, so all
    stay or go together. The null language has a band of its own.
    """
    return perplexity.judged(docs, keep=True)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays.

    Of a group the row of the smallest doc_id stays, of rows that repeat it one; a group
    without an id keeps one row. Texts without words share a fingerprint and so are one group.
    """
    return simhash_links.keep_one_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that a repeated 200-byte string covers go; n_chars counts what is left.

    A null text stays null. No row goes: of rows with the same text of 200 bytes or more each
    is left with an empty one. A cut inside a letter drops the letter's other bytes too.
    """
    return suffix_dedup.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as often as the mix takes it: not at all, once or more.

    A null or empty text has size 0 and stands at most once; the null source is a source of its
    own. Which of equally long documents are taken is decided by a seeded hash, so reruns agree.
    """
    return budget_mix.mixed_rows(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text, as digests, of every row of the mix.

    A null text counts as empty; repeated rows each give their row.
    """
    return bpe.token_digests(docs, "word_bpe_49k.json")


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("source mix", source_mix),
    ("BPE tokens", bpe_tokens),
]

#: Perplexity, fingerprints, suffixes, knapsack and merges are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

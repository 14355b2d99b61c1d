"""A corpus cleaned, deduplicated, mixed and tokenized: five stages over ``documents``.

Each stage's rows are written as Parquet and reread as the next one's input.

Defined results: null, empty and letterless texts go in the first stage; of equal
texts and of near duplicates one row stays; empty tables pass every stage as empty
results; very long texts are read whole; a document that the mix takes several times
is encoded as often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regiopanel.llm import bpe, exact_dedup, language_id, mixing, near_dedup
from regiopanel.llm.common import prepare, written
from regiopanel.llm.queries import multi_ranks


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn the languages from the labelled rows; rows in no known language go."""
    prepare(spark)
    return language_id.keep_known(docs, language_id.fit(language_id.learnable(docs)))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space."""
    prepare(spark)
    return exact_dedup.drop_duplicates(docs)


def distinct_shingles(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 of their five-word shingles."""
    prepare(spark)
    return near_dedup.drop_near_duplicates(docs, near_dedup.Params(words=5, percent=80))


def weighted_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the proportions of their weights; a document may come up to three times."""
    prepare(spark)
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of the decoded bytes, one row per row of the mix."""
    prepare(spark)
    return bpe.encode(docs, multi_ranks(), with_ids=True)


STAGES = [("language_id", known_language), ("exact_dedup", distinct_texts), ("near_dedup", distinct_shingles),
          ("mixing", weighted_sources), ("byte_bpe", token_ids)]

#: SQL cannot express language identification, MinHash grouping and BPE; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last one's rows."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

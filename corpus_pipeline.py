"""Corpus pipeline: language ID, near duplicates, decontamination, mixing, token file.

STAGES are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a
frame that is written as Parquet and reread as the next one's docs. All but the last
return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapair.llm import _store, decontaminate, jaccard_join, language_id, mixing, token_file
from terrapair.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language (null or letterless texts) go, and those whose language is a guess."""
    return language_id.keep_identified(docs).select(*COLUMNS)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of linked documents the smallest doc_id stays."""
    return jaccard_join.keep_one(docs, shingle=5, threshold=80).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: contaminated documents go."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Poisson replication to target weights; copies keep their doc_id."""
    return mixing.poisson_mix(docs, copy_col=None, order_col=None).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token file, read back: start, length and checksum of every document in it."""
    return token_file.token_file(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_file", tokens),
]

#: Neither the classifier nor the tokenizer can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _store.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = _store.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

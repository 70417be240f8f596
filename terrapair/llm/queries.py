"""Queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrapair.llm import _store, decontaminate, delta_lloyd, jaccard_join, language_id, media, mixing, oracles, prefix_trie, scaled_sketch, secrets, substring_dedup, suffix_dedup, token_counts, token_file

documents = _store.documents


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file; the folder is a parameter of the environment, not of the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(documents(spark, sf_dir))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir), shingle=4, threshold=85)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.token_file(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(documents(spark, sf_dir))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(documents(spark, sf_dir))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(documents(spark, sf_dir))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(media.to_media(documents(spark, sf_dir)))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.edit_report(documents(spark, sf_dir))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_lloyd.clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_decontamination": op3_decontamination,
    "op4_token_counts": op4_token_counts,
    "op5_token_file": op5_token_file,
    "op6_language_id": op6_language_id,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_media": op10_media,
    "op11_fingerprints": op11_fingerprints,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_clusters": op13_clusters,
}
ORACLE_SQL: dict[str, str] = {
    "op1_mixing": mixing.MIX_SQL,
    "op2_jaccard_join": oracles.JACCARD,
    "op3_decontamination": oracles.CONTAMINATION,
    "op8_substring_dedup": oracles.SUBSTRINGS,
    "op12_prefix_trie": prefix_trie.TRIE_SQL,
    "op13_clusters": delta_lloyd.CLUSTERS_SQL,
}

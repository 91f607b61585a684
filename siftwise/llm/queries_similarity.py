"""opN_ queries of the near-duplicate operators (4, 7, 9); SQL cannot express their components, tests use brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftwise.llm import embedding_dedup, minhash_dedup, substring_dedup
from siftwise.plans.stages import table


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), 0.98)


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), 85)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"), 200)


QUERIES = {"op9_substring_dedup": op9_substring_dedup, "op4_embedding_dedup": op4_embedding_dedup, "op7_minhash_dedup": op7_minhash_dedup}
SQL: dict[str, str] = {}

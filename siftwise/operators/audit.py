"""Counts and checks over keyed tables and queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_counts(df: DataFrame, key: str, at_least: int = 2) -> DataFrame:
    """Keys by falling count."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= at_least).orderBy(F.desc("n"), key)


def audit_counts(df: DataFrame, key: str, valid: Column) -> DataFrame:
    """One row: rows, valid rows, distinct keys of valid rows."""
    return df.agg(F.count("*").alias("total"), F.count_if(valid).alias("valid"), F.countDistinct(F.when(valid, F.col(key))).alias("distinct_valid"))


def update_lag(updates: DataFrame, prefix: Column) -> DataFrame:
    """Per prefix: batches, pending, started but not finished, finished."""
    started, indexed = F.coalesce("started", F.lit(False)), F.coalesce("indexed", F.lit(False))
    return updates.groupBy(prefix.alias("prefix")).agg(
        F.count("*").alias("batches"), F.count_if(~started & ~indexed).alias("pending"), F.count_if(started & ~indexed).alias("unfinished"), F.count_if(indexed).alias("finished")
    )


def corrupted_links(df: DataFrame, hashes: Column, valid: Column, length: int = 40) -> DataFrame:
    """One row: rows, rows with a bad hash, bad hashes in neighbour lists."""
    bad = F.size(F.filter(hashes, lambda h: F.length(h) != length))
    return df.agg(F.count("*").alias("total"), F.count_if(~valid).alias("bad_hash"), F.coalesce(F.sum(bad), F.lit(0)).cast("long").alias("bad_neighbours"))


def value_sets(df: DataFrame, attribute: str, value: str) -> DataFrame:
    return df.groupBy(attribute).agg(F.array_sort(F.collect_set(value)).alias("values"))


def nested_value_sets(df: DataFrame, mapped: str) -> DataFrame:
    """Distinct values of each key of a map column."""
    return df.select(F.explode(mapped).alias("attribute", "value")).groupBy("attribute").agg(F.array_sort(F.collect_set("value")).alias("values"))


def stratified_split(df: DataFrame, stratum: str, ident: str, parts: int = 3, test_parts: int = 1) -> DataFrame:
    """df with `test`: about test_parts of parts of each stratum, by a hash of the id, the same on every run."""
    head = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(stratum).cast("string"), F.col(ident).cast("string"))), 1, 8), 16, 10).cast("long")
    return df.withColumn("test", head % parts < test_parts)

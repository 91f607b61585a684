"""Merges of records that share a key: sets, lists, caps, latest and conflicts. Partial sums run before each shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwise.operators.normalize import valid_url
from siftwise.plans.stages import save_stage

CAP = 20_000
DISCARDED = "discarded because the cap on ids was passed"


def collect_ids(df: DataFrame, key: str, ident: str) -> DataFrame:
    """All ids per key, duplicates kept, sorted for a stable result."""
    return df.groupBy(key).agg(F.array_sort(F.collect_list(ident)).alias("ids"))


def merge_by_hash(df: DataFrame, cap: int = CAP, key: str = "sha1", ident: str = "id", url: str = "url", discarded: str | None = None) -> DataFrame:
    """One record per hash: sorted distinct ids, a valid url if any, and a discard mark.

    A hash with more than `cap` ids keeps none and is marked; a mark on any input stays. The count of distinct ids
    comes first, so the lists of popular hashes are never built.
    """
    marks = [F.max(discarded).alias("marked")] if discarded else [F.lit(None).cast("string").alias("marked")]
    # a table of its own: content is hashed and dealt once, both uses below read (key, id) pairs
    pairs = save_stage(df.groupBy(key, ident).agg(F.min(F.when(valid_url(F.col(url)), F.col(url))).alias("url"), *marks), "pairs")
    counts = pairs.groupBy(key).agg(F.count(ident).alias("n_ids"), F.min("url").alias("url"), F.max("marked").alias("marked"))
    over = (F.col("n_ids") > cap) | F.col("marked").isNotNull()
    lists = pairs.join(counts.where(~over).select(key), key, "left_semi").groupBy(key).agg(F.array_sort(F.collect_list(ident)).alias("ids"))
    empty = F.array().cast(f"array<{df.schema[ident].dataType.simpleString()}>")
    return counts.join(lists, key, "left").select(
        key, "url", F.when(over, empty).otherwise(F.coalesce("ids", empty)).alias("ids"), "n_ids", F.when(over, F.coalesce("marked", F.lit(DISCARDED))).alias("discarded")
    )


def union_sets(a: Column, b: Column, kind: str = "array<string>") -> Column:
    """Union of two sets of which either may be missing."""
    empty = F.array().cast(kind)
    return F.array_sort(F.array_union(F.coalesce(a, empty), F.coalesce(b, empty)))


def latest(df: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """The record with the largest ts of each key; ties go to the largest tie column."""
    best = df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), F.struct(ts, tie)).alias("best"))
    return best.select(key, "best.*")


def one_or_fail(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) where every row of a key agrees; raises where they do not."""
    agreed = df.groupBy(key).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    message = F.concat(F.lit(f"conflicting {value} for {key} "), F.col(key).cast("string"))
    return agreed.select(key, F.when(F.col("low") == F.col("high"), F.col("low")).when(F.col("low").isNull(), F.lit(None)).otherwise(F.raise_error(message)).alias(value))


def conflicts(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.countDistinct(value).alias("n_values")).where("n_values > 1")


def concat_lists(df: DataFrame, key: str, lists: str) -> DataFrame:
    """All lists of a key in one, duplicates kept, sorted."""
    return df.groupBy(key).agg(F.array_sort(F.flatten(F.collect_list(lists))).alias(lists))


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Unordered pairs, once each."""
    return df.select(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).distinct()

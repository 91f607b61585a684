"""Scans over keyed and time-ranged tables; filters and columns reach the file scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwise.functions.scalar import bound
from siftwise.operators.keyed import lookup


def scan(spark: SparkSession, path: str, columns: list[str], match: Column | None = None, order: list | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    df = df.where(match) if match is not None else df
    df = df.select(*columns)
    return df.orderBy(*order) if order else df


def key_range(df: DataFrame, key: str, start=None, stop=None, columns: list[str] | None = None) -> DataFrame:
    """Rows with start <= key < stop."""
    out = df.where(F.col(key) >= bound(start)) if start is not None else df
    out = out.where(F.col(key) < bound(stop)) if stop is not None else out
    return out.select(*columns) if columns else out


def put_cells(table: DataFrame, puts: DataFrame) -> DataFrame:
    """Cells after puts: the last write of a (key, family, qualifier) wins by ts; ties to the larger value."""
    both = table.select("key", "family", "qualifier", "value", "ts").unionByName(puts.select("key", "family", "qualifier", "value", "ts"))
    return both.groupBy("key", "family", "qualifier").agg(F.max(F.struct("ts", "value")).alias("m")).select("key", "family", "qualifier", "m.value", "m.ts")


def time_batch(df: DataFrame, ts: str, start, n: int, tie: str) -> DataFrame:
    """The first n rows from start on, oldest first."""
    return df.where(F.col(ts) >= bound(start)).orderBy(ts, tie).limit(n)


def keyset_batch(df: DataFrame, key: str, start, n: int, required: str | None = None) -> DataFrame:
    """The n rows after a key."""
    out = df.where(F.col(key) > bound(start))
    out = out.where(F.col(required).isNotNull()) if required else out
    return out.orderBy(key).limit(n)


def not_indexed_batch(items: DataFrame, index: DataFrame, key: str, extraction: str, n: int) -> DataFrame:
    """Items that the index lacks, or has without an extraction."""
    missing = items.join(index.select(key), key, "left_anti")
    bare = items.join(index.where(F.col(extraction).isNull()).select(key), key, "left_semi")
    return missing.unionByName(bare).orderBy(key).limit(n)


def copy_table(df: DataFrame, columns: list[str], required: list[str]) -> DataFrame:
    """Chosen columns of rows whose required ones are there."""
    for c in required:
        df = df.where(F.col(c).isNotNull())
    return df.select(*columns)


def subsample(df: DataFrame, key: str, start, n: int) -> DataFrame:
    return df.where(F.col(key) >= bound(start)).orderBy(key).limit(n)


def points(df: DataFrame, ids: DataFrame, key: str, max_broadcast: int = 200_000) -> DataFrame:
    """Rows of a set of ids."""
    return lookup(df, ids, key, max_broadcast)


def local_files(spark: SparkSession, folder: str, pattern: str = "*", start: int = 0, n: int | None = None) -> DataFrame:
    """Files below a folder, oldest first: path, length, modificationTime, content."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).orderBy("modificationTime", "path").offset(start)
    return df.limit(n) if n is not None else df


def fetched(df: DataFrame, fetch, key: str = "sha1", content: str = "content") -> DataFrame:
    """Content for rows that lack it, from a column function; rejected where its hash is not the key."""
    got = F.coalesce(F.col(content), fetch(F.col(key)))
    return df.withColumn(content, got).withColumn("verified", F.coalesce(F.upper(F.sha1(content)) == F.col(key), F.lit(False)))


def coverage(keys: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """One row: asked keys and how many the cache has content for."""
    joined = keys.join(cache.select(key, F.lit(True).alias("hit")), key, "left")
    return joined.agg(F.count("*").alias("asked"), F.count_if(F.col("hit").isNotNull()).alias("found"))

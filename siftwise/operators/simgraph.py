"""The precomputed similarity graph: edges both ways, canonical pairs, weekly partitions and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwise.functions.scalar import pair_key, week_tag
from siftwise.operators.normalize import explode_parallel


def eligible(table: DataFrame) -> DataFrame:
    """Rows that are indexed and have no precomputed neighbours yet."""
    return table.where(F.col("feat_id").isNotNull() & F.col("precomp").isNull())


def symmetric_edges(found: DataFrame, src: str = "qid", dst: str = "id", dist: str = "dist") -> DataFrame:
    """(src, dst, dist) in both directions, self-links left out, each pair once with its least distance."""
    rows = found.where(F.col(src) != F.col(dst)).select(F.explode(F.array(F.struct(F.col(src).alias("src"), F.col(dst).alias("dst")), F.struct(F.col(dst).alias("src"), F.col(src).alias("dst")))).alias("e"), F.col(dist).alias("dist"))
    return rows.groupBy("e.src", "e.dst").agg(F.min("dist").alias("dist"))


def canonical_pairs(df: DataFrame, key: str, hashes: str, distances: str) -> DataFrame:
    """(pair, dist) of neighbour lists, unordered."""
    rows = explode_parallel(df, key, {hashes: "other", distances: "dist"}).where(F.col("other") != F.col(key))
    return rows.groupBy(pair_key(F.col(key), F.col("other")).alias("pair")).agg(F.min(F.col("dist").cast("double")).alias("dist"))


def weekly(edges: DataFrame, ts) -> DataFrame:
    return edges.withColumn("year_week", week_tag(ts))


def neighbours_of(edges: DataFrame, keys: DataFrame, key: str = "src") -> DataFrame:
    """Edges of the asked keys by distance; a key without edges has one row of nulls."""
    return keys.select(key).join(edges, key, "left").orderBy(key, "dist", "dst")


def add_unseen_pairs(table: DataFrame, pairs: DataFrame, key: str = "pair") -> DataFrame:
    return table.unionByName(pairs.dropDuplicates([key]).join(table.select(key), key, "left_anti"))

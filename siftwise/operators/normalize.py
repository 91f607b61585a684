"""Reshapes and predicates over crawl documents and keyed cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwise.functions.scalar import bound, nullish

STORED = "https://s3"


# predicates


def valid_url(url: Column, prefix: str = STORED) -> Column:
    return F.coalesce(nullish(url).startswith(prefix), F.lit(False))


def in_range(ts: Column, start=None, end=None) -> Column:
    """start <= ts < end; an open end is None. Literals only, so that the scan takes the filter."""
    out = F.lit(True)
    if start is not None:
        out = out & (ts >= bound(start))
    if end is not None:
        out = out & (ts < bound(end))
    return out


def day_window(ts: Column, day: str) -> Column:
    """The 24 hours before `day` 00:00."""
    return (ts >= F.expr(f"timestamp_ntz'{day} 00:00:00' - interval 1 day")) & (ts < F.expr(f"timestamp_ntz'{day} 00:00:00'"))


def key_prefix(key: Column, prefix: str) -> Column:
    """Range form of a prefix test, as a key-ordered store scans it."""
    return (key >= prefix) & (key < prefix[:-1] + chr(ord(prefix[-1]) + 1))


def not_discarded(ids: Column, discarded: Column, cap: int) -> Column:
    return discarded.isNull() & (F.size(ids) <= cap)


def long_ids(ids: Column) -> Column:
    return F.filter(ids, lambda x: F.length(x) > 1)


def needs_indexing(df: DataFrame) -> DataFrame:
    """Rows with a stored url, no feature id and not discarded."""
    return df.where(valid_url(F.col("url")) & F.col("feat_id").isNull() & F.col("discarded").isNull())


def all_present(*columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


# reshapes


def docs_v2_to_links(docs: DataFrame) -> DataFrame:
    """(url, parent) of the first value of each multi-valued field, images only."""
    first = docs.select(*[F.get(c, F.lit(0)).alias(c) for c in ("content_type", "obj_stored_url", "obj_parent")])
    return first.where(F.col("content_type").startswith("image/") & F.col("obj_stored_url").isNotNull()).select(F.col("obj_stored_url").alias("url"), F.col("obj_parent").alias("parent"))


def docs_v3_to_links(docs: DataFrame, prefix: str = "") -> DataFrame:
    """(url, parent) of parallel arrays: one row per image."""
    rows = docs.select(F.col("doc_id").alias("parent"), F.explode(F.arrays_zip("content_type", "obj_stored_url")).alias("o"))
    return rows.where(F.col("o.content_type").startswith("image") & F.col("o.obj_stored_url").isNotNull()).select(F.concat(F.lit(prefix), F.col("o.obj_stored_url")).alias("url"), "parent")


def docs_v3_objects_to_links(docs: DataFrame, prefix: str = "") -> DataFrame:
    """(url, parent) of an array of objects."""
    rows = docs.select(F.col("doc_id").alias("parent"), F.explode("objects").alias("o"))
    return rows.where(F.col("o.content_type").startswith("image") & F.col("o.obj_stored_url").isNotNull()).select(F.concat(F.lit(prefix), F.col("o.obj_stored_url")).alias("url"), "parent")


def to_cells(df: DataFrame, key: str, family: str = "info") -> DataFrame:
    """Long (key, family, qualifier, value) cells of a wide table; absent values have no cell."""
    wide = df.select(F.col(key).cast("string").alias("key"), *[F.col(c).cast("string").alias(c) for c in df.columns if c != key])
    long = wide.unpivot("key", [c for c in df.columns if c != key], "qualifier", "value")
    return long.where("value is not null").select("key", F.lit(family).alias("family"), "qualifier", "value")


def from_cells(cells: DataFrame, qualifiers: list[str]) -> DataFrame:
    """Wide rows of known qualifiers: one aggregation, columns pruned by name."""
    return cells.groupBy("key").agg(*[F.max(F.when(F.col("qualifier") == q, F.col("value"))).alias(q) for q in qualifiers])


def cell_values(cells: Column, family: str, qualifier: str) -> Column:
    """Values of one family and qualifier in an array of cells."""
    return F.transform(F.filter(cells, lambda c: (c["family"] == family) & (c["qualifier"] == qualifier)), lambda c: c["value"])


def explode_parallel(df: DataFrame, key: str, lists: dict[str, str], sep: str = ",") -> DataFrame:
    """One row per place of separated lists that run in parallel; lists: column -> output name."""
    zipped = F.arrays_zip(*[F.split(F.col(c), sep).alias(out) for c, out in lists.items()])
    return df.select(key, F.explode(zipped).alias("z")).select(key, *[F.trim(F.col(f"z.{out}")).alias(out) for out in lists.values()])


def clean_neighbours(df: DataFrame, key: str, hashes: str, distances: str) -> DataFrame:
    """Neighbour lists without missing hashes, each hash once at its least distance, by distance, as lists again."""
    rows = explode_parallel(df, key, {hashes: "hash", distances: "dist"}).select(key, nullish(F.col("hash")).alias("hash"), F.col("dist").cast("double").alias("dist"))
    best = rows.where("hash is not null and dist is not null").groupBy(key, "hash").agg(F.min("dist").alias("dist"))
    ordered = best.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("dist", "hash"))).alias("n"))
    return ordered.select(key, F.array_join(F.col("n.hash"), ",").alias(hashes), F.array_join(F.transform("n.dist", lambda d: d.cast("string")), ",").alias(distances))

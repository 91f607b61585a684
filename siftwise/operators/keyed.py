"""Joins of incoming rows with keyed tables: upserts, registries, dense ids, lookups and repairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwise.operators.dedup import CAP, DISCARDED, one_or_fail, union_sets
from siftwise.operators.normalize import valid_url
from siftwise.plans.stages import broadcast_if_small, save_stage


def upsert_merge(incoming: DataFrame, existing: DataFrame, cap: int = CAP, key: str = "sha1") -> DataFrame:
    """Incoming records merged with the existing ones of the same key; rows that nothing came for are not returned.

    Both have key, url, ids, discarded; existing may have feat_id. Ids unite, a valid incoming url wins, the feature
    id is the existing one's, a discard on either side stays, and passing the cap discards.
    """
    kind = incoming.schema["ids"].dataType.simpleString()
    old = existing.select(key, F.col("url").alias("old_url"), F.col("ids").alias("old_ids"), F.col("discarded").alias("old_discarded"), *(["feat_id"] if "feat_id" in existing.columns else []))
    joined = incoming.join(old, key, "left").withColumn("all_ids", union_sets(F.col("ids"), F.col("old_ids"), kind))
    mark = F.coalesce("discarded", "old_discarded", F.when(F.size("all_ids") > cap, F.lit(DISCARDED)))
    url = F.coalesce(F.when(valid_url(F.col("url")), F.col("url")), F.when(valid_url(F.col("old_url")), F.col("old_url")))
    feat = F.col("feat_id") if "feat_id" in existing.columns else F.lit(None).cast("long")
    return joined.select(key, url.alias("url"), F.when(mark.isNotNull(), F.array().cast(kind)).otherwise(F.col("all_ids")).alias("ids"), mark.alias("discarded"), feat.alias("feat_id"))


def apply_upsert(existing: DataFrame, merged: DataFrame, key: str = "sha1") -> DataFrame:
    """The whole table after an upsert: merged rows replace those of their keys."""
    return existing.join(merged.select(key), key, "left_anti").unionByName(merged, allowMissingColumns=True)


def split_known(rows: DataFrame, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of known keys with what is known, and rows of new keys; one join each, no shared state."""
    return rows.join(known, key, "inner"), rows.join(known.select(key), key, "left_anti")


def register_new(registry: DataFrame, rows: DataFrame, key: str, value: str) -> DataFrame:
    """Registry with the new keys of rows; two values for one key raise."""
    agreed = one_or_fail(registry.select(key, value).unionByName(rows.select(key, value)), key, value)
    return agreed


def insert_ignore(table: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """Table with the rows whose key it lacks; the first of equal new keys by the whole row."""
    fresh = rows.join(table.select(*key), key, "left_anti").select(*table.columns)
    first = fresh.groupBy(*key).agg(F.min(F.struct(*table.columns)).alias("r")).select("r.*")
    return table.unionByName(first)


def correct_feature_ids(table: DataFrame, mapping: DataFrame, key: str = "sha1") -> DataFrame:
    """Feature ids as the mapping has them, and whether that changed one."""
    right = mapping.select(key, F.col("feat_id").alias("right_id"))
    joined = table.join(right, key, "left")
    wrong = F.coalesce(F.col("feat_id") != F.col("right_id"), F.lit(False))
    return joined.select(key, F.when(wrong, F.col("right_id")).otherwise(F.col("feat_id")).alias("feat_id"), wrong.alias("corrected"))


def dense_ids(rows: DataFrame, order: list[str], name: str = "feat_id", base: int = 0, partitions: int = 0) -> DataFrame:
    """rows with ids base, base + 1, ... in the given order, without a single-task window.

    Rows are range-partitioned; each partition is numbered by itself and moved by the rows before it: only one
    count per partition is gathered. The numbered rows are a stage table, as ranges may fall otherwise if made again.
    """
    ranged = (rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)).withColumn("_part", F.spark_partition_id())
    local = save_stage(ranged.withColumn("_seq", F.row_number().over(Window.partitionBy("_part").orderBy(*order))), "numbered")
    counts = local.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return local.join(F.broadcast(before), "_part").withColumn(name, F.col("_seq") + F.col("_before") - 1 + base).drop("_part", "_seq", "_before")


def aligned(table: DataFrame, name: str = "feat_id") -> DataFrame:
    """One row: count, highest id, and whether ids are dense."""
    return table.agg(F.count("*").alias("n"), F.max(name).alias("highest"), (F.count("*") == F.coalesce(F.max(name), F.lit(-1)) + 1).alias("dense"))


def unique_and_mapping(rows: DataFrame, known: DataFrame, key: str = "sha1", ident: str = "id") -> tuple[DataFrame, DataFrame]:
    """New unique rows (smallest id of each unknown key), and every row's id with its unique id."""
    firsts = rows.groupBy(key).agg(F.min(ident).alias("unique_id"))
    fresh = firsts.join(known.select(key), key, "left_anti")
    old = known.select(key, F.col(ident).alias("unique_id"))
    return fresh, rows.join(old.unionByName(fresh), key).select(ident, "unique_id")


def lookup(table: DataFrame, keys: DataFrame, key: str, max_broadcast: int = 200_000) -> DataFrame:
    """Rows of the asked keys; the keys are broadcast when counted to be few."""
    return table.join(broadcast_if_small(keys.select(key).distinct(), max_broadcast), key, "left_semi")


def ordered_lookup(spark: SparkSession, table: DataFrame, ids: list, key: str) -> DataFrame:
    """Rows of a given id list in its order (pos); an id without a row has nulls."""
    wanted = spark.createDataFrame([(i, k) for i, k in enumerate(ids)], f"pos int, {key} {table.schema[key].dataType.simpleString()}")
    return table.join(F.broadcast(wanted), key, "right").orderBy("pos")


def fallback_hash(rows: DataFrame, table: DataFrame, other: DataFrame, key: str = "id") -> DataFrame:
    """Hash per row: from the table, else from the other source, else computed from content; and where it came from."""
    joined = rows.join(table.select(key, F.col("sha1").alias("a")), key, "left").join(other.select(key, F.col("sha1").alias("b")), key, "left")
    computed = F.upper(F.sha1("content"))
    source = F.when(F.col("a").isNotNull(), "table").when(F.col("b").isNotNull(), "other").when(computed.isNotNull(), "computed").otherwise("missing")
    return joined.select(key, F.coalesce("a", "b", computed).alias("sha1"), source.alias("source"))


def drop_dangling(edges: DataFrame, nodes: DataFrame, src: str, dst: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Edges whose both ends exist, and edges whose target does not."""
    ids = nodes.select(key)
    from_known = edges.join(ids.withColumnRenamed(key, src), src, "left_semi")
    return from_known.join(ids.withColumnRenamed(key, dst), dst, "left_semi"), from_known.join(ids.withColumnRenamed(key, dst), dst, "left_anti")


def legacy_merge(old: DataFrame, new: DataFrame, key: str = "sha1") -> DataFrame:
    """Full merge of both tables: ids unite, the old url stays while valid."""
    n = new.select(key, F.col("url").alias("new_url"), F.col("ids").alias("new_ids"))
    joined = old.join(n, key, "full")
    url = F.coalesce(F.when(valid_url(F.col("url")), F.col("url")), F.col("new_url"))
    return joined.select(key, url.alias("url"), union_sets(F.col("ids"), F.col("new_ids"), old.schema["ids"].dataType.simpleString()).alias("ids"))


def stale_segments(segments: DataFrame, compressed: DataFrame, key: str = "segment") -> DataFrame:
    """Segments that have no compressed file, or one of another count."""
    have = compressed.select(key, F.col("n_index").alias("n_index"))
    return segments.join(have, key, "left").where(F.col("n_index").isNull() | (F.col("n_index") - 1 != F.col("n_codes"))).select(key)

"""The update queue: batches of keys as rows with markers, and what comes next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwise.operators.keyed import dense_ids

MARKERS = ("started", "indexed", "corrupted", "precomp_start", "precomp_finish")


def batches(keys: DataFrame, key: str, size: int, prefix: str = "index_update_") -> DataFrame:
    """One row per batch of `size` keys in key order, the last one partial; a batch is a bounded list."""
    numbered = dense_ids(keys.select(key), [key], "_at").withColumn("batch", F.floor(F.col("_at") / size))
    rows = numbered.groupBy("batch").agg(F.array_sort(F.collect_list(key)).alias("keys"))
    markers = [F.lit(None).cast("boolean").alias(m) for m in MARKERS]
    return rows.select(F.concat(F.lit(prefix), F.lpad(F.col("batch").cast("string"), 8, "0")).alias("update_id"), "keys", F.size("keys").alias("n_keys"), *markers)


def subdivide(updates: DataFrame, size: int = 50) -> DataFrame:
    """Batches cut into smaller ones, in order."""
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size("keys") - 1) / size).cast("int")), lambda b: F.slice("keys", b * size + 1, F.lit(size)))
    return updates.select("update_id", F.posexplode(parts).alias("part", "keys")).select(F.concat_ws("_", "update_id", F.col("part").cast("string")).alias("update_id"), "keys")


def set_marker(updates: DataFrame, marker: str, ids: Column, value: bool = True) -> DataFrame:
    return updates.withColumn(marker, F.when(ids, F.lit(value)).otherwise(F.col(marker)))


def _is(marker: str) -> Column:
    return F.coalesce(F.col(marker), F.lit(False))


def next_batch(updates: DataFrame, begin: str = "started", end: str = "indexed", ready: Column | None = None) -> DataFrame:
    """The batch to work on: the last one that was not begun, else the last one begun and not ended; none if all ended."""
    open_ = updates.where(~_is(end) & (ready if ready is not None else F.lit(True)))
    return open_.orderBy(_is(begin), F.desc("update_id")).limit(1)


def next_precompute_batch(updates: DataFrame) -> DataFrame:
    return next_batch(updates, "precomp_start", "precomp_finish", _is("indexed"))


def job_metrics(spark, job_id: str, metrics: dict[str, object]) -> DataFrame:
    """(job_id, name, value) rows to append."""
    return spark.createDataFrame([(job_id, k, str(v)) for k, v in metrics.items()], "job_id string, name string, value string")

"""Updates as streams: micro-batches into keyed tables, each key once, safe to run again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwise.plans.stages import make_folder


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def run_updates(stream: DataFrame, table: str, key: str, transform: Callable[[DataFrame], DataFrame], checkpoint: str, once: bool = True, interval: str = "1 minute"):
    """Append the transformed rows of each micro-batch whose key the table lacks.

    A batch that runs again after a failure finds its keys there, so every key is written once. Each batch has a folder
    of its own below the table's, overwritten when it is repeated: no path is read and overwritten by one job. The folder
    is named by the checkpoint's own id too, so a stream that starts again without its checkpoint, and counts from 0 again,
    overwrites nothing: it finds its keys in the folders of the one before.
    """
    spark = stream.sparkSession
    make_folder(spark, table)

    def one(batch: DataFrame, number: int) -> None:
        writer = spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]
        rows = transform(batch)
        rows = rows.groupBy(key).agg(F.min(F.struct(*rows.columns)).alias("r")).select("r.*")
        # the schema is given, as a table without a finished batch has none to find
        known = T.StructType([rows.schema[key], T.StructField("writer", T.StringType()), T.StructField("batch", T.LongType())])
        have = spark.read.schema(known).parquet(table).where((F.col("writer") != writer) | (F.col("batch") < number))
        rows.join(have.select(key), key, "left_anti").write.mode("overwrite").parquet(f"{table}/writer={writer}/batch={number}")

    writer = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()
    if once:
        query.awaitTermination()
    return query


def daily_counts(stream: DataFrame, ts: str, key: str, late: str = "1 hour") -> DataFrame:
    """Extension: rows per day and key with a watermark for late ones."""
    rows = stream.withColumn("at", F.col(ts).cast("timestamp")).withWatermark("at", late)
    return rows.groupBy(F.window("at", "1 day"), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("day"), key, "n")

"""Stage tables, table access and size-checked broadcasts shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; any path that Spark's readers can open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only where that setting is missing and all of Spark runs on this machine (tests, local runs) a temporary folder is made.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    set_before = spark.sparkContext.getCheckpointDir()
    if set_before:
        return set_before.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    own = tempfile.mkdtemp(prefix="siftwise-")
    atexit.register(shutil.rmtree, own, True)
    spark.sparkContext.setCheckpointDir(f"file://{own}")
    return f"file://{own}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; what is written there goes when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    fs, where = _filesystem(spark, path)
    fs.deleteOnExit(where)
    return path


def save_stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write df once to the shared folder and read it back: lineage ends there, so a lost executor costs a re-read only."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def drop_stage(df: DataFrame) -> None:
    """Delete a stage table that nothing reads any more."""
    path = getattr(df, "_stage_path", None)
    if path:
        fs, where = _filesystem(df.sparkSession, path)
        fs.delete(where, True)


def _filesystem(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder if it is not there, on whatever file system its path names."""
    fs, where = _filesystem(spark, path)
    fs.mkdirs(where)


def broadcast_if_small(df: DataFrame, max_rows: int, n_bytes: Column | None = None, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast when df is proved to have max_rows rows at most and, by n_bytes a row (for rows that vary),
    max_bytes bytes at most; else leave the choice to Spark."""
    if n_bytes is None:
        return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
    rows, size = df.agg(F.count("*"), F.sum(n_bytes.cast("long"))).first()
    return F.broadcast(df) if rows <= max_rows and (size or 0) <= max_bytes else df

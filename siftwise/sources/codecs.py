"""Text and binary exchange formats of vectors and codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwise.operators.vectors import lists_of, matrix_of

#: Element type of each SIFT-style suffix.
XVECS = {"fvecs": np.dtype("<f4"), "ivecs": np.dtype("<u4"), "bvecs": np.dtype("u1")}


@F.pandas_udf(T.StringType())
def vector_to_base64(v):
    """base64 of little-endian float32."""
    import base64

    return v.map(lambda x: None if x is None else base64.b64encode(np.asarray(x, "<f4").tobytes()).decode())


@F.pandas_udf(T.ArrayType(T.FloatType()))
def base64_to_vector(s):
    import base64

    return s.map(lambda x: None if x is None else np.frombuffer(base64.b64decode(x), "<f4"))


def write_vectors_text(df: DataFrame, path: str, key: str, vector: str) -> None:
    """Lines of id, tab, base64."""
    df.select(F.concat_ws("\t", F.col(key).cast("string"), vector_to_base64(vector)).alias("value")).write.text(path)


def read_vectors_text(spark: SparkSession, path: str, ratio: float = 1.0, seed: int = 0) -> DataFrame:
    """(id, vector), sampled by a hash of the id so that the sample does not depend on partitions."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).select(parts[0].alias("id"), parts[1].alias("data"))
    if ratio < 1:
        rows = rows.where(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1_000_000)) < int(ratio * 1_000_000))
    return rows.select("id", base64_to_vector("data").alias("vector"))


def code_json(c0: Column, c1: Column, fine: Column) -> Column:
    """[[c0,c1],[f0,...]]"""
    return F.concat(F.lit("["), F.to_json(F.array(c0, c1)), F.lit(","), F.to_json(fine), F.lit("]"))


def write_codes_text(codes: DataFrame, path: str) -> None:
    codes.select(F.concat_ws("\t", F.col("id").cast("string"), code_json(F.col("c0"), F.col("c1"), F.col("fine"))).alias("value")).write.text(path)


def read_codes_text(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", "\t")
    code = F.from_json(parts[1], "array<array<int>>")
    rows = spark.read.text(path).select(parts[0].cast("long").alias("id"), code.alias("code"))
    return rows.select("id", F.col("code")[0][0].alias("c0"), F.col("code")[0][1].alias("c1"), F.col("code")[1].alias("fine"))


def xvecs_bytes(matrix: np.ndarray, kind: str) -> bytes:
    """Each row: dimension as unsigned 32-bit, then the values."""
    dtype = XVECS[kind]
    body = np.ascontiguousarray(matrix.astype(dtype)).view(np.uint8).reshape(len(matrix), -1)
    head = np.tile(np.frombuffer(np.array([matrix.shape[1]], "<u4").tobytes(), np.uint8), (len(matrix), 1))
    return np.hstack((head, body)).tobytes()


def parse_xvecs(data: bytes, kind: str) -> np.ndarray:
    if not data:
        return np.zeros((0, 0))
    dtype = XVECS[kind]
    dim = int(np.frombuffer(data, "<u4", 1)[0])
    size = 4 + dim * dtype.itemsize
    if len(data) % size:
        raise ValueError("truncated vector file")
    rows = np.frombuffer(data, np.uint8).reshape(-1, size)
    if (rows[:, :4].copy().view("<u4") != dim).any():
        raise ValueError("vectors of several dimensions in one file")
    return rows[:, 4:].copy().view(dtype)


def _binary_files(spark: SparkSession, path: str, parse) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                m = parse(data).astype(np.float64)
                for k in range(0, len(m), 4096):
                    part = m[k : k + 4096]
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(part)), pa.array(np.arange(k, k + len(part))), lists_of(part)], ["file", "pos", "vector"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, pos long, vector array<double>")


def read_xvecs(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(file, pos, vector) of .fvecs, .ivecs or .bvecs files."""
    return _binary_files(spark, path, lambda d: parse_xvecs(d, kind))


def read_matrix(spark: SparkSession, path: str, dim: int, dtype: str = "<f4") -> DataFrame:
    """(file, pos, vector) of headerless row-major matrices."""
    return _binary_files(spark, path, lambda d: np.frombuffer(d, dtype).reshape(-1, dim))


def matrix_files(df: DataFrame, key: str, vector: str, kind: str | None = None, dtype: str = "<f4") -> DataFrame:
    """(first, n, content) rows: file contents by partition in key order, raw or with xvecs headers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                m = matrix_of(b.column(1))
                content = xvecs_bytes(m, kind) if kind else m.astype(dtype).tobytes()
                yield pa.RecordBatch.from_arrays([b.column(0).slice(0, 1), pa.array([len(m)]), pa.array([content], pa.binary())], ["first", "n", "content"])

    return df.select(F.col(key).cast("long"), vector).repartitionByRange(key).sortWithinPartitions(key).mapInArrow(run, "first long, n long, content binary")


def write_vector_files(df: DataFrame, key: str, vector: str, path: str, kind: str | None = None, dtype: str = "<f4") -> DataFrame:
    """Write .fvecs, .ivecs, .bvecs or raw files of row-major matrices under path, in key order; (file, n) of each.

    Tasks write by Arrow, to any file system that it knows and all executors share; a file is moved to its name when it is
    whole, and names follow from the partition, so a task that runs again replaces its own files.
    """
    suffix = f".{kind}" if kind else ".bin"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        fs, root = pafs.FileSystem.from_uri(path)
        fs.create_dir(root, recursive=True)
        number = 0
        for b in batches:
            for n, content in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                name = f"{root}/part-{context.partitionId():05d}-{number:05d}{suffix}"
                with fs.open_output_stream(f"{name}.{context.taskAttemptId()}.tmp") as out:
                    out.write(content)
                fs.move(f"{name}.{context.taskAttemptId()}.tmp", name)
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["file", "n"])

    return df.sparkSession.createDataFrame(matrix_files(df, key, vector, kind, dtype).mapInArrow(run, "file string, n long").collect(), "file string, n long")

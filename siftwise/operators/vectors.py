"""Vector operators: sums of outer products, PCA, projections and packed sign codes. numpy works on whole Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_BITS = 32


def matrix_of(column: pa.Array) -> np.ndarray:
    """float64[n, dim] of a list column without nulls, without Python lists."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def lists_of(matrix: np.ndarray) -> pa.ListArray:
    n, dim = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * dim + 1, dim if dim else 1)[: n + 1].astype(np.int32)), pa.array(matrix.reshape(-1)))


def map_vectors(df: DataFrame, key: str, vector: str, fn: Callable[[np.ndarray], np.ndarray], out: str, kind: str = "double") -> DataFrame:
    """(key, out): fn on float64 matrices of whole batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                yield pa.RecordBatch.from_arrays([b.column(0), lists_of(fn(matrix_of(b.column(1))))], [key, out])

    return df.where(F.col(vector).isNotNull()).select(key, vector).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, {out} array<{kind}>")


def summed(rows: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Sum of the vectors of each key, added up in the JVM before and after the shuffle: no group is held in one piece."""
    return rows.groupBy(*keys).agg(Summarizer.sum(array_to_vector(vector)).alias("s")).select(*keys, vector_to_array("s").alias(vector))


def outer_sums(df: DataFrame, vector: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, sum and sum of outer products of all vectors.

    Each partition adds up its own; matrices are then summed row by row in Spark, so the driver gets one matrix
    however many partitions there are.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if len(b):
                x = matrix_of(b.column(0))
                x = np.hstack((x, np.ones((len(x), 1))))
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), lists_of(total)], ["i", "row"])

    parts = df.where(F.col(vector).isNotNull()).select(vector).mapInArrow(partial, "i long, row array<double>")
    rows = summed(parts, ["i"], "row").orderBy("i").toArrow()
    if not len(rows):
        raise ValueError("no vectors")
    whole = matrix_of(rows.column("row").combine_chunks())
    return int(round(whole[-1, -1])), whole[-1, :-1], whole[:-1, :-1]


def covariance(n: int, total: np.ndarray, outer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and the non-centred estimator: outer / (n - 1) - mean meanᵀ, as the data model fixes it."""
    mean = total / n
    return mean, (outer + outer.T) / (2 * max(1, n - 1)) - np.outer(mean, mean)


def eigenvalue_allocation(buckets: int, eigenvalues: np.ndarray) -> np.ndarray:
    """Permutation of dimensions into equal buckets whose products of eigenvalues are balanced, the largest first to the smallest product."""
    buckets = min(buckets, len(eigenvalues))
    size = -(-len(eigenvalues) // buckets)
    logs = np.log2(np.maximum(np.abs(eigenvalues), 1e-30))
    logs = logs - logs.min() + 1
    members: list[list[int]] = [[] for _ in range(buckets)]
    for d in np.argsort(-eigenvalues, kind="stable"):
        free = [b for b in range(buckets) if len(members[b]) < size]
        members[min(free, key=lambda b: (logs[members[b]].sum(), b))].append(int(d))
    return np.array([d for m in members for d in m])


def fit_pca(df: DataFrame, vector: str, dims: int) -> dict[str, np.ndarray]:
    """mu, P (dim x dims) and E: leading eigenvectors, permuted to balance two halves."""
    n, total, outer = outer_sums(df, vector)
    mean, cov = covariance(n, total, outer)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[-dims:], vectors[:, -dims:]
    order = eigenvalue_allocation(2, values)
    return {"mu": mean, "P": vectors[:, order], "E": values[order]}


def apply_pca(df: DataFrame, key: str, vector: str, pca: dict[str, np.ndarray], out: str = "reduced") -> DataFrame:
    mu, p = pca["mu"], pca["P"]
    return map_vectors(df, key, vector, lambda x: (x - mu) @ p, out)


def sampled(df: DataFrame, key: str, percent: int, seed: int) -> DataFrame:
    """About `percent` of a hundred rows, by a hash of the key, the same on every run."""
    head = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")
    return df.where(head % 100 < percent)


def fixed_projection(dim: int, bits: int) -> np.ndarray:
    """An integer-valued projection that any engine can compute; it stands in for trained weights."""
    i, j = np.arange(dim)[:, None], np.arange(bits)[None, :]
    return ((73 * i + 151 * j + 17 * i * j) % 257 - 128).astype(np.float64)


def pack_bits(positive: np.ndarray) -> np.ndarray:
    """int64[n, bits / 32] words of booleans, lowest bit first."""
    n, bits = positive.shape
    weights = np.left_shift(np.int64(1), np.arange(WORD_BITS, dtype=np.int64))
    return (positive.reshape(n, bits // WORD_BITS, WORD_BITS) * weights).sum(axis=2)


def hash_codes(df: DataFrame, key: str, vector: str, w: np.ndarray, m: np.ndarray | None = None, out: str = "code") -> DataFrame:
    """(key, code): bits of unit vector · W - m strictly over 0, packed into 32-bit words."""
    offset = np.zeros(w.shape[1]) if m is None else m

    def codes(x: np.ndarray) -> np.ndarray:
        length = np.linalg.norm(x, axis=1, keepdims=True)
        return pack_bits((x / np.where(length > 0, length, 1)) @ w - offset > 0)

    return map_vectors(df, key, vector, codes, out, "bigint")

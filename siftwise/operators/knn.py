"""Nearest neighbours of a query set: exact, and by Hamming shortlist with exact re-rank.

The query set is collected in blocks bounded in rows and bytes, each broadcast to the tasks of its own scan; base rows
stay where they are. A task keeps a running best k per query and returns that alone, so what is shuffled grows with
queries x k x tasks, not with pairs. A Hamming shortlist is cut at a distance and an id that histograms find first
(counts per query leave a task), so the re-ranking scan needs no ranked list of candidates.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwise.operators.vectors import matrix_of

#: Queries and bytes of queries in one block; rows of a distance matrix; bins of one narrowing pass.
MAX_QUERIES, QUERY_BYTES, BLOCK, BINS = 200_000, 64 << 20, 1024, 64
FOUND = "qid long, id long, dist double"
#: Near-duplicate thresholds by name.
PRESETS = {"strict": 0.1, "balanced": 0.25, "loose": 0.5}


def collected(rows: DataFrame, key: str, *vectors: str) -> tuple[np.ndarray, ...]:
    """Ids and a matrix for each vector column, of rows where none is null."""
    rows = rows.select(key, *vectors).dropna().toArrow()
    columns = [rows.column(i + 1).combine_chunks() for i in range(len(vectors))]
    return rows.column(0).to_numpy().astype(np.int64), *(matrix_of(c.chunk(0) if isinstance(c, pa.ChunkedArray) else c) for c in columns)


def query_blocks(queries: DataFrame, key: str, *vectors: str, per_query: int = 0) -> Iterator[tuple[np.ndarray, ...]]:
    """Ids and vectors of the query set, in as many blocks by a hash of the id as keep each under MAX_QUERIES rows and
    QUERY_BYTES bytes, about; per_query: bytes that a task holds for a query besides."""
    asked = queries.select(key, *vectors).dropna()
    count, width = asked.agg(F.count("*"), F.max(reduce(Column.__add__, map(F.size, vectors)))).first()
    n = max(1, math.ceil(count / MAX_QUERIES), math.ceil(count * (8 * (width or 0) + 8 + per_query) / QUERY_BYTES))
    for k in range(n):
        yield collected(asked.where(F.pmod(F.xxhash64(key), F.lit(n)) == k) if n > 1 else asked, key, *vectors)


def over_blocks(queries: DataFrame, key: str, vectors: str | list[str], run: Callable[..., DataFrame], per_query: int = 0) -> DataFrame:
    """What `run` finds for each block of queries."""
    names = [vectors] if isinstance(vectors, str) else vectors
    return reduce(DataFrame.unionByName, [run(*block) for block in query_blocks(queries, key, *names, per_query=per_query)])


def best_of(block: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k least values of each row, all ties of the k-th included."""
    if block.shape[1] > k:
        limit = np.partition(block, k - 1, axis=1)[:, k - 1 : k]
        return np.nonzero(block <= limit)
    return np.nonzero(np.ones(block.shape, bool))


class Best:
    """The k least (dist, id) of every query among what a task has seen so far."""

    def __init__(self, n: int, k: int):
        self.n, self.k, self.limit, self.size = n, k, np.full(n, np.inf), 0
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, q: np.ndarray, ids: np.ndarray, dist: np.ndarray) -> None:
        may = np.flatnonzero(dist <= self.limit[q])
        self.held.append((q[may], ids[may], dist[may]))
        self.size += len(may)
        if self.size > 2 * self.n * self.k + (1 << 17):
            self.prune()

    def prune(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, ids, dist = (np.concatenate(x) for x in zip(*self.held, strict=True)) if self.held else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        order = np.lexsort((ids, dist, q))
        q, ids, dist = q[order], ids[order], dist[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        last = rank == self.k - 1
        self.limit[q[last]] = dist[last]
        keep = rank < self.k
        self.held, self.size = [(q[keep], ids[keep], dist[keep])], int(keep.sum())
        return self.held[0]


def _rows(qids: np.ndarray, ids: np.ndarray, dist: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(ids), 1 << 16):
        part = slice(k, k + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(qids[part]), pa.array(ids[part].astype(np.int64)), pa.array(dist[part].astype(np.float64))], ["qid", "id", "dist"])


def _scan(sent, k: int, distance) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, q = sent.value
        best = Best(len(q), k)
        for b in batches:
            if not len(b):
                continue
            ids, x = b.column(0).to_numpy(zero_copy_only=False), matrix_of(b.column(1))
            for start in range(0, len(q), BLOCK):
                d = distance(q[start : start + BLOCK], x)
                r, c = best_of(d, k)
                best.add(r + start, ids[c], d[r, c])
        at, ids, dist = best.prune()
        yield from _rows(qids[at], ids, dist)

    return run


def inner_distance(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1.0 - q @ x.T


def half_squared(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.maximum(((q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1)[None, :] - 2 * q @ x.T) / 2, 0.0)


def hamming_words(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(q), len(x)), np.int64)
    for w in range(q.shape[1]):
        out += np.bitwise_count(q[:, w].astype(np.uint64)[:, None] ^ x[:, w].astype(np.uint64)[None, :])
    return out


def ranked(found: DataFrame, k: int, dist: str = "dist") -> DataFrame:
    """Best k per query by (dist, id), with rank from 1."""
    w = Window.partitionBy("qid").orderBy(dist, "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _send(df: DataFrame, *arrays):
    return df.sparkSession.sparkContext.broadcast(arrays)


def exact_knn(base: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", distance=inner_distance) -> DataFrame:
    """(qid, id, dist, rank) of the k nearest base vectors of each query vector."""
    rows = base.where(F.col(vector).isNotNull()).select(key, vector)
    return ranked(over_blocks(queries, key, vector, lambda qids, q: rows.mapInArrow(_scan(_send(rows, qids, q), k, distance), FOUND), per_query=48 * k), k)


def within(base: DataFrame, queries: DataFrame, limit: float, key: str = "vec_id", vector: str = "embedding", distance=inner_distance) -> DataFrame:
    """(qid, n, least): how many other base vectors lie within `limit` of each query, and the least distance."""
    rows = base.where(F.col(vector).isNotNull()).select(key, vector)

    def block(qids: np.ndarray, q: np.ndarray) -> DataFrame:
        sent = _send(rows, qids, q)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            qids, q = sent.value
            n, least = np.zeros(len(q), np.int64), np.full(len(q), np.inf)
            for b in batches:
                if not len(b):
                    continue
                ids, x = b.column(0).to_numpy(zero_copy_only=False), matrix_of(b.column(1))
                for start in range(0, len(q), BLOCK):
                    part = slice(start, start + BLOCK)
                    d = distance(q[part], x)
                    d[(d > limit) | (qids[part, None] == ids[None, :])] = np.inf
                    n[part] += np.isfinite(d).sum(axis=1)
                    least[part] = np.minimum(least[part], d.min(axis=1))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(qids[some]), pa.array(n[some]), pa.array(least[some])], ["qid", "n", "least"])

        return rows.mapInArrow(run, "qid long, n long, least double")

    return over_blocks(queries, key, vector, block, per_query=16).groupBy("qid").agg(F.sum("n").alias("n"), F.min("least").alias("least"))


def _binned(rows: DataFrame, sent, bins: int, place: Callable) -> DataFrame:
    """(q, bin, n): codes counted per query and bin; place(hamming block, ids, queries) gives bins, -1 for none. Counts alone leave a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = sent.value[1]
        counts = np.zeros(len(q) * (bins + 1), np.int64)
        for b in batches:
            if not len(b):
                continue
            ids, x = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), matrix_of(b.column(1)).astype(np.int64)
            for start in range(0, len(q), BLOCK):
                part = slice(start, min(start + BLOCK, len(q)))
                at = place(hamming_words(q[part].astype(np.int64), x), ids, part) + 1
                at += (np.arange(part.start, part.stop) * (bins + 1))[:, None]
                counts += np.bincount(at.reshape(-1), minlength=len(counts))
        counts = counts.reshape(len(q), bins + 1)[:, 1:]
        r, c = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int64)), pa.array(c.astype(np.int32)), pa.array(counts[r, c])], ["q", "bin", "n"])

    return rows.mapInArrow(run, "q long, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))


def _matrix(counted: DataFrame, n: int, bins: int) -> np.ndarray:
    """Counts of one block of queries: n x bins numbers, n being bounded by query_blocks."""
    t = counted.toArrow()
    out = np.zeros((n, bins), np.int64)
    out[t.column("q").to_numpy(), t.column("bin").to_numpy()] = t.column("n").to_numpy()
    return out


def hamming_histogram(codes: DataFrame, queries: DataFrame, key: str = "vec_id") -> DataFrame:
    """(qid, hd, n): how many codes lie at each Hamming distance from each query; a scan of all codes."""
    rows = codes.select(key, "code").dropna()

    def block(qids: np.ndarray, q: np.ndarray) -> DataFrame:
        sent = _send(rows, qids, q)
        named = rows.sparkSession.createDataFrame([(i, int(x)) for i, x in enumerate(qids)], "q long, qid long")
        counts = _binned(rows, sent, 32 * q.shape[1] + 1, lambda d, ids, part: d)
        return counts.join(F.broadcast(named), "q").select("qid", F.col("bin").alias("hd"), "n")  # one row a query of a bounded block

    return over_blocks(queries, key, "code", block, per_query=2000)


def _cutoffs(rows: DataFrame, qids: np.ndarray, q: np.ndarray, size: int, key: str) -> tuple[np.ndarray, np.ndarray]:
    """For each query the Hamming distance and the id of its `size`-th code by (distance, id), found by counting."""
    sent, bits = _send(rows, qids, q), 32 * q.shape[1] + 1
    counts = _matrix(_binned(rows, sent, bits, lambda d, ids, part: d), len(q), bits)
    ahead = np.cumsum(counts, axis=1)
    radius = np.minimum((ahead < size).sum(axis=1), bits - 1)
    own = np.arange(len(q))
    need = size - (ahead[own, radius] - counts[own, radius])
    ends = rows.agg(F.min(key), F.max(key)).first()
    low, high = np.full(len(q), ends[0] or 0), np.full(len(q), ends[1] or 0)
    open_ = need < counts[own, radius]
    while open_.any():  # the range of ids that holds the last one shrinks BINS-fold
        width = (high - low) // BINS + 1
        state = _send(rows, radius, low, high, width, open_)

        def place(d: np.ndarray, ids: np.ndarray, part: slice, state=state) -> np.ndarray:
            r, lo, hi, w, o = (x[part, None] for x in state.value)
            return np.where(o & (d == r) & (ids >= lo) & (ids <= hi), (ids - lo) // w, -1)

        counts = _matrix(_binned(rows, sent, BINS, place), len(q), BINS)
        ahead = np.cumsum(counts, axis=1)
        b = np.minimum((ahead < need[:, None]).sum(axis=1), BINS - 1)
        need = np.where(open_, need - (ahead[own, b] - counts[own, b]), need)
        low = np.where(open_, low + b * width, low)
        high = np.where(open_, np.minimum(high, low + width - 1), high)
        open_ &= (need < counts[own, b]) & (low < high)
    return radius, high


def _shortlisted(rows: DataFrame, qids: np.ndarray, q: np.ndarray, size: int, key: str, x: np.ndarray | None = None, distance=None, k: int = 0) -> DataFrame:
    """Scan of rows(key, code[, vector]): each query's codes up to its cut-off, with Hamming or exact distances, all of them or the best k."""
    sent = _send(rows, qids, q, *_cutoffs(rows.select(key, "code"), qids, q, size, key), x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, q, radius, last, x = sent.value
        best = Best(len(q), k)
        for b in batches:
            if not len(b):
                continue
            ids, codes = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), matrix_of(b.column(1)).astype(np.int64)
            for start in range(0, len(q), BLOCK):
                part = slice(start, start + BLOCK)
                d = hamming_words(q[part].astype(np.int64), codes)
                in_ = (d < radius[part, None]) | ((d == radius[part, None]) & (ids <= last[part, None]))
                if distance is not None:
                    d = np.where(in_, distance(x[part], matrix_of(b.column(2))), np.inf)
                if k:
                    r, c = best_of(d, k)
                    r, c = r[in_[r, c]], c[in_[r, c]]
                    best.add(r + start, ids[c], d[r, c])
                else:
                    r, c = np.nonzero(in_)
                    yield from _rows(qids[start + r], ids[c], d[r, c])
        if k:
            at, ids, dist = best.prune()
            yield from _rows(qids[at], ids, dist)

    return rows.mapInArrow(run, FOUND)


def hamming_shortlist(codes: DataFrame, queries: DataFrame, size: int, key: str = "vec_id") -> DataFrame:
    """(qid, id, dist) of the `size` codes of least Hamming distance, ties by id."""
    rows = codes.select(key, "code").dropna()
    return over_blocks(queries, key, "code", lambda qids, q: _shortlisted(rows, qids, q, size, key), per_query=2000)


def shortlist_size(n: int, ratio: float, top: int = 0) -> int:
    return math.ceil(n * ratio) if top <= 0 else min(n, top)


def reranked(base: DataFrame, queries: DataFrame, codes: DataFrame, query_codes: DataFrame, size: int, distance=half_squared, k: int = 0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(qid, id, dist): the shortlist of `size` codes with exact distances; with k, the k nearest that each task sees."""
    rows = codes.select(key, "code").join(base.select(key, vector), key).select(key, "code", vector).dropna()
    asked = query_codes.select(key, "code").join(queries.select(key, vector), key)
    return over_blocks(asked, key, ["code", vector], lambda qids, q, x: _shortlisted(rows, qids, q, size, key, x, distance, k), per_query=2000 + 48 * k)


def hamming_knn(base: DataFrame, queries: DataFrame, codes: DataFrame, query_codes: DataFrame, k: int, ratio: float, distance=half_squared, key: str = "vec_id", vector: str = "embedding", top: int = 0) -> DataFrame:
    """Shortlist by code, exact re-rank, best k."""
    return ranked(reranked(base, queries, codes, query_codes, shortlist_size(codes.count(), ratio, top), distance, k, key, vector), k)


def near_duplicates(found: DataFrame, threshold: float | None, default: float = PRESETS["balanced"]) -> DataFrame:
    """Rows with dist <= threshold; none or 0 takes the default, a negative one turns the filter off."""
    th = threshold or default
    return found if th < 0 else found.where(F.col("dist") <= th)


def as_lists(found: DataFrame) -> DataFrame:
    """One row per query: ids and distances in rank order (k is bounded, so are the lists)."""
    rows = found.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "dist"))).alias("r"))
    return rows.select("qid", F.col("r.id").alias("ids"), F.col("r.dist").alias("dists"))


def recall_at(found: DataFrame, truth: DataFrame, ks: list[int]) -> DataFrame:
    """(k, recall): share of queries whose true nearest neighbour is among the first k found."""
    first = truth.where("rank = 1").select("qid", F.col("id"))
    at = first.join(found.select("qid", "id", "rank"), ["qid", "id"], "left")
    hits = at.agg(*[F.avg(F.when(F.col("rank") <= k, 1.0).otherwise(0.0)).alias(str(k)) for k in ks])
    return hits.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"`{k}`").alias("recall")) for k in ks])).alias("r")).select("r.*")

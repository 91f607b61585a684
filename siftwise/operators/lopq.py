"""Locally optimised product quantisation: training, encoding, decoding and inverted multi-index search.

A vector's halves are each assigned to one of V coarse centroids; the residual is rotated in the frame of its
centroid and its parts are quantised by M sub-quantisers of S centroids. Models are bounded (V, M, S do not grow with
the data) and travel with the task closure; data stay in DataFrames.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwise.operators import knn
from siftwise.operators.vectors import eigenvalue_allocation, lists_of, map_vectors, matrix_of, summed
from siftwise.plans.stages import save_stage

#: What a tuned search must find of its sample's true neighbours; over 0.9, so that other queries reach that as well.
RECALL = 0.93
#: Queries and base vectors that tuning samples, about; queries of a block.
SAMPLED, SAMPLE, BLOCK = 200, 2000, 256
CODES = "id long, c0 int, c1 int, fine array<int>"


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2) if len(x) * len(c) * x.shape[1] <= 4_000_000 else np.vstack([squared(p, c) for p in np.array_split(x, 2)])


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Nearest centroid of each row, the lowest at ties."""
    return squared(x, c).argmin(axis=1)


@dataclass
class LOPQModel:
    cs: np.ndarray  # 2 x V x D/2
    rs: np.ndarray | None = None  # 2 x V x D/2 x D/2
    mus: np.ndarray | None = None  # 2 x V x D/2
    subs: np.ndarray | None = None  # M x S x D/M
    extra: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def v(self) -> int:
        return self.cs.shape[1]

    @property
    def m(self) -> int:
        return len(self.subs)

    def halves(self, x: np.ndarray) -> list[np.ndarray]:
        return np.split(x, 2, axis=1)

    def coarse(self, x: np.ndarray) -> np.ndarray:
        return np.stack([nearest(h, c) for h, c in zip(self.halves(x), self.cs, strict=True)], axis=1)

    def project(self, x: np.ndarray, coarse: np.ndarray) -> np.ndarray:
        """Residuals in the local frames."""
        out = []
        for s, h in enumerate(self.halves(x)):
            k = coarse[:, s]
            out.append(np.einsum("nij,nj->ni", self.rs[s][k], h - self.cs[s][k] - self.mus[s][k]))
        return np.hstack(out)

    def fine(self, x: np.ndarray, coarse: np.ndarray) -> np.ndarray:
        parts = np.split(self.project(x, coarse), self.m, axis=1)
        return np.stack([nearest(p, c) for p, c in zip(parts, self.subs, strict=True)], axis=1)

    def reconstruct(self, coarse: np.ndarray, fine: np.ndarray) -> np.ndarray:
        local = np.hstack([self.subs[j][fine[:, j]] for j in range(self.m)])
        out = []
        for s, y in enumerate(np.split(local, 2, axis=1)):
            k = coarse[:, s]
            out.append(np.einsum("nji,nj->ni", self.rs[s][k], y) + self.mus[s][k] + self.cs[s][k])
        return np.hstack(out)

    def tables(self, x: np.ndarray, half: int, k: int) -> np.ndarray:
        """Squared distances of one vector's local half to every sub-centroid: M/2 x S."""
        n = self.m // 2
        local = self.rs[half][k] @ (np.split(x, 2)[half] - self.cs[half][k] - self.mus[half][k])
        return np.stack([((part - c) ** 2).sum(axis=1) for part, c in zip(np.split(local, n), self.subs[half * n : half * n + n], strict=True)])

    # persistence without pickles: one row per array

    def save(self, spark: SparkSession, path: str) -> None:
        named = {"cs": self.cs, "rs": self.rs, "mus": self.mus, "subs": self.subs, **{f"extra.{k}": v for k, v in self.extra.items()}}
        rows = [(k, [int(d) for d in a.shape], a.astype(float).reshape(-1).tolist()) for k, a in named.items() if a is not None]
        spark.createDataFrame(rows, "name string, shape array<int>, values array<double>").coalesce(1).write.mode("errorifexists").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LOPQModel:
        found = {r["name"]: np.array(r["values"]).reshape(r["shape"]) for r in spark.read.parquet(path).collect()}
        return cls(found["cs"], found.get("rs"), found.get("mus"), found.get("subs"), {k[6:]: v for k, v in found.items() if k.startswith("extra.")})


def _kmeans(df: DataFrame, vector: str, k: int, seed: int, iterations: int) -> np.ndarray:
    model = KMeans(k=k, seed=seed, maxIter=iterations, initMode="random", featuresCol="f").fit(df.select(array_to_vector(vector).alias("f")))
    centres = np.array(model.clusterCenters())
    return np.vstack([centres, np.repeat(centres[:1] + 1e6, k - len(centres), axis=0)]) if len(centres) < k else centres


def train_coarse(df: DataFrame, vector: str, v: int, seed: int = 1, iterations: int = 10) -> LOPQModel:
    """Centroids of both halves."""
    dim = len(df.select(vector).first()[0])
    halves = [df.select(F.slice(F.col(vector).cast("array<double>"), s * dim // 2 + 1, dim // 2).alias("h")) for s in (0, 1)]
    return LOPQModel(np.stack([_kmeans(h, "h", v, seed + s, iterations) for s, h in enumerate(halves)]))


def train_rotations(df: DataFrame, vector: str, model: LOPQModel) -> LOPQModel:
    """Local frames from each cluster's residual mean and covariance, summed per partition and then, row by row, in Spark."""
    v, h = model.v, model.cs.shape[2]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, v, h + 1, h + 1))
        for b in batches:
            if len(b):
                x = matrix_of(b.column(0))
                coarse = model.coarse(x)
                for s, part in enumerate(model.halves(x)):
                    for k in np.unique(coarse[:, s]):
                        r = part[coarse[:, s] == k] - model.cs[s][k]
                        r = np.hstack((r, np.ones((len(r), 1))))
                        sums[s, k] += r.T @ r
        at = np.arange(2 * v * (h + 1))
        yield pa.RecordBatch.from_arrays([pa.array(at // (h + 1)), pa.array(at % (h + 1)), lists_of(sums.reshape(-1, h + 1))], ["cluster", "i", "row"])

    parts = df.where(F.col(vector).isNotNull()).select(vector).mapInArrow(partial, "cluster long, i long, row array<double>")
    totals = np.zeros((2 * v, h + 1, h + 1))
    for r in summed(parts, ["cluster", "i"], "row").collect():
        totals[r["cluster"], r["i"]] = r["row"]
    rs, mus = np.tile(np.eye(h), (2, v, 1, 1)), np.zeros((2, v, h))
    for cluster, total in enumerate(totals):
        s, k = divmod(cluster, v)
        n = round(total[-1, -1])
        if n == 0:
            continue
        mus[s, k] = total[-1, :-1] / n
        if n >= h:  # else the identity: too few points for a frame
            a = total[:-1, :-1]
            values, vectors = np.linalg.eigh((a + a.T) / (2 * max(1, n - 1)) - np.outer(mus[s, k], mus[s, k]))
            rs[s, k] = vectors[:, eigenvalue_allocation(max(1, (model.extra.get("m", np.array([8]))[0].astype(int)) // 2), values)].T
    return LOPQModel(model.cs, rs, mus, model.subs, model.extra)


def train_subquantisers(df: DataFrame, vector: str, model: LOPQModel, m: int, s: int, seed: int = 1, iterations: int = 10) -> LOPQModel:
    dim = 2 * model.cs.shape[2]
    # projected once, for all parts
    local = save_stage(map_vectors(df.withColumn("_k", F.lit(0)), "_k", vector, lambda x: model.project(x, model.coarse(x)), "local").drop("_k"), "local")
    subs = [_kmeans(local.select(F.slice("local", j * dim // m + 1, dim // m).alias("p")), "p", s, seed + j, iterations) for j in range(m)]
    return LOPQModel(model.cs, model.rs, model.mus, np.stack(subs), model.extra)


def train(df: DataFrame, vector: str, v: int = 4, m: int = 8, s: int = 16, seed: int = 1, iterations: int = 10, start: LOPQModel | None = None) -> LOPQModel:
    """All steps; those that `start` has are reused."""
    model = start or train_coarse(df, vector, v, seed, iterations)
    model.extra["m"] = np.array([m], float)
    if model.rs is None:
        model = train_rotations(df, vector, model)
    if model.subs is None:
        model = train_subquantisers(df, vector, model, m, s, seed, iterations)
    return model


def encode(df: DataFrame, key: str, vector: str, model: LOPQModel) -> DataFrame:
    """(id, c0, c1, fine) codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                x = matrix_of(b.column(1))
                coarse = model.coarse(x)
                fine = model.fine(x, coarse).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(coarse[:, 0].astype(np.int32)), pa.array(coarse[:, 1].astype(np.int32)), lists_of(fine)], ["id", "c0", "c1", "fine"])

    return df.where(F.col(vector).isNotNull()).select(F.col(key).cast("long"), vector).mapInArrow(run, CODES)


def decode(codes: DataFrame, model: LOPQModel) -> DataFrame:
    """(id, vector) reconstructions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                coarse = np.stack([b.column(c).to_numpy() for c in ("c0", "c1")], axis=1)
                yield pa.RecordBatch.from_arrays([b.column("id"), lists_of(model.reconstruct(coarse, matrix_of(b.column("fine")).astype(int)))], ["id", "vector"])

    return codes.mapInArrow(run, "id long, vector array<double>")


def cell_counts(codes: DataFrame) -> DataFrame:
    return codes.groupBy("c0", "c1").agg(F.count("*").alias("n"))


def multisequence(x: np.ndarray, cs: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Cells (distance, c0, c1) of one vector by rising distance, ties by cell; a frontier heap, nothing enumerated ahead."""
    d = [((h - c) ** 2).sum(axis=1) for h, c in zip(np.split(x, 2), cs, strict=True)]
    order = [np.argsort(k, kind="stable") for k in d]
    heap, seen = [(d[0][order[0][0]] + d[1][order[1][0]], int(order[0][0]), int(order[1][0]), 0, 0)], {(0, 0)}
    while heap:
        total, c0, c1, i, j = heapq.heappop(heap)
        yield float(total), c0, c1
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(order[0]) and b < len(order[1]) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (d[0][order[0][a]] + d[1][order[1][b]], int(order[0][a]), int(order[1][b]), a, b))


def ranked_cells(queries: DataFrame, key: str, vector: str, cs: np.ndarray, limit: int | None = None) -> DataFrame:
    """(qid, rank, c0, c1, dist): cells of each query in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for qid, x in zip(b.column(0).to_pylist(), matrix_of(b.column(1)) if len(b) else (), strict=True):
                rows = []
                for rank, (dist, c0, c1) in enumerate(multisequence(x, cs), 1):
                    rows.append((qid, rank, c0, c1, dist))
                    if rank == limit:
                        break
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["qid", "rank", "c0", "c1", "dist"])

    return queries.select(F.col(key).cast("long"), vector).mapInArrow(run, "qid long, rank int, c0 int, c1 int, dist double")


def cells_for_quota(cells: DataFrame, counts: DataFrame, quota: int) -> DataFrame:
    """Cells of each query until the quota is met; the last is taken whole."""
    have = cells.join(F.broadcast(counts), ["c0", "c1"])  # V x V rows at most
    before = Window.partitionBy("qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return have.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < quota)


def search(queries: DataFrame, key: str, vector: str, codes: DataFrame, model: LOPQModel, quota: int, limit: int) -> DataFrame:
    """(qid, id, dist, rank, visited): codes of the quota's cells ranked by table distances."""
    cells = cells_for_quota(ranked_cells(queries, key, vector, model.cs), cell_counts(codes), quota)
    pairs = cells.join(codes, ["c0", "c1"]).join(queries.select(F.col(key).cast("long").alias("qid"), F.col(vector).alias("x")), "qid")

    def rank(t: pa.Table) -> pa.Table:
        x = np.array(t.column("x")[0].as_py(), float)
        c0, c1, fine = t.column("c0").to_numpy(), t.column("c1").to_numpy(), matrix_of(t.column("fine").combine_chunks()).astype(int)
        dist, half = np.zeros(len(t)), model.m // 2
        for s, c in enumerate((c0, c1)):
            for k in np.unique(c):
                rows = np.flatnonzero(c == k)
                table = model.tables(x, s, int(k))
                dist[rows] += table[np.arange(half)[None, :], fine[rows][:, s * half : s * half + half]].sum(axis=1)
        best = np.lexsort((t.column("id").to_numpy(), dist))[:limit]
        n = len(best)
        return pa.table({"qid": t.column("qid").slice(0, n), "id": t.column("id").take(pa.array(best)), "dist": dist[best], "rank": np.arange(1, n + 1, dtype=np.int32), "visited": np.full(n, len(t))})

    # a query's candidates are about its quota, so a group is bounded by quota + one cell
    return pairs.select("qid", "id", "c0", "c1", "fine", "x").groupBy("qid").applyInArrow(rank, "qid long, id long, dist double, rank int, visited long")


@dataclass
class Effort:
    """How far `search_reranked` goes: the quota of visited vectors, and how many of `sample` (code reconstructions of a
    sample of the base) may be nearer by code than a shortlisted vector; past the sample's size all are shortlisted."""

    quota: int
    nearer: int
    counts: np.ndarray  # vectors of each cell, V * V
    sample: np.ndarray


def _squared_distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 2 * knn.half_squared(q, x)


def _before(q: np.ndarray, model: LOPQModel, counts: np.ndarray) -> np.ndarray:
    """For each query and cell, the vectors in cells that come first; in the order of `multisequence`."""
    a, b = (squared(h, c) for h, c in zip(model.halves(q), model.cs, strict=True))
    order = np.argsort((a[:, :, None] + b[:, None, :]).reshape(len(q), model.v**2), axis=1, kind="stable")
    n = counts[order]
    out = np.empty_like(n)
    np.put_along_axis(out, order, np.cumsum(n, axis=1) - n, axis=1)
    return out


def _coded(x: np.ndarray, model: LOPQModel) -> tuple[np.ndarray, np.ndarray]:
    """Cells and reconstructions."""
    coarse = model.coarse(x)
    return coarse[:, 0] * model.v + coarse[:, 1], model.reconstruct(coarse, model.fine(x, coarse))


def tune(base: DataFrame, queries: DataFrame, key: str, vector: str, model: LOPQModel, k: int, least_quota: int = 0) -> Effort:
    """The least effort that finds RECALL of the true k nearest (but the query itself) of a sample of queries.

    Bounded: SAMPLED queries and their neighbours, SAMPLE base vectors and V x V counts reach the driver."""
    base = base.where(F.col(vector).isNotNull())
    counts = np.zeros(model.v**2, np.int64)
    for r in cell_counts(encode(base, key, vector, model)).collect():
        counts[r["c0"] * model.v + r["c1"]] = r["n"]
    some = lambda df, size, n: df.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < 1_000_000 * size / max(n, 1))
    _, x = knn.collected(some(base, SAMPLE, int(counts.sum())), key, vector)
    queries = queries.where(F.col(vector).isNotNull())
    asked = some(queries, SAMPLED, queries.count())
    qids, q = knn.collected(asked, key, vector)
    effort = Effort(least_quota, len(x) + 1, counts, _coded(x, model)[1] if len(x) else x)
    if not len(x) or not len(q):
        return effort
    near = knn.ranked(knn.exact_knn(base, asked, k + 1, key, vector, knn.half_squared).where("qid <> id").drop("rank"), k)
    true = near.select("qid", F.col("id").alias(key)).join(base.select(key, vector), key).select("qid", vector)
    owner, t = knn.collected(true, "qid", vector)
    if not len(t):
        return effort
    cell, y = _coded(t, model)
    own = np.argsort(qids)[np.searchsorted(np.sort(qids), owner)]
    before = _before(q, model, counts)[own, cell]
    effort.quota = max(least_quota, int(np.sort(before)[math.ceil((1 + RECALL) / 2 * len(before)) - 1]) + 1)
    nearer = np.sort(_squared_distances(q, effort.sample), axis=1)
    e = ((q[own] - y) ** 2).sum(axis=1)
    place = np.array([np.searchsorted(nearer[o], d - 1e-9) for o, d in zip(own, e, strict=True)]) + 1
    effort.nearer = int(np.sort(np.where(before < effort.quota, place, len(x) + 1))[math.ceil(RECALL * len(place)) - 1])
    return effort


def search_reranked(base: DataFrame, queries: DataFrame, key: str, vector: str, model: LOPQModel, limit: int, effort: Effort) -> DataFrame:
    """(qid, id, dist, rank, visited): the nearest of the quota's cells but the query itself. Code distances make the
    shortlist, exact squared distances rank it; blocks of queries meet batches of the base, so pairs are no rows."""
    rows = base.where(F.col(vector).isNotNull()).select(key, vector)
    counts, nearer = effort.counts, effort.nearer

    def scan(qids: np.ndarray, q: np.ndarray) -> DataFrame:
        visited = np.zeros((len(q), len(counts)), bool)
        radius = np.full(len(q), np.inf)
        for start in range(0, len(q), BLOCK):
            part = slice(start, start + BLOCK)
            visited[part] = _before(q[part], model, counts) < effort.quota
            if 0 < nearer <= len(effort.sample):
                radius[part] = np.partition(_squared_distances(q[part], effort.sample), nearer - 1, axis=1)[:, nearer - 1] + 1e-9

        sent = rows.sparkSession.sparkContext.broadcast((qids, q, visited, radius))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            qids, q, visited, radius = sent.value
            best = knn.Best(len(q), limit)
            for b in batches:
                if not len(b):
                    continue
                ids, x = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), matrix_of(b.column(1))
                cell, y = _coded(x, model)
                for start in range(0, len(q), BLOCK):
                    part = slice(start, start + BLOCK)
                    short = (_squared_distances(q[part], y) <= radius[part, None]) & visited[part][:, cell] & (qids[part, None] != ids)
                    d = np.where(short, _squared_distances(q[part], x), np.inf)
                    r, c = knn.best_of(d, limit)
                    r, c = r[short[r, c]], c[short[r, c]]
                    best.add(r + start, ids[c], d[r, c])
            at, ids, dist = best.prune()
            for k in range(0, len(at), 1 << 14):
                part = slice(k, k + (1 << 14))
                yield pa.RecordBatch.from_arrays([pa.array(qids[at[part]]), pa.array(ids[part]), pa.array(dist[part]), pa.array(visited[at[part]] @ counts)], ["qid", "id", "dist", "visited"])

        return rows.mapInArrow(run, "qid long, id long, dist double, visited long")

    return knn.ranked(knn.over_blocks(queries, key, vector, scan, per_query=model.v**2 + 48 * limit), limit).select("qid", "id", "dist", "rank", "visited")


def distortion(df: DataFrame, key: str, vector: str, model: LOPQModel) -> DataFrame:
    """(part, distortion): mean squared error of each sub-quantiser."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                x = matrix_of(b.column(1))
                coarse = model.coarse(x)
                parts = np.split(model.project(x, coarse), model.m, axis=1)
                errors = np.array([squared(p, c).min(axis=1).sum() for p, c in zip(parts, model.subs, strict=True)])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(model.m, dtype=np.int32)), pa.array(errors), pa.array(np.full(model.m, len(x)))], ["part", "error", "n"])

    sums = df.select(F.col(key).cast("long"), vector).mapInArrow(run, "part int, error double, n long")
    return sums.groupBy("part").agg((F.sum("error") / F.sum("n")).alias("distortion"))


def coarse_agreement(neighbours: DataFrame, codes: DataFrame) -> DataFrame:
    """One row: share of (query, neighbour) pairs with equal first, second and both coarse codes."""
    a = codes.select(F.col("id").alias("qid"), F.col("c0").alias("a0"), F.col("c1").alias("a1"))
    b = codes.select("id", "c0", "c1")
    joined = neighbours.join(a, "qid").join(b, "id")
    share = lambda e: F.avg(e.cast("int"))
    return joined.agg(share(F.col("a0") == F.col("c0")).alias("first"), share(F.col("a1") == F.col("c1")).alias("second"), share((F.col("a0") == F.col("c0")) & (F.col("a1") == F.col("c1"))).alias("both"))

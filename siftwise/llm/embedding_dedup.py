"""Near-duplicate embeddings: p-stable Euclidean hashing in several tables, exact cosine checks in double precision.

Only vectors of equal, non-null label (and equal length) are compared. Equal vectors are merged first into one
representative with a weight, so a very common vector costs one row. Unit vectors at cosine c are sqrt(2 - 2c) apart;
a table concatenates quantised Gaussian projections floor((a.v + b) / w), with w eight times that distance, so that one
projection agrees with probability 0.90 there. How many projections a table has follows from the label's number of
vectors (`plan`): so many that a vector meets FAR others at right angles in a table on average, at every size; tables
are so many that a pair at the cosine asked for misses all of them with probability MISS. Both grow with the logarithm
and a small power (0.12 at cosine 0.98) of that number. Projections are sums of whole numbers held exactly, so a key is
the same in whichever batch it is computed.

Buckets of more than one vector are found by key; those with the same members in several tables are kept once. A
bucket's blocks meet blocks (see blocks.py) in matrix products: what leaves a task is each vector's number of new
links and a spanning forest, never the pairs. A pair is counted in the first table where it meets only.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component, vectors with a null label
and vectors with a null id link with nothing; rows that repeat a vec_id count as other vectors and each is returned;
very long vectors are whole rows of a block, whose bytes are bounded; a tie at exactly the cosine asked for is a link;
the result has vec_id, n_links, component_id, kept whatever else the table has; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwise.llm.blocks import block_pairs, map_groups
from siftwise.llm.minhash_dedup import _forest
from siftwise.plans.components import connected_components
from siftwise.plans.stages import broadcast_if_small, save_stage

#: Chance that a pair at the least cosine meets nowhere; vectors at right angles that one meets in a table.
MISS, FAR, SEED = 1e-5, 0.25, 20240229
#: Scales of unit vectors, directions and their products: all sums stay under 2**53 up to 16,000 dimensions.
UNIT, DIRECTION = 2.0**18, 2.0**14
BLOCK_ROWS, BLOCK_BYTES = 1024, 16 << 20
#: Labels whose sizes are broadcast at most.
BROADCAST_LABELS = 100_000
HASHED = "vid long, label int, dim int, tbl int, bucket long"


def agree(distance: float, width: float) -> float:
    """Chance that one projection puts two vectors at a distance into one bucket."""
    x = width / distance
    return 1 - math.erfc(x / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


def width_of(min_cosine: float) -> float:
    return 8 * math.sqrt(max(2 - 2 * min_cosine, 1e-6))


def plan(n: Column, min_cosine: float) -> Column:
    """Projections of a table for a label of n vectors; an even number, so that few kinds of tables are in use."""
    far = -math.log(agree(math.sqrt(2), width_of(min_cosine)))
    return 2 * F.greatest(F.ceil(F.log(n / FAR) / (2 * far)).cast("int"), F.lit(2))


@functools.lru_cache(maxsize=6)
def _projections(dim: int, k: int, min_cosine: float) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """Directions, offsets, width and hash factors: they follow from the seed, the dimension and the number of projections."""
    rng, width = np.random.default_rng([SEED, dim, k]), np.round(width_of(min_cosine) * UNIT * DIRECTION)
    met = agree(math.sqrt(max(2 - 2 * min_cosine, 1e-6)), width_of(min_cosine)) ** k
    tables = math.ceil(math.log(MISS) / math.log1p(-met))
    a = np.round(rng.standard_normal((dim, tables * k)) * DIRECTION)
    return a, np.floor(rng.uniform(0, width, tables * k)), width, rng.integers(1, 2**62, (tables, k)) * 2 + 1


def table_hashes(unit: np.ndarray, k: int, min_cosine: float = 0.98) -> np.ndarray:
    """int64[n, tables] of unit vectors."""
    a, b, width, factors = _projections(unit.shape[1], k, min_cosine)
    q = np.floor((np.round(unit * UNIT) @ a + b) / width).astype(np.int64)
    return (q.reshape(len(unit), *factors.shape) * factors).sum(axis=2)


def _units(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and unit vectors (double precision), by length."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        v = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), int(dim))
        v = v / np.abs(v).max(axis=1, keepdims=True)  # neither overflow nor underflow in the norm
        yield rows, v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _hash(min_cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.slice(start, 1024)
                projections = part.column("k").to_numpy(zero_copy_only=False)
                for rows, unit in _units(part.column("embedding")):
                    for k in np.unique(projections[rows]):
                        own = np.flatnonzero(projections[rows] == k)
                        hashes = table_hashes(unit[own], int(k), min_cosine)
                        repeated = pa.array(np.repeat(rows[own], hashes.shape[1]))
                        columns = [part.column("vid").take(repeated), part.column("label").take(repeated), pa.array(np.full(hashes.size, unit.shape[1], np.int32)), pa.array(np.tile(np.arange(hashes.shape[1], dtype=np.int32), len(own))), pa.array(hashes.reshape(-1))]
                        yield pa.RecordBatch.from_arrays(columns, ["vid", "label", "dim", "tbl", "bucket"])

    return run


def _count(min_cosine: float):
    def run(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        vids, reps, links, hang = [], [], [], []
        own, vid, rep, weight, tbl, ks = (t.column(c).to_numpy() for c in ("_own", "vid", "rep", "weight", "tbl", "k"))
        same = t.column("_bi").to_numpy() == t.column("_bj").to_numpy()
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(t))))

        def found(v, r, n, h) -> None:
            for to, x in zip((vids, reps, links, hang), (v, r, n, h), strict=True):
                to.append(pa.array(x, pa.int64()))

        for rows, units in _units(t.column("embedding").combine_chunks()):
            edges = np.flatnonzero(np.concatenate(([True], group[rows][1:] != group[rows][:-1])))
            sizes = np.diff(np.append(edges, len(rows)))
            # pairs that are alone in their bucket, all at once
            two = edges[sizes == 2]
            two = two[same[rows[two]] | (own[rows[two]] != own[rows[two + 1]])]
            two = two[np.einsum("ij,ij->i", units[two], units[two + 1]) >= min_cosine]
            for k in np.unique(ks[rows[two]]):
                mine = two[ks[rows[two]] == k]
                first, second = table_hashes(units[mine], int(k), min_cosine), table_hashes(units[mine + 1], int(k), min_cosine)
                mine = mine[(first == second).argmax(axis=1) == tbl[rows[mine]]]
                a, b = rows[mine], rows[mine + 1]
                found(vid[a], rep[a], weight[b], rep[b])
                found(vid[b], rep[b], weight[a], rep[a])
            for lo, size in zip(edges[sizes > 2], sizes[sizes > 2], strict=True):
                unit, at = units[lo : lo + size], rows[lo : lo + size]
                near = unit @ unit.T >= min_cosine
                if not same[at[0]]:
                    near &= own[at][:, None] != own[at][None, :]
                np.fill_diagonal(near, False)
                some = np.flatnonzero(near.any(axis=1))
                if not len(some):
                    continue  # each with itself only
                near, at, table = near[np.ix_(some, some)], at[some], tbl[at[0]]
                hashes = table_hashes(unit[some], int(ks[at[0]]), min_cosine)[:, :table]
                for before in hashes.T:
                    near &= before[:, None] != before[None, :]
                count = near @ weight[at]
                up = dict((b, a) for a, b in _forest(near, np.arange(len(some))))
                linked = np.flatnonzero(count)
                found(vid[at][linked], rep[at][linked], count[linked], [int(rep[at][up[x]]) if x in up else None for x in linked])
        columns = [pa.concat_arrays(x) if x else pa.array([], pa.int64()) for x in (vids, reps, links, hang)]
        yield pa.RecordBatch.from_arrays(columns, ["vid", "rep", "links", "hang"])

    return run


def near_vectors(vectors: DataFrame, min_cosine: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors(vec_id, embedding, label)."""
    size = F.size("embedding")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.coalesce(F.col("label").isNotNull() & (size > 0) & ~bad & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = vectors.select("vec_id", "label", "embedding", good.alias("good"))
    usable = rows.where("good and vec_id is not null")
    merged = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    reps = save_stage(merged.withColumn("vid", F.monotonically_increasing_id()), "vectors")

    sizes = reps.groupBy("label").agg(F.count("*").alias("n")).select("label", plan(F.col("n"), min_cosine).alias("k"))
    reps = reps.join(broadcast_if_small(sizes, BROADCAST_LABELS), "label")

    # only keys are moved to find buckets of more than one vector; vectors follow to those
    key = ["label", "tbl", "bucket"]
    hashed = reps.select("vid", "label", "k", "embedding").mapInArrow(_hash(min_cosine), HASHED)
    h = F.xxhash64("vid")
    counted = hashed.groupBy(*key).agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 24)).alias("s")).where("n > 1")
    # what has the same members in several tables is compared in the first; a table, so that Spark can split a popular bucket
    once = counted.groupBy("label", "n", "x", "s").agg(F.min(F.struct("tbl", "bucket")).alias("b")).select("label", "b.tbl", "b.bucket")
    members = save_stage(hashed.join(save_stage(once, "buckets"), key), "members")
    paired = block_pairs(members, key, h, 8 * F.col("dim"), BLOCK_ROWS, BLOCK_BYTES).drop("dim")
    paired = paired.join(reps.select("vid", "rep", "weight", "k", "embedding"), "vid")
    found = save_stage(map_groups(paired, [*key, "_bi", "_bj"], _count(min_cosine), "vid long, rep long, links long, hang long"), "links")

    classes = connected_components(found.where("hang is not null").select(F.col("rep").alias("a"), F.col("hang").alias("b")))
    counts = found.groupBy("vid").agg(F.sum("links").alias("links"))
    known = (
        reps.join(counts, "vid", "left")
        .join(classes.withColumnRenamed("id", "rep"), "rep", "left")
        .select("label", "embedding", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    )
    named = usable.select("vec_id", "label", "embedding").join(known, ["label", "embedding"]).select("vec_id", "n_links", F.col("component").alias("component_id"))
    alone = rows.where("not good or vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return named.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

"""Near-duplicate documents: SetSketch registers, banded; joint likelihood estimates; links verified on full sets.

1. Each text's five-word shingle set gives a 128-bit digest, its size and its band hashes (one pass in numpy).
2. Documents of equal sets share one representative, so a group of copies costs one row from here on.
3. Stars: in each band bucket whose members are not of one class yet, every member is held against a pivot (one per
   bucket and round), one exact comparison a member. Verified links make classes. This is linear in the members, and
   groups of near copies of any size come together here.
4. Rest: buckets that still hold several classes are compared in full, blocks against blocks, but only pairs of
   different classes: sketches estimate J by joint likelihood, documents without a likely partner leave, and exact
   intersections of the full sets decide. Each pair of blocks returns a spanning forest of its true links.
5. Components of the true links are the classes. Only verified links ever join anything, so a chain of chance band
   hits cannot grow a group.

Bands follow from the similarity (`banding`): a pair at that similarity shares none with probability MISS at most
(1 in 26,000 at 85 percent: 32 bands of 8; 1 in 300,000 at 80: 42 of 6). Every pair that shares a band is in one class
already or is compared. Pairs whose equal registers or estimate are 7 standard errors under what the similarity
gives (SLACK for the estimate) are not verified.

Defined cases: null and empty texts, and texts without words, have no shingles and link with nothing; a text of
fewer than five words is one shingle; very long texts are hashed whole, a block holding one of them at least; a null
doc_id links with nothing, has a null component and is kept; rows that repeat a doc_id are one vertex and each is
returned; ties do not arise, a class has its smallest doc_id; the result has the columns doc_id, n_shingles,
component_id, kept, whatever else docs has; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwise.llm.blocks import block_pairs, map_groups
from siftwise.llm.memory import released
from siftwise.llm.sketches import SetSketch, shingle_sets
from siftwise.plans.components import connected_components
from siftwise.plans.stages import broadcast_if_small, save_stage

SHINGLE = 5
REGISTERS, MISS, SLACK = 256, 5e-5, 0.16
#: Rounds of stars before buckets of several classes are compared in full.
ROUNDS = 2
#: Candidate ids that are broadcast at most.
BROADCAST_IDS = 1_000_000
#: Bytes and rows of text hashed at once; rows and bytes of a block.
CHUNK, CHUNK_ROWS, BLOCK_ROWS, BLOCK_BYTES = 1 << 20, 1000, 512, 4 << 20
SKETCHED = "doc_id long, n_shingles long, set_a long, set_b long, n_bytes long, bands array<long>"


def _chunks(texts: pa.Array) -> Iterator[slice]:
    start, total = 0, 0
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for i, n in enumerate(lengths):
        total += n
        if total >= CHUNK or i + 1 - start >= CHUNK_ROWS:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(lengths):
        yield slice(start, len(lengths))


def banding(percent: int) -> tuple[int, int]:
    """Registers, and registers in a band, for a similarity: the widest bands of which a pair at that similarity shares
    none with probability MISS at most."""
    for rows in range(8, 0, -1):
        bands = REGISTERS // rows
        if (1 - (percent / 100) ** rows) ** bands <= MISS:
            return bands * rows, rows
    raise ValueError("the similarity is too low for bands")


def _sketches(registers: int, rows: int):
    return lambda batches: _sketch(batches, SetSketch(registers), rows)


def _sketch(batches: Iterator[pa.RecordBatch], sketch: SetSketch, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for part in _chunks(texts):
            own = texts.slice(part.start, part.stop - part.start).to_pylist()
            sets, counts = shingle_sets(own, SHINGLE)
            bands = sketch.bands(sketch.registers(sets, counts), rows)
            ends = np.cumsum(counts)
            digests = np.frombuffer(b"".join(hashlib.blake2b(sets[e - c : e].tobytes(), digest_size=16).digest() for c, e in zip(counts, ends, strict=True)), np.int64).reshape(-1, 2)
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, bands.shape[1]), pa.int32()), pa.array(bands.reshape(-1)))
            columns = [ids.slice(part.start, len(own)), pa.array(counts.astype(np.int64)), pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array([len(t or "") for t in own], pa.int64()), values]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_a", "set_b", "n_bytes", "bands"])


def _forest(linked: np.ndarray, i_of: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix; i_of are the rows worth starting from."""
    seen = np.zeros(len(linked), bool)
    for root in i_of:
        if seen[root]:
            continue
        seen[root] = True
        queue = [root]
        while queue:
            at = queue.pop()
            fresh = np.flatnonzero(linked[at] & ~seen)
            seen[fresh] = True
            for other in fresh:
                yield int(at), int(other)
            queue.extend(fresh)


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of all pairwise intersections: products of incidence matrices over the shared elements."""
    n = len(sets)
    lengths = np.array([len(s) for s in sets])
    value, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), lengths)
    shared = np.bincount(at)[at] > 1
    column = np.unique(at[shared], return_inverse=True)[1]
    owner, width = owner[shared], len(value)
    out = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 8192):
        a, b = np.searchsorted(column, [low, low + 8192])
        part = np.zeros((n, min(8192, width)), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out


def _verify(percent: int, sketch: SetSketch):
    def likely(registers: np.ndarray, sizes: np.ndarray, cross: np.ndarray) -> np.ndarray:
        """Pairs whose joint estimate is not clearly below the similarity asked for."""
        n, share = len(registers), percent / 100
        least = sketch.m * share - 7 * (sketch.m * share * (1 - share)) ** 0.5
        larger, smaller = np.zeros((n, n), np.int16), np.zeros((n, n), np.int16)
        for r in range(sketch.m):
            k = registers[:, r]
            larger += k[:, None] > k[None, :]
            smaller += k[:, None] < k[None, :]
        a, b = np.nonzero(cross & np.triu(sketch.m - larger - smaller >= least, 1))
        estimate = sketch.jaccard(larger[a, b].astype(float), smaller[a, b].astype(float), sizes[a].astype(float), sizes[b].astype(float))
        out = np.zeros((n, n), bool)
        sure = estimate >= share - SLACK
        out[a[sure], b[sure]] = True
        return out | out.T

    def run(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        texts = table.column("text")
        parts = [shingle_sets(texts.slice(p.start, p.stop - p.start).to_pylist(), SHINGLE) for p in _chunks(texts)]
        counts = np.concatenate([c for _, c in parts])
        each = [s for sets, c in parts for s in np.split(sets, np.cumsum(c)[:-1])]
        left, right = [], []
        classes = table.column("label").to_numpy()
        reps, owns, same = table.column("rep").to_numpy(), table.column("_own").to_numpy(), table.column("_bi").to_numpy() == table.column("_bj").to_numpy()
        for start, stop in zip(starts, [*starts[1:], len(table)], strict=True):
            n = stop - start
            sets, sizes, ids, own = each[start:stop], counts[start:stop], reps[start:stop], owns[start:stop]
            cross = np.ones((n, n), bool) if same[start] else own[:, None] != own[None, :]
            cross &= (sizes > 0)[:, None] & (sizes > 0)[None, :]
            cross &= classes[start:stop, None] != classes[None, start:stop]
            if not cross.any():
                continue
            if n > 4:
                pairs = likely(sketch.registers(np.concatenate(sets), sizes), sizes, cross)
                some = np.flatnonzero(pairs.any(axis=1))
                if not len(some):
                    continue
                sets, sizes, ids, cross = [sets[x] for x in some], sizes[some], ids[some], cross[np.ix_(some, some)]
            common = _intersections(sets).astype(np.int64)
            union = sizes[:, None] + sizes[None, :] - common
            linked = cross & (100 * common >= percent * union) & (common > 0)
            np.fill_diagonal(linked, False)
            for a, b in _forest(linked, np.flatnonzero(linked.any(axis=1))):
                left.append(ids[a])
                right.append(ids[b])
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def _verify_stars(percent: int):
    """Links of members with their pivot, by exact intersections."""

    def run(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        texts = table.column("text")
        parts = [shingle_sets(texts.slice(p.start, p.stop - p.start).to_pylist(), SHINGLE) for p in _chunks(texts)]
        counts, elements = np.concatenate([c for _, c in parts]), np.concatenate([s for s, _ in parts])
        ends = np.cumsum(counts)
        reps, pivots, is_pivot = (table.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "pivot", "is_pivot"))
        left, right = [], []
        for start, stop in zip(starts, [*starts[1:], len(table)], strict=True):
            low, sizes = ends[start] - counts[start], counts[start:stop]
            mine, owner = elements[low : ends[stop - 1]], np.repeat(np.arange(stop - start), sizes)
            for k in np.flatnonzero(is_pivot[start:stop]):
                pivot = elements[ends[start + k] - counts[start + k] : ends[start + k]]
                if not len(pivot):
                    continue
                common = np.bincount(owner[pivot[np.minimum(np.searchsorted(pivot, mine), len(pivot) - 1)] == mine], minlength=len(sizes))
                linked = (100 * common >= percent * (sizes + len(pivot) - common)) & (common > 0) & ~is_pivot[start:stop]
                left.append(reps[start:stop][linked])
                right.append(pivots[start:stop][linked])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (left, right)], ["a", "b"])

    return run


def _star_links(stars: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of stars(rep, pivot): a pivot's members are dealt in parts, and the pivot's text goes to each."""
    members = stars.join(texts, "rep").withColumn("is_pivot", F.lit(False))
    sizes = members.groupBy("pivot").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum(F.length("text")) / BLOCK_BYTES)).cast("int").alias("of"))
    sizes = save_stage(sizes, "stars")  # a table, so that Spark can split the members of a popular pivot
    dealt = members.join(sizes, "pivot").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("of")).cast("int"))
    hubs = sizes.join(texts.withColumnRenamed("rep", "pivot"), "pivot").select("pivot", F.col("pivot").alias("rep"), "text", F.lit(True).alias("is_pivot"), F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("part"))
    columns = ["pivot", "part", "rep", "text", "is_pivot"]
    return map_groups(dealt.select(*columns).unionByName(hubs.select(*columns)), ["pivot", "part"], _verify_stars(percent), "a long, b long")


def _labelled(buckets: DataFrame, links: DataFrame | None) -> DataFrame:
    """Members of buckets with their class so far."""
    if links is None:
        return buckets.withColumn("label", F.col("rep"))
    classes = connected_components(links).select(F.col("id").alias("rep"), "component")
    return buckets.join(classes, "rep", "left").select("rep", "band", F.coalesce("component", "rep").alias("label"))


def _mixed(labelled: DataFrame, turn: int) -> DataFrame:
    """Buckets of several classes, with a pivot and its class; a table, so that Spark can split a popular bucket."""
    order = F.col("rep") if turn == 0 else F.xxhash64("rep", F.lit(turn))
    found = labelled.groupBy("band").agg(F.min(F.struct(order.alias("_o"), "rep", "label")).alias("p"), F.min("label").alias("_low"), F.max("label").alias("_high"))
    return save_stage(found.where("_low < _high").select("band", F.col("p.rep").alias("pivot"), F.col("p.label").alias("pivot_label")), "mixed")


def true_links(buckets: DataFrame, texts: DataFrame, percent: int) -> DataFrame | None:
    """Links (a, b) that join all members of buckets(rep, band) whose sets are similar enough, as a forest or a little more."""
    links = None
    for turn in range(ROUNDS):
        labelled = _labelled(buckets, links)
        stars = labelled.join(_mixed(labelled, turn), "band").where("label <> pivot_label").groupBy("rep").agg(F.min("pivot").alias("pivot"))
        found = save_stage(_star_links(save_stage(stars, "stars"), texts, percent), "links")
        links = save_stage(links.unionByName(found), "links") if links is not None else found
    labelled = save_stage(_labelled(buckets, links), "labelled")
    rest = labelled.join(_mixed(labelled, ROUNDS).select("band"), "band")
    # buckets of the same members are compared once
    h = F.xxhash64("rep")
    same = rest.groupBy("band").agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 24)).alias("s"))
    once = save_stage(same.groupBy("n", "x", "s").agg(F.min("band").alias("band")).select("band"), "once")
    members = rest.join(once, "band").join(texts, "rep")
    paired = block_pairs(members, ["band"], F.xxhash64("rep"), F.length("text"), BLOCK_ROWS, BLOCK_BYTES)
    more = map_groups(paired, ["band", "_bi", "_bj"], _verify(percent, SetSketch(banding(percent)[0])), "a long, b long")
    return links.unionByName(more)


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs; links have 100 * intersection >= percent * union."""
    texts = docs.select("doc_id", "text")
    sketched = save_stage(texts.mapInArrow(released(_sketches(*banding(percent))), SKETCHED), "sketched")
    key = ["set_a", "set_b", "n_shingles"]
    known = sketched.where("n_shingles > 0 and doc_id is not null")
    reps = save_stage(known.groupBy(*key).agg(F.min("doc_id").alias("rep")), "reps")

    banded = known.join(reps, key).where("doc_id = rep").select("rep", F.explode("bands").alias("band"))
    shared = save_stage(banded.groupBy("band").agg(F.min("rep").alias("_low"), F.max("rep").alias("_high")).where("_low < _high").select("band"), "shared")
    buckets = save_stage(banded.join(shared, "band").distinct(), "buckets")
    ids = buckets.select("rep").distinct()
    # texts that are in no bucket are not moved, nor kept
    candidates = save_stage(texts.withColumnRenamed("doc_id", "rep").join(broadcast_if_small(ids, BROADCAST_IDS), "rep"), "candidates")

    classes = connected_components(true_links(buckets, candidates, percent)).select(F.col("id").alias("rep"), "component")
    named = sketched.select("doc_id", *key).join(reps.join(classes, "rep", "left"), key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

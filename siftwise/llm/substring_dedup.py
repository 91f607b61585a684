"""Exact removal of repeated byte strings: prefix doubling on ranks at sampled positions.

A byte goes when a string of WINDOW bytes over it also starts anywhere else, in any text. Ranking all positions at
lengths 1, 2, 4, ... would sort every byte of the corpus many times, so ranks are kept where they can still matter:

1. Every window holds one anchor, the position of the smallest hash among its CORE-byte strings; equal windows have
   it at the same place. Windows that follow each other and share an anchor form a run. The run's rank starts at the
   CORE bytes that all its windows share; Spark groups these ranks, and what is unique is done: nothing repeats.
2. At the next offsets the rank is that of the run's whole string. Runs whose whole string is found again are past
   the threshold: all their windows repeat, and one of them stands for all from here on.
3. In the rest, where the core repeats and the whole does not, single windows are ranked. A core of GROUP strings at
   most is compared in one task. Around a more popular core every position has a pair of ranks, those of the first
   and of the last half of its window; Spark deals positions by these pairs and counts equal ones. Windows found
   again are past the threshold, all others are unique; both ways give the same.

Steps 1 and 2 move a few numbers per 30 to 50 bytes of text. All counts are sums on the map side first, and counted
ranks are tables of their own that meet runs or positions in joins whose partitions Spark can split: a core, a whole
string or a window that is everywhere sits in no single task, and no task holds more than GROUP strings of a core.
Strings are compared by 128 bits of hash (core and whole, two halves, or two polynomials), never by more.

Defined cases: null and empty texts have no bytes and lose none; texts shorter than the window lose none; very long
texts are hashed in parts that overlap by a window, each window in one part; a null doc_id is a document as any other;
rows that repeat a doc_id are texts of their own (equal rows repeat each other), told apart by 64 bits of hash; of
equal runs the least by doc_id, hash of the text and place stands for all, so a task that runs again decides alike;
extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwise.llm.blocks import map_groups
from siftwise.llm.memory import released
from siftwise.llm.sketches import BASE, BYTE_VALUE, mix
from siftwise.plans.stages import save_stage

CORE = 48
#: Strings of one core that one task compares; bytes hashed at once.
GROUP = 4_000
CHUNK = 1 << 20
PLACE_BITS = 24
BASE_2 = np.uint64(0xD6E8FEB86659FD93)
KEY = ["doc_id", "tag"]
RUN = "doc_id long, tag long, core long, whole long, start int, n int"


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Hashes:
    """64-bit hashes of any substrings of one byte array: differences of prefix sums, moved to a common place."""

    def __init__(self, data: np.ndarray, base: np.uint64 = BASE):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[data] * _powers(max(1, len(data)), base)[: len(data)], out=self.sums[1:])
        self.back = _powers(len(data) + 1, np.uint64(pow(int(base), -1, 1 << 64)))

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix((self.sums[stops] - self.sums[starts]) * self.back[starts])


def runs_of(texts: list[bytes], window: int, core: int) -> tuple[np.ndarray, ...]:
    """text number, core hash, whole hash, first window and number of windows of every run; texts under 16 MB."""
    lengths = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    n, width = len(data), window - core + 1
    if n < window:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    hashes = _Hashes(data)
    at = np.arange(n - core + 1)
    cores = hashes.of(at, at + core)
    # smallest hash of every `width` neighbours, leftmost at ties: the place is in the low bits
    low = np.uint64((1 << PLACE_BITS) - 1)
    keyed = np.concatenate(((cores & ~low) | at.astype(np.uint64), np.full(-len(at) % width, ~np.uint64(0)))).reshape(-1, width)
    ahead = np.minimum.accumulate(keyed, axis=1).reshape(-1)
    behind = np.minimum.accumulate(keyed[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    anchor = (np.minimum(behind[: n - window + 1], ahead[width - 1 : len(at)]) & low).astype(np.int64)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(texts)), lengths)[: len(anchor)]
    inside = np.flatnonzero(np.arange(len(anchor)) + window <= ends[owner])
    if not len(inside):
        return tuple(np.empty(0, np.int64) for _ in range(5))
    anchor, owner = anchor[inside], owner[inside]
    fresh = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1] + 1))))
    first, last = inside[fresh], inside[np.append(fresh[1:], len(inside)) - 1]
    whole = hashes.of(first, last + window)
    return owner[fresh], cores[anchor[fresh]].view(np.int64), whole.view(np.int64), first - (ends - lengths)[owner[fresh]], last - first + 1


def _pieces(texts: list[bytes], window: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in lots of about CHUNK bytes; a longer text in overlapping parts, each window in one part only."""
    index, offset, lot, total = [], [], [], 0
    for i, t in enumerate(texts):
        step = 4 * CHUNK
        for k in range(0, max(1, len(t) - window + 1), step):
            part = t[k : k + step + window - 1]
            index.append(i)
            offset.append(k)
            lot.append(part)
            total += len(part)
            if total >= CHUNK:
                yield index, offset, lot
                index, offset, lot, total = [], [], [], 0
    if lot:
        yield index, offset, lot


def _runs(window: int, core: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
            for index, offset, lot in _pieces(texts, window):
                number, cores, whole, first, n = runs_of(lot, window, core)
                rows = np.array(index, np.int64)[number]
                start = first + np.array(offset, np.int64)[number]
                ids = pa.array(rows)
                columns = [batch.column(0).take(ids), batch.column(1).take(ids), *map(pa.array, (cores, whole, start.astype(np.int32), n.astype(np.int32)))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tag", "core", "whole", "start", "n"])

    return run


def _ranked(runs: DataFrame) -> DataFrame:
    """Runs with a repeated core, `same` (runs of equal whole), `least` (smallest `same` of the core) and `stand_in`."""
    # tables of their own, so that Spark can split the partitions of a popular core or whole in the joins
    cores = save_stage(runs.groupBy("core").agg(F.count("*").alias("many")).where("many > 1").select("core"), "cores")
    joined = save_stage(runs.join(cores, "core").withColumn("me", F.struct(*KEY, "start")), "repeated")
    wholes = save_stage(joined.groupBy("core", "whole", "n").agg(F.count("*").alias("same"), F.min("me").alias("one")), "wholes")
    least = save_stage(wholes.groupBy("core").agg(F.min("same").alias("least")), "least")
    wholes = save_stage(wholes.join(least, "core"), "wholes")
    return joined.join(wholes, ["core", "whole", "n"]).withColumn("stand_in", F.col("me").eqNullSafe(F.col("one"))).drop("me", "one")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes: they are moved and kept so."""
    press = zstandard.ZstdCompressor(level=3)
    for b in batches:
        for k in range(0, len(b), 500):
            part = b.slice(k, 500)
            yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array([press.compress((t or "").encode()) for t in part.column(2).to_pylist()], pa.binary())], ["doc_id", "tag", "packed"])


def _unpacked(value: pa.Scalar) -> bytes:
    return zstandard.decompress(value.as_py())


def _strings(window: int):
    """The bytes of the runs to be compared, from each text and its list of runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "tag", "core", "start", "weight", "bytes"]
        for batch in batches:
            for i in range(len(batch)):
                probes = [r for r in batch.column(3)[i].as_py() if r["weight"] > 0]
                if not probes:
                    continue
                text = _unpacked(batch.column(2)[i])
                columns = [[batch.column(0)[i].as_py()] * len(probes), [batch.column(1)[i].as_py()] * len(probes)]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                columns += [[r[c] for r in probes] for c in ("core", "start", "weight")] + [[text[r["start"] : r["start"] + r["n"] + window - 1] for r in probes]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def _windows(window: int):
    """Every position of the strings, with the ranks of the first and the last half of its window."""
    half = (window + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 500):
                part = batch.slice(k, 500)
                strings = part.column("bytes").to_pylist()
                lengths = np.array([len(x) for x in strings])
                n = lengths - window + 1
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                hashes, at = _Hashes(np.frombuffer(b"".join(strings), np.uint8)), np.repeat(np.cumsum(lengths) - lengths, n) + place
                ranks = [hashes.of(at, at + half), hashes.of(at + window - half, at + window)]
                rows = pa.array(np.repeat(np.arange(len(part)), n))
                start = np.repeat(part.column("start").to_numpy(), n) + place
                columns = [part.column("doc_id").take(rows), part.column("tag").take(rows), pa.array(start.astype(np.int32)), part.column("weight").take(rows), *(pa.array(r.view(np.int64)) for r in ranks)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tag", "start", "weight", "first", "last"])

    return run


def _compare(window: int):
    """Stretches of repeated windows in groups of runs with one core."""

    def run(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(t))))
        strings = t.column("bytes").to_pylist()
        lengths = np.array([len(s) for s in strings])
        n = lengths - window + 1
        data = np.frombuffer(b"".join(strings), np.uint8)
        row = np.repeat(np.arange(len(strings)), n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        begin = (np.cumsum(lengths) - lengths)[row] + place
        one = _Hashes(data).of(begin, begin + window)
        two = _Hashes(data, BASE_2).of(begin, begin + window)
        key = one + group.astype(np.uint64)[row] * BASE_2
        order = np.argsort(key)
        new, differs = key[order][1:] != key[order][:-1], two[order][1:] != two[order][:-1]
        if (differs & ~new).any():  # one hash agrees and the other does not
            order = np.lexsort((two, key))
            new, differs = key[order][1:] != key[order][:-1], two[order][1:] != two[order][:-1]
        g = np.concatenate(([True], new | differs))[: len(order)]
        number = np.cumsum(g) - 1
        weight = t.column("weight").to_numpy()
        total = np.bincount(number, weights=weight[row][order]) if len(g) else np.zeros(0)
        found = np.zeros(len(row), bool)
        found[order] = total[number] > 1
        found &= weight[row] == 1  # stand-ins are known to repeat
        at = np.flatnonzero(found)
        if not len(at):
            return
        r, p = row[at], place[at]
        first = np.concatenate(([True], (r[1:] != r[:-1]) | (p[1:] != p[:-1] + 1)))
        lo = np.flatnonzero(first)
        hi = np.append(lo[1:], len(at)) - 1
        rows = pa.array(r[lo])
        start = t.column("start").to_numpy()[r[lo]] + p[lo]
        columns = [t.column("doc_id").take(rows).combine_chunks(), t.column("tag").take(rows).combine_chunks(), pa.array(start.astype(np.int32)), pa.array((p[hi] - p[lo] + 1).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tag", "start", "n"])

    return run


def _merge(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Union of intervals as maximal ones, touching ones joined."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    fresh = np.concatenate(([True], starts[1:] > stops[:-1]))
    lo = np.flatnonzero(fresh)
    return list(zip(starts[lo].tolist(), stops[np.append(lo[1:], len(starts)) - 1].tolist(), strict=True))


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "tag", "spans", "n_removed", "kept_sha256"]
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for i in range(len(batch)):
                text = _unpacked(batch.column(2)[i])
                places, more = [r for r in batch.column(3)[i].as_py() if r["weight"] != 1], batch.column(4)[i].values
                start, n = (np.concatenate((np.array([r[c] for r in places], np.int64), more.field(c).to_numpy() if more is not None else [])).astype(np.int64) for c in ("start", "n"))
                if not len(start):
                    continue
                spans = _merge(start, start + n + window - 1)
                edges = [0, *[x for s in spans for x in s], len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                values = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), [{"start": a, "stop": b} for a, b in spans], sum(b - a for a, b in spans), hashlib.sha256(kept).hexdigest()
                for c, v in zip(out, values, strict=True):
                    c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return run


def repeated_spans(docs: DataFrame, window: int = 200, core: int = CORE) -> DataFrame:
    """doc_id, tag, spans (start, stop in bytes), n_removed, kept_sha256 of the texts that lose bytes; tag tells rows of one doc_id apart."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    if not 0 < core <= window:
        raise ValueError("core must be in 1 ... window")
    # hashed once: ranks are counted, then joined
    runs = save_stage(texts.where(F.octet_length("text") >= window).mapInArrow(released(_runs(window, core)), RUN), "runs")
    # weight 0: repeats as a whole; 2: the same, and stands for it in its core's group; 1: to be compared
    weight = F.when(F.col("same") == 1, 1).when(F.col("stand_in") & (F.col("least") == 1), 2).otherwise(0)
    by_text = _ranked(runs).groupBy(*KEY).agg(F.collect_list(F.struct(F.when(weight > 0, F.col("core")).alias("core"), "start", "n", weight.alias("weight"))).alias("runs"))
    # equal rows have equal keys: joined once each
    packed = texts.where(F.octet_length("text") >= window).mapInArrow(released(_packed), "doc_id long, tag long, packed binary")
    touched = save_stage(_null_safe(packed, by_text), "touched")

    strings = save_stage(touched.mapInArrow(released(_strings(window)), "doc_id long, tag long, core long, start int, weight int, bytes binary"), "strings")
    popular = save_stage(strings.groupBy("core").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select("core"), "popular")
    found = map_groups(strings.join(popular, "core", "left_anti"), ["core"], _compare(window), "doc_id long, tag long, start int, n int")
    positions = strings.join(popular, "core", "left_semi").mapInArrow(released(_windows(window)), "doc_id long, tag long, start int, weight int, first long, last long")
    ranks = save_stage(positions.groupBy("first", "last").agg(F.sum("weight").alias("same")).where("same > 1").select("first", "last"), "ranks")
    hot = positions.where("weight = 1").join(ranks, ["first", "last"])  # stand-ins are known to repeat
    found = found.unionByName(hot.select(*KEY, "start", F.lit(1).alias("n")))
    more = found.groupBy(*KEY).agg(F.collect_list(F.struct("start", "n")).alias("more"))
    return _null_safe(touched, more, "left").mapInArrow(released(_cut(window)), "doc_id long, tag long, spans array<struct<start:int,stop:int>>, n_removed long, kept_sha256 string")


def _null_safe(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    right = right.withColumnsRenamed({k: f"_{k}" for k in KEY})
    return left.join(right, left["doc_id"].eqNullSafe(right["_doc_id"]) & (left["tag"] == right["_tag"]), how).drop("_doc_id", "_tag")


def dedup_substrings(docs: DataFrame, window: int = 200, core: int = CORE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of docs(doc_id, text)."""
    cut = repeated_spans(docs, window, core).dropDuplicates(KEY)
    every = docs.select("doc_id", F.xxhash64("text").alias("tag"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("whole_sha256"))
    return _null_safe(every, cut, "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )

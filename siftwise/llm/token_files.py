"""Token-id files: encode texts, write ids in range-coded blocks in doc_id order, read them back.

A file set is a folder of Spark part files (committed as Spark commits, so a lost executor's tasks are written
again). Each row is a segment of whole documents: part, base (ids before it in its part), doc_ids, lengths and data, a
stream of independently reset, checksummed blocks (idcoder.py; coded in the JVM by idcoder_jvm.py, whose bytes are the
same, where the session has one to reach). Parts are ranges of doc_id. Only the ids total of each
part is summed on the driver's side, in a join of as many rows as there are parts.

Defined cases: a null or empty text holds just the end id; a very long text is one document of a segment of its own
size; a null doc_id comes first; rows that repeat a doc_id (ties of the order) follow each other by a hash of the text; extra columns are ignored; an empty table writes and reads as no documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwise.llm import idcoder, idcoder_jvm
from siftwise.llm.bpe import LibraryBPE, shared
from siftwise.llm.memory import released

SEGMENT = "part long, base long, doc_ids array<long>, lengths array<long>, data binary"
#: Ids coded at once (lanes of 2048 ids each) and in one segment, but for a document that is longer.
AT_ONCE, PER_SEGMENT = 8_000_000, 500_000


def _write(path: str, end_id: int, per_segment: int, raw: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, base, end = shared(LibraryBPE, path), TaskContext.get().partitionId(), 0, np.array([end_id], "<u4").tobytes()
        segments: list[tuple[list, list[int], list[bytes]]] = [([], [], [])]
        held = in_segment = 0

        def flush(kept: int = 0) -> Iterator[pa.RecordBatch]:
            """Write all segments but the last `kept`."""
            nonlocal base, held
            full = [s for s in segments[: len(segments) - kept] if s[0]]
            data = [b"".join(s[2]) for s in full]
            if not raw:
                data = idcoder.encode([np.frombuffer(d, "<u4") for d in data])
            for (ids, lengths, _), coded in zip(full, data, strict=True):
                yield pa.RecordBatch.from_pylist(
                    [{"part": part, "base": base, "doc_ids": ids, "lengths": lengths, "data": coded}],
                    schema=pa.schema([("part", pa.int64()), ("base", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("data", pa.binary())]),
                )
                base += sum(lengths)
            segments[:] = segments[-1:] if kept else [([], [], [])]
            held = 0

        for batch in batches:
            for piece in _pieces(batch):
                for doc_id, coded in zip(piece.column(0).to_pylist(), encoder.encode_many(piece.column(1).to_pylist()), strict=True):
                    n = len(coded) // 4 + 1
                    if in_segment + n > per_segment and segments[-1][0]:
                        segments.append(([], [], []))
                        in_segment = 0
                    now = segments[-1]
                    now[0].append(doc_id)
                    now[1].append(n)
                    now[2].extend((coded, end))
                    held += n
                    in_segment += n
                # numpy codes many lanes at once; the JVM takes segment by segment
                if raw and len(segments) > 1:
                    yield from flush(kept=1)
                elif not raw and held >= AT_ONCE:
                    yield from flush()
                    in_segment = 0
        yield from flush()

    return run


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """At most 200 rows, or as few as have AT_ONCE letters or more."""
    start = held = 0
    for k, n in enumerate(pc.utf8_length(batch.column(1)).to_pylist()):
        held += n or 0
        if k + 1 - start == 200 or held >= AT_ONCE:
            yield batch.slice(start, k + 1 - start)
            start, held = k + 1, 0
    if start < len(batch):
        yield batch.slice(start)


def write_token_files(docs: DataFrame, out: str, tokenizer_path: str, end_id: int = 0, partitions: int | None = None, per_segment: int = PER_SEGMENT) -> None:
    """Write docs(doc_id, text) to the folder out, by ascending doc_id."""
    rows = docs.select("doc_id", "text")
    n = [partitions] if partitions else []
    ranged = rows.repartitionByRange(*n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    raw = idcoder_jvm.register(docs.sparkSession)
    # a worker's next task finds the words that this one has met; their number is bounded
    segments = ranged.mapInArrow(released(_write(tokenizer_path, end_id, per_segment, raw)), SEGMENT)
    if raw:
        segments = segments.withColumn("data", F.call_udf("siftwise_ids_encode", "data"))
    segments.write.option("compression", "none").parquet(out)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "base", "doc_id", "n_tokens", "ids"]
    for batch in batches:
        for k in range(0, len(batch), 12):
            rows = batch.slice(k, 12).to_pylist()
            for row, ids in zip(rows, idcoder.decode([r["data"] for r in rows]), strict=True):
                lengths = np.array(row["lengths"], np.int64)
                if lengths.sum() != len(ids):
                    raise ValueError("a segment's lengths and ids differ")
                starts = np.cumsum(lengths) - lengths
                raw = ids.astype("<u4").tobytes()
                parts = [raw[4 * s : 4 * (s + n)] for s, n in zip(starts, lengths, strict=True)]
                columns = [np.full(len(lengths), row["part"]), row["base"] + starts]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(row["doc_ids"], pa.int64()), pa.array(lengths), pa.array(parts, pa.binary())], names)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): start counts the ids of all documents before; ids are little-endian 32-bit."""
    segments = spark.read.schema(SEGMENT).parquet(path)
    # lengths only: the column of data is not read for this
    totals = segments.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    # one row per part, so a window over all of them is small
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead"))
    if idcoder_jvm.register(spark):
        documents = F.inline(F.call_udf("siftwise_ids_documents", "base", "doc_ids", "lengths", "data"))
        decoded = segments.select("part", documents).withColumnRenamed("start", "base")
    else:
        decoded = segments.mapInArrow(released(_read), "part long, base long, doc_id long, n_tokens long, ids binary")
    return decoded.join(F.broadcast(before), "part").select("doc_id", (F.col("base") + F.col("ahead")).alias("start"), "n_tokens", "ids")

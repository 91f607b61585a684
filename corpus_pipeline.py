"""A training-data pipeline over documents: reject toxic ones, drop repeated lines, keep one of each group of near
duplicates, drop leaked benchmark items, encode. Each stage is written as Parquet and read again as the next one's docs.

Defined cases of every stage: an empty documents table gives an empty table, and columns besides those of documents, or of
the names that an operator makes, never reach it, as each stage selects the columns of its input. Null and empty texts pass
the first four stages and have no ids; very long texts are worked on whole. A stage's docstring states the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwise.llm import decontamination, line_dedup, minhash_dedup, toxicity
from siftwise.llm.bpe import PrefixBPE, forget, shared
from siftwise.llm.memory import released
from siftwise.plans.stages import save_stage, table

TOKENIZER = "byte_bpe_50k.json"
#: Near duplicates share this percentage of the union of their five-word shingles.
SIMILAR = 80


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5 (a tie at 0.5 goes); trained on the labelled ones that are not held out.

    Each row is judged by its text: repeated rows go or stay together, a null doc_id is judged as any other. Without labels
    (an empty table, or nulls only) every document stays; with labels of the toxic class alone none does."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of 40 code points or more that 5 documents hold, but for the last document's.

    A text that loses all lines becomes empty and its row stays. Rows that repeat a doc_id are one document; a row with a
    null doc_id keeps all its lines."""
    kept = line_dedup.dedup_lines(docs)
    changed = kept.withColumn("text", F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text")))
    return changed.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group (there are no ties); documents without words or id stay.

    Rows that repeat a doc_id are one document: all of them stay, or all go."""
    gone = minhash_dedup.near_duplicates(docs, SIMILAR).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_leaked_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item of the benchmark; 80 % of an item's tokens in place, that share included, are enough.

    Rows that repeat a doc_id go when one of them holds an item; a null doc_id stays; an empty benchmark drops nothing."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids; every text is decoded again and must come back."""
    return encode_documents(docs, public_tokenizers.path(TOKENIZER))


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids of every row of docs, whatever repeats or is null; a text that does not come back
    when its ids are decoded raises ValueError."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared(PrefixBPE, tokenizer_path)
        for batch in batches:
            for k in range(0, len(batch), 500):
                rows = batch.slice(k, 500)
                ids = []
                for text in rows.column(3).to_pylist():
                    own = bpe.encode(text)
                    if bpe.decode(own.tolist()) != (text or ""):
                        raise ValueError("a decoded text differs")
                    ids.append(own.astype(np.int32))
                counts = np.array([len(x) for x in ids], np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(counts), lists], ["doc_id", "lang", "source", "n_tokens", "ids"])

    return docs.select("doc_id", "lang", "source", "text").mapInArrow(released(run, forget), "doc_id long, lang string, source string, n_tokens long, ids array<int>")


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_near_duplicates),
    ("decontamination", drop_leaked_benchmark),
    ("bpe", encode),
]

#: Classifier, components and BPE are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save_stage(stage(spark, docs, sf_dir), name)
    return docs

"""opN_ queries of the token operators (1, 3); SQL cannot express them, tests compare with the library."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwise.llm import token_files
from siftwise.llm.bpe import PrefixBPE, shared
from siftwise.llm.memory import released
from siftwise.plans.stages import fresh_path, table

TOKENIZER = "byte_bpe_50k.json"


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), out, public_tokenizers.path(TOKENIZER))
    return token_files.read_token_files(spark, out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def bpe_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of docs(doc_id, text).

    A row stands alone: rows that repeat are all returned, a null or empty text has no ids, a very long one is encoded
    whole; other columns, whatever their names, are ignored; an empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared(PrefixBPE, tokenizer_path)
        for batch in batches:
            counts, ids_sha, decoded_sha = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py()).tolist()
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(bpe.written(ids).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(released(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


QUERIES = {"op1_token_files": op1_token_files, "op3_bpe": op3_bpe}
SQL: dict[str, str] = {}

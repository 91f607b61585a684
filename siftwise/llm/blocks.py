"""Pairs within groups of any size, as blocks against blocks: no group sits in one task and no pair is a row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwise.llm.memory import released


def block_pairs(members: DataFrame, group: list[str], salt: Column, n_bytes: Column, block_rows: int, block_bytes: int) -> DataFrame:
    """members with _bi, _bj and _own: each row once for every pair of blocks of its group that its own block is in.

    The number of blocks follows a group's rows and bytes (counted first, with map-side sums), so a pair of blocks
    is bounded whatever the group's size; groups of one row are left out.
    """
    sizes = members.groupBy(*group).agg(F.count("*").alias("_rows"), F.sum(n_bytes).alias("_bytes")).where("_rows > 1")
    k = F.greatest(F.ceil(F.col("_rows") / block_rows), F.ceil(F.col("_bytes") / block_bytes)).cast("int")
    joined = members.join(sizes.select(*group, k.alias("_k")), group)
    own = F.pmod(salt, F.col("_k")).cast("int")
    return (
        joined.withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        .withColumn("_bi", F.least("_own", "_other"))
        .withColumn("_bj", F.greatest("_own", "_other"))
        .drop("_k", "_other")
    )


def map_groups(df: DataFrame, key: list[str], fn: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], schema: str, max_bytes: int = 4 << 20) -> DataFrame:
    """fn over whole groups of `key` (integers without nulls): a table of about max_bytes and the first row of each group in it.

    Groups are dealt by a shuffle and a sort on the key; fn gets many small groups at a time, or one larger one.
    """

    def first_rows(t: pa.Table) -> np.ndarray:
        fresh = np.zeros(len(t), bool)
        fresh[0] = True
        for k in key:
            x = t.column(k).to_numpy()
            fresh[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(fresh)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n_bytes = 0
        for batch in batches:
            for k in range(0, len(batch), 1000):
                held.append(batch.slice(k, 1000))
                n_bytes += held[-1].nbytes
                # rows are sorted: with equal keys at both ends all that is held is one group, which may go on
                if n_bytes < max_bytes or all(held[0].column(c)[0] == held[-1].column(c)[len(held[-1]) - 1] for c in key):
                    continue
                t = pa.Table.from_batches(held).combine_chunks()
                starts = first_rows(t)
                # the last group may go on
                yield from fn(t.slice(0, starts[-1]).combine_chunks(), starts[:-1])
                held = t.slice(starts[-1]).to_batches()
                n_bytes = sum(b.nbytes for b in held)
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            if len(t):
                yield from fn(t, first_rows(t))

    return df.repartition(*key).sortWithinPartitions(*key).mapInArrow(released(run), schema)

"""Connected components by distributed min-label star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwise.plans.stages import drop_stage, save_stage


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """edges(a, b) of longs -> (id, component), component = smallest id reachable; only ids that have an edge.

    Alternating large-star and small-star rounds (each a groupBy-min and a join back, never a collected
    neighbour list), so the work per round is linear in the edges. The minima are tables of their own: a join with an
    aggregate of the same key would bring each hub's edges to one task, a join with a table can be split by Spark.
    Each round is written to the shared folder; nothing but a change count reaches the driver.
    """
    now = save_stage(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "cc",
    )
    mark = _mark(now)
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = save_stage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "cc-low")
        # large star: every neighbour that is larger than v hangs on v's smallest neighbour
        large = save_stage(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "cc-large")
        # small star: v and its smaller neighbours hang on the smallest of them
        small_low = save_stage(large.groupBy("a").agg(F.min("b").alias("m")), "cc-low")
        small = (
            large.join(small_low, "a")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("x"))
            .select(F.col("x.b").alias("a"), F.col("x.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        after = save_stage(small, "cc")
        for done in (now, low, large, small_low):
            drop_stage(done)
        now, was, mark = after, mark, _mark(after)
        if mark == was:
            break
    else:
        raise RuntimeError("components did not converge")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free hash of an edge set: equal marks mean a fixed point."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

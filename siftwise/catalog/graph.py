"""T16 to T21: the precomputed similarity graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwise.catalog.registry import query
from siftwise.catalog.searches import EXACT, K, queries
from siftwise.catalog.vectors import embeddings
from siftwise.operators import knn, service, simgraph
from siftwise.plans.stages import table

EDGES = EXACT + """, f AS (SELECT qid, id, dist FROM k WHERE dist <= 0.75 AND qid <> id),
edges AS (SELECT src, dst, round(min(dist), 5) + 0.0 AS dist FROM (SELECT qid AS src, id AS dst, dist FROM f UNION ALL SELECT id, qid, dist FROM f) GROUP BY 1, 2)
"""


def edges(spark, d):
    found = knn.near_duplicates(knn.exact_knn(embeddings(spark, d), queries(spark, d), K), 0.75)
    return simgraph.symmetric_edges(found).select("src", "dst", (F.round("dist", 5) + 0.0).alias("dist"))


query("t16", EDGES + "SELECT src, dst, dist FROM edges")(edges)


@query("t17", "SELECT vec_id FROM embeddings WHERE label IS NOT NULL AND vec_id % 3 <> 0")
def t17(spark, d):
    rows = embeddings(spark, d).select("vec_id", F.col("label").alias("feat_id"), F.when(F.col("vec_id") % 3 == 0, F.lit(True)).alias("precomp"))
    return simgraph.eligible(rows).select("vec_id")


@query("t18", EDGES + "SELECT src, dst, dist, 'Y2024W' || strftime(TIMESTAMP '2024-01-01' + to_days((src % 300)::INT), '%W') AS year_week FROM edges")
def t18(spark, d):
    day = F.expr("cast(timestamp_ntz'2024-01-01' + make_dt_interval(cast(src % 300 as int)) as timestamp_ntz)")
    return simgraph.weekly(edges(spark, d), day)


@query("t19", EDGES + "SELECT v.vec_id AS src, e.dst, e.dist FROM embeddings v LEFT JOIN edges e ON e.src = v.vec_id")
def t19(spark, d):
    keys = embeddings(spark, d).select(F.col("vec_id").alias("src"))
    return simgraph.neighbours_of(edges(spark, d), keys)


@query("t20", "SELECT upper(least(a, b) || '-' || greatest(a, b)) AS pair, min(x)::DOUBLE AS dist FROM (SELECT 'k' || (doc_id % 20) AS a, 'k' || (doc_id % 7) AS b, doc_id % 13 AS x FROM documents) WHERE a <> b GROUP BY 1")
def t20(spark, d):
    k = lambda n: F.concat(F.lit("k"), (F.col("doc_id") % n).cast("string"))
    rows = table(spark, d, "documents").select(k(20).alias("key"), k(7).alias("other"), (F.col("doc_id") % 13).cast("string").alias("x"), F.floor(F.col("doc_id") / 100).alias("part"))
    lists = rows.groupBy("key", "part").agg(F.collect_list(F.struct("other", "x")).alias("r")).select("key", F.array_join("r.other", ",").alias("hashes"), F.array_join("r.x", ",").alias("dists"))
    return simgraph.canonical_pairs(lists, "key", "hashes", "dists")


@query("t21", "SELECT doc_id AS feat_id, doc_id % 5 <> 0 AS sound FROM documents")
def t21(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("feat_id"), F.sha1("text").alias("sha1"))
    wrong = rows.withColumn("sha1", F.when(F.col("feat_id") % 5 == 0, F.lit("none")).otherwise(F.col("sha1")))
    sound, misaligned = service.check_alignment(wrong, rows)
    return sound.select("feat_id", F.lit(True).alias("sound")).unionByName(misaligned.select("feat_id", F.lit(False).alias("sound")))

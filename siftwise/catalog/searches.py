"""T01 to T15: similarity search."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwise.catalog.registry import query
from siftwise.catalog.sources import fresh
from siftwise.catalog.vectors import ASSIGN, FIXED, HASHED, assigned, codes, embeddings, fixed_coarse, fixed_model, trained
from siftwise.functions import scalar as s
from siftwise.operators import knn, lopq

QUERY = "vec_id % 20 = 0"
RATIO, K = 0.2, 10

HAMMING = HASHED + ", h AS (SELECT q.vec_id AS qid, c.vec_id AS id, (bit_count(xor(q.w0, c.w0)) + bit_count(xor(q.w1, c.w1)))::INT AS hd FROM code q, code c WHERE q.vec_id % 20 = 0)"
SHORT = HAMMING + ", t AS (SELECT qid, id, hd FROM h QUALIFY row_number() OVER (PARTITION BY qid ORDER BY hd, id) <= (SELECT ceil(count(*) * 0.2) FROM embeddings))"
RERANKED = SHORT + """, r AS (SELECT t.qid, t.id, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) ** 2 / 2 AS dist FROM t JOIN embeddings a ON a.vec_id = t.qid JOIN embeddings b ON b.vec_id = t.id),
k AS (SELECT qid, id, dist, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM r QUALIFY rank <= 10)"""
EXACT = """
WITH k AS (SELECT a.vec_id AS qid, b.vec_id AS id, 1 - list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS dist,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY 1 - list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), b.vec_id) AS rank
  FROM embeddings a, embeddings b WHERE a.vec_id % 20 = 0 QUALIFY rank <= 10)
"""


def shown(found):
    return found.select("qid", "id", F.col("rank").cast("long").alias("rank"), (F.round("dist", 5) + 0.0).alias("dist"))


def queries(spark, d):
    return embeddings(spark, d).where(QUERY)


def found(spark, d):
    c = codes(spark, d)
    return knn.hamming_knn(embeddings(spark, d), queries(spark, d), c, c.where(QUERY), K, RATIO)


@query("t01", f"SELECT vec_id FROM embeddings WHERE {QUERY}")
def t01(spark, d):
    return queries(spark, d).select("vec_id")


@query("t02", HAMMING + "SELECT qid, hd, count(*) AS n FROM h GROUP BY 1, 2")
def t02(spark, d):
    c = codes(spark, d)
    return knn.hamming_histogram(c, c.where(QUERY))


@query("t03", SHORT + "SELECT qid, id, hd FROM t")
def t03(spark, d):
    c = codes(spark, d)
    return knn.hamming_shortlist(c, c.where(QUERY), knn.shortlist_size(c.count(), RATIO)).select("qid", "id", F.col("dist").cast("int").alias("hd"))


@query("t04", RERANKED + "SELECT qid, id, round(dist, 5) + 0.0 AS dist FROM r")
def t04(spark, d):
    c = codes(spark, d)
    near = knn.reranked(embeddings(spark, d), queries(spark, d), c, c.where(QUERY), knn.shortlist_size(c.count(), RATIO))
    return near.select("qid", "id", (F.round("dist", 5) + 0.0).alias("dist"))


@query("t05", RERANKED + "SELECT qid, id, rank, round(dist, 5) + 0.0 AS dist FROM k")
def t05(spark, d):
    return shown(found(spark, d))


@query("t06", RERANKED.replace("list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) ** 2 / 2", "1 - list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])") + "SELECT qid, id, rank, round(dist, 5) + 0.0 AS dist FROM k")
def t06(spark, d):
    c = codes(spark, d)
    return shown(knn.hamming_knn(embeddings(spark, d), queries(spark, d), c, c.where(QUERY), K, RATIO, knn.inner_distance))


@query("t07", RERANKED + "SELECT qid, string_agg(id, ',' ORDER BY rank) AS ids FROM k GROUP BY 1")
def t07(spark, d):
    return knn.as_lists(found(spark, d)).select("qid", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@query("t08", EXACT + "SELECT qid, id, rank, round(dist, 5) + 0.0 AS dist FROM k WHERE rank <= 3")
def t08(spark, d):
    return shown(knn.exact_knn(embeddings(spark, d), queries(spark, d), 3))


@query("t09", EXACT + "SELECT qid, id, rank, round(dist, 5) + 0.0 AS dist FROM k WHERE dist <= 0.6")
def t09(spark, d):
    return shown(knn.near_duplicates(knn.exact_knn(embeddings(spark, d), queries(spark, d), K), 0.6))


CELLS = ASSIGN + """, r AS (SELECT q.vec_id AS qid, a.k::INT AS c0, b.k::INT AS c1, list_distance(q.x[1:32], a.x[1:32]) ** 2 + list_distance(q.x[33:64], b.x[33:64]) ** 2 AS dist FROM e q, c a, c b WHERE q.vec_id % 20 = 0),
cells AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, c0, c1) AS rank FROM r)"""


@query("t10", CELLS + "SELECT qid, rank::INT AS rank, round(dist, 5) + 0.0 AS dist FROM cells")
def t10(spark, d):
    return lopq.ranked_cells(queries(spark, d), "vec_id", "embedding", fixed_coarse(spark, d).cs).select("qid", "rank", (F.round("dist", 5) + 0.0).alias("dist"))


@query("t11", CELLS + """, n AS (SELECT c0, c1, count(*) AS n FROM a GROUP BY 1, 2), o AS (SELECT qid, rank, n, coalesce(sum(n) OVER (PARTITION BY qid ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM cells JOIN n USING (c0, c1))
SELECT qid, count(*) AS cells, sum(n)::BIGINT AS items FROM o WHERE before < 100 GROUP BY 1""")
def t11(spark, d):
    cells = lopq.ranked_cells(queries(spark, d), "vec_id", "embedding", fixed_coarse(spark, d).cs)
    return lopq.cells_for_quota(cells, lopq.cell_counts(assigned(spark, d)), 100).groupBy("qid").agg(F.count("*").alias("cells"), F.sum("n").alias("items"))


def lopq_found(spark, d, quota=200, limit=K):
    e, model = embeddings(spark, d), trained(spark, d)
    effort = lopq.tune(e, queries(spark, d), "vec_id", "embedding", model, K, quota)
    return lopq.search_reranked(e, queries(spark, d), "vec_id", "embedding", model, limit, effort)


@query("t12", FIXED + """, r AS (SELECT q.vec_id AS qid, a.k::INT AS c0, b.k::INT AS c1, list_distance(q.x[1:32], a.x[1:32]) ** 2 + list_distance(q.x[33:64], b.x[33:64]) ** 2 AS dist FROM e q, c a, c b WHERE q.vec_id % 20 = 0),
cells AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, c0, c1) AS rank FROM r), n AS (SELECT c0, c1, count(*) AS n FROM a GROUP BY 1, 2),
o AS (SELECT qid, c0, c1, coalesce(sum(n) OVER (PARTITION BY qid ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM cells JOIN n USING (c0, c1)),
h AS (SELECT o.qid, f.vec_id AS id, round(sum(tab.err), 6) + 0.0 AS dist FROM o JOIN a USING (c0, c1) JOIN f ON f.vec_id = a.vec_id JOIN tab ON tab.vec_id = o.qid AND tab.s = f.s AND tab.k = f.k AND tab.j = f.j AND tab.code = f.code WHERE before < 100 GROUP BY 1, 2)
SELECT qid, id, dist FROM h""")
def t12(spark, d):
    """Table distances of all codes in the cells of the quota; t13 has the search that is tuned."""
    model = fixed_model(spark, d)
    coded = lopq.encode(embeddings(spark, d), "vec_id", "embedding", model)
    found = lopq.search(queries(spark, d), "vec_id", "embedding", coded, model, 100, coded.count())
    return found.select("qid", "id", (F.round("dist", 6) + 0.0).alias("dist"))


@query("t13")
def t13(spark, d):
    return lopq_found(spark, d)


@query("t14", ASSIGN + "SELECT c0, c1, string_agg(vec_id, ',' ORDER BY vec_id) AS ids FROM a GROUP BY 1, 2")
def t14(spark, d):
    out = fresh(spark, "t14")
    assigned(spark, d).repartition("c0", "c1").write.partitionBy("c0", "c1").parquet(out)
    back = spark.read.parquet(out).groupBy("c0", "c1").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return back.select("c0", "c1", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@query("t15", EXACT + "SELECT qid, id, rank, round(dist, 5) + 0.0 AS dist FROM k")
def t15(spark, d):
    return shown(knn.exact_knn(embeddings(spark, d), queries(spark, d), K))


@query("t22", "SELECT vec_id AS sha1, vec_id % 2 = 0 AS precomputed FROM embeddings")
def t22(spark, d):
    from siftwise.operators.service import with_features

    e = embeddings(spark, d).select(F.col("vec_id").alias("sha1"), F.col("embedding").cast("array<double>").alias("feat"))
    items = e.select("sha1", F.col("sha1").cast("string").alias("content"))
    return with_features(items, e.where("sha1 % 2 = 0"), lambda c: F.array(F.length(c).cast("double"))).where("feat is not null").select("sha1", "precomputed")


@query("t23")
def t23(spark, d):
    """Service search: unit vectors, PCA, quota of ten times the limit or more, near-duplicate filter, item data."""
    from siftwise.operators import vectors as v

    e = embeddings(spark, d)
    pca = v.fit_pca(e, "embedding", 32)
    unit = e.select("vec_id", s.normalised(F.col("embedding")).alias("embedding"))
    reduced = v.apply_pca(unit, "vec_id", "embedding", pca, "x")
    model = lopq.train(reduced, "x", 4, 8, 16, 7)
    asked = reduced.where(QUERY)
    hits = lopq.search_reranked(reduced, asked, "vec_id", "x", model, K, lopq.tune(reduced, asked, "vec_id", "x", model, K, 10 * K))
    return knn.near_duplicates(hits, 0.6).join(e.select(F.col("vec_id").alias("id"), "label"), "id").select("qid", "id", "rank", "label")

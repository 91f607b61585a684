"""J: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwise.catalog.registry import query
from siftwise.functions import scalar as s
from siftwise.operators import keyed, knn
from siftwise.plans.stages import table

#: Incoming records: one per text of the first half of the sources; existing ones: of the second.
INCOMING = "SELECT upper(sha1(text)) AS sha1, list_sort(list(DISTINCT doc_id::VARCHAR)) AS ids FROM documents WHERE doc_id % 2 = 0 GROUP BY 1"
EXISTING = "SELECT upper(sha1(text)) AS sha1, list_sort(list(DISTINCT doc_id::VARCHAR)) AS ids FROM documents WHERE doc_id % 2 = 1 OR doc_id % 6 = 0 GROUP BY 1"


def records(spark, d, where):
    docs = table(spark, d, "documents").where(where)
    rows = docs.groupBy(s.content_hash(F.col("text")).alias("sha1")).agg(F.array_sort(F.collect_set(F.col("doc_id").cast("string"))).alias("ids"))
    return rows.select("sha1", F.concat(F.lit("https://s3/"), "sha1").alias("url"), "ids", F.lit(None).cast("string").alias("discarded"))


def incoming(spark, d):
    return records(spark, d, "doc_id % 2 = 0")


def existing(spark, d):
    return records(spark, d, "doc_id % 2 = 1 or doc_id % 6 = 0")


MERGED = f"""
WITH i AS ({INCOMING}), e AS ({EXISTING})
SELECT i.sha1, array_to_string(list_sort(list_distinct(list_concat(i.ids, coalesce(e.ids, [])))), ',') AS ids FROM i LEFT JOIN e ON i.sha1 = e.sha1
"""


@query("j01", MERGED)
def j01(spark, d):
    return keyed.upsert_merge(incoming(spark, d), existing(spark, d)).select("sha1", F.array_join("ids", ",").alias("ids"))


@query("j02", "SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def j02(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")


@query("j03", "SELECT doc_id, source, NULL::VARCHAR AS sha1 FROM documents")
def j03(spark, d):
    return table(spark, d, "documents").select("doc_id", "source", F.lit(None).cast("string").alias("sha1"))


@query("j04", "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def j04(spark, d):
    return keyed.split_known(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id"), "doc_id")[1]


@query("j05", "SELECT o.o_orderkey, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderkey % 3 = 0")
def j05(spark, d):
    missing = table(spark, d, "orders").where("o_orderkey % 3 = 0").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return keyed.split_known(missing, table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")[0].select("o_orderkey", "c_mktsegment")


@query("j06", """
WITH e AS (SELECT doc_id AS src, (doc_id * 7) % 1500 AS dst FROM documents)
SELECT src, dst, dst IN (SELECT doc_id FROM labels) AS sound FROM e WHERE src IN (SELECT doc_id FROM labels)
""")
def j06(spark, d):
    edges = table(spark, d, "documents").select(F.col("doc_id").alias("src"), ((F.col("doc_id") * 7) % 1500).alias("dst"))
    sound, dangling = keyed.drop_dangling(edges, table(spark, d, "labels").select(F.col("doc_id").alias("id")), "src", "dst", "id")
    tagged = lambda df, flag: df.select("src", "dst", F.lit(flag).alias("sound"))
    return tagged(sound, True).unionByName(tagged(dangling, False))


@query("j07", "SELECT u.doc_id, u.n, l.quality FROM (SELECT doc_id, n_chars AS n FROM documents WHERE doc_id % 2 = 0) u LEFT JOIN labels l ON u.doc_id = l.doc_id")
def j07(spark, d):
    update = table(spark, d, "documents").where("doc_id % 2 = 0").select("doc_id", F.col("n_chars").alias("n"))
    return update.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")


@query("j08", "SELECT l.l_orderkey, l.l_linenumber, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey")
def j08(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").join(o, "l_orderkey")


@query("j09", "SELECT l.l_orderkey, l.l_linenumber, o.o_orderstatus FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey AND o.o_totalprice > 100000")
def j09(spark, d):
    o = table(spark, d, "orders").where("o_totalprice > 100000").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").join(o, "l_orderkey", "left")


@query("j10", "SELECT f.doc_id, u.doc_id AS unique_id FROM documents f LEFT JOIN (SELECT min(doc_id) AS doc_id, sha1(text) AS h FROM documents GROUP BY 2) u ON sha1(f.text) = u.h")
def j10(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha1("text").alias("h"))
    unique = docs.groupBy("h").agg(F.min("doc_id").alias("unique_id"))
    return docs.join(unique, "h", "left").select("doc_id", "unique_id")


@query("j11", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def j11(spark, d):
    keys = table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return keyed.lookup(table(spark, d, "customer"), keys, "c_custkey").select("c_custkey", "c_mktsegment")


@query("j12", "SELECT p.pos::INT AS pos, p.k AS n_nationkey, n.n_name FROM (SELECT unnest([0, 1, 2, 3]) AS pos, unnest([7, 3, 99, 3]) AS k) p LEFT JOIN nation n ON n.n_nationkey = p.k")
def j12(spark, d):
    return keyed.ordered_lookup(spark, table(spark, d, "nation"), [7, 3, 99, 3], "n_nationkey").select("pos", "n_nationkey", "n_name")


@query("j13", "SELECT DISTINCT sha1(text) AS h FROM documents WHERE doc_id % 2 = 0 AND sha1(text) NOT IN (SELECT sha1(text) FROM documents WHERE doc_id % 2 = 1)")
def j13(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha1("text").alias("h"))
    return docs.where("doc_id % 2 = 0").select("h").distinct().join(docs.where("doc_id % 2 = 1").select("h"), "h", "left_anti")


PAIRS_SQL = """
SELECT q.vec_id AS qid, count(*) AS n, round(min(d), 6) AS least FROM (
  SELECT a.vec_id, 1 - list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d
  FROM embeddings a, embeddings b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id) q WHERE d <= 0.75 GROUP BY 1
"""


@query("j14", PAIRS_SQL)
def j14(spark, d):
    e = table(spark, d, "embeddings")
    # every distance of a stated query set, in blocks against the base; counts and minima leave a task, pairs do not
    found = knn.within(e, e.where("vec_id % 20 = 0"), 0.75)
    return found.select("qid", "n", F.round("least", 6).alias("least"))


@query("j15", "SELECT a.vec_id AS qid, b.vec_id AS id FROM embeddings a JOIN embeddings b ON a.label % 4 = b.label % 4 AND a.vec_id % 4 = b.vec_id % 4 WHERE a.vec_id % 20 = 0")
def j15(spark, d):
    cells = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), (F.col("label") % 4).alias("c0"), (F.col("vec_id") % 4).alias("c1"))
    return cells.where("id % 20 = 0").withColumnRenamed("id", "qid").join(cells, ["c0", "c1"]).select("qid", "id")


@query("j16", "SELECT u.h, d.doc_id, u.dist FROM (SELECT sha1(text) AS h, (min(doc_id) % 10)::DOUBLE AS dist FROM documents GROUP BY 1) u JOIN documents d ON sha1(d.text) = u.h")
def j16(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha1("text").alias("h"))
    found = docs.groupBy("h").agg((F.min("doc_id") % 10).cast("double").alias("dist"))
    return found.join(docs, "h").select("h", "doc_id", "dist")


@query("j17", "SELECT pair, min(dist)::DOUBLE AS dist FROM (SELECT (doc_id % 60)::VARCHAR AS pair, 1 AS dist FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT (doc_id % 60)::VARCHAR, 2 FROM documents) GROUP BY 1")
def j17(spark, d):
    from siftwise.operators.simgraph import add_unseen_pairs

    docs = table(spark, d, "documents").select("doc_id", (F.col("doc_id") % 60).cast("string").alias("pair"))
    have = docs.where("doc_id % 3 = 0").select("pair", F.lit(1.0).alias("dist")).distinct()
    return add_unseen_pairs(have, docs.select("pair", F.lit(2.0).alias("dist")))


@query("j18", "SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'old' ELSE sha1(text) END AS sha1 FROM documents")
def j18(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha1("text").alias("sha1"))
    have = docs.join(table(spark, d, "labels").select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", F.lit("old").alias("sha1"))
    return keyed.insert_ignore(have, docs, ["doc_id"])

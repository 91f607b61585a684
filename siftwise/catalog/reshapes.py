"""P: projections and reshapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwise.catalog.registry import query
from siftwise.functions import scalar as s
from siftwise.operators import normalize as n
from siftwise.plans.stages import table

#: Crawl documents made of pages: two images, one of them by its relative url, a video and an object without type.
V3_SQL = """
SELECT parent, url FROM (
  SELECT page_id::VARCHAR AS parent, unnest(['image/jpeg', 'video/mp4', NULL, 'image/png']) AS kind,
         unnest(['https://s3/a' || page_id, 'https://s3/b' || page_id, url, CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'https://s3/p' || (page_id % 7) END]) AS url
  FROM pages) WHERE kind LIKE 'image%' AND url IS NOT NULL
"""


def docs_v3(spark, d):
    pages = table(spark, d, "pages")
    ident = F.col("page_id").cast("string")
    urls = F.array(F.concat(F.lit("https://s3/a"), ident), F.concat(F.lit("https://s3/b"), ident), F.col("url"), F.when(F.col("page_id") % 3 != 0, F.concat(F.lit("https://s3/p"), (F.col("page_id") % 7).cast("string"))))
    kinds = F.array(F.lit("image/jpeg"), F.lit("video/mp4"), F.lit(None).cast("string"), F.lit("image/png"))
    return pages.select(ident.alias("doc_id"), kinds.alias("content_type"), urls.alias("obj_stored_url"))


@query("p01", "SELECT user_id, list_sort(list(value)) AS vals FROM (SELECT user_id, round(value, 4)::VARCHAR AS value FROM events WHERE event_type = 'click') GROUP BY 1".replace("list_sort(list(value)) AS vals", "string_agg(value, ',' ORDER BY value) AS vals"))
def p01(spark, d):
    cell = F.struct(F.lit("info").alias("family"), F.col("event_type").alias("qualifier"), F.round("value", 4).cast("string").alias("value"))
    rows = table(spark, d, "events").groupBy("user_id").agg(F.collect_list(cell).alias("cells"))
    return rows.select("user_id", F.array_sort(n.cell_values(F.col("cells"), "info", "click")).alias("v")).where("size(v) > 0").select("user_id", F.array_join("v", ",").alias("vals"))


@query("p02", "SELECT 'https://s3/' || page_id AS url, url AS parent FROM pages WHERE page_id % 4 <> 0")
def p02(spark, d):
    one = lambda c: F.array(c, F.lit("other"))
    docs = table(spark, d, "pages").select(
        F.when(F.col("page_id") % 4 != 0, one(F.lit("image/jpeg"))).otherwise(one(F.lit("imagetype"))).alias("content_type"), one(F.concat(F.lit("https://s3/"), F.col("page_id").cast("string"))).alias("obj_stored_url"), one(F.col("url")).alias("obj_parent")
    )
    return n.docs_v2_to_links(docs)


@query("p03", V3_SQL)
def p03(spark, d):
    return n.docs_v3_to_links(docs_v3(spark, d)).select("parent", "url")


@query("p04", V3_SQL)
def p04(spark, d):
    docs = docs_v3(spark, d).select("doc_id", F.transform(F.arrays_zip("content_type", "obj_stored_url"), lambda o: o).alias("objects"))
    return n.docs_v3_objects_to_links(docs).select("parent", "url")


@query("p05", V3_SQL.replace("SELECT parent, url FROM", "SELECT parent, 'https://s3/domain/' || url AS url FROM"))
def p05(spark, d):
    return n.docs_v3_to_links(docs_v3(spark, d), "https://s3/domain/").select("parent", "url")


CUSTOMER_CELLS = """
SELECT c_custkey::VARCHAR AS key, 'info' AS family, q AS qualifier, v AS value FROM (
  SELECT c_custkey, unnest(['c_nationkey', 'c_mktsegment']) AS q, unnest([c_nationkey::VARCHAR, c_mktsegment]) AS v FROM customer) WHERE v IS NOT NULL
"""


@query("p06", CUSTOMER_CELLS)
def p06(spark, d):
    return n.to_cells(table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey")


@query("p07", "SELECT c_custkey::VARCHAR AS key, c_nationkey::VARCHAR AS c_nationkey, c_mktsegment FROM customer")
def p07(spark, d):
    cells = n.to_cells(table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey")
    return n.from_cells(cells, ["c_nationkey", "c_mktsegment"])


@query("p08", "SELECT url, page_id AS doc_id, length(html)::INT AS n FROM pages")
def p08(spark, d):
    rows = table(spark, d, "pages").select("url", F.struct(F.col("page_id").alias("doc_id"), F.length("html").alias("n")).alias("doc"))
    return rows.select("url", "doc.doc_id", "doc.n")


@query("p09", "SELECT doc_id, upper(sha1(text)) AS sha1, source AS url FROM documents")
def p09(spark, d):
    by_url = table(spark, d, "documents").select(F.col("source").alias("url"), F.array(F.struct("doc_id", s.content_hash(F.col("text")).alias("sha1"))).alias("docs"))
    return by_url.select("url", F.explode("docs").alias("x")).select("x.doc_id", "x.sha1", "url")


@query("p10", "SELECT upper(sha1(text)) AS sha1, doc_id::VARCHAR AS ids FROM documents WHERE length(doc_id::VARCHAR) > 1")
def p10(spark, d):
    rows = table(spark, d, "documents").select(s.content_hash(F.col("text")).alias("sha1"), n.long_ids(F.array(F.col("doc_id").cast("string"))).alias("ids"))
    return rows.where("size(ids) > 0").select("sha1", F.array_join("ids", ",").alias("ids"))


@query("p11", "SELECT source AS url, upper(sha1(text)) AS sha1 FROM documents")
def p11(spark, d):
    return table(spark, d, "documents").select(F.col("source").alias("url"), s.content_hash(F.col("text")).alias("sha1"))


@query("p12", "SELECT s_suppkey AS id, s_nationkey AS place FROM supplier")
def p12(spark, d):
    out = table(spark, d, "supplier").select(F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("place"))).alias("j"))
    return out.select(F.from_json("j", "id long, place long").alias("x")).select("x.id", F.col("x.place").cast(table(spark, d, "supplier").schema["s_nationkey"].dataType).alias("place"))


@query("p13", "SELECT s_suppkey, s_nationkey FROM supplier")
def p13(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", "s_nationkey")


@query("p14", "SELECT event_id, (9999999999999 - epoch_us(ts) // 1000)::VARCHAR || '_' || event_id AS row_key FROM events")
def p14(spark, d):
    return table(spark, d, "events").select("event_id", s.reversed_key(s.to_ms(F.col("ts")), F.col("event_id")).alias("row_key"))


@query("p15", "SELECT epoch_us(ts) // 1000 AS ts_ms, event_id::VARCHAR || '_x' AS ident FROM events")
def p15(spark, d):
    key = s.reversed_key(s.to_ms(F.col("ts")), F.concat(F.col("event_id").cast("string"), F.lit("_x")))
    return table(spark, d, "events").select(s.parse_reversed_key(key).alias("k")).select("k.ts_ms", "k.ident")


@query("p16", "SELECT conv_id, min_by(role, turn) AS role, min_by(length(text), turn)::INT AS n, count(*) AS turns FROM conversations GROUP BY 1")
def p16(spark, d):
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.min(F.struct("turn", "role", F.length("text").alias("n"))).alias("first"), F.count("*").alias("turns"))
    return rows.select("conv_id", "first.role", "first.n", "turns")


PAIR = "SELECT upper(least(a, b) || '-' || greatest(a, b)) AS pair, count(*) AS n FROM (SELECT sha1(text) AS a, sha1(source) AS b FROM documents) GROUP BY 1"


@query("p17", PAIR)
def p17(spark, d):
    rows = table(spark, d, "documents").select(F.sha1("text").alias("a"), F.sha1("source").alias("b"))
    return rows.groupBy(s.pair_key(F.col("a"), F.col("b")).alias("pair")).agg(F.count("*").alias("n"))


@query("p18", "SELECT conv_id, turn::VARCHAR AS turn, role FROM conversations")
def p18(spark, d):
    # lists of eight turns at most, however long a conversation is
    rows = table(spark, d, "conversations").groupBy("conv_id", F.floor(F.col("turn") / 8)).agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("t"))
    lists = rows.select("conv_id", F.array_join(F.transform("t.turn", lambda x: x.cast("string")), ", ").alias("turns"), F.array_join("t.role", ",").alias("roles"))
    return n.explode_parallel(lists, "conv_id", {"turns": "turn", "roles": "role"})


@query("p19", "SELECT page_id, regexp_extract(url, '[^/]*$') AS tail FROM pages")
def p19(spark, d):
    return table(spark, d, "pages").select("page_id", s.id_suffix(F.col("url"), "/").alias("tail"))


@query("p20", "SELECT upper(sha1(text)) AS key, 'parent:' || source AS qualifier, count(*)::VARCHAR AS value FROM documents GROUP BY 1, 2")
def p20(spark, d):
    rows = table(spark, d, "documents").groupBy(s.content_hash(F.col("text")).alias("key"), "source").agg(F.count("*").cast("string").alias("value"))
    return rows.select("key", F.concat(F.lit("parent:"), F.col("source")).alias("qualifier"), "value")


@query("p21", "SELECT vec_id, 'True' AS precomp_sim FROM embeddings WHERE label = 3")
def p21(spark, d):
    return table(spark, d, "embeddings").where("label = 3").select("vec_id", F.lit("True").alias("precomp_sim"))


@query("p22", "SELECT vec_id, round(list_sum(embedding::DOUBLE[]), 5) AS total FROM embeddings")
def p22(spark, d):
    from siftwise.sources.codecs import base64_to_vector, vector_to_base64

    back = table(spark, d, "embeddings").select("vec_id", base64_to_vector(vector_to_base64("embedding")).alias("v"))
    return back.select("vec_id", F.round(F.aggregate(s.doubles(F.col("v")), F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


NEIGHBOURS = """
WITH g AS (SELECT source AS k, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'h' || (doc_id % 9) END AS h, (doc_id % 13)::DOUBLE AS dist FROM documents),
b AS (SELECT k, h, min(dist) AS dist FROM g WHERE h IS NOT NULL GROUP BY 1, 2)
SELECT k, string_agg(h, ',' ORDER BY dist, h) AS hashes, string_agg(printf('%.1f', dist), ',' ORDER BY dist, h) AS dists FROM b GROUP BY 1
"""


@query("p23", NEIGHBOURS)
def p23(spark, d):
    g = table(spark, d, "documents").select(F.col("source").alias("k"), F.when(F.col("doc_id") % 5 == 0, F.lit("None")).otherwise(F.concat(F.lit("h"), (F.col("doc_id") % 9).cast("string"))).alias("h"), (F.col("doc_id") % 13).cast("double").cast("string").alias("x"), "doc_id")
    lists = g.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("doc_id", "h", "x"))).alias("r")).select("k", F.array_join("r.h", ",").alias("hashes"), F.array_join("r.x", ",").alias("dists"))
    return n.clean_neighbours(lists, "k", "hashes", "dists")


@query("p24", "SELECT doc_id, regexp_replace(text, '[^a-zA-Z]+', ' ', 'g') AS clean FROM documents")
def p24(spark, d):
    return table(spark, d, "documents").select("doc_id", F.regexp_replace("text", "[^a-zA-Z]+", " ").alias("clean"))

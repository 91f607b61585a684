"""S: scans, sources and sinks."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from siftwise.catalog.registry import query
from siftwise.functions.scalar import content_hash
from siftwise.plans.stages import fresh_path as fresh
from siftwise.plans.stages import table
from siftwise.sources import codecs, tables
from siftwise.sources.store import StageStore


def day(n, month=1):
    return datetime.datetime(2024, month, n)


@query("s01", "SELECT event_id, user_id, value FROM events WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-10'")
def s01(spark, d):
    match = (F.col("event_type") == "click") & (F.col("ts") >= F.lit(day(3)).cast("timestamp_ntz")) & (F.col("ts") < F.lit(day(10)).cast("timestamp_ntz"))
    return tables.scan(spark, f"{d}/events.parquet", ["event_id", "user_id", "value"], match)


@query("s02", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey >= 100 AND o_orderkey < 5000")
def s02(spark, d):
    return tables.key_range(table(spark, d, "orders"), "o_orderkey", 100, 5000, ["o_orderkey", "o_custkey"])


CELLS_SQL = """
WITH c AS (SELECT user_id::VARCHAR AS key, event_type AS qualifier, value::VARCHAR AS value, event_id AS ts FROM events)
SELECT key, qualifier, max(ts) AS ts FROM c GROUP BY 1, 2
"""


@query("s03", CELLS_SQL)
def s03(spark, d):
    cells = table(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), F.lit("info").alias("family"), F.col("event_type").alias("qualifier"), F.col("value").cast("string").alias("value"), F.col("event_id").alias("ts"))
    return tables.put_cells(cells.where("ts % 2 = 0"), cells.where("ts % 2 = 1")).select("key", "qualifier", "ts")


@query("s04", "SELECT conv_id, turn, role, text FROM conversations")
def s04(spark, d):
    store = StageStore(spark, fresh(spark, "s04"))
    store.save(table(spark, d, "conversations"), "conversations")
    store.save(table(spark, d, "conversations").limit(0), "conversations")  # exists: left alone
    return store.load("conversations").select("conv_id", "turn", "role", "text")


@query("s05", "SELECT doc_id, lang, source, n_chars FROM documents")
def s05(spark, d):
    out = fresh(spark, "s05")
    table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars").write.json(out)
    return spark.read.schema("doc_id long, lang string, source string, n_chars long").json(out)


@query("s06", "SELECT vec_id::VARCHAR AS id, len(embedding)::INT AS dim, round(embedding[1]::DOUBLE, 6) AS first, round(embedding[len(embedding)]::DOUBLE, 6) AS last FROM embeddings")
def s06(spark, d):
    out = fresh(spark, "s06")
    codecs.write_vectors_text(table(spark, d, "embeddings"), out, "vec_id", "embedding")
    v = codecs.read_vectors_text(spark, out)
    at = lambda i: F.round(F.element_at("vector", i).cast("double"), 6)
    return v.select("id", F.size("vector").alias("dim"), at(1).alias("first"), at(-1).alias("last"))


CODES = "SELECT vec_id AS id, (label % 4)::INT AS c0, (vec_id % 4)::INT AS c1, [(vec_id % 7)::INT, (vec_id % 11)::INT] AS fine FROM embeddings"


def small_codes(spark, d):
    e = table(spark, d, "embeddings")
    mod = lambda c, n: (F.col(c) % n).cast("int")
    return e.select(F.col("vec_id").alias("id"), mod("label", 4).alias("c0"), mod("vec_id", 4).alias("c1"), F.array(mod("vec_id", 7), mod("vec_id", 11)).alias("fine"))


@query("s07", f"SELECT id::VARCHAR || chr(9) || '[[' || c0 || ',' || c1 || '],[' || fine[1] || ',' || fine[2] || ']]' AS value FROM ({CODES})")
def s07(spark, d):
    out = fresh(spark, "s07")
    codecs.write_codes_text(small_codes(spark, d), out)
    return spark.read.text(out)


@query("s08", f"SELECT id, c0, c1, fine[1] AS f0, fine[2] AS f1 FROM ({CODES})")
def s08(spark, d):
    out = fresh(spark, "s08")
    codecs.write_codes_text(small_codes(spark, d), out)
    return codecs.read_codes_text(spark, f"{out}/part-*").select("id", "c0", "c1", F.col("fine")[0].alias("f0"), F.col("fine")[1].alias("f1"))


SUMS = "SELECT count(*) AS n, round(sum(list_sum(embedding::DOUBLE[])), 4) AS total FROM embeddings"


def _sums(rows):
    return rows.agg(F.count("*").alias("n"), F.round(F.sum(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x)), 4).alias("total"))


@query("s09", SUMS)
def s09(spark, d):
    out = fresh(spark, "s09")
    codecs.write_vector_files(table(spark, d, "embeddings"), "vec_id", "embedding", out, "fvecs")
    return _sums(codecs.read_xvecs(spark, f"{out}/*.fvecs", "fvecs"))


@query("s10", SUMS)
def s10(spark, d):
    out = fresh(spark, "s10")
    codecs.write_vector_files(table(spark, d, "embeddings"), "vec_id", "embedding", out)
    return _sums(codecs.read_matrix(spark, f"{out}/*.bin", 64))


@query("s11", "SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS first FROM embeddings WHERE vec_id IN (1, 5, 17)")
def s11(spark, d):
    out = fresh(spark, "s11")
    table(spark, d, "embeddings").sort("vec_id").write.option("compression", "zstd").parquet(out)
    return spark.read.parquet(out).where(F.col("vec_id").isin(1, 5, 17)).select("vec_id", F.round(F.col("embedding")[0].cast("double"), 6).alias("first"))


@query("s12", "SELECT vec_id, label, round(embedding[2]::DOUBLE, 6) AS second FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def s12(spark, d):
    ids = table(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").alias("vec_id"))
    return tables.points(table(spark, d, "embeddings"), ids, "vec_id").select("vec_id", "label", F.round(F.col("embedding")[1].cast("double"), 6).alias("second"))


@query("s13", "SELECT event_id, ts::VARCHAR AS ts FROM events WHERE ts >= TIMESTAMP '2024-01-10' ORDER BY events.ts, event_id LIMIT 100")
def s13(spark, d):
    return tables.time_batch(table(spark, d, "events").withColumn("at", F.col("ts")), "at", day(10), 100, "event_id").select("event_id", F.col("ts").cast("string").alias("ts"))


@query("s14", "SELECT page_id, url FROM pages WHERE page_id > 20 AND url IS NOT NULL ORDER BY page_id LIMIT 50")
def s14(spark, d):
    return tables.keyset_batch(table(spark, d, "pages"), "page_id", 20, 50, "url").select("page_id", "url")


@query("s15", "SELECT n_regionkey::INT AS folder, sum(strlen(n_name) + 1)::BIGINT AS length, string_agg(upper(n_name) || chr(10), '' ORDER BY n_name) AS content FROM nation GROUP BY 1")
def s15(spark, d):
    out = fresh(spark, "s15")
    table(spark, d, "nation").select("n_regionkey", "n_name").repartition("n_regionkey").sortWithinPartitions("n_regionkey", "n_name").write.partitionBy("n_regionkey").text(out)
    files = tables.local_files(spark, out, "*.txt")
    return files.select(F.regexp_extract("path", "n_regionkey=([0-9]+)", 1).cast("int").alias("folder"), "length", F.upper(F.decode("content", "utf-8")).alias("content"))


@query("s16", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) OR doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) ORDER BY doc_id LIMIT 300")
def s16(spark, d):
    index = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") != 0, F.col("quality")).alias("features"))
    return tables.not_indexed_batch(table(spark, d, "documents").select("doc_id"), index, "doc_id", "features", 300)


@query("s17", "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IS NOT NULL")
def s17(spark, d):
    return tables.copy_table(table(spark, d, "customer"), ["c_custkey", "c_nationkey"], ["c_nationkey"])


@query("s18", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey >= 500 ORDER BY o_orderkey LIMIT 200")
def s18(spark, d):
    return tables.subsample(table(spark, d, "orders"), "o_orderkey", 500, 200).select("o_orderkey", "o_custkey")


CONTENT = "SELECT upper(sha1(text)) AS sha1, text FROM documents"


@query("s19", "SELECT upper(sha1(text)) AS sha1, count(*) AS n FROM documents WHERE length(text) > 0 GROUP BY 1")
def s19(spark, d):
    # the fetch of one url is a column function here: content that is given, checked as a download is
    docs = table(spark, d, "documents").withColumn("sha1", content_hash(F.col("text"))).withColumn("content", F.col("text").cast("binary"))
    checked = tables.fetched(docs, lambda key: F.lit(None).cast("binary")).where("verified and octet_length(content) > 0")
    return checked.groupBy("sha1").agg(F.count("*").alias("n"))


@query("s20", "SELECT 'cs' AS name, 2 * 4 * 32 AS n UNION ALL SELECT 'subs', 8 * 16 * 8")
def s20(spark, d):
    import numpy as np

    from siftwise.operators.lopq import LOPQModel

    out = fresh(spark, "s20")
    model = LOPQModel(np.arange(256.0).reshape(2, 4, 32), subs=np.ones((8, 16, 8)))
    model.save(spark, out)
    back = LOPQModel.load(spark, out)
    return spark.createDataFrame([("cs", int(back.cs.size)), ("subs", int(back.subs.size))], "name string, n int")


@query("s21", "SELECT 'done' AS name, true AS there, false AS failed UNION ALL SELECT 'broken', false, true UNION ALL SELECT 'none', false, false")
def s21(spark, d):
    store = StageStore(spark, fresh(spark, "s21"))
    store.save(table(spark, d, "region"), "done")
    store.save(table(spark, d, "region"), "broken")
    fs, where = store._fs("broken")
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(where, "_SUCCESS"), False)
    return spark.createDataFrame([(n, store.exists(n), store.failed(n)) for n in ("done", "broken", "none")], "name string, there boolean, failed boolean")


@query("s22", """SELECT n_nationkey, '{"id":' || n_nationkey || ',"name":"' || n_name || '"}' AS body FROM nation""")
def s22(spark, d):
    return table(spark, d, "nation").select("n_nationkey", F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))).alias("body"))


@query("s23", """SELECT '{"sha1":"' || upper(sha1(text)) || '","ids":[' || string_agg(doc_id, ',' ORDER BY doc_id) || ']}' AS value FROM documents GROUP BY upper(sha1(text))""")
def s23(spark, d):
    out = fresh(spark, "s23")
    rows = table(spark, d, "documents").groupBy(content_hash(F.col("text")).alias("sha1")).agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    rows.select(F.to_json(F.struct("sha1", "ids")).alias("value")).write.text(out)
    return spark.read.text(out)


@query("s24", "SELECT count(*) AS asked, count(l.doc_id) AS found FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def s24(spark, d):
    return tables.coverage(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id"), "doc_id")


@query("s25", f"SELECT sha1, count(*) AS n FROM ({CONTENT}) GROUP BY 1")
def s25(spark, d):
    docs = table(spark, d, "documents").select(content_hash(F.col("text")).alias("sha1"), F.when(F.col("doc_id") % 2 == 0, F.col("text")).alias("content"), F.col("text").alias("remote"))
    return tables.fetched(docs, lambda key: F.col("remote")).where("verified").groupBy("sha1").agg(F.count("*").alias("n"))


@query("s26", """SELECT status, count(*) AS n FROM (SELECT CASE WHEN doc_id % 3 = 0 THEN 'whole' WHEN doc_id % 3 = 1 THEN 'truncated'
WHEN coalesce(length(text), 0) = 0 THEN 'empty' ELSE 'no JPEG' END AS status FROM documents) GROUP BY 1""")
def s26(spark, d):
    """Downloads checked before they are kept: here texts between JPEG markers, without the last one, and bare."""
    from siftwise.functions.images import integrity

    body, mark = F.coalesce(F.col("text").cast("binary"), F.lit(b"")), lambda h: F.unhex(F.lit(h))
    content = F.when(F.col("doc_id") % 3 == 0, F.concat(mark("FFD8"), body, mark("FFD9"))).when(F.col("doc_id") % 3 == 1, F.concat(mark("FFD8"), body)).otherwise(body)
    return table(spark, d, "documents").groupBy(integrity(content).alias("status")).agg(F.count("*").alias("n"))

"""F: filters and predicates; L: sorts and limits; O: set operations."""

from __future__ import annotations

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from siftwise.catalog.registry import query
from siftwise.functions import scalar as s
from siftwise.operators import audit, dedup, keyed, knn
from siftwise.operators import normalize as n
from siftwise.plans.stages import table

DAY = datetime.datetime(2024, 1, 5)


@query("f01", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-05'")
def f01(spark, d):
    return table(spark, d, "events").where(n.in_range(F.col("ts"), DAY)).select("event_id")


@query("f02", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-04' AND ts < TIMESTAMP '2024-01-05'")
def f02(spark, d):
    return table(spark, d, "events").where(n.day_window(F.col("ts"), "2024-01-05")).select("event_id")


@query("f03", "SELECT event_id, event_type FROM events WHERE event_type LIKE 'p%' AND ts < TIMESTAMP '2024-01-05'")
def f03(spark, d):
    return table(spark, d, "events").where(F.col("event_type").startswith("p") & n.in_range(F.col("ts"), None, DAY)).orderBy("ts", "event_id").select("event_id", "event_type")


@query("f04", "SELECT doc_id FROM documents WHERE source LIKE 'src1%'")
def f04(spark, d):
    return table(spark, d, "documents").where(F.col("source").startswith("src1")).select("doc_id")


URLS = "CASE page_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'None' WHEN 2 THEN 'https://s3/' || page_id ELSE url END"


def urls(spark, d):
    k = F.col("page_id") % 5
    return table(spark, d, "pages").select("page_id", F.when(k == 0, None).when(k == 1, "None").when(k == 2, F.concat(F.lit("https://s3/"), F.col("page_id").cast("string"))).otherwise(F.col("url")).alias("u"))


@query("f05", f"SELECT page_id FROM (SELECT page_id, {URLS} AS u FROM pages) WHERE u IS NOT NULL AND u <> 'None' AND u LIKE 'https://s3%'")
def f05(spark, d):
    return urls(spark, d).where(n.valid_url(F.col("u"))).select("page_id")


@query("f06", "SELECT d.doc_id FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL")
def f06(spark, d):
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return joined.where(F.col("quality").isNotNull()).select("doc_id")


@query("f07", f"SELECT page_id, nullif(u, 'None') AS u FROM (SELECT page_id, {URLS} AS u FROM pages)")
def f07(spark, d):
    return urls(spark, d).select("page_id", s.nullish(F.col("u")).alias("u"))


@query("f08", "SELECT upper(sha1(text)) AS sha1, count(DISTINCT doc_id) AS n FROM documents GROUP BY 1 HAVING count(DISTINCT doc_id) <= 2")
def f08(spark, d):
    docs = table(spark, d, "documents").select(s.content_hash(F.col("text")).alias("sha1"), F.col("doc_id").alias("id"), F.lit("https://s3/x").alias("url"))
    merged = dedup.merge_by_hash(docs, cap=2)
    return merged.where(n.not_discarded(F.col("ids"), F.col("discarded"), 2)).select("sha1", F.col("n_ids").alias("n"))


@query("f09", "SELECT source, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT source, doc_id::VARCHAR AS i FROM documents) WHERE length(i) > 1 GROUP BY 1")
def f09(spark, d):
    rows = table(spark, d, "documents").groupBy("source").agg(F.collect_list(F.col("doc_id").cast("string")).alias("ids"))
    return rows.select("source", F.array_sort(n.long_ids(F.col("ids"))).alias("ids")).where("size(ids) > 0").select("source", F.array_join("ids", ",").alias("ids"))


@query("f10", f"SELECT page_id FROM (SELECT page_id, {URLS} AS u FROM pages) WHERE u LIKE 'https://s3%' AND page_id % 2 = 0 AND page_id % 3 <> 0")
def f10(spark, d):
    rows = urls(spark, d).select("page_id", F.col("u").alias("url"), F.when(F.col("page_id") % 2 != 0, F.col("page_id")).alias("feat_id"), F.when(F.col("page_id") % 3 == 0, "discarded").alias("discarded"))
    return n.needs_indexing(rows).select("page_id")


@query("f11", "SELECT event_id FROM events WHERE event_id % 3 <> 0")
def f11(spark, d):
    rows = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.lit(True)).alias("indexed"))
    return rows.where(F.col("indexed").isNull()).select("event_id")


@query("f12", "SELECT key FROM (SELECT CASE WHEN event_id % 2 = 0 THEN 'index_update_' ELSE 'other_' END || event_id AS key FROM events) WHERE key LIKE 'index!_update!_%' ESCAPE '!'")
def f12(spark, d):
    rows = table(spark, d, "events").select(F.concat(F.when(F.col("event_id") % 2 == 0, "index_update_").otherwise("other_"), F.col("event_id").cast("string")).alias("key"))
    return rows.where(n.key_prefix(F.col("key"), "index_update_"))


@query("f13", f"SELECT page_id, u IS NULL AS missing, coalesce(u LIKE 'http:%', false) AS plain FROM (SELECT page_id, {URLS} AS u FROM pages)")
def f13(spark, d):
    return urls(spark, d).select("page_id", F.col("u").isNull().alias("missing"), F.coalesce(F.col("u").startswith("http:"), F.lit(False)).alias("plain"))


@query("f14", f"SELECT count(*) AS total, count(*) FILTER (WHERE u LIKE 'https://s3%') AS valid, count(DISTINCT CASE WHEN u LIKE 'https://s3%' THEN page_id END) AS distinct_valid FROM (SELECT page_id, {URLS} AS u FROM pages)")
def f14(spark, d):
    return audit.audit_counts(urls(spark, d), "page_id", n.valid_url(F.col("u")))


@query("f15", "SELECT count(*) AS n FROM (SELECT (doc_id % 100) / 100.0 AS dist FROM documents) WHERE dist <= 0.25")
def f15(spark, d):
    rows = table(spark, d, "documents").select(((F.col("doc_id") % 100) / 100.0).alias("dist"))
    return knn.near_duplicates(rows, 0.25).agg(F.count("*").alias("n"))


@query("f16", "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (1, 3, 8)")
def f16(spark, d):
    return table(spark, d, "nation").where(F.col("n_nationkey").isin(1, 3, 8)).select("n_nationkey", "n_name")


@query("f17", f"SELECT page_id FROM (SELECT page_id, {URLS} AS u FROM pages) WHERE u IS NOT NULL")
def f17(spark, d):
    return urls(spark, d).where(n.all_present("page_id", "u")).select("page_id")


@query("f18", "SELECT page_id FROM pages WHERE contains(url, 'example')")
def f18(spark, d):
    return table(spark, d, "pages").where(F.col("url").contains("example")).select("page_id")


@query("f19", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT item_id FROM benchmark)")
def f19(spark, d):
    ids = table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"))
    return keyed.lookup(table(spark, d, "documents"), ids, "doc_id").select("doc_id")


@query("f20", "SELECT l.doc_id FROM labels l WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.item_id = l.doc_id)")
def f20(spark, d):
    parents = table(spark, d, "benchmark").groupBy(F.col("item_id").alias("doc_id")).agg(F.collect_set("item_id").alias("ids"))
    joined = table(spark, d, "labels").join(parents, "doc_id", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<long>")))
    return joined.where(F.size("ids") == 0).select("doc_id")


@query("f21", f"SELECT page_id FROM (SELECT page_id, {URLS} AS u FROM pages) WHERE u IS NOT NULL AND u <> 'None'")
def f21(spark, d):
    return urls(spark, d).where(s.nullish(F.col("u")).isNotNull()).select("page_id")


# sorts and limits


@query("l01", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS pos FROM events QUALIFY pos <= 50")
def l01(spark, d):
    first = table(spark, d, "events").orderBy("ts", "event_id").limit(50)
    return first.withColumn("pos", F.row_number().over(Window.orderBy("ts", "event_id")).cast("long")).select("event_id", "pos")


@query("l02", "SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source")
def l02(spark, d):
    return audit.duplicate_counts(table(spark, d, "documents"), "source", 1)


@query("l03", "SELECT event_id FROM events ORDER BY value, event_id LIMIT 25")
def l03(spark, d):
    return table(spark, d, "events").orderBy("value", "event_id").limit(25).select("event_id")


@query("l04", "SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY l_extendedprice, l_orderkey, l_linenumber")
def l04(spark, d):
    return table(spark, d, "lineitem").orderBy("l_extendedprice", "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber")


@query("l05", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) <= 3")
def l05(spark, d):
    rows = table(spark, d, "events").select(F.col("user_id").alias("qid"), F.col("event_id").alias("id"), F.col("value").alias("dist"))
    return knn.ranked(rows, 3).select(F.col("qid").alias("user_id"), F.col("id").alias("event_id"))


@query("l06", "SELECT max(o_orderkey) AS highest FROM orders")
def l06(spark, d):
    return table(spark, d, "orders").agg(F.max("o_orderkey").alias("highest"))


@query("l07", "SELECT user_id, string_agg(event_id, ',' ORDER BY value, event_id) AS ids FROM events GROUP BY 1")
def l07(spark, d):
    rows = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("value", "event_id"))).alias("r"))
    return rows.select("user_id", F.array_join(F.transform("r.event_id", lambda x: x.cast("string")), ",").alias("ids"))


# set operations


@query("o01", "SELECT c.c_custkey, (SELECT count(DISTINCT x) FROM unnest([c.c_nationkey, c.c_custkey % 5, 3, c.c_nationkey]) t(x)) AS n FROM customer c".replace("(SELECT count(DISTINCT x) FROM unnest([c.c_nationkey, c.c_custkey % 5, 3, c.c_nationkey]) t(x))", "len(list_distinct([c.c_nationkey::BIGINT, (c.c_custkey % 5)::BIGINT, 3, c.c_nationkey::BIGINT]))::INT"))
def o01(spark, d):
    a, b = F.array(F.col("c_nationkey").cast("long"), F.col("c_custkey") % 5), F.array(F.lit(3).cast("long"), F.col("c_nationkey").cast("long"))
    return table(spark, d, "customer").select("c_custkey", F.size(dedup.union_sets(a, b, "array<bigint>")).alias("n"))


@query("o02", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def o02(spark, d):
    return table(spark, d, "documents").select("doc_id").distinct().join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


@query("o03", "SELECT DISTINCT least(l_partkey % 50, l_suppkey % 50) AS a, greatest(l_partkey % 50, l_suppkey % 50) AS b FROM lineitem")
def o03(spark, d):
    return dedup.distinct_pairs(table(spark, d, "lineitem").select((F.col("l_partkey") % 50).alias("a"), (F.col("l_suppkey") % 50).alias("b")), "a", "b")


@query("o04", "SELECT doc_id AS id FROM documents UNION ALL SELECT item_id FROM benchmark")
def o04(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id")).unionByName(table(spark, d, "benchmark").select(F.col("item_id").alias("id")))

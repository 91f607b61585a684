"""A: aggregations; K: keyed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwise.catalog.joins import EXISTING, INCOMING, MERGED, existing, incoming
from siftwise.catalog.registry import query
from siftwise.catalog.sources import fresh
from siftwise.functions import scalar as s
from siftwise.operators import audit, dedup, keyed
from siftwise.plans.stages import table


def hashed(spark, d):
    return table(spark, d, "documents").select(s.content_hash(F.col("text")).alias("sha1"), F.col("doc_id").cast("string").alias("id"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("https://s3/"), "source")).alias("url"))


HASHED = "SELECT upper(sha1(text)) AS sha1, doc_id::VARCHAR AS id, CASE WHEN doc_id % 3 = 0 THEN 'https://s3/' || source END AS url FROM documents"


@query("a01", "SELECT source, string_agg(doc_id, ',' ORDER BY doc_id) AS ids FROM documents GROUP BY 1")
def a01(spark, d):
    return dedup.collect_ids(table(spark, d, "documents"), "source", "doc_id").select("source", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@query("a02", f"SELECT sha1, min(url) AS url, CASE WHEN count(DISTINCT id) > 4 THEN '' ELSE string_agg(DISTINCT id, ',' ORDER BY id) END AS ids, count(DISTINCT id) AS n_ids, count(DISTINCT id) > 4 AS discarded FROM ({HASHED}) GROUP BY 1")
def a02(spark, d):
    merged = dedup.merge_by_hash(hashed(spark, d), cap=4)
    return merged.select("sha1", "url", F.array_join("ids", ",").alias("ids"), "n_ids", F.col("discarded").isNotNull().alias("discarded"))


@query("a03", "SELECT upper(sha1(text)) AS sha1, string_agg(DISTINCT doc_id::VARCHAR, ',' ORDER BY doc_id::VARCHAR) AS ids, string_agg(DISTINCT source, ',' ORDER BY source) AS parents FROM documents GROUP BY 1")
def a03(spark, d):
    docs = table(spark, d, "documents").select(s.content_hash(F.col("text")).alias("sha1"), F.col("doc_id").cast("string").alias("id"), "source", F.lit("https://s3/x").alias("url"))
    ids = dedup.merge_by_hash(docs).select("sha1", F.array_join("ids", ",").alias("ids"))
    parents = dedup.merge_by_hash(docs, ident="source").select("sha1", F.array_join("ids", ",").alias("parents"))
    return ids.join(parents, "sha1")


@query("a04", "SELECT lang, string_agg(source, ',' ORDER BY source) AS sources FROM documents GROUP BY 1")
def a04(spark, d):
    return dedup.collect_ids(table(spark, d, "documents"), "lang", "source").select("lang", F.array_join("ids", ",").alias("sources"))


@query("a05", "SELECT d.doc_id, array_to_string(list_sort(list_distinct(list_concat([d.lang], CASE WHEN l.quality = 1 THEN ['good', d.lang] ELSE [] END))), ',') AS tags FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def a05(spark, d):
    right = table(spark, d, "labels").where("quality = 1").select("doc_id", F.array(F.lit("good")).alias("more"))
    joined = table(spark, d, "documents").select("doc_id", F.array("lang").alias("tags")).join(right, "doc_id", "left")
    return joined.select("doc_id", F.array_join(dedup.union_sets(F.col("tags"), F.col("more")), ",").alias("tags"))


@query("a06", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts)::VARCHAR AS ts FROM events GROUP BY 1")
def a06(spark, d):
    last = dedup.latest(table(spark, d, "events").select("user_id", "event_id", "ts"), "user_id", "ts", "event_id")
    return last.select("user_id", "event_id", F.col("ts").cast("string").alias("ts"))


@query("a07", "SELECT sha1(text) AS h, min(n_chars) AS n FROM documents GROUP BY 1")
def a07(spark, d):
    return dedup.one_or_fail(table(spark, d, "documents").select(F.sha1("text").alias("h"), F.col("n_chars").alias("n")), "h", "n")


@query("a08", "SELECT source, string_agg(doc_id, ',' ORDER BY doc_id) AS ids FROM (SELECT source, doc_id FROM documents UNION ALL SELECT source, doc_id FROM documents WHERE doc_id % 10 = 0) GROUP BY 1")
def a08(spark, d):
    docs = table(spark, d, "documents")
    lists = docs.select("source", F.when(F.col("doc_id") % 10 == 0, F.array("doc_id", "doc_id")).otherwise(F.array("doc_id")).alias("ids"))
    return dedup.concat_lists(lists, "source", "ids").select("source", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@query("a09", "SELECT upper(sha1(text)) AS sha1, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def a09(spark, d):
    return audit.duplicate_counts(hashed(spark, d), "sha1")


@query("a10", "SELECT count(*) AS n, count(*) = 0 AS empty, min(doc_id) AS first FROM documents")
def a10(spark, d):
    return table(spark, d, "documents").agg(F.count("*").alias("n"), (F.count("*") == 0).alias("empty"), F.min("doc_id").alias("first"))


@query("a11", "SELECT min(epoch_us(ts) // 1000) AS low, max(epoch_us(ts) // 1000) AS high FROM events")
def a11(spark, d):
    ms = s.to_ms(F.col("ts"))
    return table(spark, d, "events").agg(F.min(ms).alias("low"), F.max(ms).alias("high"))


@query("a12", "SELECT count(*) AS total, count(*) FILTER (WHERE n_chars > 500) AS valid, count(DISTINCT CASE WHEN n_chars > 500 THEN sha1(text) END) AS distinct_valid FROM documents")
def a12(spark, d):
    return audit.audit_counts(table(spark, d, "documents").withColumn("h", F.sha1("text")), "h", F.col("n_chars") > 500)


LAG = """
SELECT event_type AS prefix, count(*) AS batches, count(*) FILTER (WHERE user_id % 3 = 0) AS pending,
       count(*) FILTER (WHERE user_id % 3 = 1) AS unfinished, count(*) FILTER (WHERE user_id % 3 = 2) AS finished FROM events GROUP BY 1
"""


def lag(spark, d):
    third = F.col("user_id") % 3
    updates = table(spark, d, "events").select("event_type", F.when(third > 0, F.lit(True)).alias("started"), F.when(third == 2, F.lit(True)).alias("indexed"))
    return audit.update_lag(updates, F.col("event_type"))


query("a13", LAG)(lag)
query("u12", LAG)(lag)


@query("a14", "SELECT count(*) FILTER (WHERE l.doc_id IS NULL) AS missing FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def a14(spark, d):
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return joined.agg(F.count_if(F.col("quality").isNull()).alias("missing"))


@query("a22", "SELECT lang, string_agg(DISTINCT source, ',' ORDER BY source) AS vals FROM documents GROUP BY 1")
def a22(spark, d):
    return audit.value_sets(table(spark, d, "documents"), "lang", "source").select("lang", F.array_join("values", ",").alias("vals"))


@query("a23", "SELECT quality, count(*) AS n, count(*) FILTER (WHERE ('0x' || substr(md5(quality || ':' || doc_id), 1, 8))::BIGINT % 3 < 1) AS n_test FROM labels GROUP BY 1")
def a23(spark, d):
    split = audit.stratified_split(table(spark, d, "labels"), "quality", "doc_id")
    return split.groupBy("quality").agg(F.count("*").alias("n"), F.count_if("test").alias("n_test"))


@query("a24", "SELECT count(*) AS total, count(*) FILTER (WHERE doc_id % 11 = 0) AS bad_hash, count(*) FILTER (WHERE doc_id % 4 = 0) AS bad_neighbours FROM documents")
def a24(spark, d):
    docs = table(spark, d, "documents").select(F.when(F.col("doc_id") % 11 != 0, F.sha1("text")).alias("h"), F.concat_ws(",", F.sha1("text"), F.when(F.col("doc_id") % 4 == 0, F.lit("short"))).alias("near"))
    return audit.corrupted_links(docs, s.split_list(F.col("near")), F.col("h").isNotNull() & (F.length("h") == 40))


@query("a25", "SELECT event_type AS attribute, string_agg(DISTINCT json_extract_string(props, '$.k'), ',' ORDER BY json_extract_string(props, '$.k')) AS vals FROM events GROUP BY 1")
def a25(spark, d):
    rows = table(spark, d, "events").select(F.create_map(F.col("event_type"), F.get_json_object("props", "$.k")).alias("m"))
    return audit.nested_value_sets(rows, "m").select("attribute", F.array_join("values", ",").alias("vals"))


# keyed tables


@query("k01", f"""
WITH m AS ({MERGED}), e AS ({EXISTING})
SELECT sha1, ids FROM m UNION ALL SELECT sha1, array_to_string(ids, ',') FROM e WHERE sha1 NOT IN (SELECT sha1 FROM m)
""")
def k01(spark, d):
    old = existing(spark, d)
    whole = keyed.apply_upsert(old, keyed.upsert_merge(incoming(spark, d), old))
    out = fresh(spark, "k01")
    whole.write.parquet(out)  # a new folder: a table is never read and overwritten by one job
    return spark.read.parquet(out).select("sha1", F.array_join("ids", ",").alias("ids"))


@query("k02", "SELECT d.doc_id, l.doc_id IS NOT NULL AS known FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def k02(spark, d):
    known, new = keyed.split_known(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id"), "doc_id")
    return known.withColumn("known", F.lit(True)).unionByName(new.withColumn("known", F.lit(False)))


@query("k03", "SELECT source AS url, min(length(source))::INT AS sha1 FROM documents GROUP BY 1")
def k03(spark, d):
    rows = table(spark, d, "documents").select(F.col("source").alias("url"), F.length("source").alias("sha1"), "doc_id")
    return keyed.register_new(rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 = 1"), "url", "sha1")


@query("k04", "SELECT doc_id::VARCHAR AS sha1, doc_id AS feat_id, doc_id % 5 = 0 AS corrected FROM documents")
def k04(spark, d):
    docs = table(spark, d, "documents")
    wrong = docs.select(F.col("doc_id").cast("string").alias("sha1"), F.when(F.col("doc_id") % 5 == 0, F.col("doc_id") + 1).otherwise(F.col("doc_id")).alias("feat_id"))
    return keyed.correct_feature_ids(wrong, docs.select(F.col("doc_id").cast("string").alias("sha1"), F.col("doc_id").alias("feat_id")))


@query("k05", "SELECT sha1, row_number() OVER (ORDER BY sha1) + 99 AS feat_id FROM (SELECT DISTINCT upper(sha1(text)) AS sha1 FROM documents)")
def k05(spark, d):
    return keyed.dense_ids(hashed(spark, d).select("sha1").distinct(), ["sha1"], base=100).select("sha1", F.col("feat_id").cast("long").alias("feat_id"))


@query("k06", "SELECT doc_id AS id, min(doc_id) OVER (PARTITION BY sha1(text)) AS unique_id FROM documents")
def k06(spark, d):
    rows = table(spark, d, "documents").select(F.sha1("text").alias("sha1"), F.col("doc_id").alias("id"))
    firsts = rows.groupBy("sha1").agg(F.min("id").alias("id"))
    return keyed.unique_and_mapping(rows, firsts.where("id % 2 = 0"))[1]


@query("k07", "SELECT count(*) AS n, count(*) * 64 * 4 AS bytes, true AS consistent FROM embeddings")
def k07(spark, d):
    e = table(spark, d, "embeddings")
    return e.agg(F.count("*").alias("n"), (F.sum(F.size("embedding")) * 4).alias("bytes"), (F.min(F.size("embedding")) == F.max(F.size("embedding"))).alias("consistent"))


@query("k08", "SELECT segment, min(pos) AS low, max(pos) AS high FROM (SELECT doc_id % 3 AS segment, row_number() OVER (ORDER BY doc_id % 3, doc_id) - 1 AS pos FROM documents) GROUP BY 1")
def k08(spark, d):
    rows = table(spark, d, "documents").select((F.col("doc_id") % 3).alias("segment"), "doc_id")
    out = fresh(spark, "k08")
    keyed.dense_ids(rows, ["segment", "doc_id"], "pos").write.parquet(out)
    return spark.read.parquet(out).groupBy("segment").agg(F.min("pos").cast("long").alias("low"), F.max("pos").cast("long").alias("high"))


@query("k09", "SELECT doc_id AS id, upper(sha1(text)) AS sha1, CASE WHEN doc_id % 3 = 0 THEN 'table' WHEN doc_id % 3 = 1 THEN 'other' ELSE 'computed' END AS source FROM documents")
def k09(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"), s.content_hash(F.col("text")).alias("sha1"))
    third = F.col("id") % 3
    return keyed.fallback_hash(docs.select("id", "content"), docs.where(third == 0), docs.where(third < 2))


@query("k10", "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'new' END AS n_name FROM nation")
def k10(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    return keyed.insert_ignore(nation.where("n_nationkey % 2 = 0"), nation.withColumn("n_name", F.lit("new")), ["n_nationkey"])


@query("k11", "SELECT 'made' AS name, 0::BIGINT AS n")
def k11(spark, d):
    from siftwise.sources.store import StageStore

    store = StageStore(spark, fresh(spark, "k11"))
    for _ in range(2):  # the second finds it
        store.save(spark.createDataFrame([], "key string, family string, qualifier string, value string"), "made")
    return store.load("made").agg(F.lit("made").alias("name"), F.count("*").alias("n"))


@query("k12", f"""
WITH i AS ({INCOMING}), e AS ({EXISTING})
SELECT coalesce(i.sha1, e.sha1) AS sha1, array_to_string(list_sort(list_distinct(list_concat(coalesce(e.ids, []), coalesce(i.ids, [])))), ',') AS ids FROM e FULL JOIN i ON i.sha1 = e.sha1
""")
def k12(spark, d):
    return keyed.legacy_merge(existing(spark, d), incoming(spark, d)).select("sha1", F.array_join("ids", ",").alias("ids"))


@query("k13", "SELECT source AS segment FROM documents GROUP BY 1 HAVING min(doc_id) % 2 = 1 OR count(*) % 3 = 0")
def k13(spark, d):
    segments = table(spark, d, "documents").groupBy(F.col("source").alias("segment")).agg(F.count("*").alias("n_codes"), F.min("doc_id").alias("low"))
    compressed = segments.where("low % 2 = 0").select("segment", (F.col("n_codes") + F.when(F.col("n_codes") % 3 == 0, 5).otherwise(1)).alias("n_index"))
    return keyed.stale_segments(segments.select("segment", "n_codes"), compressed)

"""U: the update queue and its streams; D: pluggable functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwise.catalog.registry import query
from siftwise.catalog.sources import fresh
from siftwise.functions import scalar as s
from siftwise.operators import keyed, queue
from siftwise.plans.stages import table
from siftwise.sources.store import StageStore
from siftwise.streaming import updates

HASHES = "SELECT DISTINCT upper(sha1(text)) AS sha1 FROM documents"
BATCHES = f"SELECT 'index_update_' || lpad(((row_number() OVER (ORDER BY sha1) - 1) // {{n}})::VARCHAR, 8, '0') AS update_id, sha1 FROM ({HASHES})"


def hashes(spark, d):
    return table(spark, d, "documents").select(s.content_hash(F.col("text")).alias("sha1")).distinct()


def grouped(rows):
    return rows.select("update_id", F.array_join("keys", ",").alias("keys"))


@query("u01", f"SELECT update_id, string_agg(sha1, ',' ORDER BY sha1) AS keys FROM ({BATCHES.format(n=100)}) GROUP BY 1")
def u01(spark, d):
    return grouped(queue.batches(hashes(spark, d), "sha1", 100))


@query("u02", f"SELECT update_id, string_agg(sha1, ',' ORDER BY sha1) AS keys FROM ({BATCHES.format(n=250)}) GROUP BY 1")
def u02(spark, d):
    return grouped(queue.batches(hashes(spark, d), "sha1", 250))


def marked(spark, d):
    rows = queue.batches(hashes(spark, d), "sha1", 20)
    number = F.substring("update_id", 14, 8).cast("int")
    rows = queue.set_marker(rows, "started", number < 3)
    rows = queue.set_marker(rows, "indexed", number < 2)
    return queue.set_marker(rows, "precomp_start", number < 1)


LAST = f"SELECT max(update_id) AS update_id FROM ({BATCHES.format(n=20)})"


@query("u03", LAST)
def u03(spark, d):
    return queue.next_batch(marked(spark, d)).select("update_id")


@query("u04", "SELECT 'index_update_00000001' AS update_id")
def u04(spark, d):
    return queue.next_precompute_batch(marked(spark, d)).select("update_id")


@query("u05", f"SELECT DISTINCT update_id, update_id <= 'index_update_00000002' AS started FROM ({BATCHES.format(n=20)})")
def u05(spark, d):
    return marked(spark, d).select("update_id", F.coalesce("started", F.lit(False)).alias("started"))


@query("u06", f"SELECT update_id || '_' || part AS update_id, count(*) AS n FROM (SELECT update_id, (row_number() OVER (PARTITION BY update_id ORDER BY sha1) - 1) // 50 AS part FROM ({BATCHES.format(n=120)})) GROUP BY 1")
def u06(spark, d):
    return queue.subdivide(queue.batches(hashes(spark, d), "sha1", 120), 50).select("update_id", F.size("keys").cast("long").alias("n"))


@query("u07", "SELECT event_id, user_id FROM events WHERE event_type = 'purchase'")
def u07(spark, d):
    source, out = fresh(spark, "u07-in"), fresh(spark, "u07-out")
    events = table(spark, d, "events")
    events.repartition(3, "event_id").write.parquet(source)
    stream = updates.file_stream(spark, source, events.schema, 1)
    updates.run_updates(stream, out, "event_id", lambda b: b.where("event_type = 'purchase'").select("event_id", "user_id"), fresh(spark, "u07-checkpoint"))
    return spark.read.parquet(out).select("event_id", "user_id")


@query("u08", "SELECT user_id, min(event_id) IS NOT NULL AS seen FROM events GROUP BY 1")
def u08(spark, d):
    """Run twice over overlapping input: each key is there once."""
    source, out, checkpoint = fresh(spark, "u08-in"), fresh(spark, "u08-out"), fresh(spark, "u08-checkpoint")
    events = table(spark, d, "events").select("user_id", "event_id")
    for part in (events.where("event_id % 2 = 0"), events):
        part.write.mode("append").parquet(source)
        updates.run_updates(updates.file_stream(spark, source, events.schema), out, "user_id", lambda b: b, checkpoint)
    return spark.read.parquet(out).select("user_id", F.lit(True).alias("seen"))


@query("u09", "SELECT doc_id, quality FROM labels")
def u09(spark, d):
    store = StageStore(spark, fresh(spark, "u09"))
    store.stage("one", lambda: table(spark, d, "labels"))

    def never():
        raise AssertionError("a finished stage is not made again")

    return store.stage("one", never).select("doc_id", "quality")


@query("u10", "SELECT 'job' AS job_id, 'documents' AS name, count(*)::VARCHAR AS value FROM documents")
def u10(spark, d):
    return queue.job_metrics(spark, "job", {"documents": table(spark, d, "documents").count()})


@query("u11", f"SELECT sha1, row_number() OVER (ORDER BY sha1) - 1 AS feat_id FROM ({HASHES})")
def u11(spark, d):
    """Index one batch: its keys, less those indexed already, get the next dense ids."""
    batch = hashes(spark, d)
    index = keyed.dense_ids(batch.where("sha1 < '4'"), ["sha1"])
    fresh_keys = batch.join(index.select("sha1"), "sha1", "left_anti")
    base = index.agg(F.max("feat_id")).first()[0] + 1
    return index.unionByName(keyed.dense_ids(fresh_keys, ["sha1"], base=base)).select("sha1", F.col("feat_id").cast("long").alias("feat_id"))


# functions that the user gives


@query("d01", "SELECT vec_id FROM embeddings WHERE vec_id % 2 = 0")
def d01(spark, d):
    loaders = {"even": lambda: table(spark, d, "embeddings").where("vec_id % 2 = 0")}
    return loaders["even"]().select("vec_id")


@query("d02", "SELECT doc_id, upper(lang) AS lang FROM documents")
def d02(spark, d):
    return table(spark, d, "documents").select("doc_id", F.upper("lang").alias("lang"))


@query("d03", "SELECT source, count(DISTINCT lang) AS n FROM documents GROUP BY 1")
def d03(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.countDistinct("lang").alias("n"))


@query("d04", "SELECT count(*) AS n FROM embeddings")
def d04(spark, d):
    from siftwise.operators.vectors import outer_sums

    return spark.createDataFrame([(outer_sums(table(spark, d, "embeddings"), "embedding")[0],)], "n long")


@query("d05", "SELECT conv_id, unnest(string_split(role, 's')) AS part FROM conversations")
def d05(spark, d):
    return table(spark, d, "conversations").select("conv_id", F.explode(F.split("role", "s", -1)).alias("part"))


@query("d06", "SELECT doc_id, CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 ELSE 0 END AS code FROM documents")
def d06(spark, d):
    # a bounded model becomes a map literal of the plan, which Spark ships to every task
    model = F.create_map(*[F.lit(x) for pair in {"en": 1, "de": 2}.items() for x in pair])
    return table(spark, d, "documents").select("doc_id", F.coalesce(model[F.col("lang")], F.lit(0)).alias("code"))

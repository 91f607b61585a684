"""Q: service operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwise.catalog.graph import EDGES, edges
from siftwise.catalog.registry import query
from siftwise.catalog.searches import EXACT, K, queries
from siftwise.catalog.sources import fresh
from siftwise.catalog.vectors import embeddings
from siftwise.functions import scalar as s
from siftwise.operators import knn, service
from siftwise.plans.stages import table
from siftwise.sources.store import StageStore, StateStore

ITEM = "'H' || vec_id AS sha1, 'https://s3/' || vec_id AS url"
BODY = EXACT + f""", i AS (SELECT vec_id AS id, {ITEM} FROM embeddings)
SELECT qid, '{{"query_sha1":"H' || qid || '","similar_images":{{"number":' || count(*) || ',"sha1":[' || string_agg('"' || sha1 || '"', ',' ORDER BY rank) || ']}}}}' AS body FROM k JOIN i USING (id) WHERE dist <= 0.75 GROUP BY 1
"""


def items(spark, d):
    ident = F.col("vec_id").cast("string")
    return embeddings(spark, d).select(F.col("vec_id").alias("id"), F.concat(F.lit("H"), ident).alias("sha1"), F.concat(F.lit("https://s3/"), ident).alias("url"))


def exact(spark, d):
    return knn.near_duplicates(knn.exact_knn(embeddings(spark, d), queries(spark, d), K), 0.75)


def documents(spark, d, camel=False):
    asked = queries(spark, d).select(F.col("vec_id").alias("qid"), F.concat(F.lit("H"), F.col("vec_id").cast("string")).alias("query_sha1"))
    return service.result_documents(asked, exact(spark, d), items(spark, d), camel)


def short(body, number="number", sha1="sha1", outer="similar_images", query_name="query_sha1"):
    parsed = F.from_json(body, f"{query_name} string, {outer} struct<{number}: int, {sha1}: array<string>>")
    return F.to_json(F.struct(parsed[query_name].alias("query_sha1"), F.struct(parsed[outer][number].alias("number"), parsed[outer][sha1].alias("sha1")).alias("similar_images")))


@query("q01", BODY)
def q01(spark, d):
    return documents(spark, d).select("qid", short(F.col("body")).alias("body"))


CACHED = EDGES + "SELECT p.pos::INT AS pos, p.k AS sha1, e.dst, e.dist FROM (SELECT unnest(range(5)) AS pos, unnest([40, 20, 123456, 0, 20]) AS k) p LEFT JOIN edges e ON e.src = p.k"


@query("q02", CACHED)
def q02(spark, d):
    asked = spark.createDataFrame([(i, k) for i, k in enumerate([40, 20, 123456, 0, 20])], "pos int, sha1 long")
    return service.search_by_hash(asked, edges(spark, d)).select("pos", "sha1", "dst", "dist")


@query("q03", "SELECT vec_id AS sha1, vec_id % 3 = 0 AS precomputed FROM embeddings")
def q03(spark, d):
    e = embeddings(spark, d).select(F.col("vec_id").alias("sha1"), F.col("embedding").cast("array<double>").alias("feat"), F.col("label").cast("string").alias("content"))
    return service.with_features(e.select("sha1", "content"), e.where("sha1 % 3 = 0"), lambda c: F.array(c.cast("double"))).select("sha1", "precomputed")


@query("q04", "SELECT doc_id, upper(sha1(text)) AS sha1 FROM documents")
def q04(spark, d):
    sent = table(spark, d, "documents").select("doc_id", F.base64(F.encode("text", "utf-8")).alias("data"))
    return service.decode_b64(sent).select("doc_id", "sha1")


@query("q05", "SELECT vec_id AS id, '<li><a href=\"https://s3/' || vec_id || '\">H' || vec_id || '</a></li>' AS row FROM embeddings")
def q05(spark, d):
    return items(spark, d).select("id", service.html_row(F.col("url"), F.col("sha1")).alias("row"))


@query("q06", "SELECT 0.3::DOUBLE AS threshold, 5 AS sim_limit, 'unknown option other' AS errors UNION ALL SELECT -1.0, 100, 'options are no JSON'")
def q06(spark, d):
    rows = [service.search_options(t) for t in ('{"near_dup": true, "near_dup_th": 0.3, "sim_limit": 5, "other": 1}', "{")]
    return spark.createDataFrame([(float(t), n, ";".join(e)) for t, n, e in rows], "threshold double, sim_limit int, errors string")


@query("q07", BODY)
def q07(spark, d):
    return documents(spark, d, camel=True).select("qid", short(F.col("body"), "Number", "Sha1", "SimilarImages", "QuerySha1").alias("body"))


@query("q08", "SELECT 0::BIGINT AS before, count(*) AS indexed, 'OK' AS status, true AS refreshed FROM embeddings")
def q08(spark, d):
    state = StateStore(spark, fresh(spark, "q08"))
    before = service.IndexStatus(state).status()
    service.IndexStatus(state).refresh(embeddings(spark, d))
    now = service.IndexStatus(state).status()
    return spark.createDataFrame([(before["indexed"], now["indexed"], now["status"], now["last_refresh"] is not None)], "before long, indexed long, status string, refreshed boolean")


def registry(spark, name):
    made = service.ProjectRegistry(StateStore(spark, fresh(spark, name)))
    for project in ("one", "two", "three"):
        made.create(project, "domain", [{"type": "crawl"}])
    return made


@query("q09", "SELECT 'one' AS name, 'created' AS result UNION ALL SELECT 'one', 'project one exists' UNION ALL SELECT '', 'a project name has 1 to 255 characters' UNION ALL SELECT 'x', 'a project needs sources'")
def q09(spark, d):
    """Each project through a registry of its own, as if the driver had started anew."""
    state, out = StateStore(spark, fresh(spark, "q09")), []
    for name, sources in (("one", [{}]), ("one", [{}]), ("", [{}]), ("x", [])):
        try:
            service.ProjectRegistry(state).create(name, "domain", sources)
            out.append((name, "created"))
        except ValueError as e:
            out.append((name, str(e)))
    return spark.createDataFrame(out, "name string, result string")


@query("q10", "SELECT 'one' AS name, 'ready' AS status UNION ALL SELECT 'two', 'rerunning' UNION ALL SELECT 'three', 'failed'")
def q10(spark, d):
    made = registry(spark, "q10")
    for name, job in (("one", "RUNNING"), ("one", "SUCCEEDED"), ("two", "FAILED"), ("three", "FAILED"), ("three", "FAILED")):
        made.advance(name, job)
    return spark.createDataFrame([(p["name"], p["status"]) for p in service.ProjectRegistry(made.state).projects()], "name string, status string")


@query("q11", "SELECT 'domain' AS domain, 'one,three' AS projects")
def q11(spark, d):
    made = registry(spark, "q11")
    made.delete("two")
    return spark.createDataFrame([(k, ",".join(p)) for k, p in made.domains().items()], "domain string, projects string")


@query("q12", "SELECT true AS held, false AS again, true AS after")
def q12(spark, d):
    one, other = (StateStore(spark, root) for root in [fresh(spark, "q12")] * 2)
    held, again = one.acquire("domain"), other.acquire("domain")
    one.release("domain")
    return spark.createDataFrame([(held, again, other.acquire("domain"))], "held boolean, again boolean, after boolean")


@query("q13", "SELECT 'job-one-0' AS job_id, 'SUCCEEDED' AS status, count(*) AS rows FROM documents UNION ALL SELECT 'job-two-0', 'FAILED', NULL")
def q13(spark, d):
    """A job that counts a table and one that fails, run and looked up."""
    state, counted = StateStore(spark, fresh(spark, "q13")), {}

    def job(project):
        counted[project["name"]] = table(spark, d, project["sources"][0]["table"]).count()

    runner = service.JobRunner(state, job)
    made = service.ProjectRegistry(state, runner.submit)
    jobs = {name: made.create(name, "domain", [{"table": source}])["job_ids"][-1] for name, source in (("one", "documents"), ("two", "none"))}
    runner.wait()
    return spark.createDataFrame([(j, runner.info(j)["status"], counted.get(name)) for name, j in jobs.items()], "job_id string, status string, rows long")


@query("q14", EXACT + "SELECT qid, id, rank FROM k")
def q14(spark, d):
    """Local features are normalised again, so their scale does not count."""
    scaled = queries(spark, d).select("vec_id", s.normalised(F.transform("embedding", lambda x: x * 7)).alias("embedding"))
    return knn.exact_knn(embeddings(spark, d), scaled, K).select("qid", "id", F.col("rank").cast("long").alias("rank"))


@query("q15", "SELECT upper(sha1(text)) AS sha1, string_agg(doc_id, ',' ORDER BY doc_id) AS ids FROM documents GROUP BY 1 HAVING count(*) > 1")
def q15(spark, d):
    rows = table(spark, d, "documents").groupBy(s.content_hash(F.col("text")).alias("sha1")).agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    return rows.where("size(ids) > 1").select("sha1", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@query("q16", "SELECT vec_id, label FROM embeddings WHERE vec_id IN (3, 4, 5)")
def q16(spark, d):
    from siftwise.sources.codecs import base64_to_vector, vector_to_base64

    stored = embeddings(spark, d).select("vec_id", "label", vector_to_base64("embedding").alias("feat"))
    return stored.where(F.col("vec_id").isin(3, 4, 5)).withColumn("v", base64_to_vector("feat")).where("size(v) = 64").select("vec_id", "label")


@query("q17", EXACT + "SELECT qid, count(*) AS n FROM k WHERE dist <= 0.5 GROUP BY 1")
def q17(spark, d):
    cache = service.ResultCache(StageStore(spark, fresh(spark, "q17")))
    params = {"preset": "loose", "k": K}
    make = lambda: knn.near_duplicates(knn.exact_knn(embeddings(spark, d), queries(spark, d), K), knn.PRESETS["loose"])
    cache.get("queries", params, make)
    return cache.get("queries", params, lambda: spark.range(0)).groupBy("qid").agg(F.count("*").alias("n"))

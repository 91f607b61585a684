"""Search and project operations as plain functions over DataFrames; no server."""

from __future__ import annotations

import json
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwise.functions.scalar import content_hash
from siftwise.operators.knn import PRESETS, near_duplicates

OPTIONS = {"near_dup": bool, "near_dup_th": float, "no_blur": bool, "sim_limit": int}


def parse_options(text: str | None) -> tuple[dict, list[str]]:
    """Known options of a JSON object, and messages on what was not understood."""
    try:
        given = json.loads(text) if text else {}
    except ValueError:
        return {}, ["options are no JSON"]
    if not isinstance(given, dict):
        return {}, ["options are no object"]
    out, errors = {}, []
    for name, value in given.items():
        kind = OPTIONS.get(name)
        if kind is None:
            errors.append(f"unknown option {name}")
        elif isinstance(value, bool) != (kind is bool) or not isinstance(value, (int, float)):
            errors.append(f"option {name} is no {kind.__name__}")
        else:
            out[name] = kind(value)
    return out, errors


def search_options(text: str | None, preset: str | None = None) -> tuple[float, int, list[str]]:
    """Threshold (negative: no filter), limit and errors."""
    options, errors = parse_options(text)
    base = PRESETS.get(preset or "balanced", PRESETS["balanced"])
    threshold = (options.get("near_dup_th") or base) if options.get("near_dup", False) else -1.0
    return threshold, options.get("sim_limit", 100), errors


def with_ranks(found: DataFrame, limit: int) -> DataFrame:
    return found.where(F.col("rank") <= limit)


def result_documents(queries: DataFrame, found: DataFrame, items: DataFrame, camel: bool = False) -> DataFrame:
    """(qid, body): one JSON document per query in the service's shape; a query without results has an empty list.

    queries: qid, query_sha1; found: qid, id, dist, rank (k per query at most); items: id, sha1, url.
    """
    name = (lambda s: "".join(p.capitalize() for p in s.split("_"))) if camel else (lambda s: s)
    rows = found.join(items, "id").groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "sha1", "url", F.round("dist", 6).alias("dist")))).alias("r"))
    joined = queries.join(rows, "qid", "left")
    r = F.coalesce("r", F.array().cast("array<struct<rank:int,sha1:string,url:string,dist:double>>"))
    similar = F.struct(F.size(r).alias(name("number")), r["sha1"].alias(name("sha1")), r["url"].alias(name("cached_image_urls")), r["dist"].alias(name("distance")))
    return joined.select("qid", F.to_json(F.struct(F.col("query_sha1").alias(name("query_sha1")), similar.alias(name("similar_images")))).alias("body"))


def html_row(url, label):
    """One result as a list item of a page, both parts escaped."""
    escaped = [F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;")) for c in (url, label)]
    return F.concat(F.lit('<li><a href="'), escaped[0], F.lit('">'), escaped[1], F.lit("</a></li>"))


def search_by_hash(hashes: DataFrame, edges: DataFrame, threshold: float = -1.0, limit: int = 100) -> DataFrame:
    """Cached search: (pos, sha1, dst, dist, rank) in query order; an unknown hash has one row of nulls."""
    from pyspark.sql import Window

    kept = near_duplicates(edges, threshold)
    joined = hashes.join(kept.withColumnRenamed("src", "sha1"), "sha1", "left")
    return joined.withColumn("rank", F.row_number().over(Window.partitionBy("pos").orderBy("dist", "dst"))).where(F.col("rank") <= limit).orderBy("pos", "rank")


def with_features(queries: DataFrame, features: DataFrame, compute, key: str = "sha1") -> DataFrame:
    """Precomputed features where there are any, else computed ones from `content`; compute is a column function."""
    return queries.join(features.select(key, F.col("feat").alias("known")), key, "left").withColumn("feat", F.coalesce("known", compute(F.col("content")))).withColumn("precomputed", F.col("known").isNotNull()).drop("known")


def decode_b64(queries: DataFrame, column: str = "data") -> DataFrame:
    """Content and hash of base64 queries; what is no base64 has nulls and an error."""
    data = F.expr(f"try_to_binary({column}, 'base64')")
    return queries.withColumn("content", data).withColumn("sha1", content_hash(data)).withColumn("error", F.when(data.isNull(), F.lit("not base64")))


def check_alignment(found: DataFrame, table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose (feat_id, sha1) the table has, and the misaligned rest."""
    pair = ["feat_id", "sha1"]
    return found.join(table.select(*pair), pair, "left_semi"), found.join(table.select(*pair), pair, "left_anti")


class JobRunner:
    """Runs a project's job in threads of this driver and keeps what became of it in the state store."""

    def __init__(self, state, job, threads: int = 2):
        self.state, self.job = state, job
        self.pool = ThreadPoolExecutor(threads, thread_name_prefix="job")

    def submit(self, project: dict) -> str:
        """Start the job; its id counts the project's jobs."""
        return self._start(f"job-{project['name']}-{len(project['job_ids'])}", project)

    def _start(self, job_id: str, project: dict) -> str:
        self.state.change(f"job {job_id}", lambda _: {"kind": "job", "id": job_id, "project": project, "status": "RUNNING", "error": None})
        self.pool.submit(self._run, job_id, project)
        return job_id

    def _run(self, job_id: str, project: dict) -> None:
        status, error = "SUCCEEDED", None
        try:
            self.job(project)
        except Exception as e:  # whatever the user's job raises is its result
            status, error = "FAILED", f"{type(e).__name__}: {e}"
        self.state.change(f"job {job_id}", lambda was: {**was, "status": status, "error": error})

    def info(self, job_id: str) -> dict | None:
        """State of a job: RUNNING, SUCCEEDED or FAILED, with what it raised."""
        return self.state.read(f"job {job_id}")[1]

    def rerun(self, job_id: str) -> str:
        """Start a failed job again under its own id."""
        was = self.info(job_id)
        if not was or was["status"] != "FAILED":
            raise ValueError(f"job {job_id} has not failed")
        return self._start(job_id, was["project"])

    def wait(self) -> None:
        """Until all jobs are done; none can be submitted after."""
        self.pool.shutdown(wait=True)


class ProjectRegistry:
    """Projects and their state machine: indexing -> rerunning -> failed, or ready. States and locks are in the store, so
    another driver, or this one started anew, finds them."""

    def __init__(self, state, run_job=None, max_reruns: int = 1):
        self.state, self.max_reruns = state, max_reruns
        self.run_job = run_job or (lambda project: f"job-{project['name']}-{len(project['job_ids'])}")
        self.started = time.time()

    def create(self, name: str, domain: str, sources: list[dict]) -> dict:
        if not 1 <= len(name) <= 255:
            raise ValueError("a project name has 1 to 255 characters")
        if self.get(name):
            raise ValueError(f"project {name} exists")
        if not sources:
            raise ValueError("a project needs sources")
        project = {"kind": "project", "name": name, "domain": domain, "sources": sources, "job_ids": [], "status": "indexing"}
        with self.state.locked(domain):
            number, now = self.state.read(f"project {name}")
            # the name is taken before its job starts
            if now or not self.state.swap(f"project {name}", number, project):
                raise ValueError(f"project {name} exists")
            return self._submit(name, "indexing")

    def _submit(self, name: str, status: str) -> dict:
        job_id = self.run_job(self.get(name))
        return self.state.change(f"project {name}", lambda p: {**p, "status": status, "job_ids": [*p["job_ids"], job_id]})

    def get(self, name: str) -> dict | None:
        return self.state.read(f"project {name}")[1]

    def advance(self, name: str, job_status: str) -> str:
        """Status after a look at the last job: SUCCEEDED, FAILED or RUNNING."""
        project = self.get(name)
        with self.state.locked(project["domain"]):
            project = self.get(name)
            if project["status"] in ("ready", "failed") or job_status not in ("SUCCEEDED", "FAILED"):
                return project["status"]
            if job_status == "FAILED" and len(project["job_ids"]) <= self.max_reruns:
                return self._submit(name, "rerunning")["status"]
            return self.state.change(f"project {name}", lambda p: {**p, "status": "ready" if job_status == "SUCCEEDED" else "failed"})["status"]

    def delete(self, name: str) -> None:
        project = self.get(name)
        if not project:
            raise KeyError(name)
        with self.state.locked(project["domain"]):
            self.state.change(f"project {name}", lambda _: None)

    def projects(self) -> list[dict]:
        return sorted((p for p in self.state.values() if p["kind"] == "project"), key=lambda p: p["name"])

    def domains(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for p in self.projects():
            out.setdefault(p["domain"], []).append(p["name"])
        return out

    def status(self) -> dict:
        return {"projects": len(self.projects()), "uptime": time.time() - self.started}


class IndexStatus:
    """Counts of the indexed table as of the last refresh, kept in the store; asked for as often as one likes."""

    def __init__(self, state):
        self.state, self.started = state, time.time()

    def refresh(self, index: DataFrame) -> dict:
        counted = {"kind": "index", "indexed": index.count(), "last_refresh": time.time()}
        return self.state.change("index", lambda _: counted)

    def status(self) -> dict:
        """Before the first refresh nothing is counted and its time is None."""
        known = self.state.read("index")[1] or {"indexed": 0, "last_refresh": None}
        return {"status": "OK", "uptime": time.time() - self.started, "indexed": known["indexed"], "last_refresh": known["last_refresh"]}


class ResultCache:
    """Results keyed by query hash and parameters, as tables in a folder."""

    def __init__(self, store):
        self.store = store

    def get(self, query_hash: str, params: dict, compute) -> DataFrame:
        key = "cache-" + "-".join([query_hash, *(f"{k}={params[k]}" for k in sorted(params))]).replace("/", "_")
        return self.store.stage(key, compute)

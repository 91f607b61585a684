"""Edge cases and invariants of the operators."""

import math
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwise.functions import images, layers
from siftwise.functions import scalar as s
from siftwise.operators import dedup, keyed, knn, lopq, queue, service
from siftwise.operators import normalize as n
from siftwise.operators import vectors as v
from siftwise.sources import codecs
from siftwise.sources.store import StageStore, StateStore

RECORD = "sha1 string, url string, ids array<string>, discarded string"


def test_merge_cap_and_marks(spark):
    rows = [("a", "1", "https://s3/x", None), ("a", "1", None, None), ("a", "2", "None", None), ("b", "1", "http://x", None), ("b", "2", None, None), ("b", "3", None, None), ("c", "1", "https://s3/c", "old"), ("d", None, "https://s3/d", None)]
    df = spark.createDataFrame(rows, "sha1 string, id string, url string, mark string")
    got = {r["sha1"]: r for r in dedup.merge_by_hash(df, cap=2, discarded="mark").collect()}
    assert (got["a"]["ids"], got["a"]["url"], got["a"]["discarded"]) == (["1", "2"], "https://s3/x", None)
    assert (got["b"]["ids"], got["b"]["url"], got["b"]["discarded"], got["b"]["n_ids"]) == ([], None, dedup.DISCARDED, 3)
    assert (got["c"]["ids"], got["c"]["discarded"]) == ([], "old")
    assert got["d"]["ids"] == []


def test_upsert_is_idempotent_and_keeps_marks(spark):
    new = spark.createDataFrame([("a", "https://s3/n", ["1"], None), ("b", None, ["2"], None), ("z", "https://s3/z", [], "gone")], RECORD)
    old = spark.createDataFrame([("a", "https://s3/o", ["0", "1"], None), ("b", "https://s3/b", ["3"], "marked"), ("c", None, ["9"], None)], RECORD).withColumn("feat_id", F.lit(5).cast("long"))
    merged = keyed.upsert_merge(new, old, cap=10)
    got = {r["sha1"]: tuple(r)[1:] for r in merged.collect()}
    assert got == {"a": ("https://s3/n", ["0", "1"], None, 5), "b": ("https://s3/b", [], "marked", 5), "z": ("https://s3/z", [], "gone", None)}
    again = keyed.upsert_merge(new, keyed.apply_upsert(old, merged), cap=10)
    assert {r["sha1"]: tuple(r)[1:] for r in again.collect()} == got
    assert keyed.upsert_merge(new.limit(0), old).count() == 0


def test_conflict_raises(spark):
    df = spark.createDataFrame([("u", "A"), ("u", "B"), ("w", None)], "url string, sha1 string")
    with pytest.raises(Exception, match="conflicting sha1 for url u"):
        dedup.one_or_fail(df, "url", "sha1").collect()
    assert [r["url"] for r in dedup.conflicts(df, "url", "sha1").collect()] == ["u"]


def test_latest_ties(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, 4, 9), (2, None, 3)], "k int, ts int, e int")
    assert {tuple(r) for r in dedup.latest(df, "k", "ts", "e").collect()} == {(1, 5, 2), (2, None, 3)}


def test_dense_ids_over_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k"))
    got = [tuple(r) for r in keyed.dense_ids(df, ["k"], base=10, partitions=7).orderBy("k").select("k", "feat_id").collect()]
    assert [i for _, i in got] == list(range(10, 1010))
    assert tuple(keyed.aligned(keyed.dense_ids(df, ["k"])).first()) == (1000, 999, True)
    assert keyed.dense_ids(df.limit(0), ["k"]).count() == 0


def test_urls_and_nullish(spark):
    df = spark.createDataFrame([("https://a/x,1.jpg,https://b/y",), ("http://a,",), (None,), ("",)], "t string").select(s.split_urls(F.col("t")).alias("u"))
    assert [r["u"] for r in df.collect()] == [["https://a/x,1.jpg", "https://b/y"], ["http://a"], None, []]
    got = spark.createDataFrame([("None",), (" ",), ("https://s3/a",), ("http://s3",), (None,)], "u string").select(n.valid_url(F.col("u")).alias("v"))
    assert [r["v"] for r in got.collect()] == [False, False, True, False, False]


def test_week_tag(spark):
    import datetime

    days = [datetime.datetime(2017, 1, 1), datetime.datetime(2017, 1, 2), datetime.datetime(2020, 12, 31), datetime.datetime(2018, 1, 1)]
    got = spark.createDataFrame([(d,) for d in days], "ts timestamp").select(s.week_tag(F.col("ts")).alias("w"))
    assert [r["w"] for r in got.collect()] == [f"Y{d.year}W{d:%W}" for d in days]


def test_image_headers(spark):
    jpeg = b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"xx\xff\xff\xc2" + struct.pack(">HBHHB", 11, 8, 480, 640, 3) + b"..."
    rows = [jpeg, b"GIF89a" + struct.pack("<HH", 3, 4), b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", 5, 6), b"\xff\xd8\xff", b"GIF89a", b"", None, b"\xff\xd8\xff\xda\0\0"]
    got = spark.createDataFrame([(r,) for r in rows], "data binary").select(images.image_info("data").alias("i"), images.info_json(images.image_info("data")).alias("j")).collect()
    assert [r["i"] and tuple(r["i"]) for r in got][:3] == [("JPEG", 640, 480), ("GIF", 3, 4), ("PNG", 5, 6)]
    assert all(r["j"] is None for r in got[3:]) and got[0]["j"] == '{"size":{"width":640,"height":480},"format":"JPEG"}'


def test_pack_bits_strict():
    codes = v.pack_bits(np.array([[True] + [False] * 30 + [True] + [False] * 32]))
    assert codes.tolist() == [[1 + (1 << 31), 0]]


def test_zero_vectors(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, None)], "vec_id long, embedding array<float>")
    assert [r[0] for r in df.where("embedding is not null").select(F.round(s.norm(s.normalised(F.col("embedding"))), 6)).collect()] == [0.0, 1.0]
    assert v.hash_codes(df, "vec_id", "embedding", np.ones((2, 32))).orderBy("vec_id").collect()[0]["code"] == [0]


def test_shortlist_of_everything_is_exact(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    q = e.where("vec_id % 50 = 0")
    codes = v.hash_codes(e, "vec_id", "embedding", v.fixed_projection(64, 64))
    near = knn.hamming_knn(e, q, codes, codes.join(q.select("vec_id"), "vec_id"), 5, 1.0, knn.inner_distance)
    pairs = lambda df: sorted((r["qid"], r["rank"], r["id"]) for r in df.collect())
    assert pairs(near) == pairs(knn.exact_knn(e, q, 5))
    exact = knn.exact_knn(e, q, 5)
    assert [r["recall"] for r in knn.recall_at(exact, exact, [1, 5]).collect()] == [1.0, 1.0]
    counts = [knn.near_duplicates(exact, t).count() for t in (0.1, 0.6, 0.7, -1)]
    assert counts == sorted(counts) and counts[-1] == 5 * q.count()


def test_knn_ties(spark):
    df = spark.createDataFrame([(i, [1.0, 0.0] if i < 6 else [0.0, 1.0]) for i in range(9)], "vec_id long, embedding array<double>").repartition(3)
    got = knn.exact_knn(df, df.where("vec_id = 5"), 3).orderBy("rank").collect()
    assert [r["id"] for r in got] == [0, 1, 2]


def test_multisequence_is_sorted():
    rng = np.random.default_rng(1)
    cs, x = rng.standard_normal((2, 6, 4)), rng.standard_normal(8)
    got = list(lopq.multisequence(x, cs))
    every = sorted((((x[:4] - cs[0][a]) ** 2).sum() + ((x[4:] - cs[1][b]) ** 2).sum(), a, b) for a in range(6) for b in range(6))
    assert [g[1:] for g in got] == [e[1:] for e in every]


def test_lopq(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    model = lopq.train(e, "embedding", 4, 8, 16, seed=3)
    model.save(spark, str(tmp_path / "model"))
    back = lopq.LOPQModel.load(spark, str(tmp_path / "model"))
    assert all((getattr(model, a) == getattr(back, a)).all() for a in ("cs", "rs", "mus", "subs"))
    codes = lopq.encode(e, "vec_id", "embedding", model)
    decoded = lopq.decode(codes, model)
    again = lopq.encode(decoded, "id", "vector", model)
    same = codes.join(again.select("id", F.col("c0").alias("d0"), F.col("c1").alias("d1")), "id").where("c0 = d0 and c1 = d1").count()
    assert same > 0.9 * codes.count()
    q = e.where("vec_id % 25 = 0")
    found = lopq.search(q, "vec_id", "embedding", codes, model, quota=10**6, limit=50)
    assert found.agg(F.min("visited")).first()[0] == codes.count()
    recall = {r["k"]: r["recall"] for r in knn.recall_at(found, knn.exact_knn(e, q, 1), [1, 50]).collect()}
    assert recall[50] >= 0.9 and recall[1] >= 0.5
    # table distances are those of the reconstruction
    x = dict((r["vec_id"], np.array(r["embedding"], float)) for r in q.collect())
    y = {r["id"]: np.array(r["vector"]) for r in decoded.collect()}
    for r in found.limit(40).collect():
        assert abs(((x[r["qid"]] - y[r["id"]]) ** 2).sum() - r["dist"]) < 1e-6
    codecs.write_codes_text(codes, str(tmp_path / "codes"))
    assert codecs.read_codes_text(spark, str(tmp_path / "codes")).exceptAll(codes).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_registered_search_finds_true_neighbours(spark, sf):
    from siftwise.catalog import QUERIES

    d = f"/root/testdata/{sf}"
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    true = knn.ranked(knn.exact_knn(e, e.where("vec_id % 20 = 0"), 11).where("qid <> id").drop("rank"), 10)
    found = QUERIES["t13"](spark, d)
    want, got = ({(r["qid"], r["id"]) for r in x.collect()} for x in (true, found))
    assert len(want & got) >= 0.9 * len(want) and not any(q == i for q, i in got) and len(got) == len(want)
    recall = {r["k"]: r["recall"] for r in QUERIES["a19"](spark, d).collect()}
    assert recall[1] >= 0.9


def test_query_blocks(spark, monkeypatch):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    whole = sorted(map(tuple, knn.exact_knn(e, e.where("vec_id % 20 = 0"), 3).select("qid", "id", "rank").collect()))
    monkeypatch.setattr(knn, "MAX_QUERIES", 7)
    assert len(list(knn.query_blocks(e.where("vec_id % 20 = 0"), "vec_id", "embedding"))) == 4
    assert sorted(map(tuple, knn.exact_knn(e, e.where("vec_id % 20 = 0"), 3).select("qid", "id", "rank").collect())) == whole


def test_few_points_keep_identity(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0, 2.0, 3.0]) for i in range(3)], "id long, x array<double>")
    model = lopq.train_rotations(df, "x", lopq.LOPQModel(np.array([[[0.0, 1.0], [100.0, 100.0]], [[2.0, 3.0], [50.0, 50.0]]])))
    assert (model.rs[0][1] == np.eye(2)).all() and (model.mus[0][1] == 0).all()


@pytest.mark.parametrize("kind", ["fvecs", "ivecs", "bvecs"])
def test_xvecs(spark, tmp_path, kind):
    m = np.arange(12).reshape(3, 4)
    data = codecs.xvecs_bytes(m, kind)
    assert (codecs.parse_xvecs(data, kind) == m).all()
    (tmp_path / f"x.{kind}").write_bytes(data)
    got = codecs.read_xvecs(spark, str(tmp_path / f"x.{kind}"), kind).orderBy("pos").collect()
    assert [r["vector"] for r in got] == m.tolist()
    with pytest.raises(ValueError, match="truncated"):
        codecs.parse_xvecs(data[:-1], kind)
    # written by tasks, as files, and read again
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "id long, v array<double>").repartition(2)
    files = codecs.write_vector_files(df, "id", "v", f"file://{tmp_path}/out", kind).collect()
    assert sum(r["n"] for r in files) == 3 and all((tmp_path / "out" / r["file"].rsplit("/", 1)[-1]).exists() for r in files)
    back = codecs.read_xvecs(spark, f"file://{tmp_path}/out/*.{kind}", kind).orderBy("file", "pos").collect()
    assert sorted(r["vector"] for r in back) == m.tolist()


def test_queue(spark):
    keys = spark.range(25).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("k"))
    rows = queue.batches(keys, "k", 10)
    assert sorted((r["update_id"][-1], r["n_keys"]) for r in rows.collect()) == [("0", 10), ("1", 10), ("2", 5)]
    assert queue.batches(keys.limit(0), "k", 10).count() == 0
    assert queue.batches(keys.limit(10), "k", 10).count() == 1
    done = rows
    for m in ("started", "indexed"):
        done = queue.set_marker(done, m, F.lit(True))
    assert queue.next_batch(done).count() == 0
    half = queue.set_marker(queue.set_marker(rows, "started", F.lit(True)), "indexed", F.col("update_id").endswith("2"))
    assert queue.next_batch(half).first()["update_id"].endswith("1")


def test_store(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    df = spark.range(3)
    assert not store.exists("a") and store.save(df, "a") and not store.save(df, "a")
    with pytest.raises(FileExistsError):
        store.save(df, "a", skip_existing=False)
    (tmp_path / "a" / "_SUCCESS").unlink()
    assert store.failed("a") and store.save(df, "a") and store.load("a").count() == 3


def test_stream_without_its_checkpoint(spark, tmp_path):
    """A stream that lost its checkpoint numbers its batches from 0 again and keeps what is there."""
    import shutil

    from siftwise.streaming import updates

    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for part, lost in (([1, 2], False), ([2, 3], False), ([3, 4], True)):
        spark.createDataFrame([(k,) for k in part], "k long").coalesce(1).write.mode("append").parquet(source)
        if lost:
            shutil.rmtree(checkpoint)
            shutil.rmtree(source)
            spark.createDataFrame([(k,) for k in part], "k long").coalesce(1).write.parquet(source)
        updates.run_updates(updates.file_stream(spark, source, "k long"), out, "k", lambda b: b, checkpoint)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4]


def test_states(spark, tmp_path):
    """Changes from many threads are all kept; unfinished files, deletions and locks left behind."""
    from concurrent.futures import ThreadPoolExecutor

    state, other = (StateStore(spark, f"file://{tmp_path}") for _ in range(2))
    assert state.read("n") == (0, None) and list(state.values()) == []
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: (state, other)[i % 2].change("n", lambda v: {"n": (v or {"n": 0})["n"] + 1}), range(20)))
    assert other.read("n") == (20, {"n": 20}) and not other.swap("n", 19, {"n": 0})
    (tmp_path / "unfinished" / "x").write_text('{"na')
    assert state.change("n", lambda v: {"n": 5}) == {"n": 5} and state.read("n") == (21, {"n": 5}) and list(other.values()) == [{"n": 5}]
    state.change("n", lambda v: None)
    assert other.read("n") == (22, None) and list(state.values()) == []
    assert state.acquire("a/b: ..") and not other.acquire("a/b: ..") and other.acquire("a/b: ..", stale=-1)
    with pytest.raises(TimeoutError), other.locked("a/b: ..", wait=0.1):
        pass


def test_jobs(spark, tmp_path):
    state, ran = StateStore(spark, f"file://{tmp_path}"), []

    def job(project):
        ran.append(project["name"])
        if len(ran) == 1:
            raise OSError("first")

    runner = service.JobRunner(state, job, threads=1)
    made = service.ProjectRegistry(state, runner.submit)
    first = made.create("p", "d", [{}])["job_ids"][0]
    runner.pool.submit(int).result()  # after the job in the one thread
    assert runner.info(first)["status"] == "FAILED" and runner.info(first)["error"] == "OSError: first"
    assert made.advance("p", "FAILED") == "rerunning" and runner.rerun(first) == first
    runner.wait()
    again = service.ProjectRegistry(state)
    assert again.get("p")["job_ids"] == ["job-p-0", "job-p-1"] and len(ran) == 3
    assert {runner.info(j)["status"] for j in again.get("p")["job_ids"]} == {"SUCCEEDED"} and runner.info("none") is None
    with pytest.raises(ValueError):
        runner.rerun(first)
    again.delete("p")
    assert again.status()["projects"] == 0 and again.create("p", "d", [{}])["job_ids"] == ["job-p-0"]


def test_service(spark, tmp_path):
    assert service.parse_options(None) == ({}, [])
    assert service.parse_options("[]")[1] and service.parse_options('{"near_dup": 1, "no_blur": true}') == ({"no_blur": True}, ["option near_dup is no bool"])
    assert service.search_options('{"near_dup": true}', "strict")[0] == 0.1
    made = service.ProjectRegistry(StateStore(spark, f"file://{tmp_path}"), max_reruns=0)
    made.create("p", "d", [{}])
    assert made.advance("p", "FAILED") == "failed" == made.advance("p", "SUCCEEDED")


def png(pixels, kind, filters):
    """A PNG of height x width x channels samples, row y filtered by filters[y % len(filters)], one sample at a time."""
    def chunk(name, body):
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    height, width, channels = pixels.shape
    at = lambda y, x, c: int(pixels[y, x, c]) if y >= 0 and x >= 0 else 0
    raw = bytearray()
    for y in range(height):
        f = filters[y % len(filters)]
        raw.append(f)
        for x in range(width):
            for c in range(channels):
                a, b, d = at(y, x - 1, c), at(y - 1, x, c), at(y - 1, x - 1, c)
                paeth = min((a, b, d), key=lambda v: abs(a + b - d - v))  # the first of equals
                raw.append((at(y, x, c) - (0, a, b, (a + b) // 2, paeth)[f]) % 256)
    head = struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)
    plte = chunk(b"PLTE", bytes(range(256)) * 3) if kind == 3 else b""
    packed = zlib.compress(bytes(raw))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + plte + chunk(b"IDAT", packed[:9]) + chunk(b"IDAT", packed[9:]) + chunk(b"IEND", b"")


def test_pixels():
    from siftwise.functions import pixels

    rng = np.random.default_rng(3)
    for kind, channels in pixels.PNG_CHANNELS.items():
        image = rng.integers(0, 256, (7, 5, channels), np.uint8)
        palette = np.frombuffer(bytes(range(256)) * 3, np.uint8).reshape(-1, 3)
        want = palette[image[..., 0]] if kind == 3 else np.repeat(image[..., :1], 3, axis=2) if channels < 3 else image[..., :3]
        data = png(image, kind, [0, 1, 2, 3, 4, 4, 3])
        assert (pixels.decode(data) == want).all()
        assert pixels.decode(data[:60]) is None
    colour = rng.integers(0, 256, (2, 3, 3), np.uint8)
    assert (pixels.decode(b"P6\n3 2\n255\n" + colour.tobytes()) == colour).all()
    assert (pixels.decode(b"P5 2 1 255\n\n ") == [[[10] * 3, [32] * 3]]).all()
    assert [pixels.decode(x) for x in (None, b"", b"P5 2 2 255\nab", b"P6", b"\xff\xd8\xff")] == [None] * 5

    def cubic(x):
        x = abs(x)
        return 1.5 * x**3 - 2.5 * x**2 + 1 if x < 1 else -0.5 * x**3 + 2.5 * x**2 - 4 * x + 2 if x < 2 else 0.0

    def line(samples, to):
        scale, out = len(samples) / to, []
        for i in range(to):
            w = [cubic((j + 0.5 - (i + 0.5) * scale) / max(scale, 1)) for j in range(len(samples))]
            out.append(min(255, max(0, math.floor(sum(a * b for a, b in zip(w, samples)) / sum(w) + 0.5))))
        return out

    for shape, to in (((5, 9), (8, 4)), ((3, 3), (3, 7)), ((12, 10), (5, 5))):
        image = rng.integers(0, 256, (*shape, 1), np.uint8)
        wide = np.array([line(row, to[1]) for row in image[..., 0].tolist()])
        assert (pixels.resize(image, *to)[..., 0] == np.array([line(column, to[0]) for column in wide.T.tolist()]).T).all()
    assert (pixels.prepared(colour.repeat(2, 0).repeat(2, 1)[:4, :4], 4, 2, (1, 2, 3)) == colour.repeat(2, 0).repeat(2, 1)[1:3, 1:3, ::-1] - np.float32([1, 2, 3])).all()


def test_extraction(spark):
    """Against a network of plain loops; bytes that are no image have no features."""
    from siftwise.functions import network

    assert network.weight_shapes(network.IMAGE_NET) == {"conv1": (11, 11, 3, 96), "conv2": (5, 5, 48, 256), "conv3": (3, 3, 256, 384), "conv4": (3, 3, 192, 384), "conv5": (3, 3, 192, 256), "fc6": (9216, 4096), "fc7": (4096, 4096), "fc8": (4096, 2089)}
    net = (network.Layer("c1", "conv", 3, 4, 2, padding="VALID"), network.Layer("c2", "conv", 3, 4, groups=2), network.Layer("p", "max_pool", 2, stride=1, padding="VALID"), network.Layer("n", "norm"), network.Layer("d", "dense", filters=3, relu=False))
    rng = np.random.default_rng(5)
    weights = {n: (rng.normal(size=s), rng.normal(size=s[-1])) for n, s in network.weight_shapes(net, 7).items()}
    images = rng.integers(0, 256, (40, 9, 9, 3), np.uint8)

    def convolved(x, w, b, stride, pad, groups):
        size, inside, filters = w.shape[0], w.shape[2], w.shape[3]
        x = np.pad(x, ((pad, pad), (pad, pad), (0, 0)))
        n = (x.shape[0] - size) // stride + 1
        out = np.empty((n, n, filters))
        for r, c, f in np.ndindex(out.shape):
            g = f // (filters // groups)
            out[r, c, f] = max(0, (x[r * stride : r * stride + size, c * stride : c * stride + size, g * inside : (g + 1) * inside] * w[..., f]).sum() + b[f])
        return out

    def plain(image):
        x = convolved(image[1:8, 1:8, ::-1] - 100.0, *weights["c1"], 2, 0, 1)
        x = convolved(x, *weights["c2"], 1, 1, 2)
        x = np.array([[x[r : r + 2, c : c + 2].max(axis=(0, 1)) for c in range(x.shape[1] - 1)] for r in range(x.shape[0] - 1)])
        x = x / (1 + 2e-5 * np.stack([(x[..., max(0, c - 2) : c + 3] ** 2).sum(axis=-1) for c in range(x.shape[2])], axis=-1)) ** 0.75
        return x.ravel() @ weights["d"][0] + weights["d"][1]

    rows = [(i, b"P6 9 9 255\n" + image.tobytes()) for i, image in enumerate(images)] + [(40, b"no image"), (41, None), (42, b"")]
    features = network.extractor(net, "test", lambda: weights, "d", 9, 7, 100.0)
    got = {r.i: r.feat for r in spark.createDataFrame(rows, "i int, data binary").select("i", features("data").alias("feat")).collect()}
    assert len(got) == 43 and all(got[i] is None for i in (40, 41, 42))
    for i, image in enumerate(images):
        assert np.allclose(got[i], plain(image), rtol=1e-4, atol=1e-2)
    with pytest.raises(ValueError):
        network.apply(net, weights, np.zeros((1, 7, 7, 3)), "none")


def test_layers():
    x = np.arange(32.0).reshape(1, 4, 4, 2)
    w = np.zeros((1, 1, 1, 2))
    w[..., :] = 2
    assert (layers.conv(x, w, np.ones(2), groups=2) == 2 * x + 1).all()
    assert layers.max_pool(x, 2, 2).shape == (1, 2, 2, 2) and layers.max_pool(x, 2, 2)[0, 0, 0, 0] == 10
    assert np.allclose(layers.avg_pool(np.ones((1, 3, 3, 1)), 2, 2, "SAME"), 1)
    assert np.allclose(layers.softmax(np.array([[1.0, 1.0]])), 0.5)
    assert layers.local_response(x).shape == x.shape and layers.dense(x, np.ones((32, 3)), np.zeros(3)).shape == (1, 3)

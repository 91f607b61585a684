"""V: vector operators; A15 to A21: vector aggregates and evaluation. Models are small and fixed by seeds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from siftwise.catalog.registry import query
from siftwise.catalog.sources import fresh
from siftwise.functions import scalar as s
from siftwise.operators import knn, lopq
from siftwise.operators import vectors as v
from siftwise.plans.stages import table

V, M, S, SUB, SEED, BITS = 4, 8, 16, 4, 7, 64


def embeddings(spark, d):
    return table(spark, d, "embeddings")


def fixed_coarse(spark, d):
    """Centroids that SQL can know: the halves of the first V vectors."""
    rows = embeddings(spark, d).where(F.col("vec_id") < V).orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows], float)
    return lopq.LOPQModel(np.stack([x[:, :32], x[:, 32:]]))


def fixed_model(spark, d):
    """A whole model that SQL can know: frames turn their coordinates by the cluster's number, centres and sub-centroids
    follow a formula of exact binary fractions. Trained models are tested against numpy and by recall."""
    model = fixed_coarse(spark, d)
    j, code, pos = np.indices((M, SUB, 64 // M))
    model.rs = np.stack([[np.roll(np.eye(32), k, axis=0) for k in range(V)]] * 2)
    model.mus = np.tile((np.arange(V)[None, :, None] + 1) / 64, (2, 1, 32))
    model.subs = ((3 * j + 5 * code + 7 * pos) % 11 - 5) / 16
    return model


def trained(spark, d):
    return lopq.train(embeddings(spark, d), "embedding", V, M, S, SEED)


#: Nearest of the first V vectors' halves, the lowest at ties, for both halves.
ASSIGN = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
c AS (SELECT vec_id AS k, x FROM e WHERE vec_id < 4),
a AS (SELECT e.vec_id, arg_min(c.k, (list_distance(e.x[1:32], c.x[1:32]), c.k))::INT AS c0, arg_min(c.k, (list_distance(e.x[33:64], c.x[33:64]), c.k))::INT AS c1 FROM e, c GROUP BY 1)
"""
#: The fixed model: local residuals in every cluster (l), squared distances of their parts to the sub-centroids (tab), codes (f).
FIXED = ASSIGN + """, l AS (SELECT e.vec_id, s, c.k, (i + c.k) % 32 AS n, e.x[s * 32 + i + 1] - c.x[s * 32 + i + 1] - (c.k + 1) / 64 AS y
  FROM e, c, (SELECT unnest(range(2)) AS s), (SELECT unnest(range(32)) AS i)),
tab AS (SELECT vec_id, s, k, s * 4 + n // 8 AS j, code, sum((y - ((3 * (s * 4 + n // 8) + 5 * code + 7 * (n % 8)) % 11 - 5) / 16) ** 2) AS err
  FROM l, (SELECT unnest(range(4)) AS code) GROUP BY 1, 2, 3, 4, 5),
own AS (SELECT vec_id, 0 AS s, c0 AS k FROM a UNION ALL SELECT vec_id, 1, c1 FROM a),
f AS (SELECT vec_id, s, k, j, arg_min(code, (err, code)) AS code, min(err) AS err FROM tab JOIN own USING (vec_id, s, k) GROUP BY 1, 2, 3, 4)
"""
#: Codes by the fixed projection: bits strictly over 0, packed into two words.
HASHED = """
WITH x AS (SELECT vec_id, i - 1 AS i, embedding[i]::DOUBLE AS val FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings)),
b AS (SELECT vec_id, j, sum(val * (((73 * i + 151 * j + 17 * i * j) % 257) - 128)) > 0 AS bit FROM x, (SELECT unnest(range(0, 64)) AS j) GROUP BY 1, 2),
code AS (SELECT vec_id, sum(CASE WHEN bit AND j < 32 THEN (1::BIGINT << j::INT) ELSE 0 END)::BIGINT AS w0, sum(CASE WHEN bit AND j >= 32 THEN (1::BIGINT << (j - 32)::INT) ELSE 0 END)::BIGINT AS w1 FROM b GROUP BY 1)
"""


def codes(spark, d):
    return v.hash_codes(embeddings(spark, d), "vec_id", "embedding", v.fixed_projection(64, BITS))


@query("a15", "SELECT pos::INT AS pos, round(avg(x), 5) AS mean FROM (SELECT unnest(range(64)) AS pos, unnest(embedding::DOUBLE[]) AS x FROM embeddings) GROUP BY 1")
def a15(spark, d):
    n, total, _ = v.outer_sums(embeddings(spark, d), "embedding")
    return spark.createDataFrame([(i, round(float(x), 5)) for i, x in enumerate(total / n)], "pos int, mean double")


@query("a16", "SELECT i::INT AS i, j::INT AS j, round(sum(embedding[i + 1]::DOUBLE * embedding[j + 1]::DOUBLE), 4) AS total FROM embeddings, (SELECT unnest(range(64)) AS i), (SELECT unnest(range(64)) AS j) GROUP BY ALL")
def a16(spark, d):
    _, _, outer = v.outer_sums(embeddings(spark, d), "embedding")
    return spark.createDataFrame([(i, j, round(float(outer[i, j]), 4)) for i in range(64) for j in range(64)], "i int, j int, total double")


@query("a17", ASSIGN + "SELECT c0, count(*) AS n FROM a GROUP BY 1")
def a17(spark, d):
    model = fixed_coarse(spark, d)
    assigned = v.map_vectors(embeddings(spark, d), "vec_id", "embedding", model.coarse, "c", "bigint")
    return assigned.groupBy(F.col("c")[0].cast("int").alias("c0")).agg(F.count("*").alias("n"))


def assigned(spark, d):
    rows = v.map_vectors(embeddings(spark, d), "vec_id", "embedding", fixed_coarse(spark, d).coarse, "c", "bigint")
    return rows.select("vec_id", F.col("c")[0].cast("int").alias("c0"), F.col("c")[1].cast("int").alias("c1"))


@query("a18", ASSIGN + "SELECT (c1 + c0 * 4)::INT AS cell, count(*) AS n FROM a GROUP BY 1")
def a18(spark, d):
    return assigned(spark, d).groupBy(s.cell_id(F.col("c0"), F.col("c1"), V).cast("int").alias("cell")).agg(F.count("*").alias("n"))


@query("a19")
def a19(spark, d):
    e, queries = embeddings(spark, d), embeddings(spark, d).where("vec_id % 20 = 0")
    truth = knn.ranked(knn.exact_knn(e, queries, 2).where("qid <> id").drop("rank"), 1)
    model = trained(spark, d)
    found = lopq.search_reranked(e, queries, "vec_id", "embedding", model, 100, lopq.tune(e, queries, "vec_id", "embedding", model, 10, 200))
    return knn.recall_at(found, truth, [1, 10, 100])


@query("a20", FIXED + "SELECT j::INT AS part, round(avg(err), 6) AS distortion FROM f GROUP BY 1")
def a20(spark, d):
    found = lopq.distortion(embeddings(spark, d), "vec_id", "embedding", fixed_model(spark, d))
    return found.select("part", F.round("distortion", 6).alias("distortion"))


@query("a21", ASSIGN + """, near AS (SELECT q.vec_id AS qid, b.vec_id AS id FROM e q, e b WHERE q.vec_id % 20 = 0 AND q.vec_id <> b.vec_id
  QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY 1 - list_inner_product(q.x, b.x), b.vec_id) = 1)
SELECT avg((p.c0 = r.c0)::INT) AS first, avg((p.c1 = r.c1)::INT) AS second, avg((p.c0 = r.c0 AND p.c1 = r.c1)::INT) AS "both" FROM near JOIN a p ON p.vec_id = qid JOIN a r ON r.vec_id = id""")
def a21(spark, d):
    e = embeddings(spark, d)
    near = knn.ranked(knn.exact_knn(e, e.where("vec_id % 20 = 0"), 2).where("qid <> id").drop("rank"), 1)
    return lopq.coarse_agreement(near, lopq.encode(e, "vec_id", "embedding", fixed_model(spark, d)))


V01 = """
WITH p AS (SELECT doc_id, r, c, ascii(substr(h, (r * 8 + c + 1)::INT, 1)) AS v FROM (SELECT doc_id, sha256(text) AS h FROM documents), (SELECT unnest(range(1, 7)) AS r), (SELECT unnest(range(1, 7)) AS c)),
s AS (SELECT doc_id, (r - 1) // 3 AS a, (c - 1) // 3 AS b, f, sum((v - 10 * (k + 1)) * (((r - 1) % 3 * 3 + (c - 1) % 3 + k + 5 * f) % 7 - 3)) + f AS x
  FROM p, (SELECT unnest(range(3)) AS k), (SELECT unnest(range(4)) AS f) GROUP BY 1, 2, 3, 4)
SELECT doc_id, max(CASE WHEN f = 0 THEN x * (x > 0)::INT END)::DOUBLE AS f0, max(CASE WHEN f = 1 THEN x * (x > 0)::INT END)::DOUBLE AS f1,
  max(CASE WHEN f = 2 THEN x * (x > 0)::INT END)::DOUBLE AS f2, max(CASE WHEN f = 3 THEN x * (x > 0)::INT END)::DOUBLE AS f3 FROM s GROUP BY 1
"""


@query("v01", V01)
def v01(spark, d):
    """The whole way from image bytes to a layer's output, through a network small enough for SQL: a document's hash in
    hexadecimal digits is an 8 x 8 image, of which the 6 x 6 in the middle is convolved."""
    from siftwise.functions import network

    def load():
        i, j, k, f = np.indices((3, 3, 3, 4))
        return {"conv": (((i * 3 + j + k + 5 * f) % 7 - 3).astype(np.float32), np.arange(4, dtype=np.float32))}

    net = (network.Layer("conv", "conv", 3, 4, 3, padding="VALID"), network.Layer("pool", "max_pool", 2, stride=2, padding="VALID"))
    features = network.extractor(net, "v01", load, "pool", 8, 6, (10, 20, 30))
    image = F.concat(F.encode(F.lit("P5 8 8 255\n"), "utf-8"), F.encode(F.sha2("text", 256), "utf-8"))
    rows = table(spark, d, "documents").select("doc_id", features(image).alias("feat"))
    return rows.select("doc_id", *[F.col("feat")[i].cast("double").alias(f"f{i}") for i in range(4)])


@query("v02", "SELECT vec_id, 1.0::DOUBLE AS norm FROM embeddings")
def v02(spark, d):
    from siftwise.sources.codecs import base64_to_vector, vector_to_base64

    unit = base64_to_vector(vector_to_base64(s.normalised(F.col("embedding")).cast("array<float>")))
    return embeddings(spark, d).select("vec_id", F.round(s.norm(unit), 4).alias("norm"))


@query("v03", "SELECT vec_id, round(embedding[1]::DOUBLE / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS first FROM embeddings")
def v03(spark, d):
    return embeddings(spark, d).select("vec_id", F.round(s.normalised(F.col("embedding"))[0], 6).alias("first"))


@query("v04", "SELECT vec_id, round(sum(val * (((73 * i + 17 * i * 3 + 151 * 3) % 257) - 128)), 4) AS third FROM (SELECT vec_id, i - 1 AS i, embedding[i]::DOUBLE AS val FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings)) GROUP BY 1")
def v04(spark, d):
    w = v.fixed_projection(64, BITS)
    return v.map_vectors(embeddings(spark, d), "vec_id", "embedding", lambda x: x @ w, "p").select("vec_id", F.round(F.col("p")[3], 4).alias("third"))


@query("v05", HASHED + "SELECT vec_id, w0, w1 FROM code")
def v05(spark, d):
    return codes(spark, d).select("vec_id", F.col("code")[0].alias("w0"), F.col("code")[1].alias("w1"))


@query("v06", "SELECT i::INT AS i, j::INT AS j, (((73 * i + 151 * j + 17 * i * j) % 257) - 128)::DOUBLE AS w FROM (SELECT unnest(range(64)) AS i), (SELECT unnest(range(64)) AS j)")
def v06(spark, d):
    out = fresh(spark, "v06")
    w = v.fixed_projection(64, BITS)
    spark.createDataFrame([("W", [64, BITS], w.reshape(-1).tolist())], "name string, shape array<int>, values array<double>").write.parquet(out)
    return spark.read.parquet(out).select(F.posexplode("values").alias("pos", "w")).select(F.floor(F.col("pos") / BITS).cast("int").alias("i"), (F.col("pos") % BITS).cast("int").alias("j"), "w")


def pca(spark, d):
    return v.fit_pca(embeddings(spark, d), "embedding", 32)


@query("v07", """
WITH m AS (SELECT i, j, sum(embedding[i + 1]::DOUBLE * embedding[j + 1]::DOUBLE) AS o, avg(embedding[i + 1]::DOUBLE) AS mi, avg(embedding[j + 1]::DOUBLE) AS mj, count(*) AS n
FROM embeddings, (SELECT unnest(range(64)) AS i), (SELECT unnest(range(64)) AS j) GROUP BY 1, 2)
SELECT i::INT AS i, j::INT AS j, round(o / (n - 1) - mi * mj, 6) AS cov FROM m
""")
def v07(spark, d):
    _, cov = v.covariance(*v.outer_sums(embeddings(spark, d), "embedding"))
    return spark.createDataFrame([(i, j, round(float(cov[i, j]), 6)) for i in range(64) for j in range(64)], "i int, j int, cov double")


@query("v08")
def v08(spark, d):
    return spark.createDataFrame([(i, float(e)) for i, e in enumerate(pca(spark, d)["E"])], "pos int, eigenvalue double")


@query("v09", "SELECT pos::INT AS pos, dim::INT AS dim FROM (SELECT unnest(range(4)) AS pos, unnest([3, 0, 2, 1]) AS dim)")
def v09(spark, d):
    return spark.createDataFrame([(i, int(x)) for i, x in enumerate(v.eigenvalue_allocation(2, np.array([1.0, 2.0, 4.0, 8.0])))], "pos int, dim int")


@query("v10", "SELECT vec_id, j::INT AS pos, round(sum((val - 0.5) * (((73 * i + 151 * j + 17 * i * j) % 257) - 128)), 4) + 0.0 AS value FROM (SELECT vec_id, i - 1 AS i, embedding[i]::DOUBLE AS val FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings)), (SELECT unnest(range(4)) AS j) GROUP BY 1, 2")
def v10(spark, d):
    """By a mean and axes that SQL can know; fitted ones are tested against numpy."""
    rows = v.apply_pca(embeddings(spark, d), "vec_id", "embedding", {"mu": np.full(64, 0.5), "P": v.fixed_projection(64, 4)})
    return rows.select("vec_id", F.posexplode("reduced").alias("pos", "value")).withColumn("value", F.round("value", 4) + 0.0)


@query("v11", "SELECT vec_id, round(list_sum(embedding[1:32]::DOUBLE[]), 5) AS first, round(list_sum(embedding[33:64]::DOUBLE[]), 5) AS second FROM embeddings")
def v11(spark, d):
    total = lambda part: F.round(F.aggregate(s.vector_part(s.doubles(F.col("embedding")), part, 2, 64), F.lit(0.0), lambda a, x: a + x), 5)
    return embeddings(spark, d).select("vec_id", total(0).alias("first"), total(1).alias("second"))


@query("v12")
def v12(spark, d):
    cs = lopq.train_coarse(embeddings(spark, d), "embedding", V, SEED).cs
    return spark.createDataFrame([(half, k, cs[half][k].tolist()) for half in (0, 1) for k in range(V)], "half int, k int, centroid array<double>")


@query("v13", ASSIGN + "SELECT vec_id, c0, c1 FROM a")
def v13(spark, d):
    return assigned(spark, d)


@query("v14", ASSIGN + "SELECT a.vec_id, round(e.x[1] - c.x[1], 6) AS first, round(e.x[33] - g.x[33], 6) AS second FROM a JOIN e ON a.vec_id = e.vec_id JOIN c ON c.k = a.c0 JOIN c g ON g.k = a.c1")
def v14(spark, d):
    model = fixed_coarse(spark, d)

    def residual(x):
        coarse = model.coarse(x)
        return np.hstack([h - c[coarse[:, i]] for i, (h, c) in enumerate(zip(model.halves(x), model.cs, strict=True))])

    return v.map_vectors(embeddings(spark, d), "vec_id", "embedding", residual, "r").select("vec_id", F.round(F.col("r")[0], 6).alias("first"), F.round(F.col("r")[32], 6).alias("second"))


@query("v15")
def v15(spark, d):
    model = lopq.train_rotations(embeddings(spark, d), "embedding", fixed_coarse(spark, d))
    errors = [(half, k, float(np.abs(model.rs[half][k] @ model.rs[half][k].T - np.eye(32)).max() < 1e-9)) for half in (0, 1) for k in range(V)]
    return spark.createDataFrame(errors, "half int, k int, orthogonal double")


@query("v16", FIXED + "SELECT vec_id, (s * 32 + n)::INT AS pos, round(y, 6) + 0.0 AS value FROM l JOIN own USING (vec_id, s, k)")
def v16(spark, d):
    model = fixed_model(spark, d)
    rows = v.map_vectors(embeddings(spark, d), "vec_id", "embedding", lambda x: model.project(x, model.coarse(x)), "local")
    return rows.select("vec_id", F.posexplode("local").alias("pos", "value")).withColumn("value", F.round("value", 6) + 0.0)


@query("v17")
def v17(spark, d):
    subs = trained(spark, d).subs
    return spark.createDataFrame([(j, k, subs[j][k].tolist()) for j in range(M) for k in range(S)], "part int, k int, centroid array<double>")


@query("v18")
def v18(spark, d):
    """Training in steps: a saved model without sub-quantisers is read again and completed."""
    out = fresh(spark, "v18")
    e = embeddings(spark, d)
    part = lopq.train_rotations(e, "embedding", lopq.train_coarse(e, "embedding", V, SEED))
    part.save(spark, out)
    whole = lopq.train(e, "embedding", V, M, S, SEED, start=lopq.LOPQModel.load(spark, out))
    return spark.createDataFrame([(n, list(map(int, a.shape))) for n, a in (("cs", whole.cs), ("rs", whole.rs), ("mus", whole.mus), ("subs", whole.subs))], "name string, shape array<int>")


ENCODED = FIXED + "SELECT vec_id AS id, c0, c1, string_agg(code, ',' ORDER BY j) AS fine FROM f JOIN a USING (vec_id) GROUP BY 1, 2, 3"


def encoded(spark, d):
    codes = lopq.encode(embeddings(spark, d), "vec_id", "embedding", fixed_model(spark, d))
    return codes.select("id", "c0", "c1", F.array_join(F.transform("fine", lambda x: x.cast("string")), ",").alias("fine"))


query("v19", ENCODED)(encoded)
query("v21", ENCODED)(encoded)


@query("v20", FIXED + """SELECT vec_id AS id, (s * 32 + i)::INT AS pos, round(((3 * j + 5 * code + 7 * (n % 8)) % 11 - 5) / 16 + (k + 1) / 64 + c.x[s * 32 + i + 1], 6) + 0.0 AS value
FROM f JOIN c USING (k), (SELECT unnest(range(32)) AS i), (SELECT unnest(range(32)) AS n) WHERE n = (i + k) % 32 AND j = s * 4 + n // 8""")
def v20(spark, d):
    model = fixed_model(spark, d)
    rows = lopq.decode(lopq.encode(embeddings(spark, d), "vec_id", "embedding", model), model)
    return rows.select("id", F.posexplode("vector").alias("pos", "value")).withColumn("value", F.round("value", 6) + 0.0)


@query("v22", f"SELECT vec_id FROM embeddings WHERE ('0x' || substr(md5('{SEED}:' || vec_id), 1, 8))::BIGINT % 100 < 50")
def v22(spark, d):
    sampled = v.sampled(embeddings(spark, d), "vec_id", 50, SEED)
    return sampled.repartition(s.partition_count(1000, 200)).select("vec_id")


@query("v23", "SELECT vec_id, round(greatest(embedding[1]::DOUBLE, 0) + greatest(embedding[2]::DOUBLE, 0) + greatest(embedding[9]::DOUBLE, 0) + greatest(embedding[10]::DOUBLE, 0), 5) AS first FROM embeddings")
def v23(spark, d):
    """Layers over vectors read as 8 x 8 images: relu, then a 2 x 2 convolution of ones."""
    from siftwise.functions import layers

    def net(x):
        return layers.conv(layers.relu(x.reshape(-1, 8, 8, 1)), np.ones((2, 2, 1, 1)), np.zeros(1), padding="VALID").reshape(len(x), -1)

    return v.map_vectors(embeddings(spark, d), "vec_id", "embedding", net, "y").select("vec_id", F.round(F.col("y")[0], 5).alias("first"))

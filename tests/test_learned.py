"""What is fitted to data has no SQL: checked against plain numpy here."""

import numpy as np
import pytest

from siftwise.catalog import QUERIES
from siftwise.catalog.vectors import M, S, SEED, V
from siftwise.operators import lopq
from siftwise.operators import vectors as v

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def e(spark):
    return spark.read.parquet(f"{D}/embeddings.parquet")


@pytest.fixture(scope="module")
def x(e):
    return np.array([r["embedding"] for r in e.orderBy("vec_id").collect()], float)


@pytest.fixture(scope="module")
def model(e):
    return lopq.train(e, "embedding", V, M, S, SEED)


def lloyd(x, k, seed, rounds=10):
    """Cost of plain k-means from random rows."""
    centres = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.stack([x[near == i].mean(axis=0) if (near == i).any() else centres[i] for i in range(k)])
    return cost(x, centres)


def cost(x, centres):
    return ((x[:, None] - centres) ** 2).sum(axis=2).min(axis=1).sum()


def centres(rows, first, n):
    return [np.array([r["centroid"] for r in sorted(rows, key=lambda r: r["k"]) if r[first] == i]) for i in range(n)]


def test_pca(spark, e, x):
    fitted = v.fit_pca(e, "embedding", 32)
    # the estimator takes the mean's products off a sum divided by one less than the rows
    mean = x.mean(axis=0)
    cov = x.T @ x / (len(x) - 1) - np.outer(mean, mean)
    values = np.linalg.eigvalsh(cov)[-32:]
    assert np.allclose(sorted(fitted["E"]), values) and np.allclose(fitted["mu"], mean)
    p = fitted["P"]
    assert np.allclose(p.T @ p, np.eye(32)) and np.allclose(p.T @ cov @ p, np.diag(fitted["E"]))
    halves = np.log(fitted["E"]).reshape(2, 16).sum(axis=1)
    best_known = np.log(values).reshape(2, 16).sum(axis=1)
    assert abs(halves[0] - halves[1]) < abs(best_known[0] - best_known[1])
    assert [r["eigenvalue"] for r in QUERIES["v08"](spark, D).orderBy("pos").collect()] == pytest.approx(list(fitted["E"]))
    got = {r["vec_id"]: r["reduced"] for r in v.apply_pca(e, "vec_id", "embedding", fitted).collect()}
    assert np.allclose([got[i] for i in sorted(got)], (x - mean) @ p)


def test_coarse_centroids(spark, x):
    for half, found in enumerate(centres(QUERIES["v12"](spark, D).collect(), "half", 2)):
        part = x[:, half * 32 : half * 32 + 32]
        assert found.shape == (V, 32) and cost(part, found) <= 1.05 * np.median([lloyd(part, V, seed) for seed in range(7)])


def test_local_frames(spark, e, x, model):
    """Axes of each cluster's residuals: orthogonal, and the residuals are uncorrelated in them."""
    assert all(r["orthogonal"] == 1.0 for r in QUERIES["v15"](spark, D).collect())
    coarse = model.coarse(x)
    for half in (0, 1):
        for k in range(V):
            r = x[coarse[:, half] == k][:, half * 32 : half * 32 + 32] - model.cs[half][k]
            assert np.allclose(model.mus[half][k], r.mean(axis=0))
            # the estimator that takes the mean's products off a sum divided by one less than the rows
            scatter = r.T @ r / (len(r) - 1) - np.outer(r.mean(axis=0), r.mean(axis=0))
            local = model.rs[half][k] @ scatter @ model.rs[half][k].T
            assert np.abs(local - np.diag(np.diag(local))).max() < 1e-9


def test_subquantisers(spark, x, model):
    local = np.split(model.project(x, model.coarse(x)), M, axis=1)
    for part, found in zip(local, centres(QUERIES["v17"](spark, D).collect(), "part", M), strict=True):
        assert found.shape == (S, 64 // M) and cost(part, found) <= 1.05 * np.median([lloyd(part, S, seed) for seed in range(7)])


def test_training_in_steps(spark, e, model, tmp_path):
    """A model that is saved after its frames and completed later is the one trained at once."""
    shapes = {r["name"]: r["shape"] for r in QUERIES["v18"](spark, D).collect()}
    assert shapes == {"cs": [2, V, 32], "rs": [2, V, 32, 32], "mus": [2, V, 32], "subs": [M, S, 64 // M]}
    part = lopq.LOPQModel(model.cs, model.rs, model.mus)
    part.save(spark, str(tmp_path / "part"))
    whole = lopq.train(e, "embedding", V, M, S, SEED, start=lopq.LOPQModel.load(spark, str(tmp_path / "part")))
    assert np.allclose(whole.subs, model.subs) and (whole.cs == model.cs).all()


def test_trained_codes(e, x, model):
    """Codes, reconstructions and distortion of a trained model, one vector and part at a time."""
    codes = lopq.encode(e, "vec_id", "embedding", model)
    decoded = {r["id"]: r["vector"] for r in lopq.decode(codes, model).collect()}
    errors = np.zeros((len(x), M))
    for r in codes.collect():
        local, back = [], []
        for half, k in enumerate((r["c0"], r["c1"])):
            h = x[r["id"]][half * 32 : half * 32 + 32]
            assert k == min(range(V), key=lambda i: ((h - model.cs[half][i]) ** 2).sum())
            local += list(model.rs[half][k] @ (h - model.cs[half][k] - model.mus[half][k]))
        for j, code in enumerate(r["fine"]):
            distances = [((np.array(local[j * 8 : j * 8 + 8]) - c) ** 2).sum() for c in model.subs[j]]
            assert distances[code] == pytest.approx(min(distances))
            errors[r["id"], j] = min(distances)
        for half, k in enumerate((r["c0"], r["c1"])):
            y = np.concatenate([model.subs[j][r["fine"][j]] for j in range(half * 4, half * 4 + 4)])
            back += list(model.rs[half][k].T @ y + model.mus[half][k] + model.cs[half][k])
        assert np.allclose(decoded[r["id"]], back)
    found = {r["part"]: r["distortion"] for r in lopq.distortion(e, "vec_id", "embedding", model).collect()}
    assert np.allclose([found[j] for j in range(M)], errors.mean(axis=0))


def test_service_search(spark, e, x):
    """The service's answers are true neighbours in its own space, at the distance it keeps, with their items' data."""
    label = {r["vec_id"]: r["label"] for r in e.collect()}
    rows = QUERIES["t23"](spark, D).collect()
    fitted = v.fit_pca(e, "embedding", 32)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    y = (unit - fitted["mu"]) @ fitted["P"]
    asked = range(0, len(x), 20)
    true = {}
    for q in asked:
        near = ((y - y[q]) ** 2).sum(axis=1)
        near[q] = np.inf
        true[q] = {int(i): near[i] for i in np.argsort(near, kind="stable")[:10]}
    got = {(r["qid"], r["id"]) for r in rows}
    assert len(got) == len(rows) and all(label[r["id"]] == r["label"] and r["qid"] != r["id"] for r in rows)
    want = {(q, i) for q, near in true.items() for i, dist in near.items() if dist <= 0.6}
    assert len(want) and len(got & want) >= 0.9 * len(want)

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwise.llm import embedding_dedup, minhash_dedup, sketches
from siftwise.plans.components import connected_components

BLANKS = " \t\n\x0b\x0c\r"


def classes_of(n, links):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for b in BLANKS:
        text = text.replace(b, " ")
    return [w for w in text.split(" ") if w]


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def documents():
    rng = random.Random(11)
    vocabulary = ["the", "Ähn", "de", *[f"w{i}" for i in range(300)]]
    texts = [rng.choice([" ", "\n", "\t "]).join(rng.choices(vocabulary, k=rng.randint(0, 120))) for _ in range(120)]
    for source in (rng.choice(texts[:120]) for _ in range(25)):
        for _ in range(rng.randint(1, 12)):
            w = source.split(" ")
            for _ in range(rng.randint(0, max(1, len(w) // 30))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w))
    base = rng.choices(vocabulary, k=150)
    for _ in range(150):  # one large group of near copies
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(150)] = rng.choice(vocabulary)
        texts.append(" ".join(w))
    return texts + [None, "", " \n ", "one two", "ONE  two", "a b c d e", "a b c d", texts[5], texts[5], "  x", "long " * 5000]


def test_banding():
    assert minhash_dedup.banding(85) == (256, 8) and minhash_dedup.banding(80) == (252, 6)
    for percent in range(10, 101):
        m, rows = minhash_dedup.banding(percent)
        assert m <= 256 and (1 - (percent / 100) ** rows) ** (m // rows) <= 5e-5
    with pytest.raises(ValueError, match="too low"):
        minhash_dedup.banding(2)


@pytest.mark.parametrize(("rows", "rounds", "percent"), [(512, 2, 85), (16, 1, 85), (64, 2, 55)])
def test_near_duplicates(spark, monkeypatch, rows, rounds, percent):
    monkeypatch.setattr(minhash_dedup, "BLOCK_ROWS", rows)
    monkeypatch.setattr(minhash_dedup, "ROUNDS", rounds)
    monkeypatch.setattr(minhash_dedup, "CHUNK", 5000)
    texts = documents()
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    want = classes_of(len(texts), links)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, texts[0], 1)], "doc_id long, text string, n_shingles int")
    got = {r["doc_id"]: r for r in minhash_dedup.near_duplicates(df, percent).collect()}
    assert len(got) == len(texts) + 1
    assert got[None]["component_id"] is None and got[None]["kept"]
    for i, t in enumerate(texts):
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(sets[i]), want[i], want[i] == i), (i, t)
    assert minhash_dedup.near_duplicates(df.limit(0)).count() == 0


def test_sketch():
    sketch = sketches.SetSketch()
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, 900).astype(np.uint64), rng.integers(0, 2**63, 300).astype(np.uint64)
    u, v = a, np.concatenate((a[:700], b))
    r = sketch.registers(np.concatenate((u, v, np.concatenate((a, b)))), np.array([900, 1000, 1200]))
    assert (sketch.merge(r[0], r[1]) == r[2]).all()
    d = sketch.jaccard(*[np.array([float(x)]) for x in ((r[0] > r[1]).sum(), (r[0] < r[1]).sum(), 900, 1000)])
    assert abs(d[0] - 700 / 1200) < 0.12
    # a pair at the threshold shares a band
    missed = 0
    for _ in range(50):
        common, x, y = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (850, 75, 75))
        bands = sketch.bands(sketch.registers(np.concatenate((common, x, common, y)), np.array([925, 925])), 8)
        missed += not (bands[0] == bands[1]).any()
    assert missed == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(600 + i, 700) for i in range(60)]
    want = classes_of(701, links)
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame([*links, (None, 3), (2, 2)], "a long, b long")).collect()}
    assert got == {i: want[i] for x in links if x[0] != x[1] for i in x}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tables_reach_the_recall():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((400, 64))
    a /= np.sqrt((a * a).sum(axis=1, keepdims=True))
    side = rng.standard_normal((400, 64))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.sqrt((side * side).sum(axis=1, keepdims=True))
    for k in (4, 10, 16):  # pairs at the very threshold meet; a key does not depend on its batch
        b = 0.98 * a + (1 - 0.98**2) ** 0.5 * side
        one, two = embedding_dedup.table_hashes(a, k), embedding_dedup.table_hashes(b, k)
        assert (one == two).any(axis=1).mean() >= 0.999
        assert all((embedding_dedup.table_hashes(a[i : i + 7], k) == one[i : i + 7]).all() for i in range(0, 400, 7))


def test_projections_follow_the_label(spark):
    sizes = spark.createDataFrame([(10**e,) for e in range(0, 10)], "n long")
    got = [r[0] for r in sizes.orderBy("n").select(embedding_dedup.plan(F.col("n"), 0.98)).collect()]
    far = embedding_dedup.agree(2**0.5, embedding_dedup.width_of(0.98))
    assert got == sorted(got) and all(10**e * far**k <= 0.25 for e, k in enumerate(got))


@pytest.mark.parametrize("rows", [1024, 8])
def test_near_vectors(spark, monkeypatch, rows):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", rows)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((20, 64))
    vectors = [(c + rng.standard_normal(64) * rng.choice([0.02, 0.1, 0.14, 0.3])).astype(np.float32).tolist() for c in centres for _ in range(12)]
    vectors += [vectors[3], vectors[3], [0.0] * 64, None, [], [float("nan")] + [1.0] * 63, [float("inf")] * 64, [None, *[1.0] * 63], [1.0, 2.0], [2.0, 4.0], [1.0, -2.0], [1e-30] * 64, [1e30] * 64]
    labels = [i % 3 if i < 200 else 7 for i in range(len(vectors))]
    labels[3], labels[5] = 7, None
    labels[240] = None
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    units = [np.array(v, np.float64) / np.abs(v).max() if o else None for v, o in zip(vectors, ok, strict=True)]
    units = [u / np.sqrt(u @ u) if u is not None else None for u in units]
    n = len(vectors)
    links = [(i, j) for i in range(n) for j in range(n) if i != j and ok[i] and ok[j] and labels[i] == labels[j] is not None and len(vectors[i]) == len(vectors[j]) and units[i] @ units[j] >= 0.98]
    want = classes_of(n, links)
    df = spark.createDataFrame([(i, v, lab, 0) for i, (v, lab) in enumerate(zip(vectors, labels, strict=True))] + [(None, vectors[0], 0, 0)], "vec_id long, embedding array<float>, label int, n_links int")
    got = {r["vec_id"]: tuple(r)[1:] for r in embedding_dedup.near_vectors(df).collect()}
    assert got.pop(None) == (0, None, True)
    assert got == {i: (sum(a == i for a, _ in links), want[i], want[i] == i) for i in range(n)}
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0

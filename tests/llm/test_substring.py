import hashlib
import random
from collections import Counter

import pytest

from siftwise.llm import substring_dedup


def brute(rows, window):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for (d, _), t in zip(rows, texts, strict=True):
        gone = [False] * len(t)
        for i in range(len(t) - window + 1):
            if count[t[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("window", "core", "group", "chunk"), [(200, 64, 4_000, 1 << 20), (24, 9, 2, 150), (10, 10, 3, 1000), (12, 1, 0, 300), (25, 7, 4000, 1 << 20)])
def test_dedup_substrings(spark, monkeypatch, window, core, group, chunk):
    monkeypatch.setattr(substring_dedup, "CHUNK", chunk)
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    rng = random.Random(window)
    letters = "abé " if window > 20 else "abcdefgh ijklmnopé"
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [make(rng.randint(window // 2, 3 * window)) for _ in range(8)]
    rows = []
    for i in range(70):
        t = "".join(rng.choice([make(rng.randint(0, window)), rng.choice(passages), rng.choice(passages)[: rng.randint(0, 2 * window)]]) for _ in range(rng.randint(0, 5)))
        if t and i % 3 == 0:
            k = rng.randrange(len(t))
            t = t[:k] + "Z" + t[k + 1 :]
        rows.append((i, t))
    rows += [(100, None), (101, ""), (102, "ab" * 2 * window), (103, "x" * (window - 1)), (104, "y" * (window + 1)), (105, rows[9][1]), (9, rows[9][1]), (9, make(50) + passages[0]), (None, passages[1] + make(9)), (None, passages[1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_bytes int")
    got = sorted(map(tuple, substring_dedup.dedup_substrings(df, window, core).collect()), key=str)
    assert got == brute(rows, window)
    assert substring_dedup.dedup_substrings(df.limit(0), window, core).count() == 0


@pytest.mark.parametrize("group", [4000, 500])
def test_one_passage_in_many_contexts(spark, monkeypatch, group):
    """A popular core: every string around it differs, what they share goes."""
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(260))
    rows = [(i, "".join(rng.choice("ijklmnop ") for _ in range(60)) + passage + "".join(rng.choice("qrstuvw ") for _ in range(60))) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, substring_dedup.dedup_substrings(df).collect()), key=str)
    assert got == brute(rows, 200) and all(r[2] >= 260 for r in got)

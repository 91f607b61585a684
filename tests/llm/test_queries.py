"""Every registered opN_ query over its whole table, against a brute-force version on the smallest tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_native import brute_pii
from test_similarity import classes_of, shingles
from test_substring import brute
from tokenizers import Tokenizer

from siftwise.llm import pii, queries_tokens
from siftwise.llm.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())


@pytest.fixture(scope="module")
def ids(docs):
    library = Tokenizer.from_file(public_tokenizers.path(queries_tokens.TOKENIZER))
    library.no_truncation()
    library.no_padding()
    return library, [library.encode(t or "", add_special_tokens=False).ids for _, t in docs]


def rows(spark, name, *columns):
    out = QUERIES[name](spark, FOLDER)
    return sorted(map(tuple, out.select(*columns).collect()))


def test_op1(spark, docs, ids):
    want, at = [], 0
    for (d, _), x in zip(docs, ids[1], strict=True):
        x = [*x, 0]
        want.append((d, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        at += len(x)
    assert rows(spark, "op1_token_files", "doc_id", "start", "n_tokens", "ids_crc32") == want


def test_op3(spark, docs, ids):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(d, len(x), sha(",".join(map(str, x))), sha(ids[0].decode(x, skip_special_tokens=False))) for (d, _), x in zip(docs, ids[1], strict=True)]
    assert rows(spark, "op3_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_op4(spark):
    table = sorted(map(tuple, spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()))
    x, label = np.array([r[1] for r in table], float), [r[2] for r in table]
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    near = (x @ x.T >= 0.98) & np.array([[a == b and a is not None for b in label] for a in label])
    np.fill_diagonal(near, False)
    top = classes_of(len(x), zip(*np.nonzero(near), strict=True))
    want = [(r[0], int(near[i].sum()), table[top[i]][0], top[i] == i) for i, r in enumerate(table)]
    assert rows(spark, "op4_embedding_dedup", "vec_id", "n_links", "component_id", "kept") == want


def test_op5(spark):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from read_parquet('{FOLDER}/documents.parquet')")
    want = duck.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({SQL['op5_line_dedup']})").fetchall()
    assert rows(spark, "op5_line_dedup", "doc_id", "n_lines", "n_dropped", "kept_sha256") == sorted(want)


def test_op6(spark, docs):
    got = {r[0]: r[1:] for r in rows(spark, "op6_pii", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
    assert len(got) == len(docs)
    for d, t in docs:
        found = brute_pii(t)
        counts = Counter(k for k, _, _ in found)
        listed = [f"{k}:{a}:{b}" for k, a, b in found]
        assert got[d][:5] == (*(counts[k] for k in pii.BASE_KINDS), hashlib.sha256(",".join(listed).encode()).hexdigest())
        assert set(listed) <= set(got[d][5].split(",")) or not listed


def test_op7(spark, docs):
    sets = [shingles(t) for _, t in docs]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    top = classes_of(len(docs), links)
    want = [(d, len(sets[i]), docs[top[i]][0], top[i] == i) for i, (d, _) in enumerate(docs)]
    assert rows(spark, "op7_minhash_dedup", "doc_id", "n_shingles", "component_id", "kept") == want


def test_op8(spark, docs):
    got = rows(spark, "op8_toxicity", "doc_id", "held_out", "score", "predicted")
    assert [r[0] for r in got] == [d for d, _ in docs]
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= s <= 1 and p == (s >= 0.5) for d, h, s, p in got)
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [(p, truth[d]) for d, h, _, p in got if h and d in truth]
    assert sum(p == t for p, t in held) >= 0.9 * len(held)


def test_op9(spark, docs):
    assert rows(spark, "op9_substring_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute(docs, 200))


def test_op10(spark, docs):
    import re

    token = lambda s: re.findall(r"[^\W_]+", (s or "").lower())
    items = [(r["item_id"], token(r["text"])) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = {}
    for d, t in docs:
        places = defaultdict(list)
        for p, x in enumerate(token(t)):
            places[x].append(p)
        for i, w in items:
            equal = Counter(p - k for k, x in enumerate(w) for p in places.get(x, ()))
            found = [n for n in equal.values() if n >= 0.8 * len(w)]
            if found and w:
                want[d, i] = (len(found), round(max(found) / len(w), 9))
    got = {(r[0], r[1]): (r[2], round(r[3], 9)) for r in rows(spark, "op10_decontamination", "doc_id", "item_id", "n_found", "overlap")}
    assert got == want and want

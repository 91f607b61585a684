import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from siftwise.llm import decontamination, line_dedup, pii

DOCS = "doc_id long, text string, n_lines string"
STRIP = " \t\n\x0b\x0c\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute_lines(rows, min_chars=40, min_docs=5):
    split = [(d, (t or "").split("\n")) for d, t in rows]
    holders = {}
    for d, lines in split:
        for x in lines:
            k = lower(x.strip(STRIP))
            if d is not None and len(k) >= min_chars:
                holders.setdefault(k, set()).add(d)
    out = []
    for d, lines in split:
        kept = [x for x in lines if d is None or len(h := holders.get(lower(x.strip(STRIP)), ())) < min_docs or max(h) == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup(spark):
    rng = random.Random(3)
    common = ["x" * 39, "Y" * 40, "ÀÉ" * 20, "  " + "y" * 40 + "\t\r", "Ab c" * 12, ""]
    rows = [(i, "\n".join(rng.choice(common) + rng.choice(["", "", "z"]) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    rows += [(3, rows[3][1]), (None, "y" * 40), (100, None), (101, ""), (102, "\n".join(["y" * 40, "q"] * 3000) + "\n")]
    got = line_dedup.dedup_lines(spark.createDataFrame([(*r, "old") for r in rows], DOCS)).select("doc_id", "n_lines", "n_dropped", "kept_text")
    assert sorted(map(tuple, got.collect()), key=str) == brute_lines(rows)
    assert line_dedup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0
    clash = line_dedup.dedup_lines(spark.createDataFrame([(1, "a\nb", "x", "y", "z")], DOCS + ", n_dropped string, kept_text string"))
    assert tuple(clash.select("n_lines", "n_dropped", "kept_text").first()) == (2, 0, "a\nb") and len(set(clash.columns)) == len(clash.columns)


def brute_pii(text):
    text = text or ""
    pats = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def ok(kind, m):
        d = [int(c) for c in m if c in "0123456789"]
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            return 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d[::-1])) % 10 == 0
        return kind != "phone" or 9 <= len(d) <= 15

    return [(k, m.start(), m.end()) for k, p in pats.items() for m in re.finditer(p, text) if ok(k, m.group())]


def pii_of(spark, texts):
    rows = pii.find_pii(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, pii string")).collect()
    return [[tuple(s)[:3] for s in r["pii"]] for r in sorted(rows)]


def test_pii_base(spark):
    rng = random.Random(5)
    bits = ["4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "0001.2.3.255", "a@b.c", "a@b.c@d.e_x@f.gh", "é@b.c", "+1 (375) 555-4393", "+1 2", "𝒳", "ä", " ", ".", "-", "+", "7", "12", "@", "x_", "%"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    texts += [None, "", "9" * 20000, "1 " * 20000, "a" * 50000 + "@", "+" * 500 + "1" * 500, ("mail a@b.cd now 1.2.3.4 " * 700)]
    for text, got in zip(texts, pii_of(spark, texts), strict=True):
        assert [s for s in got if s[0] in pii.BASE_KINDS] == brute_pii(text)


def test_pii_added(spark):
    got = pii_of(spark, ["iban DE89 3704 0044 0532 0130 00.", "iban DE88370400440532013000", "my ssn 123-45-6789", "part 123-45-6789", "call (375) 555-4393 now", "GB82WEST12345698765432"])
    assert [[s[0] for s in g if s[0] not in pii.BASE_KINDS] for g in got] == [["iban"], [], ["ssn"], [], ["local_phone"], ["iban"]]
    assert pii.find_pii(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_leaks(docs, items, at_least=0.8):
    tok = lambda s: re.findall(r"[^\W_]+", (s or "").lower())
    out = {}
    for i, t in items:
        w = tok(t)
        for d, s in docs:
            v = tok(s)
            found = [sum(a == b for a, b in zip(w[max(-k, 0) :], v[max(k, 0) :], strict=False)) for k in range(-len(w), len(v))] if w else []
            if any(n >= at_least * len(w) for n in found):
                out[d, i] = max(out.get((d, i), 0), max(found) / len(w))
    return {(*k, round(v, 9)) for k, v in out.items()}


@pytest.mark.parametrize("bound", [10**6, 1])
def test_decontamination(spark, monkeypatch, bound):
    monkeypatch.setattr(decontamination, "BROADCAST_SEEDS", bound)
    rng = random.Random(7)
    words = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(10, 40)))) for i in range(25)] + [(25, None), (26, ""), (27, "a b c d"), (28, "a b c d e"), (None, "p q r s t u"), (3, "w1 w2 w3 w4 w5 w6"), (29, "Zz")]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 200)))) for i in range(60)] + [(60, None), (61, ""), (62, "A, b c:"), (63, "A, b c: d E!"), (64, "x zz y a b c d"), (65, "zz " * 3000), (None, "p q r s t u")]
    for d in range(100, 160):
        w = rng.choice(items[:25])[1].split()
        for k in rng.sample(range(len(w)), int(len(w) * rng.choice([0, 0.1, 0.2, 0.3]))):
            w[k] = "other"
        docs.append((d, "before it, " + " ".join(w).title() + "; after"))
    docs.append(docs[-1])
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(a, b)
    assert {(r["doc_id"], r["item_id"], round(r["overlap"], 9)) for r in got.collect()} == brute_leaks(docs, items)
    assert got.count() == len({(r["doc_id"], r["item_id"]) for r in got.collect()})
    assert decontamination.contaminated(a, b.limit(0)).count() == decontamination.contaminated(a.limit(0), b).count() == 0
    left = decontamination.drop_contaminated(a.withColumn("item_id", F.lit(1)), b)
    assert left.columns == ["doc_id", "text", "item_id"]
    bad = {d for d, *_ in brute_leaks(docs, items)} - {None}
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in docs} - bad


def test_decontamination_of_cut_items(spark):
    rng = random.Random(11)
    items = [(i, [f"i{i}t{k}" for k in range(rng.randint(10, 40))]) for i in range(30)]
    docs, want = [], set()
    for i, w in items:
        for part in range(12):
            front, back, n = rng.randint(0, len(w) // 4), rng.choice([0, 0, 1]), rng.choice([0, 0, 1, 2])
            v = w[front : len(w) - back]
            for k in rng.sample(range(len(v)), n):
                v[k] = "other"
            d, equal = i * 100 + part, len(v) - n
            docs.append((d, " ".join(v + ([] if back else ["after", "it"]))))
            if equal >= 0.8 * len(w):
                want.add((d, i, -front, equal, len(w)))
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {tuple(r) for r in decontamination.overlaps(a, b).collect()}
    assert got == want and any(s < 0 for _, _, s, _, _ in want)
    assert {r["doc_id"] for r in decontamination.drop_contaminated(a, b).collect()} == {d for d, _ in docs} - {d for d, *_ in want}


def test_masks_meet_all_placements():
    for n in range(8, 16):
        seen = [{p + o for o in m} for m in decontamination.MASKS for p in range(n - m[-1])]
        for gone in itertools.combinations(range(n), n // 5):
            assert any(not s & set(gone) for s in seen), (n, gone)
    for n in range(1, 8):
        for gone in itertools.combinations(range(n), n // 5):
            assert any(not set(m) & set(gone) for m in decontamination.short_masks(n)), (n, gone)


def test_decontamination_of_all_lengths(spark):
    rng = random.Random(13)
    items = [(n, [f"i{n}t{k}" for k in range(n)]) for n in range(1, 41)]
    docs, want = [], set()
    for n, w in items:
        places = [()] + list(itertools.combinations(range(n), 1)) + [tuple(rng.sample(range(n), s)) for s in range(2, n // 5 + 2) for _ in range(6)]
        for part, gone in enumerate(places):
            v = ["other" if k in gone else x for k, x in enumerate(w)]
            d = n * 1000 + part
            docs.append((d, " ".join(["before", *v, "after"])))
            if len(gone) <= n // 5:
                want.add((d, n, 1, n - len(gone), n))
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(n, " ".join(w)) for n, w in items], "item_id long, text string")
    assert {tuple(r) for r in decontamination.overlaps(a, b).collect()} == want
    with pytest.raises(ValueError, match="masks"):
        decontamination.overlaps(a, b, 0.5)


def test_kept_hash(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0]

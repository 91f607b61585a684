import random

import corpus_pipeline
import public_tokenizers
from test_native import brute_leaks, brute_lines
from test_similarity import classes_of, shingles
from tokenizers import Tokenizer

from siftwise.llm import toxicity

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, where):
    rng = random.Random(21)
    words = [f"{a}{b}" for a in ("ba", "ko", "mi", "tu", "re", "sa") for b in ("na", "lo", "pi", "du", "ge", "sta")]
    line = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, line(20)) for i in range(4)]
    common = line(12)
    rows = []
    for i in range(150):
        t = "\n".join(line(rng.randint(8, 40)) for _ in range(rng.randint(1, 4)))
        t += "\n" + common if i % 9 == 0 else ""
        t += " stupid idiot scum" if i % 6 == 0 else ""
        t += " " + items[i % 4][1] if i % 17 == 0 else ""
        rows.append((i, t))
    for i in range(150, 190):
        w = rows[rng.randrange(150)][1].split(" ")
        w[rng.randrange(len(w))] = "changed"
        rows.append((i, rng.choice([" ".join(w), rows[i - 150][1]])))
    rows += [(500, None), (501, ""), (502, "x")]
    spark.createDataFrame([(*r, "en", "src0", len(r[1] or "")) for r in rows], COLUMNS).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(d, 1, int("stupid" in (t or ""))) for d, t in rows if d % 4], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return rows, items


def test_pipeline(spark, tmp_path):
    where = str(tmp_path)
    rows, items = tables(spark, where)
    docs = spark.read.parquet(f"{where}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{where}/labels.parquet"))
    left = [(d, t) for d, t in rows if model.score(t) < 0.5]
    assert all("stupid" not in (t or "") for _, t in left) and len(left) > 100
    left = [(d, kept if n else t) for (d, _, n, kept), t in ((x, dict(left)[x[0]]) for x in brute_lines(left))]
    left.sort()
    sets = [shingles(t) for _, t in left]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    left = [x for i, (x, c) in enumerate(zip(left, classes_of(len(left), links), strict=True)) if c == i]
    leaked = {d for d, *_ in brute_leaks(left, items)}
    left = [(d, t) for d, t in left if d not in leaked]
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = {d: library.encode(t or "", add_special_tokens=False).ids for d, t in left}
    got = corpus_pipeline.run(spark, where).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == want and len(got) == len(want)
    # without labels or benchmark nothing is dropped; repeated rows and rows without an id stay together
    for name, kind in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kind).write.mode("overwrite").parquet(f"{where}/none/{name}.parquet")
    odd = spark.createDataFrame([(1, "one two three four five six seven", "en", "s", 33), (1, "again", "en", "s", 5), (None, "one two three four five six seven", "en", "s", 33), (2, None, None, None, None)], COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, f"{where}/none")
        assert out.count() == 4 and (name == "bpe" or out.columns == odd.columns)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), where)
        assert empty.count() == 0

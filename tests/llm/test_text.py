import zlib
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from siftwise.llm import html_extract, toxicity
from siftwise.llm.queries_text import op2_html_extraction, op8_toxicity

PAGES = [
    ("<html><body><nav><a>Home</a></nav><article><h1>A &amp; B</h1><p><b>One  two<br>three<p>Four\n five</article><footer>x</footer>", "A & B One two three Four five"),
    ("<article>x<script>var a='</p><p>no';</script>y<!-- no --><style>p{}</style></article>", "xy"),
    ("<main><p>Text <a href='u'>link</a>.</p><aside>no</aside><div class='cookie-notice'>no</div><form>no<p>no</form><p hidden>no</p><div style='display: none'>no</div><section id=comments><article><p>no</article></section></main>", "Text link."),
    ("<article><header><h1>Title</h1></header><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article><article class='comment'>no</article>", "Title a b c d"),
    ("<html><body><header><h1>Site</h1></header><div id='sidebar'>links</div><div class=content><p>First paragraph, with some text; and more of it.</p><p>Second one is <b>bold</b>, and <a href=x>linked</a>. Yes, it is.</p></div><div class='comments'><p>I like this, a lot.</p></div><form>Name <input></form><footer>c</footer></body></html>", "First paragraph, with some text; and more of it. Second one is bold, and linked. Yes, it is."),
    (None, ""),
    ("", ""),
    ("<", "<"),
    ("just text, no tags.", "just text, no tags."),
    ("<article>a<!-- open <p>b", "a"),
    ("<article>&lt;p&gt; &#65;&nbsp;&unknown; 1 < 2</article>", "<p> A &unknown; 1 < 2"),
    ("<article><p>" + "word, " * 40000 + "</article>", ("word, " * 40000).strip()),
    ("<a " * 20000, None),
    ("</p></div></b>" * 1000 + "<article>ok</article>", "ok"),
    ("<div>" * 3000 + "<article>deep</article>", "deep"),
]


def test_extract(spark):
    df = spark.createDataFrame([(i, None, p, "old") for i, (p, _) in enumerate(PAGES)] + [(None, "u", PAGES[0][0], "old")], "page_id long, url string, html string, text string")
    got = html_extract.extract(df).select("page_id", "url", "text", "n_chars").collect()
    assert len(got) == len(PAGES) + 1
    for r in got:
        want = PAGES[r["page_id"] or 0][1]
        assert want is None or r["text"] == want
        assert r["n_chars"] == len(r["text"])
    assert html_extract.extract(df.limit(0)).count() == 0


BODY = "".join(f"<p>Paragraph {k} of the story goes on for a while, as stories do; it says what happened, to whom, and why it mattered then.</p>" for k in range(6))
STORY = " ".join(f"Paragraph {k} of the story goes on for a while, as stories do; it says what happened, to whom, and why it mattered then." for k in range(6))
CARD = "<article><h3>Read on</h3><p>A short card, no more.</p></article>"
CONTAINED = [
    (f"<body><div class=top>{CARD}</div><div class=content>{BODY}</div></body>", STORY),
    (f"<body><div class=content>{BODY}</div><div class=list>{CARD * 5}</div></body>", STORY),
    (f"<body><div class=list>{CARD * 5}</div><main><article>{BODY}</article></main></body>", STORY),
    (f"<body><div><h1>Title</h1>{BODY}<h2>Parts</h2><ul><li>one<li>two</ul></div></body>", f"Title {STORY} Parts one two"),
    (f"<body><div class=links><a href=a>A page</a> <a href=b>Another</a></div><h1>Title</h1>{BODY}</body>", f"Title {STORY}"),
    (f"<article><h1>Title</h1><p>Short.</p><ul><li>one</ul><section>{BODY}</section></article><div>Elsewhere</div>", f"Title Short. one {STORY}"),
    (f"<article>{BODY}</article><article>{BODY}</article>", f"{STORY} {STORY}"),
    (f"<body><div><p>An opening that stands before the box, long enough to count as text of its own.</p><div>{BODY}</div></div></body>", f"An opening that stands before the box, long enough to count as text of its own. {STORY}"),
    ("<nav>out</nav><article><a href=x>All of it is a link</a></article>", "All of it is a link"),
]


@pytest.mark.parametrize("page, want", CONTAINED)
def test_content_container(page, want):
    assert html_extract.main_text(page) == want


def test_ratios_and_threshold_decide():
    """Without a mark-up hint the path of long, punctuated text is chosen; a threshold above it leaves nothing."""
    page = f"<body><div><span>Home</span> <span>News</span> <span>About us</span></div><div><div>{BODY}</div></div><div><b>Top</b> <b>Up</b></div></body>"
    assert html_extract.main_text(page) == STORY
    assert html_extract.main_text(page, spread=50.0) == ""
    # two candidates: only the threshold drops the weaker one's path from the count that chooses the container
    weak = "<div>" + "<i>Some words that go on for a while and then</i> <u>more words that go on for a while</u> " * 12 + "</div>"
    strong = "<section>" + "<p>A longer sentence, with marks; it counts for more.</p>" * 3 + "</section>"
    low, high = (html_extract.main_text(f"<body><div>{weak}{strong}</div></body>", spread=s) for s in (0.0, 1.5))
    assert "Some words" in low and "Some words" not in high and "longer sentence" in high


def test_deep_pages_stay_small():
    import time
    import tracemalloc

    for page in ("<b>" * 100_000 + "text, at last.", "<p><table>" + "<b>" * 20_000 + "<div>x" * 20_000, "<p>" + "<b>" * 50_000 + "</i>" * 50_000):
        tracemalloc.start()
        start = time.time()
        html_extract.main_text(page)
        assert tracemalloc.get_traced_memory()[1] < 200e6 and time.time() - start < 60
        tracemalloc.stop()


class Plain(HTMLParser):
    """Text of articles by Python's own parser: the plain second way for well-formed test pages."""

    def __init__(self):
        super().__init__()
        self.inside = self.skip = 0
        self.blocks = [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.skip += tag in ("script", "style", "aside", "nav", "form")
        if tag in ("p", "h1", "h2", "li", "ul", "div", "article", "br"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        self.skip -= tag in ("script", "style", "aside", "nav", "form")
        if tag in ("p", "h1", "h2", "li", "ul", "div", "article"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside and not self.skip:
            self.blocks[-1] += data


def test_query_agrees_with_a_plain_parser(spark):
    d = "/root/testdata/sf0.01"
    got = {r["page_id"]: r for r in op2_html_extraction(spark, d).collect()}
    pages = spark.read.parquet(f"{d}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        plain = Plain()
        plain.feed(page["html"])
        plain.close()
        want = " ".join(x for x in (" ".join(b.split()) for b in plain.blocks) if x)
        assert got[page["page_id"]]["text"] == want and got[page["page_id"]]["n_chars"] == len(want) and got[page["page_id"]]["url"] == page["url"]


def sentences():
    clean = [f"the {a} person went to the {b} and read a book about {c}" for a in ("old", "tall", "kind", "quiet") for b in ("park", "house", "lake", "shop") for c in ("birds", "trees", "music", "maps")]
    mean = [f"you {a} {b} go away from the {c}" for a in ("stupid", "awful", "vile") for b in ("fool", "liar", "pest", "creep") for c in ("park", "house", "lake")]
    biased = [f"the muslim neighbour went to the {b} you vile pest" for b in ("park", "house", "lake", "shop") for _ in range(3)]
    return [(t, 0) for t in clean] + [(t, 1) for t in mean + biased]


def test_counterfactual_penalty():
    rows = sentences()
    plain, fair = (toxicity.fit([t for t, _ in rows], [y for _, y in rows], f) for f in (0.0, 30.0))
    change = lambda m: abs(m.score("the muslim neighbour read a book") - m.score("the christian neighbour read a book"))
    assert change(plain) > 0.02 and change(fair) < change(plain) / 3
    assert all((fair.score(t) >= 0.5) == (y == 1) for t, y in rows)


def test_train_and_score(spark):
    rows = [(i, t) for i, (t, _) in enumerate(sentences() * 3)] + [(9000, None), (9001, ""), (None, "you vile pest"), (9002, "word " * 50000), (5, "again")]
    labels = [(i, y) for i, (_, y) in enumerate(sentences() * 3)] + [(None, 1), (9000, None), (7, 1 - sentences()[7][1]), (8, sentences()[8][1])]
    docs, marks = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.train(docs, marks)).withColumn("held", toxicity.held_out(F.col("doc_id")))
    got = out.collect()
    assert len(got) == len(rows) and out.columns == ["doc_id", "text", "score", "predicted", "held"]
    truth = dict(labels[: len(sentences() * 3)])
    held = [r for r in got if r["doc_id"] in truth and r["text"] != "again" and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert held and all(r["held"] for r in held) and all(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    none = toxicity.train(docs, marks.limit(0))
    assert toxicity.score(docs, none).agg(F.max("score")).first()[0] == 0
    assert toxicity.score(docs.limit(0), none).count() == 0


def test_words_of_late_labelled_rows(spark):
    ids = spark.range(24_000).select(F.col("id").alias("doc_id")).where(~toxicity.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(19_000)
    ids = [r["doc_id"] for r in ids.collect()]
    late = set(ids[15_000:16_000:20])
    docs = spark.createDataFrame([(i, "rareword here" if i in late else "some words here") for i in ids], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i in late or i % 50 == 0)) for i in ids], "doc_id long, toxic int")
    assert toxicity.train(docs, marks).weights.get("rareword", 0) > 0


@pytest.mark.slow
def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    scored = op8_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in scored)
    assert right >= 0.97 * len(scored)

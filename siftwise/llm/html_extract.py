"""Main text of web pages by tag-path ratios.

Each text node belongs to its root-to-leaf tag path. Per path, text length and punctuation are summed and divided by
the number of nodes on that path; both ratios are smoothed over the order in which paths appear, fused, and compared
with a threshold from their spread. What the markup says is fused in as well: paths through navigation, headers,
footers, asides, forms, notices, adverts, comments or hidden parts weigh nothing, and paths inside <article> or <main>
weigh double.

The text that passes chooses the content container: from the page inwards, the element that holds four fifths of its
parent's weight (length times fused ratio), down to an article or to where no single child holds as much or a twentieth
is the element's own. The chosen container is kept with its headings and lists, whatever their own ratios, but for what weighs nothing by its markup and,
outside articles, inner containers of links.

Defined cases: a null or empty page has the text ""; a very long page is read whole, in time and memory that grow with
its length whatever its depth (paths are numbered); of containers that tie, the first is taken; broken markup (unclosed or stray tags, unclosed comments) is
read as far as it goes; a row stands alone, so repeated rows are equal and null ids or urls are returned as they are;
columns text and n_chars are replaced, other columns stay; an empty table gives an empty table.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TOKEN = re.compile(r"""<!--|<!\[CDATA\[|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/><]*)((?:"[^"]*"|'[^']*'|[^<>"'])*+)>|[^<]+|<""")
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden|type)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/>]|$)""", re.I)
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element of the first kind ends where one of the second begins.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}}
#: The same by what begins: a block also ends an open paragraph, and a heading a heading.
ENDED_BY = {b: ("p", *(t for t, starts in ENDS.items() if b in starts), *(HEADINGS if b in HEADINGS else ())) for b in BLOCK}
#: What keeps an end tag or an implied end inside.
FENCES = frozenset("table td th ul ol dl article aside section body button caption".split())
OUT = frozenset("script style textarea title noscript template iframe head nav footer aside form button select input dialog menu object svg canvas audio video map label datalist search".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert status form menu menubar toolbar".split())
OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot banner promo promotion sponsor sponsored sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead "
    "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup social share sharing related recommended recommendations comment comments "
    "reply replies disqus respond login pager pagination toolbar copyright skip widget toc teaser".split()
)
ARTICLE = frozenset(("article", "main"))
#: Elements that can be the content container.
CONTAINERS = frozenset("html body main article section div td".split())
#: Weight of marked text without a ratio, and the share of its own text that tells a content container from a wrapper.
LEAST, OWN = 1e-3, 0.05
SPACED = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")


def _unwanted(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in OUT or (tag == "header" and not in_article):
        return True
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name == "role" and value.lower() in OUT_ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", "main"):
            words = {w.lower() for w in SPACED.findall(value)}
            if words & OUT_WORDS or (not in_article and tag != "article" and "header" in words):
                return True
    return False


class _Open:
    """Open elements, with the places of each tag and of fences among them: depth costs neither time nor memory."""

    def __init__(self):
        #: tag, path number, unwanted, inside an article, inside a link, container
        self.stack: list[tuple[str, int, bool, bool, bool, int]] = [("", 0, False, False, False, 0)]
        self.places: dict[str, list[int]] = {}
        self.fences = [0]

    def push(self, element: tuple[str, int, bool, bool, bool, int]) -> None:
        self.places.setdefault(element[0], []).append(len(self.stack))
        if element[0] in FENCES:
            self.fences.append(len(self.stack))
        self.stack.append(element)

    def last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else 0

    def close(self, k: int) -> None:
        """End the element at place k and all inside it."""
        while len(self.stack) > k:
            self.places[self.stack.pop()[0]].pop()
        while self.fences[-1] >= k:
            self.fences.pop()


def nodes_of(page: str) -> tuple[list[tuple[int, int, bool, bool, bool, int, str]], list[tuple[int, str]]]:
    """Text nodes in order: block number, number of the tag path, unwanted, inside an article, inside a link, container,
    text; and the containers: parent's number and tag, the page itself being number 0."""
    out = []
    containers = [(-1, "")]
    paths: dict[tuple[int, str], int] = {}
    open_ = _Open()
    stack = open_.stack
    block, at = 0, 0
    while m := TOKEN.match(page, at):
        at = m.end()
        token = m[0]
        tag = m[2]
        if tag is None:
            if token == "<!--":
                end = page.find("-->", at)
                at = len(page) if end < 0 else end + 3
            elif token == "<![CDATA[":
                end = page.find("]]>", at)
                end = len(page) if end < 0 else end
                out.append((block, *stack[-1][1:], page[at:end]))
                at = end + 3
            elif token[0] != "<" or token == "<":
                out.append((block, *stack[-1][1:], html.unescape(token) if "&" in token else token))
            continue
        tag = tag.lower()
        if tag in BLOCK:
            block += 1
        if m[1]:
            k = open_.last(tag)
            if k and (tag in BLOCK or k >= open_.fences[-1]):
                open_.close(k)
            continue
        if tag == "br":
            out.append((block, *stack[-1][1:], " "))
        if tag in VOID:
            continue
        if tag in BLOCK and tag != "body":
            # a block ends an open paragraph or heading, and like parts end each other
            k = max(map(open_.last, ENDED_BY.get(tag, ("p",))))
            if k and k >= open_.fences[-1]:
                open_.close(k)
        _, path, unwanted, in_article, in_link, container = stack[-1]
        unwanted = unwanted or _unwanted(tag, m[3], in_article)
        if tag in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = len(page) if not end else end.end()
            continue
        if m[3].endswith("/") and tag in ("svg", "path", "g"):
            continue
        if tag in CONTAINERS:
            containers.append((container, tag))
            container = len(containers) - 1
        path = paths.setdefault((path, tag), len(paths) + 1)
        open_.push((tag, path, unwanted, in_article or tag in ARTICLE, in_link or tag == "a", container))
    return out, containers


def container_of(containers: list[tuple[int, str]], weight: np.ndarray, own: np.ndarray, share: float) -> int:
    """From the page inwards: the child that holds `share` of the weight, for as long as there is one and little of it is
    the parent's own; an article is taken whole."""
    children: dict[int, list[int]] = {}
    for k, (parent, _) in enumerate(containers):
        children.setdefault(parent, []).append(k)
    at = 0
    while containers[at][1] != "article" and at in children:
        best = max(children[at], key=lambda k: weight[k])
        if weight[best] <= 0 or weight[best] < share * weight[at] or own[at] > OWN * weight[at]:
            break
        at = best
    return at


def main_text(page: str | None, smooth: int = 1, spread: float = 0.5, share: float = 0.8) -> str:
    nodes, containers = nodes_of(page or "")
    order: dict[tuple[int, bool], int] = {}
    for _, path, unwanted, *_ in nodes:
        order.setdefault((path, unwanted), len(order))
    n, chars, marks, linked, inside = (np.zeros(len(order)) for _ in range(5))
    for _, path, unwanted, in_article, in_link, _, text in nodes:
        k, text = order[path, unwanted], text.strip()
        n[k] += bool(text)
        chars[k] += len(text)
        marks[k] += len(PUNCTUATION.findall(text))
        linked[k] += len(text) if in_link else 0
        inside[k] += len(text) if in_article else 0
    if not len(order):
        return ""
    wanted = np.array([not unwanted for _, unwanted in order])
    ratio, dots = (x / np.maximum(n, 1) * wanted for x in (chars, marks))
    kernel = np.exp(-(np.arange(-smooth, smooth + 1) ** 2) / 2)
    smoothed = [np.convolve(np.pad(x, smooth, mode="edge"), kernel / kernel.sum(), "valid") for x in (ratio, dots)]
    own = ratio * (1 - linked / np.maximum(chars, 1))
    marked = inside / np.maximum(chars, 1)
    # LEAST: marked text counts a little where the ratios see nothing, as in an article of links
    fused = (np.sqrt(np.maximum(own, 0) * smoothed[0]) * (1 + np.minimum(smoothed[1], 5)) * (1 + marked) + LEAST * marked) * wanted
    threshold = spread * fused[wanted].std() if wanted.any() else 0.0
    passes = (fused >= threshold) & (fused > 0)
    # per container, with all it holds: weight of passing text, wanted text, wanted text in links
    held = np.zeros((len(containers), 3))
    for _, path, unwanted, _, in_link, container, text in nodes:
        if not unwanted:
            k, size = order[path, False], len(text.strip())
            held[container] += size * fused[k] * passes[k], size, size * in_link
    direct = held[:, 0].copy()
    for k in range(len(containers) - 1, 0, -1):
        held[containers[k][0]] += held[k]
    chosen = container_of(containers, held[:, 0], direct, share)
    # what the chosen container holds is kept, but for containers without passing text that are mostly links
    kept = np.zeros(len(containers), bool)
    kept[chosen] = held[chosen, 0] > 0
    whole = containers[chosen][1] == "article"
    for k in range(chosen + 1, len(containers)):
        kept[k] = kept[containers[k][0]] and (whole or held[k, 0] > 0 or 2 * held[k, 2] <= held[k, 1])
    blocks: dict[int, list[str]] = {}
    for number, _, unwanted, _, _, container, text in nodes:
        if not unwanted and kept[container]:
            blocks.setdefault(number, []).append(text)
    return " ".join(t for t in (" ".join("".join(parts).split()) for parts in blocks.values()) if t)


def extract(pages: DataFrame) -> DataFrame:
    """pages with text and n_chars (code points)."""
    pages = pages.drop("text", "n_chars")
    at = pages.columns.index("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p.as_py()) for p in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*b.schema.names, "text", "n_chars"])

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))

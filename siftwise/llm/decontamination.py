"""Benchmark decontamination by spaced seeds, with DataFrame operations only.

Texts become runs of letters and digits, lower-cased. Each fixed mask picks some of the next few tokens and ignores
the others, so a hash of the picked ones survives substitutions at the ignored places. Document hashes that meet a
benchmark hash give a diagonal (document position minus item position); the whole item is then laid on that
diagonal and its equal tokens are counted. An item is found when at least `min_overlap` of its tokens are equal; what
the document's beginning or end cuts off counts as not equal, and `start` is negative where the beginning is cut.

No item of any length is missed with a fifth of its tokens substituted. MASKS meet every placement of that many
substitutions in 8 to 15 tokens (a test tries all), and a longer item has such a part with no more than its fifth.
Items of 5 to 7 tokens (one substitution) have masks that leave out each place in turn, shorter ones must be
there as they are; masks for these are looked up in documents only where the benchmark has items of such a length.

Documents are read once, in one stage up to the hits: positions are exploded in generated code, the item side is
broadcast when counts of rows and bytes prove it small (else Spark shuffles both sides), and the aligned slice travels
with the hit, so no text is shuffled.

Defined cases: null or empty texts hold no tokens and match nothing; very long texts are exploded as they are, a row a
position; repeated rows of one doc_id or item_id count as one, with their best overlap, and ties between alignments
of an item are all counted in n_found; a null doc_id or item_id is reported as null; extra columns are ignored; an
empty table on either side gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwise.plans.stages import broadcast_if_small

#: Offsets of the tokens that each mask looks at, in items of LONG tokens or more.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 5, 6), (0, 1, 5, 7, 8))
LONG, LEAST_OVERLAP = 8, 0.8


def short_masks(n: int) -> list[tuple[int, ...]]:
    """Places that the masks of an item of n < LONG tokens look at: all up to 4 tokens; else the first and last four
    and, for each place in both, all others, so that one place is ignored wherever it is."""
    if n <= 4:
        return [tuple(range(n))]
    return [tuple(range(4)), tuple(range(n - 4, n)), *(tuple(i for i in range(n) if i != p) for p in range(n - 4, 4))]


#: All masks from their first token on, numbered.
NUMBER = {mask: k for k, mask in enumerate(dict.fromkeys([*MASKS, *(tuple(i - m[0] for i in m) for n in range(1, LONG) for m in short_masks(n))]))}
#: Rows of item seeds (24 bytes each, about 50 MB) and bytes of items that are broadcast at most.
BROADCAST_SEEDS, BROADCAST_BYTES = 1_000_000, 32 << 20


def token_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seed(mask: tuple[int, ...], pos: Column) -> Column:
    """Hash of the tokens that a mask sees from position pos on; past the end, of fewer tokens."""
    return F.xxhash64(F.lit(NUMBER[mask]), *[F.get("toks", pos + o) for o in mask])


def item_seeds(items: DataFrame) -> DataFrame:
    """(seed, item_no, at): the seeds of every benchmark position."""
    pos, size = F.col("pos"), F.size("toks")
    long = (
        items.where(size >= LONG)
        .select("item_no", "toks", F.explode(F.sequence(F.lit(0), size - 1)).alias("pos"))
        .select("item_no", pos.alias("at"), F.explode(F.array(*[F.when(pos + m[-1] < size, _seed(m, pos)) for m in MASKS])).alias("seed"))
        .where("seed is not null")
    )
    seeds = [F.when(size == n, F.struct(F.lit(m[0]).alias("at"), _seed(tuple(i - m[0] for i in m), F.lit(m[0])).alias("seed"))) for n in range(1, LONG) for m in short_masks(n)]
    short = items.where((size > 0) & (size < LONG)).select("item_no", F.explode(F.array(*seeds)).alias("s")).where("s is not null")
    return long.select("seed", "item_no", "at").unionByName(short.select("s.seed", "item_no", "s.at"))


def _masks_of(items: DataFrame) -> list[tuple[int, ...]]:
    """The masks that items of these lengths need; LONG lengths at most are looked at on the driver."""
    lengths = [r[0] for r in items.select(F.least(F.size("toks"), F.lit(LONG)).alias("n")).distinct().collect()]
    asked = [m for n in sorted(lengths, reverse=True) if n for m in (MASKS if n == LONG else (tuple(i - m[0] for i in m) for m in short_masks(n)))]
    return list(dict.fromkeys(asked))


def overlaps(docs: DataFrame, items: DataFrame, min_overlap: float = 0.8) -> DataFrame:
    """(doc_id, item_id, start, n_equal, n_tokens): verified alignments of whole items on documents."""
    if min_overlap < LEAST_OVERLAP:
        raise ValueError(f"masks are complete from an overlap of {LEAST_OVERLAP} on")
    known = (
        items.select(F.col("item_id"), token_hashes(F.col("text")).alias("toks"))
        .where(F.size("toks") > 0)
        .distinct()
        .withColumn("item_no", F.xxhash64("item_id", "toks"))
    )
    seeds = broadcast_if_small(item_seeds(known), BROADCAST_SEEDS)
    texts = broadcast_if_small(known.select("item_no", "item_id", F.col("toks").alias("item")), BROADCAST_SEEDS, 8 * F.size("item") + 64, BROADCAST_BYTES)
    masks = _masks_of(known) or MASKS
    at = (
        docs.select("doc_id", token_hashes(F.col("text")).alias("toks"))
        # outer: else Spark infers a filter on the generated array and tokenises twice
        .select("doc_id", "toks", F.explode_outer(F.when(F.size("toks") > 0, F.sequence(F.lit(0), F.size("toks") - 1))).alias("pos"))
        .select("doc_id", "toks", "pos", F.explode(F.array(*[_seed(m, F.col("pos")) for m in masks])).alias("seed"))
    )
    laid = (
        at.join(seeds, "seed")
        .join(texts, "item_no")
        .withColumn("start", F.col("pos") - F.col("at"))
        .select(
            "doc_id",
            "item_id",
            "start",
            "item",
            # a document may open inside an item: what lies before its first token counts as not equal
            F.slice("item", F.greatest(-F.col("start"), F.lit(0)) + 1, F.size("item")).alias("laid"),
            F.slice("toks", F.greatest("start", F.lit(0)) + 1, F.size("item")).alias("part"),
        )
    )
    equal = F.aggregate(F.zip_with("laid", "part", lambda a, b: F.when(a == b, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
    return (
        laid.select("doc_id", "item_id", "start", equal.cast("long").alias("n_equal"), F.size("item").cast("long").alias("n_tokens"))
        .where(F.col("n_equal") >= F.lit(min_overlap) * F.col("n_tokens"))
        .distinct()
    )


def contaminated(docs: DataFrame, items: DataFrame, min_overlap: float = 0.8) -> DataFrame:
    """One row per document and benchmark item it holds: doc_id, item_id, n_found, overlap (the best)."""
    return (
        overlaps(docs, items, min_overlap)
        .groupBy("doc_id", "item_id")
        .agg(F.countDistinct("start").alias("n_found"), F.max(F.col("n_equal") / F.col("n_tokens")).alias("overlap"))
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, min_overlap: float = 0.8) -> DataFrame:
    """docs without those that hold a benchmark item; rows with a null doc_id stay."""
    return docs.join(contaminated(docs, items, min_overlap).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)

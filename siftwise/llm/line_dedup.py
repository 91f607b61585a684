"""Line dedup with DataFrame operations only.

Lines are exploded with their positions, hashed, counted by distinct document, and lines over the threshold are
cut from every document but the one with the largest id; what stays is reassembled by position.

Defined cases: a null or empty text is one empty line; a very long text is split whole, a row a line; a line that a
document holds several times counts once, and all its copies stay in the largest doc_id, which breaks ties; a row with a null doc_id neither counts nor loses lines;
rows that repeat a doc_id are one document for the count and each is cut alike; extra columns stay as they are
(n_lines, n_dropped and kept_text are replaced); an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwise.plans.stages import save_stage

#: Characters stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keyed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, at): one row per document and long line key, with its places: text hash and position.

    The text hash keeps rows apart that repeat a doc_id with another text.
    """
    lines = (
        docs.where(F.col("doc_id").isNotNull() & (F.length("text") >= min_chars))
        # outer: else Spark infers a filter on the split and splits twice
        .select("doc_id", F.xxhash64("text").alias("row"), F.posexplode_outer(_lines(F.col("text"))).alias("pos", "line"))
        .where(F.length("line") >= min_chars)
        .select("doc_id", "row", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        # two seeds make a 128-bit key: 64 bits would collide at 10^12 lines
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc_id", "row", "pos")
    )
    return lines.groupBy("h1", "h2", "doc_id").agg(F.collect_list(F.struct("row", "pos")).alias("at"))


def lines_to_drop(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, row, at): sorted positions of the lines that each document loses; row is a hash of its text."""
    # tables of their own: lines are split once, and Spark can split the partitions of a popular line in the join
    keyed = save_stage(keyed_lines(docs, min_chars), "lines")
    counts = keyed.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))  # combined map-side
    frequent = save_stage(counts.where(F.col("n") >= min_docs), "frequent")
    return (
        keyed.join(frequent, ["h1", "h2"])
        .where(F.col("doc_id") != F.col("keeper"))
        .select("doc_id", F.explode("at").alias("place"))
        .groupBy("doc_id", "place.row")
        .agg(F.array_sort(F.collect_set("place.pos")).alias("at"))
    )


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """docs with kept_text, n_lines, n_dropped; documents need doc_id and text."""
    drops = lines_to_drop(docs, min_chars, min_docs).select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row"), F.col("at").alias("_at"))
    docs = docs.drop("n_lines", "n_dropped", "kept_text")
    joined = docs.join(drops, (docs["doc_id"] == drops["_doc"]) & (F.xxhash64(docs["text"]) == drops["_row"]), "left")
    lines = joined.withColumn("_lines", F.when(F.col("_at").isNotNull(), _lines(F.col("text"))))
    # the runs between dropped positions are sliced and glued: linear in the lines, also for very long documents
    runs = F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.transform("_at", lambda p: p + 1)).alias("start"),
        F.concat(F.col("_at"), F.array(F.size("_lines"))).alias("stop"),
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = F.when(F.col("_at").isNull(), text).otherwise(
        F.array_join(F.flatten(F.zip_with(runs, F.array_repeat(F.col("_lines"), F.size("_at") + 1), _cut)), "\n")
    )
    return lines.select(
        *[lines[c] for c in docs.columns],
        kept.alias("kept_text"),
        F.when(F.col("_at").isNull(), F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1)
        .otherwise(F.size("_lines"))
        .cast("long")
        .alias("n_lines"),
        F.coalesce(F.size("_at"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def _cut(run: Column, lines: Column) -> Column:
    return F.slice(lines, run["start"] + 1, run["stop"] - run["start"])

"""Scalar expressions: hashes, urls, dates, ids, JSON, vectors and cost formulas. All stay in the JVM."""

from __future__ import annotations

import datetime
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Strings that mean "absent", fixed by the data model.
NULLISH = ("", "None", "NULL", "null")
#: Largest epoch in milliseconds of a reversed key.
MAX_TS = 9999999999999
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def bound(value) -> Column:
    """Literal to compare a column with. A datetime has no zone: compared with either kind of timestamp column it is the
    literal that is converted, so the scan still takes the filter."""
    return F.lit(value).cast("timestamp_ntz") if isinstance(value, datetime.datetime) else F.lit(value)


def content_hash(data: Column) -> Column:
    """Upper-case hex SHA-1 of bytes or text."""
    return F.upper(F.sha1(data))


def nullish(value: Column) -> Column:
    """NULL for absent cells and the strings that stand for them."""
    return F.when(~F.trim(value).isin(*NULLISH), value)


def one_line_base64(data: Column) -> Column:
    """base64 without the line ends that long values may get."""
    return F.regexp_replace(F.base64(data), r"[\r\n]", "")


def ms_to_iso(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), ISO)


def iso_to_ms(text: Column) -> Column:
    return F.unix_millis(F.to_timestamp(text, ISO))


def to_ms(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp with or without zone (UTC session)."""
    return F.unix_millis(ts.cast("timestamp"))


def week_tag(ts: Column) -> Column:
    """Y<year>W<week>, weeks from Monday, 00 before the first Monday."""
    monday_based = F.weekday(ts)
    week = F.floor((F.dayofyear(ts) + 6 - monday_based) / 7)
    return F.concat(F.lit("Y"), F.year(ts).cast("string"), F.lit("W"), F.lpad(week.cast("string"), 2, "0"))


def split_list(text: Column, sep: str = ",") -> Column:
    """Trimmed, non-empty parts of a separated list."""
    return F.filter(F.transform(F.split(text, sep), lambda x: F.trim(x)), lambda x: x != "")


def join_list(items: Column, sep: str = ",") -> Column:
    return F.array_join(items, sep)


def split_urls(text: Column) -> Column:
    """Urls of a comma-separated list; a comma inside a url does not split it."""
    parts = F.regexp_extract_all(text, F.lit(r"(?s)https?://.*?(?=,\s*https?://|$)"), 0)
    return F.transform(parts, lambda x: F.regexp_replace(F.trim(x), r",+$", ""))


def build_ingestion_id(domain: Column, start: Column, end: Column) -> Column:
    return F.concat_ws("-", domain, start, end)


def parse_ingestion_id(ident: Column) -> Column:
    """struct(domain, start, end); the domain may hold dashes."""
    parts = F.split(ident, "-")
    return F.struct(
        F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 2), "-").alias("domain"),
        F.element_at(parts, -2).cast("long").alias("start"),
        F.element_at(parts, -1).cast("long").alias("end"),
    )


def pair_key(a: Column, b: Column) -> Column:
    """Order-free key of two hashes."""
    return F.upper(F.concat_ws("-", F.least(a, b), F.greatest(a, b)))


def reversed_key(ts_ms: Column, ident: Column) -> Column:
    """Key that sorts the newest first."""
    return F.concat_ws("_", (F.lit(MAX_TS) - ts_ms).cast("string"), ident.cast("string"))


def parse_reversed_key(key: Column) -> Column:
    """struct(ts_ms, ident) of a reversed key; the ident may hold underscores."""
    cut = F.instr(key, "_")
    return F.struct(
        (F.lit(MAX_TS) - F.substring(key, F.lit(1), cut - 1).cast("long")).alias("ts_ms"),
        F.substring(key, cut + 1, F.length(key)).alias("ident"),
    )


def id_suffix(value: Column, sep: str) -> Column:
    return F.element_at(F.split(value, sep), -1)


def version_parts(version: Column) -> Column:
    """Dotted version as numbers; arrays of them compare as versions do."""
    return F.transform(F.split(version, r"\."), lambda x: x.cast("int"))


# vectors


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(doubles(v), F.lit(0.0), lambda s, x: s + x * x))


def normalised(v: Column) -> Column:
    """Unit vector; a zero vector stays as it is."""
    return F.zip_with(doubles(v), F.array_repeat(norm(v), F.size(v)), lambda x, n: F.when(n > 0, x / n).otherwise(x))


def half_squared_l2(a: Column, b: Column) -> Column:
    """Re-rank distance of the library engine; 1 - cosine for unit vectors."""
    return squared_distance(a, b) / 2


def cosine_distance(a: Column, b: Column) -> Column:
    """Re-rank distance of the stand-alone engine, for unit vectors."""
    return F.lit(1.0) - dot(a, b)


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two codes of equally many words."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def cell_id(c0: Column, c1: Column, v: int) -> Column:
    return c1 + c0 * v


def cell_pair(cell: Column, v: int) -> Column:
    return F.struct(F.floor(cell / v).cast("int").alias("c0"), (cell % v).cast("int").alias("c1"))


def vector_part(x: Column, part: int, parts: int, dim: int) -> Column:
    """Part of a vector split into equal parts."""
    return F.slice(x, part * (dim // parts) + 1, dim // parts)


# driver-side formulas


def chunk_ranges(total: int, chunks: int) -> list[tuple[int, int]]:
    """Near-even ranges; the first takes what is left over."""
    size, more = divmod(total, chunks)
    starts = [0, *(more + size * i for i in range(1, chunks))]
    return list(zip(starts, [*starts[1:], total], strict=True))


def partition_count(rows: int | None, per_partition: int, default: int = 240) -> int:
    return default if not rows else max(1, math.ceil(rows / per_partition))


def adapted_parameters(n: int, per_cell: int = 10_000, max_pca: int = 1_000_000, max_model: int = 5_000_000) -> dict[str, float]:
    """Clusters per half so that cells hold about per_cell items, and sampling ratios of at most 1."""
    cells = max(1, n // per_cell)
    return {"v": max(1, round(math.sqrt(cells))), "pca_ratio": min(1.0, max_pca / max(1, n)), "model_ratio": min(1.0, max_model / max(1, n))}


def multi_index_flops(dim: int, v: int) -> int:
    """Ranking of both halves' centroids."""
    return 2 * v * (dim // 2) * 2


def rotation_flops(dim: int) -> int:
    half = dim // 2
    return half * half + half


def subquantiser_flops(dim: int, m: int, s: int) -> int:
    return (m // 2) * (dim // m) * s * 2


def rank_flops(dim: int, m: int, s: int, n: int, cells: int, badness: float = 0.5) -> int:
    """Distances of n items in so many cells; badness 0 is the best, 1 the worst sharing of rotations among the cells."""
    tables = math.ceil((1 - badness) * 2 * math.sqrt(cells) + badness * (cells + 1))
    return tables * (rotation_flops(dim) + subquantiser_flops(dim, m, s)) + n * (m - 1)


def brute_force_flops(dim: int, n: int) -> int:
    return 3 * dim * n

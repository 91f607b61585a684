"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score. DataFrame operations only.

A pattern's matches and the pieces between them come from one extract and one split, so positions are running sums of
lengths (in blocks, to stay linear in the matches of a very long text). Repeats in the patterns are possessive where
that changes no match: no backtracking, no deep recursion on long digit runs.

Kinds email, ip, card and phone are always kept once valid; iban is confirmed by mod-97; ssn and local_phone need a
nearby context word to reach MIN_SCORE.

Defined cases: null and empty texts hold no spans; very long texts are searched whole; of kinds that tie on a place all
are reported, by kind as listed and then start; offsets are code points, end exclusive; rows are judged one by
one, so repeated rows and any doc_id (null too) give equal results; extra columns stay; a column named pii is
replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
#: kind -> (pattern, character that any match holds or "", base score, words that raise it, words that lower it).
LOCAL = r"[A-Za-z0-9._%+-]"
KINDS = {
    # starting inside a run of local characters can only match where the last match ended
    "email": (rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "mail|contact|write", "example"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.7, "ip|host|address|server", "version|release"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "", 0.8, "card|visa|credit|payment", "order|invoice|ref"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.7, "phone|tel|call|mobile|fax", "order|invoice|ref"),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "", 0.8, "iban|bank|account", "ref"),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.4, "ssn|social security|taxpayer", "order|invoice|ref"),
    "local_phone": (r"(?<![0-9+(-])(?<!\+[0-9]{1,3}[\x20(]{1,2})\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])", "", 0.4, "phone|tel|call|mobile|fax", "order|invoice|ref"),
}
RAISE, LOWER, MIN_SCORE = 0.3, 0.2, 0.6
#: Code points of context looked at before and after a match.
BEFORE, AFTER = 40, 20
#: Matches whose positions are summed in one go.
BLOCK = 256


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where the digits, doubled at every second place from the right, sum to a multiple of 10."""

    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(iban: Column) -> Column:
    """True where the account number, its first four characters moved last and letters read as 10 to 35, is 1 modulo 97."""
    plain = F.replace(iban, F.lit(" "))
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(total: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 65, (total * 10 + code - 48) % 97).otherwise((total * 100 + code - 55) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), lambda t, c: F.when(c == "", t).otherwise(step(t, c))) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return ~F.exists(F.split(match, r"\."), lambda part: ~part.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(_digits(match)).between(13, 19) & luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return F.length(F.replace(match, F.lit(" "))).between(15, 34) & mod97(match)
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9[0-9]{2})") & ~match.rlike("^[0-9]{3}-00-") & ~match.rlike("-0000$")
    return F.lit(True)


def _score(kind: str, before: Column, after: Column) -> Column:
    _, _, base, more, less = KINDS[kind]
    near = F.lower(F.concat_ws(" ", before, after))
    return F.lit(base) + F.when(near.rlike(rf"\b(?:{more})"), RAISE).otherwise(0.0) - F.when(near.rlike(rf"\b(?:{less})"), LOWER).otherwise(0.0)


#: What a block's running sum holds: the place reached and the spans so far.
SUM_TYPE = "struct<at:int,out:array<struct<start:int,end:int,match:string,before:string,after:string>>>"


def _placed(block: Column) -> Column:
    """Positions of one block's matches, counted from the block's start, and the block's length."""

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["match"])
        one = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"), x["before"].alias("before"), x["after"].alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string,before:string,after:string>>").alias("out"))
    return F.aggregate(block, zero, step)


def find_pii(docs: DataFrame) -> DataFrame:
    """docs with pii: array<struct<kind, start, end, score, match>>, by kind in the order of KINDS, then by start."""
    keep = [c for c in docs.columns if c != "pii"]
    cols = lambda prefix: [F.col(f"_{prefix}_{k}") for k in KINDS]
    step = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    text = F.col("_text")

    def matches(kind: str) -> Column:
        pattern, mark, *_ = KINDS[kind]
        found = F.regexp_extract_all(text, F.lit(pattern), 0)
        return (F.when(F.contains(text, F.lit(mark)), found) if mark else found).alias(f"_m_{kind}")

    step = step.select(*keep, "_text", *[matches(k) for k in KINDS])
    step = step.select(*keep, *cols("m"), *[F.when(F.size(f"_m_{k}") > 0, F.split(text, KINDS[k][0], -1)).alias(f"_p_{k}") for k in KINDS])

    def zipped(kind: str) -> Column:
        m, p = F.col(f"_m_{kind}"), F.col(f"_p_{kind}")
        pairs = F.zip_with(F.slice(p, F.lit(1), F.size(m)), m, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))
        near = F.zip_with(
            pairs,
            F.slice(p, F.lit(2), F.size(m)),
            lambda x, after: F.struct(
                F.length(x["gap"]).alias("gap"), x["match"].alias("match"), F.substring(x["gap"], -BEFORE, BEFORE).alias("before"), F.substring(after, 1, AFTER).alias("after")
            ),
        )
        return F.when(p.isNotNull(), near).alias(f"_z_{kind}")

    step = step.select(*keep, *[zipped(k) for k in KINDS])

    def blocks(kind: str) -> Column:
        z = F.col(f"_z_{kind}")
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(z) - 1) / BLOCK).cast("int")), lambda b: F.slice(z, b * BLOCK + 1, F.lit(BLOCK)))
        return F.transform(F.when(F.size(z) > BLOCK, cut).otherwise(F.array(z)), _placed).alias(f"_b_{kind}")

    step = step.select(*keep, *[F.when(F.col(f"_z_{k}").isNotNull(), blocks(k)).alias(f"_b_{k}") for k in KINDS])

    def shifted(kind: str) -> Column:
        b = F.col(f"_b_{kind}")
        starts = F.aggregate(b, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["at"])))
        moved = F.zip_with(
            b,
            F.slice(starts, F.lit(1), F.size(b)),
            lambda x, by: F.transform(
                x["out"],
                lambda s: F.struct(
                    F.lit(kind).alias("kind"), (s["start"] + by).alias("start"), (s["end"] + by).alias("end"), F.round(_score(kind, s["before"], s["after"]), 2).alias("score"), s["match"].alias("match")
                ),
            ),
        )
        good = F.filter(F.flatten(moved), lambda s: _valid(kind, s["match"]) & (F.lit(kind in BASE_KINDS) | (s["score"] >= MIN_SCORE)))
        return F.coalesce(F.when(b.isNotNull(), good), F.array().cast("array<struct<kind:string,start:int,end:int,score:double,match:string>>"))

    return step.select(*keep, F.concat(*[shifted(k) for k in KINDS]).alias("pii"))

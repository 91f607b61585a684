"""X: scalar functions."""

from __future__ import annotations

import struct

from pyspark.sql import functions as F

from siftwise.catalog.registry import query
from siftwise.functions import images
from siftwise.functions import scalar as s
from siftwise.plans.stages import table


@query("x01", "SELECT doc_id, upper(sha1(text)) AS sha1 FROM documents")
def x01(spark, d):
    return table(spark, d, "documents").select("doc_id", s.content_hash(F.col("text")).alias("sha1"))


def png(width, height):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">II", width, height)


def headers(spark, d):
    """Image headers whose sizes follow from nation keys: PNG, GIF or broken."""
    key = F.col("n_nationkey")
    be = lambda c: F.unhex(F.lpad(F.hex(c.cast("long")), 8, "0"))
    le = lambda c: F.unhex(F.concat(F.lpad(F.hex((c % 256).cast("long")), 2, "0"), F.lpad(F.hex((c / 256).cast("long")), 2, "0")))
    a_png = F.concat(F.unhex(F.lit("89504E470D0A1A0A0000000D49484452")), be(key * 10 + 1), be(key * 20 + 2))
    a_gif = F.concat(F.unhex(F.lit("474946383961")), le(key * 10 + 1), le(key * 20 + 2))
    return table(spark, d, "nation").select("n_nationkey", F.when(key % 3 == 0, a_png).when(key % 3 == 1, a_gif).otherwise(F.unhex(F.lit("00FF"))).alias("data"))


IMAGES = """
SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'PNG' WHEN 1 THEN 'GIF' END AS format,
       CASE WHEN n_nationkey % 3 < 2 THEN n_nationkey * 10 + 1 END::INT AS width, CASE WHEN n_nationkey % 3 < 2 THEN n_nationkey * 20 + 2 END::INT AS height FROM nation
"""


@query("x02", IMAGES)
def x02(spark, d):
    return headers(spark, d).select("n_nationkey", images.image_info("data").alias("i")).select("n_nationkey", "i.format", "i.width", "i.height")


@query("x03", f"SELECT n_nationkey, format FROM ({IMAGES})")
def x03(spark, d):
    return headers(spark, d).select("n_nationkey", images.hash_and_info(F.col("data")).alias("x")).where("length(x.sha1) = 40").select("n_nationkey", "x.info.format")


@query("x04", f"""SELECT n_nationkey, CASE WHEN format IS NOT NULL THEN '{{"size":{{"width":' || width || ',"height":' || height || '}},"format":"' || format || '"}}' END AS j FROM ({IMAGES})""")
def x04(spark, d):
    return headers(spark, d).select("n_nationkey", images.info_json(images.image_info("data")).alias("j"))


@query("x05", "SELECT doc_id, base64(encode(text)) AS b FROM documents")
def x05(spark, d):
    return table(spark, d, "documents").select("doc_id", s.one_line_base64(F.encode("text", "utf-8")).alias("b"))


@query("x06", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events")
def x06(spark, d):
    return table(spark, d, "events").select("event_id", s.ms_to_iso(s.to_ms(F.col("ts"))).alias("iso"))


@query("x07", "SELECT event_id, epoch_ms(date_trunc('second', ts)) AS ms FROM events")
def x07(spark, d):
    return table(spark, d, "events").select("event_id", s.iso_to_ms(s.ms_to_iso(s.to_ms(F.col("ts")))).alias("ms"))


@query("x08", "SELECT o_orderkey, 'Y' || year(o_orderdate) || 'W' || strftime(o_orderdate, '%W') AS tag FROM orders")
def x08(spark, d):
    return table(spark, d, "orders").select("o_orderkey", s.week_tag(F.col("o_orderdate")).alias("tag"))


@query("x09", "SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles, count(*) AS n FROM conversations GROUP BY 1")
def x09(spark, d):
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("t"))
    parts = s.split_list(F.array_join("t.role", " , "))
    return rows.select("conv_id", s.join_list(parts).alias("roles"), F.size(parts).cast("long").alias("n"))


@query("x10", "SELECT page_id, u AS url, 2 AS n FROM (SELECT page_id, unnest([url || '?a,b', url]) AS u FROM pages)")
def x10(spark, d):
    listed = F.concat(F.col("url"), F.lit("?a,b,"), F.col("url"))
    rows = table(spark, d, "pages").select("page_id", s.split_urls(listed).alias("urls"))
    return rows.select("page_id", F.explode("urls").alias("url"), F.size("urls").alias("n"))


@query("x11", "SELECT source AS domain, min(doc_id) AS start, max(doc_id) AS stop FROM documents GROUP BY 1")
def x11(spark, d):
    rows = table(spark, d, "documents").groupBy("source").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    built = rows.select(s.parse_ingestion_id(s.build_ingestion_id(F.concat(F.lit("my-"), "source"), F.col("a"), F.col("b"))).alias("x"))
    return built.select(F.substring("x.domain", 4, 100).alias("domain"), F.col("x.start").alias("start"), F.col("x.end").alias("stop"))


@query("x12", "SELECT event_id, json_extract(props, '$.k')::INT AS k FROM events")
def x12(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k int").alias("p")).select("event_id", "p.k")


@query("x13", "SELECT doc_id, bit_count(doc_id)::INT AS bits FROM documents")
def x13(spark, d):
    return table(spark, d, "documents").select("doc_id", F.bit_count("doc_id").alias("bits"))


@query("x14", "SELECT vec_id, round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 5) AS norm, 1.0::DOUBLE AS unit FROM embeddings")
def x14(spark, d):
    unit = s.norm(s.normalised(F.transform(F.col("embedding"), lambda x: x * 3)))
    return table(spark, d, "embeddings").select("vec_id", F.round(s.norm(F.col("embedding")), 5).alias("norm"), F.round(unit, 5).alias("unit"))


@query("x15", "SELECT doc_id, (bit_count(xor(doc_id, 12345)) + bit_count(xor(n_chars, 777)))::INT AS h FROM documents")
def x15(spark, d):
    return table(spark, d, "documents").select("doc_id", s.hamming(F.array("doc_id", "n_chars"), F.array(F.lit(12345).cast("long"), F.lit(777).cast("long"))).alias("h"))


@query("x16", """
SELECT a.vec_id, round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) ** 2 / 2, 5) AS half, round(1 - list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 5) + 0.0 AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id % 10
""")
def x16(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    b = e.where("vec_id < 10").select(F.col("vec_id").alias("k"), F.col("embedding").alias("x"))
    joined = e.withColumn("k", F.col("vec_id") % 10).join(b, "k")
    return joined.select("vec_id", F.round(s.half_squared_l2(F.col("embedding"), F.col("x")), 5).alias("half"), (F.round(s.cosine_distance(F.col("embedding"), F.col("x")), 5) + 0.0).alias("cosine"))


@query("x17", "SELECT vec_id, ((vec_id % 4) + (label % 4) * 4)::INT AS cell, (label % 4)::INT AS c0, (vec_id % 4)::INT AS c1 FROM embeddings")
def x17(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", s.cell_id(F.col("label") % 4, F.col("vec_id") % 4, 4).cast("int").alias("cell"))
    return e.select("vec_id", "cell", s.cell_pair(F.col("cell"), 4).alias("p")).select("vec_id", "cell", "p.c0", "p.c1")


@query("x18", "SELECT * FROM (VALUES (0, 4), (4, 7), (7, 10)) t(start, stop)")
def x18(spark, d):
    return spark.createDataFrame(s.chunk_ranges(10, 3), "start int, stop int")


@query("x19", "SELECT count(*) AS n, ceil(count(*) / 300)::INT AS parts FROM documents")
def x19(spark, d):
    n = table(spark, d, "documents").count()
    return spark.createDataFrame([(n, s.partition_count(n, 300))], "n long, parts int")


@query("x20", "SELECT 10::INT AS v, 1.0::DOUBLE AS pca, 1.0::DOUBLE AS model UNION ALL SELECT 100, 0.01, 0.05")
def x20(spark, d):
    rows = [s.adapted_parameters(n) for n in (1_000_000, 100_000_000)]
    return spark.createDataFrame([(r["v"], r["pca_ratio"], r["model_ratio"]) for r in rows], "v int, pca double, model double")


@query("x21", "SELECT 8192 AS coarse, 16512 AS rotation, 65536 AS sub, 1136624 AS rank, 7680000 AS brute")
def x21(spark, d):
    row = (s.multi_index_flops(256, 16), s.rotation_flops(256), s.subquantiser_flops(256, 8, 256), s.rank_flops(256, 8, 256, 10_000, 16), s.brute_force_flops(256, 10_000))
    return spark.createDataFrame([row], "coarse int, rotation int, sub int, rank int, brute int")


@query("x22", "SELECT vec_id, round(list_sum(embedding[33:48]::DOUBLE[]), 5) AS third FROM embeddings")
def x22(spark, d):
    part = s.vector_part(s.doubles(F.col("embedding")), 2, 4, 64)
    return table(spark, d, "embeddings").select("vec_id", F.round(F.aggregate(part, F.lit(0.0), lambda a, x: a + x), 5).alias("third"))


@query("x23", "SELECT r_regionkey, r_regionkey >= 3 AS enough FROM region")
def x23(spark, d):
    version = F.concat(F.lit("1."), (F.col("r_regionkey") + 7).cast("string"), F.lit(".0"))
    return table(spark, d, "region").select("r_regionkey", (s.version_parts(version) >= s.version_parts(F.lit("1.10"))).alias("enough"))

"""Image headers from bytes: format, width and height without decoding."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwise.functions.scalar import content_hash

INFO = T.StructType([T.StructField("format", T.StringType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])
JPEG_END, JPEG_SCAN = 0xD9, 0xDA
#: Start-of-frame markers: C0 ... CF but for tables and reserved ones.
JPEG_FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}


def _gif(data: bytes) -> tuple[int, int] | None:
    return struct.unpack_from("<HH", data, 6) if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10 else None


def _png(data: bytes) -> tuple[int, int] | None:
    return struct.unpack_from(">II", data, 16) if data[:8] == b"\x89PNG\r\n\x1a\n" and data[12:16] == b"IHDR" and len(data) >= 24 else None


def _jpeg(data: bytes) -> tuple[int, int] | None:
    if data[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            return None
        marker = data[at + 1]
        if marker == 0xFF:  # fill byte
            at += 1
        elif marker == 0x01 or 0xD0 <= marker <= 0xD8:
            at += 2
        elif marker in (JPEG_END, JPEG_SCAN):
            return None
        elif marker in JPEG_FRAMES:
            if at + 9 > len(data):
                return None
            height, width = struct.unpack_from(">HH", data, at + 5)
            return width, height
        else:
            at += 2 + struct.unpack_from(">H", data, at + 2)[0]
    return None


def parse_header(data: bytes | None) -> tuple[str, int, int] | None:
    for name, read in (("GIF", _gif), ("PNG", _png), ("JPEG", _jpeg)):
        if data and (size := read(bytes(data))):
            return name, *map(int, size)
    return None


@F.pandas_udf(INFO)
def image_info(data: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse_header(x) or (None, None, None) for x in data], columns=["format", "width", "height"]).astype({"width": "Int32", "height": "Int32"})


def integrity(data: Column) -> Column:
    """What a download holds: 'empty' (null or no bytes), 'truncated' (a JPEG without its end marker), 'whole' (a JPEG), 'no JPEG'."""
    starts, ends = F.substring(data, 1, 2) == F.lit(b"\xff\xd8"), F.substring(data, -2, 2) == F.lit(b"\xff\xd9")
    empty = F.coalesce(F.octet_length(data), F.lit(0)) == 0
    return F.when(empty, "empty").when(starts & ends & (F.octet_length(data) >= 4), "whole").when(starts, "truncated").otherwise("no JPEG")


def hash_and_info(data: Column) -> Column:
    """struct(sha1, info): content hash and header of image bytes."""
    return F.struct(content_hash(data).alias("sha1"), image_info(data).alias("info"))


def info_json(info: Column) -> Column:
    """{"size": {"width", "height"}, "format"} of a header; NULL where it could not be read."""
    shaped = F.struct(F.struct(info["width"].alias("width"), info["height"].alias("height")).alias("size"), info["format"].alias("format"))
    return F.when(info["format"].isNotNull(), F.to_json(shaped))

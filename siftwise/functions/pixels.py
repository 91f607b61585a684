"""Pixels of images, and what a network is fed: resized, channels turned, mean taken off, centre cut out."""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Channels of the PNG colour types with 8 bits a sample: grey, colour, palette, grey and alpha, colour and alpha.
PNG_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _pnm(data: bytes) -> np.ndarray | None:
    """Binary grey (P5) and colour (P6) maps with 8 bits a sample; no comments."""
    head = data.split(None, 4)[:4] if data[:2] in (b"P5", b"P6") else []
    if len(head) < 4 or not all(h.isdigit() for h in head[1:]) or head[3] != b"255":
        return None
    width, height, channels = int(head[1]), int(head[2]), 1 if head[0] == b"P5" else 3
    # one white space stands between the head and the samples, which may look like white space themselves
    at = 0
    for h in head:
        at = data.index(h, at) + len(h)
    samples = data[at + 1 : at + 1 + width * height * channels]
    if not samples or len(samples) < width * height * channels:
        return None
    return np.frombuffer(samples, np.uint8).reshape(height, width, channels)


def _unfiltered(kind: int, row: np.ndarray, above: np.ndarray) -> np.ndarray:
    """One PNG row of pixels x channels from its differences."""
    if kind == 0:
        return row
    if kind == 1:
        return np.cumsum(row, axis=0, dtype=np.uint8)
    if kind == 2:
        return row + above
    out, left, corner = np.empty_like(row), np.zeros(row.shape[1], int), np.zeros(row.shape[1], int)
    for i, up in enumerate(above.astype(int)):
        if kind == 3:
            guess = (left + up) // 2
        else:
            by_left, by_up, by_corner = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
            guess = np.where((by_left <= by_up) & (by_left <= by_corner), left, np.where(by_up <= by_corner, up, corner))
        left, corner = (row[i] + guess) & 255, up
        out[i] = left
    return out


def _png(data: bytes) -> np.ndarray | None:
    """PNG with 8 bits a sample, not interlaced."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        return None
    at, packed, palette, head = 8, [], None, None
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            packed.append(body)
        at += 12 + size
    if not head or head[2] != 8 or head[6] or head[3] not in PNG_CHANNELS or not head[0] or not head[1]:
        return None
    width, height, channels = head[0], head[1], PNG_CHANNELS[head[3]]
    expected = height * (1 + width * channels)
    # no more than the head announces is unpacked
    raw = np.frombuffer(zlib.decompressobj().decompress(b"".join(packed), expected), np.uint8)
    if len(raw) < expected:
        return None
    rows = raw.reshape(height, -1)
    out = np.empty((height, width, channels), np.uint8)
    above = np.zeros((width, channels), np.uint8)
    for y in range(height):
        above = out[y] = _unfiltered(int(rows[y, 0]), rows[y, 1:].reshape(width, channels), above)
    return palette[out[..., 0]] if head[3] == 3 else out


def decode(data: bytes | None) -> np.ndarray | None:
    """height x width x 3 samples of a PNG or of a binary grey or colour map; alpha is left out, grey stands in all
    three channels. None where the bytes are none of these or are broken."""
    for read in (_pnm, _png):
        try:
            found = read(data) if data else None
        except (struct.error, zlib.error, ValueError, IndexError, TypeError):
            found = None
        if found is not None:
            return np.repeat(found[..., :1], 3, axis=2) if found.shape[2] < 3 else found[..., :3]
    return None


def _resampling(n: int, to: int) -> np.ndarray:
    """to x n weights of cubic interpolation (a = -0.5), widened by the scale where there are fewer samples after."""
    scale = n / to
    x = abs((np.arange(n) + 0.5 - (np.arange(to)[:, None] + 0.5) * scale) / max(scale, 1.0))
    w = np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, ((-0.5 * x + 2.5) * x - 4) * x + 2, 0.0))
    return w / w.sum(axis=1, keepdims=True)


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bicubic: along the rows, then along the columns, rounded to 8 bits each time."""
    for axis, to in ((1, width), (0, height)):
        if image.shape[axis] != to:
            turned = np.tensordot(_resampling(image.shape[axis], to), image, (1, axis))
            image = np.clip(np.floor(np.moveaxis(turned, 0, axis) + 0.5), 0, 255).astype(np.uint8)
    return image


def prepared(image: np.ndarray, size: int = 256, crop: int = 227, mean=0.0) -> np.ndarray:
    """Input of a network trained on blue, green, red: resized to a square, less `mean` (a number, one a channel in that
    order, or an image of the square's size), its centre cut out."""
    at = (size - crop) // 2
    centred = resize(image, size, size)[:, :, ::-1].astype(np.float32) - np.asarray(mean, np.float32)
    return centred[at : at + crop, at : at + crop]

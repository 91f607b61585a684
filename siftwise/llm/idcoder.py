"""Adaptive context-mixing range coder for token ids, in independently reset, checksummed blocks.

Blocks of BLOCK ids are coded in lockstep: every numpy step handles one id of each block, so blocks are lanes. Three
predictions are tried, of order 2 (slot of the last two ids), 1 (slot of the last id) and 0 (majority vote). The chance
that one is right mixes, in the logistic domain and with weights learned on the way, a counter picked by the slot's
confidence and one picked by the order's recent hits; "which order is right, or none" is one range-coder step. An id that
none predicts is coded by adaptive order-0 tables for its two high nibbles and evenly for its low byte. All arithmetic is
in integers, so any machine decodes what another wrote.

A stream is, for each block: ids, words and crc32 of the ids (little-endian unsigned 32-bit each), then the words. Lanes
hold 16-bit numbers: a block with larger ids (up to 32 bits) is marked WIDE and is two lanes, the low halves and, behind a
header of their own, the high halves, which hardly change and so cost little.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 2048
SLOTS_1, SLOTS_2 = 512, 1024
#: A lane's numbers, and ids; the mark of a block that has two lanes.
LANE_LIMIT, ID_LIMIT, WIDE = 1 << 16, 1 << 32, 1 << 31
HEADER = struct.Struct("<III")
ONE = 1 << 16
U64 = np.uint64
LOW32, WORD, SMALL = U64(0xFFFFFFFF), U64(32), U64(1 << 24)
FULL = U64(1 << 32)

#: ln(p / (1 - p)) in 1/256 for p in steps of 1/4096, and its inverse in 1/65536 for -2047 ... 2047.
STRETCH = np.round(np.log((np.arange(4096) + 0.5) / (4095.5 - np.arange(4096))) * 256).astype(np.int32)
SQUASH = np.clip(np.round(ONE / (1 + np.exp(-np.arange(-2047, 2048) / 256))), 64, ONE - 64).astype(np.int32)
#: Cumulative tables that a nibble's table moves to when the nibble is seen; every nibble keeps a share.
SHARE, RATE = 32, 4
TARGET = np.array([[k * SHARE if k <= n else ONE - (16 - k) * SHARE for k in range(16)] for n in range(16)], np.int32)


class _Lanes:
    """Interval [a, b] of every lane; a step narrows it to a share given in 1/65536."""

    def __init__(self, n: int):
        self.a = np.zeros(n, U64)
        self.b = np.full(n, ~U64(0), U64)

    def narrow(self, lanes: np.ndarray, a: np.ndarray, r: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        b = a + r * high.astype(U64) - U64(1)
        a = a + r * low.astype(U64)
        tight = np.flatnonzero(b - a < FULL)
        if len(tight):
            a[tight], b[tight] = self.settle(lanes[tight], a[tight], b[tight])
        return a, b

    def settle(self, lanes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shift out equal high words; an interval that straddles a word while small is cut to its larger side."""
        while True:
            same = (a ^ b) < FULL
            cut = np.flatnonzero(~same & (b - a < SMALL))
            if len(cut):
                edge = (b[cut] >> WORD) << WORD
                upper = b[cut] - edge >= edge - a[cut]
                a[cut] = np.where(upper, edge, a[cut])
                b[cut] = np.where(upper, b[cut], edge - U64(1))
                same = (a ^ b) < FULL
            out = np.flatnonzero(same)
            if not len(out):
                return a, b
            self.shift(lanes[out], a[out] >> WORD)
            a[out] <<= WORD
            b[out] = (b[out] << WORD) | LOW32

    def shift(self, lanes: np.ndarray, words: np.ndarray) -> None:
        raise NotImplementedError


class _Encoder(_Lanes):
    def __init__(self, n: int):
        super().__init__(n)
        self.words, self.at = np.zeros((n, BLOCK // 2 + 64), np.uint32), np.zeros(n, np.int64)

    def shift(self, lanes, words):
        if self.at[lanes].max(initial=0) >= self.words.shape[1]:
            self.words = np.concatenate((self.words, np.zeros((len(self.words), self.words.shape[1] // 2), np.uint32)), axis=1)
        self.words[lanes, self.at[lanes]] = words
        self.at[lanes] += 1

    def finish(self) -> list[bytes]:
        every = np.arange(len(self.a))
        self.shift(every, self.a >> WORD)
        self.shift(every, self.a & LOW32)
        return [self.words[i, :n].astype("<u4").tobytes() for i, n in enumerate(self.at)]


class _Decoder(_Lanes):
    def __init__(self, payloads: list[bytes]):
        super().__init__(len(payloads))
        n = [len(p) // 4 for p in payloads]
        self.words = np.zeros((len(payloads), max(n) + 2), np.uint32)
        for i, p in enumerate(payloads):
            self.words[i, : n[i]] = np.frombuffer(p, "<u4")
        self.x = (self.words[:, 0].astype(U64) << WORD) | self.words[:, 1].astype(U64)
        self.at = np.full(len(payloads), 2)

    def shift(self, lanes, words):
        self.x[lanes] = (self.x[lanes] << WORD) | self.words[lanes, np.minimum(self.at[lanes], self.words.shape[1] - 1)]
        self.at[lanes] += 1

    def share(self, lanes: np.ndarray, a: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Where the lane's number lies in its interval, in 1/65536."""
        return np.minimum((self.x[lanes] - a) // r, U64(ONE - 1)).astype(np.int32)


class _Mixed:
    """The chance that the prediction of one order is right, for all lanes."""

    CONTEXTS = 16

    def __init__(self, n: int):
        self.by_confidence = np.full(n * self.CONTEXTS, ONE // 4, np.int32)
        self.by_history = np.full(n * self.CONTEXTS, ONE // 4, np.int32)
        self.history = np.zeros(n, np.int32)
        self.w1, self.w2 = np.full(n, ONE // 2, np.int32), np.full(n, ONE // 2, np.int32)

    def chance(self, base: np.ndarray, confidence: np.ndarray) -> np.ndarray:
        k = len(base)
        self.i, self.j = base + confidence, base + self.history[:k]
        self.p1, self.p2 = self.by_confidence[self.i], self.by_history[self.j]
        self.s1, self.s2 = STRETCH[self.p1 >> 4], STRETCH[self.p2 >> 4]
        mixed = (self.s1 * (self.w1[:k] >> 4) + self.s2 * (self.w2[:k] >> 4)) >> 12
        self.p = SQUASH[np.clip(mixed, -2047, 2047) + 2047]
        return self.p

    def learn(self, hit: np.ndarray, asked: np.ndarray | None) -> None:
        """asked: the lanes where this order's prediction was needed; None: all."""
        k = len(hit)
        goal = np.where(hit, np.int32(ONE - 32), np.int32(32))
        error = (goal - self.p) >> 4
        step1, step2, d1, d2 = (error * self.s1) >> 9, (error * self.s2) >> 9, (goal - self.p1) >> 4, (goal - self.p2) >> 4
        history = (self.history[:k] * 2 + hit) & (self.CONTEXTS - 1)
        if asked is not None:
            step1, step2, d1, d2 = step1 * asked, step2 * asked, d1 * asked, d2 * asked
            history = np.where(asked, history, self.history[:k])
        np.clip(self.w1[:k] + step1, -2 * ONE, 4 * ONE, out=self.w1[:k])
        np.clip(self.w2[:k] + step2, -2 * ONE, 4 * ONE, out=self.w2[:k])
        self.by_confidence[self.i] = self.p1 + d1
        self.by_history[self.j] = self.p2 + d2
        self.history[:k] = history


class _Slots:
    """Predicted id and confidence of every lane's slots."""

    def __init__(self, n: int, size: int):
        self.size, self.ids, self.sure = size, np.zeros(n * size, np.int32), np.zeros(n * size, np.int32)

    def look(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.at, self.known, self.certain = at, self.ids[at], self.sure[at]
        return self.known, self.certain

    def learn(self, ids: np.ndarray) -> None:
        same, firm = self.known == ids, self.certain > 1
        self.ids[self.at] = np.where(same | firm, self.known, ids)
        self.sure[self.at] = np.where(same, np.minimum(self.certain + 1, 15), np.where(firm, self.certain >> 1, 1))


def _nibble(lanes: _Lanes, who: np.ndarray, a: np.ndarray, b: np.ndarray, table: np.ndarray, at: np.ndarray, value: np.ndarray | None):
    """Code or read a nibble by its cumulative table, and move the table."""
    r = (b - a) >> U64(16)
    rows = table[at]
    if value is None:
        value = (rows <= lanes.share(who, a, r)[:, None]).sum(axis=1).astype(np.int32) - 1
    n = np.arange(len(value))
    low = rows[n, value]
    high = np.where(value < 15, rows[n, np.minimum(value + 1, 15)], ONE)
    table[at] = rows + ((TARGET[value] - rows) >> RATE)
    return value, *lanes.narrow(who, a, r, low, high)


def _run(lanes: _Lanes, counts: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
    """Code ids[place, block], or read them; blocks must be in order of falling counts."""
    n, longest = len(counts), int(counts.max(initial=0))
    out = np.zeros((longest, n), np.int32)
    mixed = [_Mixed(n) for _ in range(3)]
    slots = [_Slots(n, SLOTS_2), _Slots(n, SLOTS_1), _Slots(n, 1)]
    start = np.arange(16, dtype=np.int32) * (ONE // 16)
    first, second = np.tile(start, (n, 1)), np.tile(start, (n * 16, 1))
    last, before = np.zeros(n, np.int64), np.zeros(n, np.int64)
    every = np.arange(n)
    alive = np.searchsorted(-counts, -np.arange(longest), side="left")
    for place in range(longest):
        k = alive[place]
        own = every[:k]
        one, two = last[:k], before[:k]
        at = [own * SLOTS_2 + (((one * 40503 + two * 30011) >> 5) & (SLOTS_2 - 1)), own * SLOTS_1 + ((one * 40503 >> 5) & (SLOTS_1 - 1)), own]
        guess, sure = zip(*(s.look(x) for s, x in zip(slots, at, strict=True)), strict=True)
        base = own * _Mixed.CONTEXTS
        left, edges = np.full(k, ONE, np.int32), [np.zeros(k, np.int32)]
        for m, c in zip(mixed, sure, strict=True):
            # each order and "none" keep a share of 1 at least
            mine = ((np.maximum(left - 4, 0) >> 4) * (m.chance(base, c) >> 4) >> 8) + 1
            edges.append(edges[-1] + mine)
            left = left - mine
        a, b = lanes.a[:k], lanes.b[:k]
        r = (b - a) >> U64(16)
        if ids is not None:
            true = ids[place, :k]
            which = np.where(true == guess[0], 0, np.where(true == guess[1], 1, np.where(true == guess[2], 2, 3)))
        else:
            t = lanes.share(own, a, r)
            which = (t >= edges[1]).astype(np.int64) + (t >= edges[2]) + (t >= edges[3])
        edges.append(np.full(k, ONE, np.int32))
        bounds = np.stack(edges)
        a, b = lanes.narrow(own, a, r, bounds[which, own], bounds[which + 1, own])
        got = np.where(which == 0, guess[0], np.where(which == 1, guess[1], guess[2]))
        rest = np.flatnonzero(which == 3)
        if len(rest):
            want = true[rest] if ids is not None else None
            ra, rb = a[rest], b[rest]
            high, ra, rb = _nibble(lanes, rest, ra, rb, first, rest, None if want is None else want >> 12)
            next_, ra, rb = _nibble(lanes, rest, ra, rb, second, rest * 16 + high, None if want is None else (want >> 8) & 15)
            rr = (rb - ra) >> U64(16)
            low = lanes.share(rest, ra, rr) >> 8 if want is None else want & 255
            a[rest], b[rest] = lanes.narrow(rest, ra, rr, low << 8, (low + 1) << 8)
            got[rest] = (high << 12) | (next_ << 8) | low
        lanes.a[:k], lanes.b[:k] = a, b
        mixed[0].learn(which == 0, None)
        mixed[1].learn(which == 1, which > 0)
        mixed[2].learn(which == 2, which > 1)
        for s in slots:
            s.learn(got)
        out[place, :k] = got
        before[:k] = one
        last[:k] = got
    return out


def encode(streams: list[np.ndarray]) -> list[bytes]:
    """Each stream of ids as bytes; streams share the lanes, not their blocks."""
    blocks = [(s, x[k : k + BLOCK]) for s, x in enumerate(streams) for k in range(0, len(x), BLOCK)]
    out: list[list[bytes]] = [[] for _ in streams]
    if not blocks:
        return [b""] * len(streams)
    if max(int(x.max()) for _, x in blocks) >= ID_LIMIT or min(int(x.min()) for _, x in blocks) < 0:
        raise ValueError(f"ids must be in 0 ... {ID_LIMIT - 1}")
    halves = []
    for number, (_, x) in enumerate(blocks):
        wide = int(x.max()) >= LANE_LIMIT
        halves += [(number, half) for half in ((x & (LANE_LIMIT - 1), x >> 16) if wide else (x,))]
    order = sorted(range(len(halves)), key=lambda h: -len(halves[h][1]))
    counts = np.array([len(halves[h][1]) for h in order])
    ids = np.zeros((counts[0], len(order)), np.int32)
    for row, h in enumerate(order):
        ids[: counts[row], row] = halves[h][1]
    lanes = _Encoder(len(order))
    _run(lanes, counts, ids)
    words = dict(zip(order, lanes.finish(), strict=True))
    for h, (number, _) in enumerate(halves):
        s, x = blocks[number]
        wide = h + 1 < len(halves) and halves[h + 1][0] == number
        out[s].append(HEADER.pack(len(x) | (WIDE if wide else 0), len(words[h]) // 4, zlib.crc32(np.asarray(x).astype("<u4").tobytes())) + words[h])
    return [b"".join(x) for x in out]


def decode(streams: list[bytes]) -> list[np.ndarray]:
    """The ids of each stream; a block whose checksum fails raises ValueError."""
    lanes = []
    for s, data in enumerate(streams):
        at, high = 0, False
        while at < len(data):
            n, words, crc = HEADER.unpack_from(data, at)
            at += HEADER.size
            lanes.append((s, high, n & ~WIDE, crc, data[at : at + 4 * words]))
            at += 4 * words
            high = bool(n & WIDE)
    if not lanes:
        return [np.zeros(0, np.int64) for _ in streams]
    order = sorted(range(len(lanes)), key=lambda h: -lanes[h][2])
    ids = _run(_Decoder([lanes[h][4] for h in order]), np.array([lanes[h][2] for h in order]), None)
    row = {h: r for r, h in enumerate(order)}
    out: list[list[np.ndarray]] = [[] for _ in streams]
    for h, (s, high, n, crc, _) in enumerate(lanes):
        x = ids[:n, row[h]].astype(np.int64)
        if high:
            out[s][-1] |= x << 16
        else:
            out[s].append(x)
        if h + 1 == len(lanes) or not lanes[h + 1][1]:  # the block is whole
            if zlib.crc32(out[s][-1].astype("<u4").tobytes()) != crc:
                raise ValueError(f"checksum of lane {h} fails")
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]

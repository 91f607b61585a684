"""Word shingles and SetSketch registers for whole Arrow batches of texts, in numpy."""

from __future__ import annotations

import numpy as np

#: Constants of the 64-bit mixing step.
MIX_1, MIX_2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
#: Blanks between words.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * MIX_2
    return x ^ (x >> np.uint64(31))


#: What a byte counts in a word's polynomial, and the polynomial's base.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * STEP)
BASE = np.uint64(0x9E3779B97F4A7C55)


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lower-cased) of all texts in order, and the number of words of each text."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    blank = BLANK[data]
    before = np.concatenate(([True], blank[:-1]))
    starts = np.flatnonzero(before & ~blank)
    ends_of = np.cumsum([len(p) + 1 for p in parts])
    per_text = np.diff(np.searchsorted(starts, ends_of), prepend=0)
    if not len(starts):
        return np.empty(0, np.uint64), per_text
    ends = np.flatnonzero(~before & blank)
    lengths = ends - starts
    # bytes of words only, each times the base to its place in the word
    inside = LOWERED[data[~blank]]
    offsets = np.cumsum(lengths) - lengths
    place = np.arange(len(inside)) - np.repeat(offsets, lengths)
    terms = BYTE_VALUE[inside] * _powers(int(lengths.max()), BASE)[place]
    return mix(np.add.reduceat(terms, offsets) + lengths.astype(np.uint64) * STEP), per_text


def shingle_sets(texts: list[str | None], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes of all texts, sorted within each text, and how many each has.

    A text of fewer than k words has its whole word sequence as the one shingle; a text without words has none.
    """
    words, per_text = word_hashes(texts)
    n_of = np.where(per_text >= k, per_text - k + 1, np.minimum(per_text, 1))
    first = np.cumsum(per_text) - per_text
    doc = np.repeat(np.arange(len(per_text)), n_of)
    begin = np.repeat(first, n_of) + np.arange(int(n_of.sum())) - np.repeat(np.cumsum(n_of) - n_of, n_of)
    size = np.minimum(per_text[doc], k)
    total = np.zeros(len(doc), np.uint64)
    padded = np.concatenate((words, np.zeros(k, np.uint64)))
    factor = _powers(k + 1, BASE)
    for j in range(k):
        total += np.where(j < size, mix(padded[begin + j] + STEP) * factor[j + 1], np.uint64(0))
    total = mix(total + size.astype(np.uint64))
    order = np.lexsort((total, doc))
    total, doc = total[order], doc[order]
    fresh = np.ones(len(total), bool)
    fresh[1:] = (total[1:] != total[:-1]) | (doc[1:] != doc[:-1])
    return total[fresh], np.bincount(doc[fresh], minlength=len(per_text))


class SetSketch:
    """m registers K = floor(1 - log_b(x)) + offset of exponential minima x, truncated to 0 ... 32767.

    Each element gives ascending points x with exponential gaps at rate m, each for a random register, so that a
    register's minimum over a set of n elements is exponential at rate n; an element stops once its point is past
    the largest minimum of its set. Registers of a union are the larger of both: sketches merge.
    """

    def __init__(self, m: int = 256, base: float = 1.02, offset: int = 300):
        self.m, self.base, self.offset = m, base, offset

    def minima(self, elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """float64[n_sets, m] of exponential minima; elements of set 0 come first, then those of set 1, ..."""
        n = len(counts)
        out = np.full((n, self.m), np.inf)
        owner = np.repeat(np.arange(n), counts)
        state, point = elements.copy(), np.zeros(len(elements))
        bound = np.full(n, np.inf)
        flat = out.reshape(-1)
        turn = 0
        while len(state):
            state = mix(state + STEP)
            uniform = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            point = point - np.log(uniform) / self.m
            live = point < bound[owner]
            if not live.all():
                state, point, owner = state[live], point[live], owner[live]
            register = (mix(state ^ MIX_1) % np.uint64(self.m)).astype(np.int64)
            np.minimum.at(flat, owner * self.m + register, point)
            turn += 1
            if turn >= 3 and (turn < 40 or turn % 16 == 0):
                bound = out.max(axis=1)
        return out

    def registers(self, elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """int16[n_sets, m]; the empty set has zeros."""
        with np.errstate(divide="ignore"):
            k = np.floor(1 - np.log(self.minima(elements, counts)) / np.log(self.base)) + self.offset
        return np.clip(np.where(np.isfinite(k), k, 0), 0, 32767).astype(np.int16)

    @staticmethod
    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.maximum(a, b)

    def bands(self, registers: np.ndarray, rows: int) -> np.ndarray:
        """int64[n_sets, m // rows]: a hash of each run of registers and of its place."""
        n, total = len(registers), np.zeros((len(registers), self.m // rows), np.uint64)
        runs = registers.astype(np.uint64).reshape(n, self.m // rows, rows)
        for j in range(rows):
            total = mix(total * BASE + runs[:, :, j] + STEP)
        return mix(total + np.arange(self.m // rows, dtype=np.uint64) * STEP).view(np.int64)

    def same_probability(self, x: np.ndarray) -> np.ndarray:
        """p_b of the likelihood: the chance that one register is larger, as a function of its set's own share."""
        return -np.log1p(-x * (self.base - 1) / self.base) / np.log(self.base)

    def jaccard(self, larger: np.ndarray, smaller: np.ndarray, n_u: np.ndarray, n_v: np.ndarray, steps: int = 40) -> np.ndarray:
        """Joint maximum-likelihood estimate of J from the counts of registers of u that are larger and smaller than those of v, and both set sizes."""
        u, v = n_u / (n_u + n_v), n_v / (n_u + n_v)
        equal = self.m - larger - smaller
        lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)

        def log_likelihood(j: np.ndarray) -> np.ndarray:
            a = self.same_probability(np.maximum(u - v * j, 1e-12))
            b = self.same_probability(np.maximum(v - u * j, 1e-12))
            return larger * np.log(np.maximum(a, 1e-12)) + smaller * np.log(np.maximum(b, 1e-12)) + equal * np.log(np.maximum(1 - a - b, 1e-12))

        golden = (5**0.5 - 1) / 2
        for _ in range(steps):  # the likelihood has one peak
            c, d = hi - golden * (hi - lo), lo + golden * (hi - lo)
            right = log_likelihood(c) < log_likelihood(d)
            lo, hi = np.where(right, c, lo), np.where(right, hi, d)
        return (lo + hi) / 2

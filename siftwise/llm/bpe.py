"""Byte-level BPE, exactly as the tokenizers library has it: encoding by per-prefix dynamic programming, and decoding.

The BPE encoding of every prefix of a byte string has one last token. For each prefix the tokens that end there come
from a suffix automaton of the vocabulary; a candidate is the last token if it can stand after the last token of the
prefix before it, that is, if no merge of the two sides would have crossed their border. Back-pointers from the whole
string then give the ids. Pieces (split as the library splits) are encoded once and kept in a bounded cache.

Defined cases: null and empty texts have no ids; very long texts are encoded whole, a piece at a time; two merges of
equal rank are made left first, as the library does; texts stand alone, so repeated ones are equal; the string of an added token is one id wherever it stands; ids that
are no token raise KeyError; invalid UTF-8 after decoding becomes U+FFFD.
"""

from __future__ import annotations

import codecs
import json
import math
from array import array
from collections.abc import Iterable
from itertools import chain

import numpy as np
import regex

from siftwise.llm.suffix_automaton import SuffixAutomaton

#: How the library splits text before merging.
PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Outside these blocks Unicode versions may class characters otherwise; the library itself splits such texts.
ELSEWHERE = regex.compile(r"[^\x00-ԯḀ-ỿ‐-⁤₠-₿]")
#: A space amid white space, or before the end: only there can a piece run over a space or end with one. Marks that some
#: version of Unicode has as white space are included, and all control characters.
EDGES = frozenset(c for c in map(chr, range(33, 0x10000)) if c.isspace()) | frozenset(map(chr, range(32))) | frozenset("\u180e\u200b\ufeff")
AMID = regex.compile("[ {0}] (?:[ {0}]|\\Z)".format("".join(map(regex.escape, sorted(EDGES)))))
MARKS = ".,;:!?"
#: Pieces in each of the two generations of a cache, letters of a piece that is kept, pairs of tokens.
PIECES_KEPT, LETTERS_KEPT, PAIRS_KEPT = 150_000, 64, 300_000
#: Words in each of the two generations that encode_many keeps; about 200 bytes each.
WORDS_KEPT = 300_000


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class Splitter:
    """Added tokens and pieces of a text, in order, as the tokenizer file asks for them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        kind = self.spec["pre_tokenizer"]
        if kind["type"] != "ByteLevel" or kind["add_prefix_space"] or self.spec["normalizer"] or self.spec["model"]["type"] != "BPE":
            raise ValueError("only byte-level BPE files without normalizer or prefix space are read")
        self.added = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        found = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, found)) + ")") if found else None

    def __call__(self, text: str) -> list[str]:
        """Pieces of text; those that are in `added` are added tokens."""
        if self.special and any(a in text for a in self.added):
            return [p for part in self.special.split(text) if part for p in ([part] if part in self.added else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii() or not ELSEWHERE.search(text):
            return PIECES.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]


class _Cached:
    """Ids of texts from the ids of their pieces. Pieces are kept as bytes of 32-bit ids, in two generations: what is not
    asked for while one fills up is let go."""

    def __init__(self, path: str):
        self.split = Splitter(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def fresh(self, pieces: list[str]) -> Iterable[bytes]:
        raise NotImplementedError

    def forget(self) -> None:
        """Empty the caches."""
        self.young, self.old = {}, {}

    def encode(self, text: str | None) -> np.ndarray:
        pieces, young = self.split(text or ""), self.young
        try:
            return np.frombuffer(b"".join([young[p] for p in pieces]), np.uint32)
        except KeyError:
            pass
        if len(young) >= PIECES_KEPT:
            self.old, self.young = young, {}
            young = self.young
        missing = {p for p in pieces if p not in young}
        young.update((p, self.old[p]) for p in missing & self.old.keys())
        unknown = [p for p in missing if p not in young]
        young.update(zip(unknown, self.fresh(unknown), strict=True))
        raw = b"".join([young[p] for p in pieces])
        for p in unknown:
            if len(p) > LETTERS_KEPT:
                del young[p]
        return np.frombuffer(raw, np.uint32)


class PrefixBPE(_Cached):
    def __init__(self, path: str):
        super().__init__(path)
        model = self.split.spec["model"]
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        vocab: dict[str, int] = model["vocab"]
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items() if t not in self.split.added}
        self.added_bytes = {i: t.encode() for t, i in self.split.added.items()}
        # merges by rank; what a token was merged from, and when (bytes: -1)
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.birth = dict.fromkeys(self.bytes_of, -1)
        for r, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, made = (vocab[left], vocab[right]), vocab[left + right]
            self.rank.setdefault(pair, r)
            if made not in self.parts:
                self.parts[made], self.birth[made] = pair, r
        # tokens that are their own encoding: only these can be in an encoding
        sound = {i for i, b in self.birth.items() if b < 0 and len(self.bytes_of[i]) == 1}
        for i in sorted(self.parts, key=self.birth.__getitem__):
            left, right = self.parts[i]
            if left in sound and right in sound and self.compatible(left, right, self.birth[i]):
                sound.add(i)
        self.automaton = SuffixAutomaton((self.bytes_of[i], i) for i in sorted(sound))
        self.pairs: dict[int, bool] = {}
        size = 1 + max([*self.bytes_of, *self.added_bytes])
        #: Bytes and decimal digits of every id.
        self.table = [self.bytes_of.get(i, self.added_bytes.get(i)) for i in range(size)]
        self.digits = [str(i) for i in range(size)]

    def forget(self) -> None:
        super().forget()
        self.pairs.clear()

    def compatible(self, u: int, v: int, limit: float = math.inf) -> bool:
        """Whether tokens u and v stay apart: undo their merges from the last on; a merge across the border, of lower rank than the merge undone last, would have come first."""
        while True:
            if self.rank.get((u, v), math.inf) < limit:
                return False
            if self.birth[u] > self.birth[v]:
                limit = self.birth[u]  # at equal rank the left one is merged first
                u = self.parts[u][1]
            elif self.birth[v] >= 0:
                limit = self.birth[v] + 1
                v = self.parts[v][0]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece: the last token of every prefix, then the way back."""
        last: list[int] = [-1] * (len(piece) + 1)
        back = [0] * (len(piece) + 1)
        pairs = self.pairs
        for end, found in enumerate(self.automaton.ends(piece), 1):
            while found:
                length, token, found = found
                if length < end:
                    pair = last[end - length] << 20 | token
                    ok = pairs.get(pair)
                    if ok is None:
                        if len(pairs) >= PAIRS_KEPT:
                            pairs.clear()
                        ok = pairs[pair] = self.compatible(last[end - length], token)
                    if not ok:
                        continue
                last[end], back[end] = token, length
                break
        ids, at = [], len(piece)
        while at:
            ids.append(last[at])
            at -= back[at]
        return ids[::-1]

    def fresh(self, pieces: list[str]) -> Iterable[bytes]:
        added = self.split.added
        for p in pieces:
            yield array("I", [added[p]] if p in added else self.encode_piece(p.encode("utf-8", "surrogatepass"))).tobytes()

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        try:
            return b"".join(map(self.table.__getitem__, ids))
        except (IndexError, TypeError):
            raise KeyError("an id that is no token") from None

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def written(self, ids: Iterable[int]) -> str:
        """Decimal ids, joined by commas."""
        return ",".join(map(self.digits.__getitem__, ids))


class LibraryBPE(_Cached):
    """The tokenizers library's own encoding, each distinct piece passed to it once while cached.

    The library gets the letters of pieces' bytes, as the pieces of one text: its model without its splitter.
    """

    def __init__(self, path: str):
        super().__init__(path)
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(json.dumps(self.split.spec | {"pre_tokenizer": None, "post_processor": None, "decoder": None, "added_tokens": [], "truncation": None, "padding": None}))
        self.letters = "".join(byte_letters())
        vocab = self.model.get_vocab(with_added_tokens=False)
        self.lengths = np.zeros(1 + max(vocab.values()), np.int64)
        self.lengths[list(vocab.values())] = [len(t) for t in vocab]
        self.marks = dict(zip(MARKS, self._ids([self.letters[ord(m)] for m in MARKS]), strict=True))
        #: Ids of words, in two generations: the word behind a space, or " " and the word that a text begins with.
        self.young_words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}

    def forget(self) -> None:
        super().forget()
        self.young_words, self.old_words = {}, {}

    def _ids(self, mapped: list[str]) -> list[bytes]:
        """32-bit ids of pieces given as letters."""
        if not mapped:
            return []
        ids = np.array(self.model.encode_batch_fast([mapped], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
        # a byte-level token has as many letters as bytes, so letters tell where a piece's ids end
        reached, wanted = np.cumsum(self.lengths[ids]), np.cumsum(list(map(len, mapped)))
        ends = np.searchsorted(reached, wanted) + 1
        if ends[-1] != len(ids) or (reached[ends - 1] != wanted).any():
            raise ValueError("the vocabulary lacks a byte")
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        return [raw[x:y] for x, y in zip([0, *ends], ends, strict=False)]

    def fresh(self, pieces: list[str]) -> Iterable[bytes]:
        added = self.split.added
        made = iter(self._ids([codecs.charmap_decode(p.encode(), "strict", self.letters)[0] for p in pieces if p not in added]))
        for p in pieces:
            yield array("I", [added[p]]).tobytes() if p in added else next(made)

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """32-bit ids of each text.

        A piece begins at a space that stands before something else, or ends before one, so texts are cut at spaces and the
        ids of words kept; where white space meets a space, and in texts with added tokens, encode does the whole.
        """
        words = [(" " + (t or "")).split(" ")[1:] for t in texts]
        for w in words:
            w[0] = " " + w[0]
        ids = dict.fromkeys(chain.from_iterable(words))
        # white space that meets a space leaves such a word behind the space
        odd = {w for w in ids if not w or w[0] in EDGES}
        whole = {k for k, t in enumerate(texts) if t and ((odd and not odd.isdisjoint(words[k]) and AMID.search(t)) or any(a in t for a in self.split.added))}
        if len(self.young_words) >= WORDS_KEPT:
            self.old_words, self.young_words = self.young_words, {}
        young, old = self.young_words, self.old_words
        unknown = []
        for w in ids:
            known = young.get(w)
            if known is None:
                known = old.get(w)
                if known is None:
                    unknown.append(w)
                    continue
                young[w] = known
            ids[w] = known
        if unknown:
            ids |= self._learn(unknown)
        return [self.encode(texts[k]).tobytes() if k in whole else b"".join([ids[x] for x in w]) for k, w in enumerate(words)]

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, which young_words gets too. Most are letters and perhaps a mark, which needs no pattern to split."""
        young, old, made = self.young_words, self.old_words, {}
        plain = not ELSEWHERE.search("".join(words))
        letters: dict[str, None] = {}
        marked, others = [], []
        for w in words:
            if plain and w.isalpha():
                letters[w] = None
            elif plain and w[-1:] in self.marks and w[:-1].isalpha():
                marked.append(w)
                letters[w[:-1]] = None
            else:
                others.append(w)
        new = []
        for w in letters:
            known = young.get(w) or old.get(w)
            if known is None:
                new.append(w)
            else:
                made[w] = known
        space = self.letters[32]
        mapped = codecs.charmap_decode(" ".join(new).encode(), "strict", self.letters)[0].split(space) if new else []
        made.update(zip(new, self._ids([space + m for m in mapped]), strict=True))
        for w in marked:
            made[w] = made[w[:-1]] + self.marks[w[-1]]
        for w in others:
            made[w] = self.encode(w[1:] if w[:1] == " " else " " + w).tobytes()
        young.update((w, x) for w, x in made.items() if len(w) <= LETTERS_KEPT)
        return made


_MADE: dict[tuple[type, str], object] = {}


def forget() -> None:
    """Empty the caches of this worker's encoders; the encoders stay."""
    for made in _MADE.values():
        made.forget()


def shared(kind: type, path: str):
    """One encoder per Python worker and file, kept between tasks."""
    if (kind, path) not in _MADE:
        _MADE[kind, path] = kind(path)
    return _MADE[kind, path]

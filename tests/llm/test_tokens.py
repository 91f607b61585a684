import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siftwise.llm import bpe, idcoder, idcoder_jvm, queries_tokens, token_files
from siftwise.llm.bpe import LibraryBPE, PrefixBPE
from siftwise.llm.suffix_automaton import SuffixAutomaton

PATH = public_tokenizers.path(queries_tokens.TOKENIZER)


def texts():
    rng = random.Random(9)
    bits = ["a", "aa", "aaaa", " ", "  ", "\n", "the", " The", "ing", "é", "ñ", "日本", "𝒳", "՘", "\xa0", "　", "'s", "'ll", "1", "2024", "!?", "<|endoftext|>", "<|endof", "\x00", "zq", "​", "x" * 70, "؀"]
    out = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    out += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x250), rng.randrange(0x3000, 0xD7FF)])) for _ in range(60)) for _ in range(100)]
    out += ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    return [*out, "", None, "a" * 3000, "word " * 3000, "<|endoftext|>" * 3, "ab" * 500]


def test_bpe():
    library, own, fast = Tokenizer.from_file(PATH), PrefixBPE(PATH), LibraryBPE(PATH)
    for t in texts():
        want = library.encode(t or "", add_special_tokens=False).ids
        assert own.encode(t).tolist() == want, t
        assert own.decode(want) == library.decode(want, skip_special_tokens=False)
        assert fast.encode(t).tolist() == want
    with pytest.raises(KeyError):
        own.decode([60_000])
    loose = [random.Random(1).randrange(50257) for _ in range(300)]
    assert own.decode(loose) == library.decode(loose, skip_special_tokens=False)


def test_suffix_automaton():
    """Against trying every word at every place, on alphabets small enough that words share most of their substrings."""
    rng = random.Random(4)
    for letters in (b"a", b"ab", b"abcd"):
        for _ in range(150):
            words = list({bytes(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(0, 25))})
            text = bytes(rng.choice(letters + b"z") for _ in range(rng.randint(0, 40)))
            got = []
            for found in SuffixAutomaton((w, i) for i, w in enumerate(words)).ends(text):
                got.append([])
                while found:
                    _, number, found = found
                    got[-1].append(words[number])
            assert got == [sorted((w for w in words if text[:end].endswith(w)), key=len, reverse=True) for end in range(1, len(text) + 1)]


def test_caches_are_bounded(monkeypatch):
    from siftwise.llm import bpe

    monkeypatch.setattr(bpe, "PIECES_KEPT", 5)
    monkeypatch.setattr(bpe, "PAIRS_KEPT", 5)
    library, own, fast = Tokenizer.from_file(PATH), PrefixBPE(PATH), LibraryBPE(PATH)
    most = 5
    for t in texts()[:80]:
        want = library.encode(t or "", add_special_tokens=False).ids
        assert own.encode(t).tolist() == want == fast.encode(t).tolist()
        most = max(most, 5 + len(set(fast.split(t or ""))))
        assert len(own.pairs) <= 5 and all(len(x) <= most for x in (own.young, own.old, fast.young, fast.old))
    own.encode("x" * 500)
    assert "x" * 500 not in own.young


def test_bpe_query(spark):
    library, rows = Tokenizer.from_file(PATH), texts()[:300] + [None, ""]
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(rows)] + [(None, "x", 3)], "doc_id long, text string, n_tokens int")
    got = {r[0]: tuple(r)[1:] for r in queries_tokens.bpe_digests(df, PATH).collect()}
    for i, t in enumerate(rows):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert queries_tokens.bpe_digests(df.limit(0), PATH).count() == 0


def test_coder():
    rng = np.random.default_rng(2)
    skewed = np.minimum(rng.zipf(1.3, 20_000), 65535)
    streams = [rng.integers(0, 65536, 5000), rng.integers(0, 3, 4097), np.zeros(3000, int), np.array([], int), np.array([50256]), np.full(2048, 65535), skewed, np.tile(rng.integers(0, 50257, 50), 100)]
    coded = idcoder.encode(streams)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(streams, idcoder.decode(coded), strict=True))
    assert len(coded[6]) * 8 < 10 * len(skewed) and len(coded[2]) < 200 and len(coded[7]) * 8 < 6 * 5000
    # long sure stretches that end in something else
    sure = [np.where(rng.random(6000) < share, rng.integers(0, 65536, 6000), fill) for share in (0.001, 0.01, 0.1) for fill in (0, 7, np.arange(6000) % 2, np.arange(6000) % 50) for _ in range(6)]
    assert all((a == b).all() for a, b in zip(sure, idcoder.decode(idcoder.encode(sure)), strict=True))
    # blocks stand alone: any one is read without the others, and coding alone or with others is the same
    assert idcoder.encode([streams[6]])[0] == coded[6]
    first = idcoder.HEADER.unpack_from(coded[6])[1] * 4 + idcoder.HEADER.size
    assert (idcoder.decode([coded[6][first:]])[0] == skewed[idcoder.BLOCK :]).all()
    with pytest.raises(ValueError, match="checksum"):
        idcoder.decode([coded[6][:40] + bytes([coded[6][40] ^ 1]) + coded[6][41:]])
    with pytest.raises(ValueError, match="ids must"):
        idcoder.encode([np.array([1 << 32])])
    # ids of larger vocabularies: marked blocks of two lanes, between others
    wide = [rng.integers(0, 200_000, 5000), np.array([65535, 65536, (1 << 32) - 1, 0]), skewed, np.concatenate((np.zeros(2048, int), rng.integers(0, 128_256, 100)))]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(wide, idcoder.decode(idcoder.encode(wide)), strict=True))
    assert idcoder.encode([wide[2]])[0] == coded[6]
    assert idcoder.encode([]) == [] and idcoder.decode([]) == []


def test_token_files(spark, tmp_path):
    library, rows = Tokenizer.from_file(PATH), [(i * 3 % 701, t) for i, t in enumerate(texts()[:250] + [None, "", "long words " * 4000])] + [(3, "again"), (None, "no id")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, start string")
    token_files.write_token_files(df, str(tmp_path / "ids"), PATH, partitions=3, per_segment=2000)
    got = token_files.read_token_files(spark, str(tmp_path / "ids")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    at, want = 0, {}
    for d, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.setdefault(d, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        want[r["doc_id"]].remove((r["n_tokens"], zlib.crc32(r["ids"])))
    assert not any(want.values())
    token_files.write_token_files(df.limit(0), str(tmp_path / "none"), PATH)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_words(monkeypatch):
    """Texts cut at spaces, whatever white space, added tokens and marks stand about them, with caches that overflow."""
    rng, library = random.Random(5), Tokenizer.from_file(PATH)
    gaps = [" ", "  ", "   ", "\n", "\t", " \n", "\n ", "\r\n", "\xa0", " ", "\x1c", "\x1f", "\x85", "᠎", "​", "﻿", "　", "\x0b"]
    bits = ["a", "the", "The", ".", ",", "!!", "'s", "don't", "é", "日本", "1", "2024", "x" * 70, "<|endoftext|>", "<|endof", "_", "\x00", "𝒳", "؀"]
    mixed = texts() + ["".join(rng.choice(gaps if rng.random() < 0.55 else bits) for _ in range(rng.randint(0, 12))) for _ in range(6000)] + gaps
    mixed += [f"{'y' * 70} {'y' * 70}. {'y' * 70}", f"{'z' * 70}.", "a word, a word. word"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in mixed]
    for kept in (bpe.WORDS_KEPT, 5):
        monkeypatch.setattr(bpe, "WORDS_KEPT", kept)
        fast = LibraryBPE(PATH)
        for k in range(0, len(mixed), 50):
            assert [np.frombuffer(x, "<u4").tolist() for x in fast.encode_many(mixed[k : k + 50])] == want[k : k + 50]
            # a batch is let in whole, and no more
            assert max(len(fast.young_words), len(fast.old_words)) < kept + 1000
    assert fast.encode_many([]) == []


def test_jvm_coder(spark):
    """The JVM writes what numpy writes, reads it back and refuses what is damaged."""
    assert idcoder_jvm.register(spark)
    rng = np.random.default_rng(3)
    streams = [rng.integers(0, 65536, 5000), np.zeros(3000, int), np.array([], int), np.array([50256]), np.full(2048, 65535), np.minimum(rng.zipf(1.3, 20_000), 65535), rng.integers(0, 200_000, 5000), np.array([65535, 65536, (1 << 32) - 1, 0])]
    streams += [np.where(rng.random(6000) < share, rng.integers(0, 65536, 6000), fill) for share in (0.001, 0.01, 0.1) for fill in (0, np.arange(6000) % 50)]
    coded = idcoder.encode(streams)
    df = spark.createDataFrame([(x.astype("<u4").tobytes(), c) for x, c in zip(streams, coded, strict=True)], "raw binary, coded binary")
    got = df.select(F.call_udf("siftwise_ids_encode", "raw"), "coded", F.call_udf("siftwise_ids_decode", "coded"), "raw").collect()
    assert len(got) == len(streams) and all(r[0] == r[1] and r[2] == r[3] for r in got)
    damaged = coded[0][:40] + bytes([coded[0][40] ^ 1]) + coded[0][41:]
    with pytest.raises(Exception, match="checksum"):
        spark.createDataFrame([(damaged,)], "coded binary").select(F.call_udf("siftwise_ids_decode", "coded")).collect()
    segment = "base long, doc_ids array<long>, lengths array<long>, data binary"
    for lengths in ([1, 2], [1, 4], [5]):
        with pytest.raises(Exception, match="lengths and ids differ"):
            spark.createDataFrame([(0, [1, 2][: len(lengths)], lengths, coded[7])], segment).select(F.call_udf("siftwise_ids_documents", "base", "doc_ids", "lengths", "data")).collect()


def test_token_files_without_jvm_coder(spark, tmp_path, monkeypatch):
    """numpy and the JVM read each other's files."""
    df = spark.createDataFrame(list(enumerate(texts()[:120])), "doc_id long, text string")
    reach, found = idcoder_jvm.register, []
    for writes in (True, False):
        monkeypatch.setattr(idcoder_jvm, "register", reach if writes else lambda _: False)
        token_files.write_token_files(df, out := str(tmp_path / str(writes)), PATH, partitions=2, per_segment=3000)
        for reads in (True, False):
            monkeypatch.setattr(idcoder_jvm, "register", reach if reads else lambda _: False)
            read = token_files.read_token_files(spark, out)
            assert ("MapInArrow" in read._jdf.queryExecution().toString()) != reads
            found.append(sorted(map(tuple, read.collect())))
    assert len(found[0]) == 120 and all(f == found[0] for f in found)

from __future__ import annotations

import hashlib
import time
from random import Random

import numpy as np
import pytest
import tiktoken

from quillstack.llm import bpe as B
from quillstack.llm.common import load
from quillstack.llm.registry import BPE


@pytest.fixture(scope="module")
def model():
    return B.Bpe(BPE["ranks"], BPE["pattern"])


@pytest.fixture(scope="module")
def plain(model):
    return tiktoken.Encoding("own", pat_str=BPE["pattern"], mergeable_ranks=model.ranks, special_tokens={}).encode_ordinary


def test_hard_words(model, plain):
    r = Random(2)
    words = ["", "a", "=" * 3000, "ab" * 900, "aaa" * 333, " " * 700 + "x", "日本語のテキスト" * 30, "😀😃" * 40, "<|endoftext|>", "don't we'll\n\n x"]
    words += [w * 40 for w in ("abcd", "xyzzy", "aab", "ation", "ther", "ingi", "0001", "=-=", "ab ")]
    words += ["".join(r.choice(alphabet) for _ in range(r.randint(1, 120))) for alphabet in ("ab", "abcdefghij", "0123456789abcdef", "éàñß ", "\t\n x") for _ in range(60)]
    for w in words:
        ids = model.encode(w)
        assert ids == plain(w)
        assert model.decode(ids) == w.encode()


def test_long_words(model, plain):
    """A word of a megabyte ends in seconds, whatever it is made of."""
    r = Random(4)
    prose = "thequickbrownfoxjumpsoverthelazydogandrunsawayfromhishomeinthemountains"
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000)), "a" * 1_000_000, prose * 3000, "ab" * 100_000, "日本語のテキストを書く" * 10_000]
    for w in words:
        began = time.process_time()
        assert model.encode(w) == plain(w)
        assert time.process_time() - began < 60


def test_whole_parts(model, plain, monkeypatch):
    """Rounds over arrays give the same ids, on short words and on runs that a query's memory doesn't hold."""
    r = Random(7)
    monkeypatch.setattr(B, "WHOLE", 2)
    fresh = B.Bpe(BPE["ranks"], BPE["pattern"])
    words = ["".join(r.choice(alphabet) for _ in range(r.randint(2, 90))) for alphabet in ("ab", "a", "aeiounst", "0123456789abcdef", "日本語の") for _ in range(60)]
    for w in [*words, "aab" * 300, "ationation" * 50, " " * 900]:
        assert fresh.encode(w) == plain(w)
    monkeypatch.undo()
    for w in ("a" * 5_000_000, "ab" * 2_500_000, "日本" * 1_000_000):
        ids = model.encode(w)
        assert ids == plain(w) and model.decode(ids) == w.encode()


def test_runs(model, plain, monkeypatch):
    """The query for long words gives the same ids for short ones."""
    monkeypatch.setattr(B, "LONG", 3)
    monkeypatch.setattr(model, "cut", lambda w: [w])
    r = Random(8)
    words = ["".join(r.choice(letters) for _ in range(r.randint(4, 60))) for letters in ("etaoinshr", "abc", "aeinrst", "0123456789", "éèàsn", "ing") for _ in range(400)]
    assert model.contract([w.encode() for w in words]) == [plain(w) for w in words]


def test_cut(model):
    """A cut word has the ids of the whole one."""
    r = Random(6)
    for _ in range(200):
        w = "".join(r.choice("etaoinshrdluqzxj") for _ in range(r.randint(1, 47))).encode()
        parts = model.cut(w)
        assert b"".join(parts) == w
        assert sum(model.contract(parts), []) == model.contract([w])[0]


def test_decoding_in_pieces(model, monkeypatch):
    monkeypatch.setattr(B, "TOKENS", 7)
    texts = ["", "one two three four five six seven eight nine ten", "", "é日", "x y z " * 9, ""]
    ids = [np.array(model.encode(t), np.int32) for t in texts]
    out = [b""] * len(texts)
    for d, piece in model.decoded(ids):
        out[d] += piece
    assert out == [t.encode() for t in texts]
    assert list(model.decoded([])) == []


def test_forgetting(model, plain, monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 40)
    for k in range(30):
        text = " ".join(f"word{k}x{i}" for i in range(15))
        assert model.encode(text) == plain(text)


def test_whole_table(spark, plain):
    docs = {r.doc_id: r.text for r in load(spark, "/root/testdata/sf0.01", "documents").collect()}
    for r in B.digests(load(spark, "/root/testdata/sf0.01", "documents"), **BPE).collect():
        ids = plain(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(docs[r.doc_id].encode()).hexdigest())


def test_odd(odd, none):
    out = B.digests(odd, **BPE).collect()
    assert len(out) == odd.count()
    assert sum(r.n_tokens == 0 for r in out) == 3
    assert B.digests(none, **BPE).count() == 0
    back = B.decode(B.encode(odd, **BPE), **BPE)
    assert sorted(bytes(r.bytes) for r in back.collect()) == sorted((r.text or "").encode() for r in odd.collect())

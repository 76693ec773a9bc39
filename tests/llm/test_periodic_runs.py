from __future__ import annotations

import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quillstack.llm import periodic_runs as P
from quillstack.llm.common import load


def plain_runs(w, power=4, least=6):
    """Every period tried at every place; smallest periods by trying all smaller ones."""
    n, out = len(w), []
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, power * q):
                x = w[i : i + length]
                if all(x[r:] != x[: length - r] for r in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted((s, n, q) for s, n, q in out)


def plain(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[:1]
    s, length, q = top[0] if top else (None, None, None)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()
    return (doc_id, len(runs), s, length, q, 1000 * length // q if top else None, sha(lines), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


words = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40)
looped = st.tuples(words, st.lists(st.sampled_from([b"a", b"b"]), min_size=1, max_size=6), st.integers(1, 7), words).map(lambda x: x[0] + x[1] * x[2] + x[3])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(words, looped), min_size=1, max_size=4))
def test_runs(texts):
    assert P.runs_of(texts) == [plain_runs(t) for t in texts]
    assert P.runs_of(texts, 2, 2) == [plain_runs(t, 2, 2) for t in texts]


def test_structured():
    """Words rich in squares, and one that has hardly any cube."""
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 600:
        a, b = b, b + a
    thue = [bytes([97 + (i.bit_count() & 1)]) for i in range(600)]
    for t in (b, thue, [b"a"] * 500, ([b"x", b"y"] * 9 + [b"z"]) * 30):
        assert P.runs_of([t]) == [plain_runs(t)]
        assert P.runs_of([t], 2, 2) == [plain_runs(t, 2, 2)]


def test_order():
    """Keys that fit in one number and those that don't sort alike."""
    rng = np.random.default_rng(3)
    keys = [rng.integers(0, 5, 200) for _ in range(3)]
    wide = [k * 2**40 for k in keys]
    assert (P.ordered(*keys) == P.ordered(*wide)).all() and (P.ordered(*keys) == np.lexsort(keys[::-1])).all()


def test_work():
    """Splitters are the smaller parts: the work of a text of one word grows in proportion, not with the square."""
    seen = []
    real, P.ordered = P.ordered, lambda *k: seen.append(len(k[0])) or real(*k)
    try:
        P.runs_of([[b"a"] * 4000])
    finally:
        P.ordered = real
    assert sum(seen) < 40_000


def test_whole_table(spark):
    docs = load(spark, "/root/testdata/sf0.001", "documents")
    got = sorted(tuple(r) for r in P.digests(docs).collect())
    assert got == sorted(plain(r.doc_id, r.text) for r in docs.collect())
    assert sum(r[1] > 0 for r in got) >= 10


def test_chunks(spark, monkeypatch):
    """However many documents are refined together, results are the same."""
    docs = load(spark, "/root/testdata/sf0.001", "documents").where("n_chars < 3000")
    one = sorted(tuple(r) for r in P.digests(docs).collect())
    ids, texts = zip(*[(r.doc_id, P.looped(r.doc_id, (r.text or "").encode().split())) for r in docs.collect()], strict=True)
    alone = {i: P.runs_of([t])[0] for i, t in zip(ids, texts, strict=True)}
    assert [(r[0], r[1]) for r in one] == sorted((i, len(x)) for i, x in alone.items())


def test_odd(odd, none):
    got = sorted((tuple(r) for r in P.digests(odd).collect()), key=str)
    assert got == sorted((plain(r.doc_id, r.text if r.text is None or len(r.text) < 50_000 else r.text) for r in odd.collect()), key=str)
    assert P.digests(none).count() == 0 and P.detect(none).count() == 0


def test_detect(make):
    text = "start " + "one two three " * 6 + "end " + "x " * 8
    got = P.detect(make([(1, text), (2, None)], clash=True)).collect()
    assert [tuple(r) for r in got[0].runs] == [(1, 18, 3), (20, 8, 1)]
    assert b" ".join(bytes(w) for w in got[0].kept) == b"start one two three end x"
    assert got[1].words == [] and got[1].runs == []

from __future__ import annotations

import hashlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from quillstack.llm import fingerprints as P
from quillstack.llm.common import load

texts = st.text(alphabet="ab .\né", max_size=60)


@settings(max_examples=60, deadline=None)
@given(texts, texts)
def test_homomorphic(a, b):
    p, q = P.paragraphs(a), P.paragraphs(b)
    assert P.fingerprint(p + q).hex() == P.fingerprint(q + p).hex()
    assert (P.fingerprint(p) + P.fingerprint(q)).hex() == P.fingerprint(p + q).hex()
    assert (P.fingerprint(p + q) - P.fingerprint(q)).hex() == P.fingerprint(p).hex()
    assert P.revise(P.fingerprint(p), a, b).hex() == P.fingerprint(q).hex()
    assert (P.fingerprint(p).hex() == P.fingerprint(q).hex()) == (sorted(p) == sorted(q))
    assert P.likeness(P.fingerprint(p), P.fingerprint(p)) == 1.0


def test_likeness():
    words = [f"w{i}" for i in range(1200)]
    whole, half = " ".join(words), " ".join(words[:600] + [f"v{i}" for i in range(600)])
    f = lambda t: P.fingerprint(P.paragraphs(t))
    assert 0.3 < P.likeness(f(whole), f(half)) < 0.7
    assert P.likeness(f(whole), f(" ".join(f"u{i}" for i in range(1200)))) < 0.2


def exact(a, b):
    """The share of sliding runs in common, with repeats."""
    count = lambda t: Counter(tuple(w[k : k + 6]) for p in P.paragraphs(t) if (w := p.split()) for k in range(max(len(w) - 5, 1)))
    x, y = count(a), count(b)
    return 2 * (x & y).total() / (x.total() + y.total())


def test_repeats():
    """Likeness of texts with repeated lines, and of those with one early word changed, is near that of their runs' multisets."""
    f = lambda t: P.fingerprint(P.paragraphs(t))
    line = "a line of text that is said again and again"
    words = [f"w{i}" for i in range(600)]
    for a, b in (
        ("\n".join([line] * 1000), "\n".join([line] * 500)),
        ("\n".join([line] * 100_000), "\n".join([line] * 50_000)),
        ("\n".join([line] * 900 + [f"own line number {i}" for i in range(100)]), "\n".join([line] * 900)),
        (" ".join(words), " ".join(["other", "words", *words])),
        (" ".join(words), " ".join(reversed(words))),
    ):
        assert f(a).runs == sum(max(len(p.split()) - 5, 1) for p in P.paragraphs(a))
        assert abs(P.likeness(f(a), f(b)) - exact(a, b)) < 0.2


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (i, t) in enumerate(rows):
        t, n = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + n[:half] if half else t
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), P.fingerprint(P.paragraphs(t)).hex(), P.fingerprint(P.paragraphs(e)).hex()))
    return sorted(out, key=str)


def test_whole_table(spark):
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    got = P.fingerprints(docs).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == plain([(r.doc_id, r.text) for r in docs.collect()])
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert sum(r.near_edited for r in got) > sum(r.near_next for r in got) + 0.2 * len(got)


def test_odd(odd, none, make):
    got = P.fingerprints(odd).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == plain([(r.doc_id, r.text) for r in odd.collect()])
    assert P.fingerprints(none).count() == 0
    one = P.fingerprints(make([(5, "abcd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()

from __future__ import annotations

import re
from random import Random

import numpy as np
import pytest

from quillstack.llm import jaccard_join as J
from quillstack.llm.common import load


def plain(rows, size, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        n = min(size, len(w))
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset())
    head = list(range(len(rows)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            s, t = sets[a], sets[b]
            if s and t and 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)) and 100 * len(s & t) >= percent * len(s | t):
                head[find(b)] = find(a)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, len(sets[k]), (low.get(find(k)) if sets[k] else i)) for k, (i, _) in enumerate(rows)), key=str)


def got(df, **options):
    return sorted((tuple(r) for r in J.join(df, **options).collect()), key=str)


def test_whole_table(spark):
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    assert got(docs, size=4, percent=85) == plain([(r.doc_id, r.text) for r in docs.collect()], 4, 85)


@pytest.mark.parametrize("options", [{"hot": 4, "block": 3}, {"hot": 4, "block": 500}, {"bucket": 100}])
def test_crowded(make, options):
    """Many near copies of one text, joined in blocks and over many buckets, are linked as by all pairs."""
    r = Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(70):
        words = list(base)
        for _ in range(r.randrange(5)):
            words[r.randrange(60)] = f"x{r.randrange(1000)}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(f"v{r.randrange(40)}" for _ in range(r.randrange(12)))) for i in range(60)]
    assert got(make(rows), size=4, percent=85, **options) == plain(rows, 4, 85)


def test_odd(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(odd, size=4, percent=85) == plain(rows, 4, 85)
    assert got(none) == []


def test_block_links():
    r = Random(1)
    sets = [np.array(sorted(r.sample(range(30), r.randint(1, 20))), np.uint64) for _ in range(25)]
    want = {(a, b) for a in range(25) for b in range(a + 1, 25) if J.linked(sets[a], sets[b], 60)}
    plain_ = {(a, b) for a in range(25) for b in range(a + 1, 25) if 100 * len(set(sets[a].tolist()) & set(sets[b].tolist())) >= 60 * len(set(sets[a].tolist()) | set(sets[b].tolist()))}
    assert want == plain_
    found = J.block_links(sets, np.arange(25), np.arange(25), 60, width=7)
    joined = lambda pairs: len(J._forest(np.array(sorted(pairs) or np.zeros((0, 2), int)), 25))
    assert joined(found) == joined(want)

from __future__ import annotations

import zlib
from collections import defaultdict

from quillstack.llm import sharding as S
from quillstack.llm.common import load


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in load(spark, "/root/testdata/sf0.01", "documents").collect()}
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in S.shards(load(spark, "/root/testdata/sf0.01", "documents")).collect():
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len(t.encode()) for t in docs.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest


def test_even_with_ties(spark, make):
    """Two thousand equal rows of one source are split as evenly as others."""
    docs = make([(7, "x" * 92)] * 2000 + [(i, "y" * 92) for i in range(400)])
    sizes = [r["sum(size)"] for r in S.shards(docs).groupBy("shard").sum("size").collect()]
    assert len(sizes) == 24
    assert max(sizes) - min(sizes) <= 0.1 * max(sizes)


def test_odd(odd, none):
    out = S.shards(odd).collect()
    assert len(out) == odd.count()
    assert sorted((r.size, r.text_crc32) for r in out)[:3] == [(8, 0)] * 3
    assert S.shards(none).count() == 0

from __future__ import annotations

import zlib
from collections import defaultdict
from random import Random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quillstack.llm import packing as K
from quillstack.llm.common import load
from quillstack.llm.registry import PACKING, op3_packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit(lengths):
    """The same windows as a scan of all open windows for the tightest."""
    room, plain = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [(r, -w) for w, r in enumerate(room) if r >= lengths[i]]
        if fits:
            tight = min(fits)[0]
            w = next(w for w in range(len(room)) if room[w] == tight)
        else:
            room.append(64)
            plain.append([])
            w = len(room) - 1
        room[w] -= lengths[i]
        plain[w].append(i)
    got = K.best_fit_decreasing(lengths, 64)
    fill = lambda ws: sorted(sum(lengths[i] for i in w) for w in ws)
    assert fill(got) == fill(plain)
    assert sorted(i for w in got for i in w) == list(range(len(lengths)))
    pieces = K.close_gaps([[(i, 0, lengths[i]) for i in w] for w in got], 64, 4)
    assert all(sum(p[2] for p in w) <= 64 for w in pieces)
    assert sum(p[2] for w in pieces for p in w) == sum(lengths)


def test_encoders_agree():
    fast, slow = K.Encoder(**{k: PACKING[k] for k in ("tokenizer", "ranks", "pattern")}), K.Encoder(PACKING["tokenizer"], None, PACKING["pattern"])
    r = Random(3)
    for text in ["", "don't  we'll \n\n x", "<|endoftext|> x", "été ñ ß 日本 😀", "a" * 3000, " " * 3000, *("".join(r.choice("ab é'.,\n\t 12") for _ in range(200)) for _ in range(50))]:
        assert fast(text) == slow(text)


def check(rows, texts, encode):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, text in texts.items():
        ids = np.array([*encode(text or ""), 0], "<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return sum(r.length for r in rows) / (1024 * len(sequences))


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in load(spark, "/root/testdata/sf0.01", "documents").collect()}
    slow = K.Encoder(PACKING["tokenizer"], None, PACKING["pattern"])
    assert check(op3_packing(spark, "/root/testdata/sf0.01").collect(), docs, slow) > 0.99


def test_odd(odd, none):
    out = K.pack(odd, **PACKING).collect()
    assert sum(r.length for r in out if r.start == 0 and r.doc_tokens == 1) == 3
    assert sum(r.length for r in out) == sum({(r.doc_id, r.doc_tokens): r.doc_tokens for r in out if r.doc_id not in (None, 1)}.values()) + sum(r.length for r in out if r.doc_id in (None, 1))
    assert K.pack(none, **PACKING).count() == 0

"""Packing token sequences into windows by best-fit decreasing.

Documents longer than a window are first cut into full windows; what remains of
each is packed, longest first, into the open window with the least room that
still takes it. A segment tree over the remaining capacities finds that window
in log(window) steps. Remainders are dealt by hash into groups of bounded size
that are packed independently, so the work spreads over any number of tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstack.llm.common import materialize

WINDOW = 1024
#: Remainders packed together; at 4 bytes an id a group stays under about 16 MB.
GROUP = 4096
#: Gaps of at least this many tokens are closed by cutting a piece from the emptiest windows.
LEAST_CUT = 32
#: Texts in other scripts, or with huge blanks, are left to the slower reference tokenizer.
OTHER = re.compile(r"[^\x00-ɏ]|<\||\s{2000}")
PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary, piece_no long"


class Encoder:
    """Token ids of the `tokenizers` file, by the same vocabulary's rank file where both agree."""

    def __init__(self, tokenizer: str, ranks: str | None, pattern: str):
        import base64

        import tiktoken

        self.file = tokenizer
        self.slow = self.fast = None
        if ranks:
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.fast is None or OTHER.search(text):
            if self.slow is None:  # it takes far more memory than the other
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.file)
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class CapacityTree:
    """Counts of open windows by remaining capacity, with the least capacity of at least n found by descent."""

    def __init__(self, window: int):
        self.base = 1 << window.bit_length()
        self.count = [0] * (2 * self.base)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, by: int) -> None:
        k, count = capacity + self.base, self.count
        while k:
            count[k] += by
            k >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(window, capacity) of the tightest open window that has room for `least`."""
        k, count = least + self.base, self.count
        if not count[k]:
            while k > 1 and (k & 1 or not count[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.base:
                k = 2 * k if count[2 * k] else 2 * k + 1
        capacity = k - self.base
        self._add(capacity, -1)
        return self.windows[capacity].pop(), capacity


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> list[list[int]]:
    """Windows as lists of item numbers; ties go by item number."""
    tree, windows = CapacityTree(window), []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[item])
        if found is None:
            windows.append([])
            found = len(windows) - 1, window
        windows[found[0]].append(item)
        if found[1] > lengths[item]:
            tree.put(found[1] - lengths[item], found[0])
    return windows


def close_gaps(windows: list[list[tuple[int, int, int]]], window: int, least: int) -> list[list[tuple[int, int, int]]]:
    """Moves pieces (item, start, length) of the emptiest windows, cut to fit, into gaps of at least `least` tokens."""
    order = sorted(windows, key=lambda w: (sum(p[2] for p in w), w))
    donor, taker = 0, len(order) - 1
    while donor < taker:
        gap = window - sum(p[2] for p in order[taker])
        if gap < least:
            taker -= 1
            continue
        while gap and donor < taker:
            item, start, length = order[donor].pop()
            moved = min(gap, length)
            order[taker].append((item, start, moved))
            gap -= moved
            if moved < length:
                order[donor].append((item, start + moved, length - moved))
            if not order[donor]:
                donor += 1
    return [w for w in order if w]


def _cut(encoder_args: tuple, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, number = Encoder(*encoder_args), TaskContext.get().partitionId() << 33
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), 0], "<u4")
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    rows.append((doc_id, start, len(part), len(ids), part.tobytes(), number))
                    number += 1
                size += len(ids)
                if size > 1_000_000:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)
            pa.default_memory_pool().release_unused()

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    a, b, c, d, e, f = zip(*rows, strict=True)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((a, b, c, d, e, f), kinds, strict=True)], names=["doc_id", "start", "length", "doc_tokens", "ids", "piece_no"])


PACKED = "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"


def _pack(window: int, least: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("piece_no")
        group, lengths, starts = key[0].as_py(), table.column("length").to_pylist(), table.column("start").to_pylist()
        docs, tokens, raw = table.column("doc_id").to_pylist(), table.column("doc_tokens").to_pylist(), table.column("ids").to_pylist()
        windows = [[(i, 0, lengths[i]) for i in w] for w in best_fit_decreasing(lengths, window)]
        rows = []
        for k, w in enumerate(close_gaps(windows, window, least)):
            at = 0
            for item, start, length in w:
                rows.append((docs[item], starts[item] + start, length, tokens[item], raw[item][4 * start : 4 * (start + length)], (group << 32 | k) * 2 + 1, at))
                at += length
        names = [c.split()[0] for c in PACKED.split(", ")]
        return pa.table({n: pa.array(x, pa.binary() if n == "ids" else pa.int64()) for n, x in zip(names, zip(*rows, strict=True), strict=True)})

    return run


def pack(
    docs: DataFrame, *, tokenizer: str, ranks: str | None, pattern: str, window: int = WINDOW, group: int = GROUP, least_cut: int = LEAST_CUT
) -> DataFrame:
    """docs (doc_id, text) as pieces: doc_id, start, length, doc_tokens, ids, sequence_id, offset.

    A document is its token ids and an id 0; `ids` are little-endian unsigned
    32-bit. A null or empty text is the one id 0. Repeated rows and null ids are
    packed like others; other columns are left out; no rows give no pieces.
    Only remainders, less than a window a document, are shuffled.
    """
    pieces = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_cut((tokenizer, ranks, pattern), window), PIECES)
    pieces = materialize(pieces, "pieces")
    full = pieces.where(F.col("length") == window).select(
        "doc_id", "start", "length", "doc_tokens", "ids", (F.col("piece_no") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = pieces.where(F.col("length") < window)
    groups = max(1, -(-rest.count() // group))
    packed = rest.withColumn("group", F.pmod(F.xxhash64("piece_no"), F.lit(groups))).groupBy("group").applyInArrow(_pack(window, least_cut), PACKED)
    return full.unionByName(packed)

"""Periodic runs of words by partition refinement (Crochemore's method).

Positions of a text are kept in classes of equal factors. From one length to
the next a class is split by the classes of its members' right neighbours, and
of the parts that a class falls into only the smaller ones act as splitters in
the next step, so a position takes part O(log n) times. Members of a class are
linked in order of place: neighbours at a distance equal to the length begin a
square, and squares in a row are one run.

The arrays hold the words of many documents at once, with an end mark of its
own after each, so that a step costs a few array operations for all of them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that are refined at once; a longer document is refined alone.
WORDS = 400_000
#: Rows and bytes of text that a batch of a task may hold before it is worked on.
FEWEST = 6
NONE = np.iinfo(np.int64).max


def ordered(*keys: np.ndarray) -> np.ndarray:
    """The order that sorts by the keys (not negative), the first one first. Equal rows keep their order.

    Keys of 63 bits together with the place are packed into one number.
    """
    n = len(keys[0])
    bits = [int(k.max(initial=0)).bit_length() for k in keys] + [n.bit_length()]
    if sum(bits) > 63:
        return np.lexsort(keys[::-1])
    packed = np.zeros(n, np.int64)
    for k, b in zip(keys, bits, strict=False):
        packed = (packed << b) | k
    packed = np.sort((packed << bits[-1]) | np.arange(n))
    return packed & ((1 << bits[-1]) - 1)


def starts_of(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new group of equal keys begins."""
    new = np.ones(len(sorted_keys[0]), bool)
    new[1:] = False
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at starts and have the sizes."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def squares(words: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, periods) of primitive squares: the factors of length q at i and at i + q are equal, and none between.

    words: numbers of the words, an end mark of its own after each text; most:
    the greatest period of interest at each place.
    """
    n = len(words)
    place = ordered(words)
    edges = starts_of(words[place])
    size = np.diff(np.append(edges, n))  # members of a class
    start = edges.copy()  # where a class begins in `place`
    cls = np.empty(n, np.int64)
    cls[place] = np.repeat(np.arange(len(edges)), size)
    where = np.empty(n, np.int64)
    where[place] = np.arange(n)
    after, before = np.full(n, n), np.full(n + 1, -1)  # the neighbours in the class
    inner = np.ones(n, bool)
    inner[edges] = False
    second = np.flatnonzero(inner)
    after[place[second - 1]] = place[second]
    before[place[second]] = place[second - 1]
    gap = np.where(after < n, after - np.arange(n), NONE)  # since the length in `since`
    since = np.ones(n, np.int64)
    grown = n - len(edges)
    size, start = np.append(size, np.zeros(grown, np.int64)), np.append(start, np.zeros(grown, np.int64))
    classes = len(edges)
    moved_flag = np.zeros(n, bool)
    found_at, found_q = [], []

    def keep(at: np.ndarray, length: int) -> None:
        """The gaps at these places hold up to length - 1."""
        d = gap[at]
        good = (d >= since[at]) & (d < length) & (d <= most[at])
        if good.any():
            found_at.append(at[good])
            found_q.append(d[good])

    splitters, length, longest = place, 1, int(most.max(initial=0))
    while len(splitters) and length < longest:
        length += 1
        left = splitters[splitters > 0] - 1
        left = left[(size[cls[left]] > 1) & (most[left] >= length)]
        if not len(left):
            break
        by = cls[left + 1]
        of = cls[left]
        turn = ordered(of, by, left)
        left, of, by = left[turn], of[turn], by[turn]
        group = starts_of(of, by)
        g_size = np.diff(np.append(group, len(left)))
        g_of = of[group]
        first_g = starts_of(g_of)  # the first group of each class that is split
        groups = np.diff(np.append(first_g, len(group)))
        k = g_of[first_g]
        m = np.add.reduceat(g_size, first_g)
        rest = size[k] - m
        # classes that move as a whole stay as they are
        whole = (rest == 0) & (groups == 1)
        if whole.any():
            if whole.all():
                break
            stay = np.repeat(~whole, groups)
            pick = np.repeat(stay, g_size)
            left, of, by = left[pick], of[pick], by[pick]
            g_size, g_of = g_size[stay], g_of[stay]
            group = np.cumsum(g_size) - g_size
            k, m, rest, groups = k[~whole], m[~whole], rest[~whole], groups[~whole]
            first_g = np.cumsum(groups) - groups

        # members leave the chains of their classes, and are chained in their groups
        link = np.empty(len(left), bool)  # the one before has left too, and was its neighbour
        c_left, c_of = left, of
        if len(group) > len(k):
            chain = ordered(of, left)
            c_left, c_of = left[chain], of[chain]
        link[0] = False
        link[1:] = (after[c_left[:-1]] == c_left[1:]) & (c_of[:-1] == c_of[1:])
        heads = np.flatnonzero(~link)
        tails = np.append(heads[1:], len(left)) - 1
        prev, nxt = before[c_left[heads]], after[c_left[tails]]
        inside = np.ones(len(left), bool)
        inside[group] = False
        tied = np.flatnonzero(inside)
        new_after = np.full(len(left), n)
        new_after[tied - 1] = left[tied]
        new_before = np.full(len(left), -1)
        new_before[tied] = left[tied - 1]
        has = prev >= 0
        changed = np.concatenate([left, prev[has]])
        changed_after = np.concatenate([new_after, nxt[has]])
        new_gap = np.where(changed_after < n, changed_after - changed, NONE)
        other = new_gap != gap[changed]
        keep(changed[other], length)
        gap[changed[other]], since[changed[other]] = new_gap[other], length
        after[changed] = changed_after
        before[nxt] = prev  # before[n] is a spare cell
        before[left] = new_before

        # a class's moved members come to its end, group by group
        end = start[k] + size[k]
        tail = spans(end - m, m)
        moved_flag[left] = True
        at = where[left]
        bound = np.repeat(end - m, m)
        holes = at[at < bound]
        strays = place[tail]
        strays = strays[~moved_flag[strays]]
        place[holes] = strays
        where[strays] = holes
        place[tail] = left
        where[left] = tail
        moved_flag[left] = False

        # numbers: what stays keeps the class's; where nothing stays, the first group does
        empty = rest == 0
        fresh = np.ones(len(g_size), bool)
        fresh[first_g[empty]] = False
        number = np.repeat(k, groups)
        n_new = int(fresh.sum())
        number[fresh] = classes + np.arange(n_new)
        classes += n_new
        size[k] = rest
        size[number] = g_size
        start[number] = np.repeat(end - m, groups) + (group - np.repeat(group[first_g], groups))
        cls[left] = np.repeat(number, g_size)

        # the largest part of each class doesn't split, all others do
        largest = np.maximum.reduceat(g_size, first_g)
        rest_splits = (rest <= largest) & ~empty
        peak = np.flatnonzero(g_size == np.repeat(largest, groups))
        peak = peak[starts_of(np.repeat(np.arange(len(k)), groups)[peak])]  # one of each class
        splits = np.ones(len(g_size), bool)
        splits[peak[empty | rest_splits]] = False
        splitters = left[np.repeat(splits, g_size)]
        if rest_splits.any():
            r = k[rest_splits]
            splitters = np.concatenate([splitters, place[spans(start[r], size[r])]])
    keep(np.arange(n), NONE)
    if not found_at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_at), np.concatenate(found_q)


def runs(words: np.ndarray, ends: np.ndarray, power: int = 4, least: int = FEWEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all maximal runs of at least `power` periods and `least` words, by start, then period.

    words: numbers of the words with an end mark after each text; ends: places
    of the marks. A run of `power` periods is no longer than its text, which
    bounds the lengths that are refined. power is 2 at least.
    """
    sizes = np.diff(ends, prepend=-1) - 1
    most = np.repeat(sizes // power, sizes + 1)
    at, q = squares(words, most)
    turn = ordered(q, at)
    at, q = at[turn], q[turn]
    new = np.ones(len(at), bool)
    new[1:] = (q[1:] != q[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    start, period = at[first], q[first]
    length = at[last] - start + 2 * period if len(first) else start
    good = length >= np.maximum(least, power * period)
    start, length, period = start[good], length[good], period[good]
    turn = ordered(start, period)
    return start[turn], length[turn], period[turn]


def runs_of(texts: Sequence[Sequence[bytes]], power: int = 4, least: int = FEWEST) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of words, all lists refined together."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not texts:
        return out
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1
    words = np.empty(int(ends[-1]) + 1, np.int64)
    for t, end, size in zip(texts, ends.tolist(), sizes.tolist(), strict=True):
        words[end - size : end] = np.fromiter(map(numbers.__getitem__, t), np.int64, size)
    words[ends] = 0
    doc = np.repeat(np.arange(len(texts)), sizes + 1)
    words += doc * len(numbers)  # documents share no word
    words[ends] = len(texts) * len(numbers) + np.arange(len(texts))
    for s, length, q in zip(*(x.tolist() for x in runs(words, ends, power, least)), strict=True):
        d = int(doc[s])
        out[d].append((s - int(ends[d] - sizes[d]), length, q))
    return out


def collapsed(words: Sequence[bytes], found: Sequence[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not found:
        return list(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for s, length, q in found:
        depth[s + q] += 1
        depth[s + length] -= 1
    gone = np.cumsum(depth) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=False) if not g]


def looped(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten, by a hash of doc_id, with a stretch that repeats to the end; others as they are."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


SCHEMA = "doc_id long, words array<binary>, runs array<struct<start: long, length: long, period: long>>, kept array<binary>"
DIGESTS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _groups(batches: Iterator[pa.RecordBatch], loops: bool) -> Iterator[tuple[list[int | None], list[list[bytes]]]]:
    """Ids and words of documents, about WORDS words at a time."""
    ids: list[int | None] = []
    texts: list[list[bytes]] = []
    n = 0
    for batch in batches:
        names = batch.schema.names
        for i, t in zip(batch.column(names.index("doc_id")), batch.column(names.index("text")), strict=True):
            i, words = i.as_py(), (t.as_py() or b"").split()
            words = looped(i, words) if loops else words
            if texts and n + len(words) > WORDS:
                yield ids, texts
                ids, texts, n = [], [], 0
            ids.append(i)
            texts.append(words)
            n += len(words) + 1
    if texts:
        yield ids, texts


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))


def detect(docs: DataFrame, power: int = 4, least: int = FEWEST, loops: bool = False) -> DataFrame:
    """docs (doc_id, text) as doc_id, words, runs and kept, a row for each row.

    Words are runs of bytes other than ASCII white space. runs: the maximal
    stretches of smallest period q with at least `power` periods and `least`
    words, by start, then period; kept: the words that no run holds after its
    first period. A null or empty text has no words; repeated rows have equal
    results; no rows give none; other columns are left out. `loops` gives one
    document in ten a repeating end first (see `looped`).

    Nothing is shuffled. A task holds about WORDS words, or one document, at
    some 200 bytes a word.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for ids, texts in _groups(batches, loops):
            found = runs_of(texts, power, least)
            kept = [collapsed(t, r) for t, r in zip(texts, found, strict=True)]
            rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.list_(pa.binary())), pa.array(rows, kind), pa.array(kept, pa.list_(pa.binary()))], names=["doc_id", "words", "runs", "kept"])

    return _columns(docs).mapInArrow(work, SCHEMA)


def digests(docs: DataFrame, loops: bool = True) -> DataFrame:
    """Per row of docs its number of runs, the longest one, and hashes of all runs and of the text without repetitions."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in DIGESTS.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        for ids, texts in _groups(batches, loops):
            rows = []
            for i, words, found in zip(ids, texts, runs_of(texts), strict=True):
                s, length, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
                digest = [hashlib.sha256(x).hexdigest() for x in (lines.encode(), b" ".join(collapsed(words, found)))]
                rows.append((i, len(found), s, length, q, None if s is None else 1000 * length // q, *digest))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return _columns(docs).mapInArrow(work, DIGESTS)

"""N-gram Jaccard join: rare-first prefix filtering of word-shingle sets, exactly verified.

1. Texts that are equal are one class; one text of each is cut into a set of
   64-bit shingle hashes.
2. Hashes, packed in blocks, are dealt by value to buckets of bounded size that
   count in how many classes each shingle lies. Only those in two or more can
   link anything, and only they travel on.
3. A class's shingles in order of that count (rare first) give its prefix:
   classes that link share a shingle of both prefixes. What is left of the
   prefix after the shingles of one class only, which come first, is kept.
4. Classes that share a prefix shingle are joined on it, with length and
   positional filters. A shingle in more than HOT prefixes is not joined: its
   classes are dealt into blocks, and pairs of blocks are compared at once in
   a task, by products of incidence matrices, that return a spanning forest.
5. Each pair is verified once on its two sets, after the suffix filter.
6. Links go to the distributed union-find.

Hash equality stands for equality of shingles (64 bits).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstack.llm.common import materialize, partitions
from quillstack.llm.components import components

#: Prefixes up to which classes that share a shingle are joined in pairs; block size beyond it.
HOT, BLOCK = 64, 512
#: Shingles in a bucket, and in the packed block of a task.
BUCKET, PACKED = 2_000_000, 1_000_000
#: Keys (8 bytes each) that may be broadcast; with more, the same joins are shuffled.
BROADCAST_KEYS = 1_000_000
#: Words that a worker remembers the hashes of. It affects no result.
REMEMBERED = 200_000
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
EMPTY = np.zeros(0, np.uint64)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


_words = _Words()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of `size` words; of all words if there are fewer; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return EMPTY
    a = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = min(size, len(a))
    h = a[: len(a) - n + 1] * FACTORS[0]
    for k in range(1, n):
        h = h + a[k : len(a) - n + 1 + k] * FACTORS[k]
    return np.unique(mixed(h + np.uint64(n)))


def least_overlap(a: int, b: int, percent: int) -> int:
    """The least intersection of sets of a and b elements that makes 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link; the suffix filter bounds their intersection before it is counted."""
    need = least_overlap(len(a), len(b), percent)
    if min(len(a), len(b)) < need:
        return False
    if len(a) >= 16:  # halves, then quarters by the quartiles of a: no more in common than the smaller part
        cuts = a[[len(a) // 4, len(a) // 2, 3 * len(a) // 4]]
        pa_, pb = np.diff([0, *np.searchsorted(a, cuts), len(a)]), np.diff([0, *np.searchsorted(b, cuts), len(b)])
        if int(np.minimum(pa_, pb).sum()) < need:
            return False
    return len(np.intersect1d(a, b, assume_unique=True)) >= need


def _u48(h: np.ndarray) -> bytes:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from48(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


PACKED_ROW = "bucket int, kind int, a binary, b binary, c binary"
PACKED_NAMES = ["bucket", "kind", "a", "b", "c"]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=PACKED_NAMES)


def _cut(size: int, bits: int):
    """Texts (k, text) as packed blocks: kind 0 a bucket's hashes, numbers of classes and their keys; kind 1 keys and set sizes."""
    top, rest = np.uint64(64 - bits), np.uint64(16 - bits if bits < 16 else 0)
    keep = np.uint64((1 << 48) - 1)

    def flush(keys: list[int], sets: list[np.ndarray], turn: int) -> pa.RecordBatch:
        k = np.array(keys, "<i8")
        sizes = np.array([len(s) for s in sets], "<i4")
        rows = [(turn % (1 << bits), 1, k.tobytes(), sizes.tobytes(), b"")]
        h, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(h, kind="stable")
        h, owner = h[order], owner[order]
        bucket = (h >> top).astype(np.int64) if bits else np.zeros(len(h), np.int64)
        low = (h >> rest) & keep  # the 48 bits after those of the bucket, at most the last 48
        edges = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        for b in range(1 << bits):
            i, j = edges[b], edges[b + 1]
            if i < j:
                here, local = np.unique(owner[i:j], return_inverse=True)
                rows.append((b, 0, _u48(low[i:j]), local.astype("<u2").tobytes(), k[here].tobytes()))
        return _rows(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        keys, sets, total, turn = [], [], 0, TaskContext.get().partitionId()
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys.append(k)
                sets.append(shingle_set(text.as_py(), size))
                total += len(sets[-1])
                if total >= PACKED or len(keys) >= 60_000:
                    yield flush(keys, sets, turn)
                    keys, sets, total, turn = [], [], 0, turn + 1
        if keys:
            yield flush(keys, sets, turn)

    return run


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each bucket; a partition's rows come sorted by bucket."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(i) for i in range(5)), strict=True):
            bucket, *rest = (x.as_py() for x in row)
            if bucket != now:
                if rows:
                    yield now, rows
                now, rows = bucket, []
            rows.append(rest)
    if rows:
        yield now, rows


ENTRY = np.dtype([("k", "<i8"), ("h", "<i8"), ("df", "<u2")])
SIZE = np.dtype([("k", "<i8"), ("n", "<i4")])


def _place(k: np.ndarray, bits: int) -> np.ndarray:
    return (k.astype(np.uint64) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(k), np.int64)


def _deal(x: np.ndarray, kind: int, bits: int) -> list[tuple]:
    place = _place(x["k"], bits)
    order = np.argsort(place, kind="stable")
    x, place = x[order], place[order]
    edges = np.searchsorted(place, np.arange((1 << bits) + 1))
    return [(b, kind, x[edges[b] : edges[b + 1]].tobytes(), b"", b"") for b in range(1 << bits) if edges[b] < edges[b + 1]]


def _count(bits: int, to_bits: int):
    """Buckets of shingles to buckets of classes: the shingles that lie in two or more classes, with their number."""
    top, rest = np.uint64(64 - bits), np.uint64(16 - bits if bits < 16 else 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches):
            sizes = [(a, b) for kind, a, b, _ in rows if kind == 1]
            if sizes:
                k = np.frombuffer(b"".join(a for a, _ in sizes), "<i8")
                x = np.zeros(len(k), SIZE)
                x["k"], x["n"] = k, np.frombuffer(b"".join(b for _, b in sizes), "<i4")
                yield _rows(_deal(x, 1, to_bits))
            hs = [_from48(a) for kind, a, _, _ in rows if kind == 0]
            if not hs:
                continue
            ks = [np.frombuffer(c, "<i8")[np.frombuffer(b, "<u2")] for kind, _, b, c in rows if kind == 0]
            del rows
            h, k = np.concatenate(hs), np.concatenate(ks)
            del hs, ks
            order = np.argsort(h, kind="stable")
            h, k = h[order], k[order]
            starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            counts = np.diff(np.append(starts, len(h)))
            many = np.repeat(counts >= 2, counts)
            x = np.zeros(int(many.sum()), ENTRY)
            x["k"], x["df"] = k[many], np.minimum(np.repeat(counts, counts)[many], 65535)
            x["h"] = ((h[many] << rest) | (np.uint64(bucket) << top)).astype(np.int64) if bits else h[many].astype(np.int64)
            if len(x):
                yield _rows(_deal(x, 0, to_bits))

    return run


def _prefixes(percent: int):
    """Buckets of classes to (k, n, first, shingles): the shared shingles of the prefix, the first at position `first`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_bucket(batches):
            docs = np.sort(np.frombuffer(b"".join(a for kind, a, _, _ in rows if kind == 1), SIZE), order="k")
            x = np.frombuffer(b"".join(a for kind, a, _, _ in rows if kind == 0), ENTRY)
            del rows
            x = x[np.lexsort((x["h"], x["df"], x["k"]))]
            starts, ends = np.searchsorted(x["k"], docs["k"]), np.searchsorted(x["k"], docs["k"], "right")
            n = docs["n"].astype(np.int64)
            first = n - (ends - starts)
            prefix = n - (percent * n + 99) // 100 + 1
            take = np.clip(np.minimum(prefix - first, ends - starts), 0, None)
            picked = np.repeat(starts - np.concatenate(([0], np.cumsum(take)[:-1])), take) + np.arange(int(take.sum())) if len(docs) else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(take))), pa.int32()), pa.array(x["h"][picked]))
            yield pa.RecordBatch.from_arrays([pa.array(docs["k"]), pa.array(n), pa.array(first), lists], names=["k", "n", "first", "shingles"])

    return run


def _verify(size: int, percent: int):
    """Rows sorted by (a, b): the text of a (b null) before those of its partners; returns the pairs that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, EMPTY
        for batch in batches:
            found = []
            for a, b, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if b is None:
                    now, own = a, shingle_set(text.as_py(), size)
                elif a == now and linked(own, shingle_set(text.as_py(), size), percent):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(2)], names=["a", "b"])

    return run


def _forest(links: np.ndarray, n: int) -> list[tuple[int, int]]:
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in links.tolist():
        a, b = find(i), find(j)
        if a != b:
            parent[b] = a
            out.append((i, j))
    return out


def block_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int, width: int = 4096) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets[left] and sets[right], all pairs compared by matrix products."""
    sizes = np.array([len(s) for s in sets])
    tokens, number = np.unique(np.concatenate(sets), return_inverse=True) if len(sets) else (EMPTY, np.zeros(0, int))
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = np.bincount(number, minlength=len(tokens)) >= 2
    column = (np.cumsum(shared) - 1)[number]
    owner, column = owner[shared[number]], column[shared[number]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(left), len(right)), np.float32)
    where_l, where_r = np.full(len(sets), -1), np.full(len(sets), -1)
    where_l[left], where_r[right] = np.arange(len(left)), np.arange(len(right))
    for start in range(0, int(shared.sum()), width):
        i, j = np.searchsorted(column, (start, start + width))
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        o, c = owner[i:j], column[i:j] - start
        for m, w in ((x, where_l), (y, where_r)):
            inside = w[o] >= 0
            m[w[o][inside], c[inside]] = 1
        common += x @ y.T
    total = sizes[left][:, None] + sizes[right][None, :]
    found = np.argwhere((100 + percent) * common.astype(np.int64) >= percent * total)
    return _forest(np.stack([left[found[:, 0]], right[found[:, 1]]], 1), len(sets))


def _blocks(size: int, percent: int):
    """A pair of blocks of one hot shingle's classes."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, i, j = (x.as_py() for x in key)
        k, block = table.column("k").to_numpy(), table.column("block").to_numpy()
        sets = [shingle_set(t.as_py(), size) for t in table.column("text")]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links = [(a, b) for a, b in block_links(sets, left, right, percent) if a != b]
        return pa.table({"a": pa.array([k[a] for a, _ in links], pa.int64()), "b": pa.array([k[b] for _, b in links], pa.int64())})

    return run


def _chosen(docs: DataFrame, keys: DataFrame, count: int, how: str) -> DataFrame:
    """docs whose k is (semi) or isn't (anti) among keys; keys of a checked number are broadcast."""
    return docs.join(F.broadcast(keys) if count <= BROADCAST_KEYS else keys, "k", how)


def join(docs: DataFrame, *, size: int = 5, percent: int = 80, hot: int = HOT, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id (the least doc_id reachable by links).

    Words are split at ASCII white space, A-Z lower-cased; documents link if
    100 * intersection >= percent * union of their sets of `size`-word
    shingles. A null or wordless text has no shingles and its own doc_id.
    Repeated rows link with each other; null ids never name a component. Other
    columns are left out. No rows give no rows.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("k", F.xxhash64("text"))
    ids = materialize(keyed.select("doc_id", "k", F.octet_length("text").alias("bytes")), "ids")
    keyed = keyed.where("text is not null").select("k", "text")

    copies = ids.groupBy("k").agg(F.count("*").alias("n"), F.max("bytes").alias("bytes"))
    size_of = copies.agg(F.sum("bytes").alias("bytes"), F.count_if(F.col("n") > 1).alias("many")).first()
    repeated = copies.where("n > 1").select("k")
    if size_of.many <= BROADCAST_KEYS:
        texts = _chosen(keyed, repeated, size_of.many, "left_anti").unionByName(_chosen(keyed, repeated, size_of.many, "left_semi").distinct())
    else:
        texts = keyed.distinct()
    shingles = (size_of.bytes or 0) // 6
    bits = min(20, max(0, (shingles // bucket).bit_length()))
    to_bits = min(20, max(0, (shingles // bucket // 4).bit_length()))
    packed = texts.mapInArrow(_cut(size, bits), PACKED_ROW).repartition(1 << bits, "bucket").sortWithinPartitions("bucket", "kind", "a")
    counted = packed.mapInArrow(_count(bits, to_bits), PACKED_ROW).repartition(1 << to_bits, "bucket").sortWithinPartitions("bucket", "kind", "a")
    prefixes = materialize(counted.mapInArrow(_prefixes(percent), "k long, n long, first long, shingles array<long>"), "prefixes")

    entries = prefixes.where(F.size("shingles") > 0).select("k", "n", "first", F.posexplode("shingles").alias("i", "h")).select("h", "k", "n", (F.col("first") + F.col("i")).alias("pos"))
    entries = materialize(entries, "entries")
    held = entries.groupBy("h").agg(F.count("*").alias("m"), F.sum("n").alias("sum"))
    few = entries.join(held.where((F.col("m") >= 2) & (F.col("m") <= hot)).select("h"), "h")
    a, b = few.alias("a"), few.alias("b")
    least = F.least("a.n", "b.n")
    need = F.ceil(F.lit(percent) * (F.col("a.n") + F.col("b.n")) / (100 + percent))
    rest = F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos"))
    pairs = a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.k") < F.col("b.k")) & (100 * least >= percent * F.greatest("a.n", "b.n")) & (rest >= need))
    pairs = materialize(pairs.select(F.col("a.k").alias("a"), F.col("b.k").alias("b")).distinct(), "pairs")
    crowded = held.where(F.col("m") > hot).withColumn("blocks", F.ceil(F.greatest(F.col("m") / block, F.col("sum") / (1000 * block))).cast("int"))
    crowds = materialize(entries.join(crowded, "h").select("h", "k", "blocks"), "crowds")

    keys = materialize(pairs.select(F.col("a").alias("k")).union(pairs.select("b")).union(crowds.select("k")).distinct(), "keys")
    wanted = materialize(_chosen(keyed, keys, keys.count(), "left_semi").distinct(), "texts")
    partners = pairs.join(wanted, pairs.b == wanted.k).select("a", "b", "text")
    own = wanted.join(pairs.select(F.col("a").alias("k")).distinct(), "k", "left_semi").select(F.col("k").alias("a"), F.lit(None).cast("long").alias("b"), "text")
    rows = own.unionByName(partners).repartition(partitions(spark), "a").sortWithinPartitions("a", F.col("b").asc_nulls_first())
    links = rows.mapInArrow(_verify(size, percent), "a long, b long")
    mine = F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int")
    dealt = crowds.withColumn("block", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("h", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "k", "block").join(wanted, "k")
    crowd_links = dealt.groupBy("h", "i", "j").applyInArrow(_blocks(size, percent), "a long, b long")
    found = components(materialize(links.unionByName(crowd_links), "found"))

    labelled = ids.join(prefixes.select("k", "n"), "k", "left").join(found.withColumnRenamed("node", "k"), "k", "left")
    labelled = labelled.select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), F.coalesce("component", "k").alias("label"))
    lowest = labelled.where("n_shingles > 0").groupBy("label").agg(F.min("doc_id").alias("lowest"))
    return labelled.join(lowest, "label", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("lowest")).otherwise(F.col("doc_id")).alias("component_id")
    )

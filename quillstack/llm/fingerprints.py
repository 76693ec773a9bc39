"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A fingerprint is a vector of sums. Every paragraph is hashed to a wide vector
of random 32-bit lanes that are summed modulo 2^32, so equal multisets of
paragraphs have equal fingerprints in any order, and a paragraph is inserted
or deleted by adding or subtracting its vector. Further lanes sum a Cauchy
variate of each sliding run of words, modulo 2^64: a sum of Cauchy variates is
one, scaled by the sum of the absolute weights, so the median size of the
differences estimates how many runs, counted with their repeats, two documents
don't share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.llm.common import partitions

#: Lanes of the paragraph sums (modulo 2^32), lanes of the run sums (modulo 2^64), words in a run.
WIDE, LANES, RUN = 16, 128, 6
#: Cauchy variates in units of 1/SCALE, by 16 random bits.
SCALE = 2**16
CAUCHY = np.rint(np.tan(np.pi * ((np.arange(2**16) + 0.5) / 2**16 - 0.5)) * SCALE).astype(np.int64).view(np.uint64)
#: Odd constants that mix hashes; runs that are hashed at once.
_rng = np.random.default_rng(12)
PLACES = _rng.integers(0, 2**63, RUN, np.uint64) * np.uint64(2) + np.uint64(1)
STEPS = _rng.integers(0, 2**63, LANES // 4, np.uint64) * np.uint64(2) + np.uint64(1)
MIX = [np.array([x], np.uint64) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
CHUNK = 2048
#: Bytes of text in a range, and ranges at most, whose bounds and first ids come to the driver.
RANGE, MOST_RANGES = 64_000_000, 50_000
#: Fills up a paragraph that is shorter than a run.
PAD = xxhash.xxh3_64_intdigest(b" ")


class Fingerprint:
    """wide: paragraph sums; lanes: sums of the runs' variates; runs: number of runs. Sums can be added and subtracted."""

    __slots__ = ("wide", "lanes", "runs")

    def __init__(self, wide: np.ndarray | None = None, lanes: np.ndarray | None = None, runs: int = 0):
        self.wide = np.zeros(WIDE, np.uint32) if wide is None else wide
        self.lanes = np.zeros(LANES, np.uint64) if lanes is None else lanes
        self.runs = runs

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide + other.wide, self.lanes + other.lanes, self.runs + other.runs)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide - other.wide, self.lanes - other.lanes, self.runs - other.runs)

    def hex(self) -> str:
        return self.wide.astype("<u4").tobytes().hex() + self.lanes.astype("<u8").tobytes().hex() + f"{self.runs % 2**32:08x}"


def paragraphs(text: str) -> list[str]:
    return text.split("\n") if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """x with all bits depending on all bits (the finalizer of splitmix64), in place."""
    for shift, factor in zip((30, 27), MIX, strict=True):
        x ^= x >> np.uint64(shift)
        x *= factor
    x ^= x >> np.uint64(31)
    return x


def run_hashes(parts: Iterable[str]) -> np.ndarray:
    """A hash of each run of RUN words of each paragraph, from every word on; a shorter paragraph is one run."""
    hashes: list[int] = []
    ends: list[int] = []
    digest = xxhash.xxh3_64_intdigest
    for p in parts:
        words = p.split()
        if words:
            hashes += [digest(w.encode("utf-8", "surrogatepass")) for w in words]
            hashes += [PAD] * (RUN - len(words))
            ends.append(len(hashes))
    if not ends:
        return np.zeros(0, np.uint64)
    h = np.array(hashes, np.uint64)
    n = len(h) - RUN + 1
    runs = np.zeros(n, np.uint64)
    for j in range(RUN):
        runs += mixed(h[j : j + n] * PLACES[j : j + 1])
    inside = np.ones(len(h), bool)
    for j in range(1, RUN):
        inside[np.array(ends) - j] = False
    return runs[inside[:n]]


def fingerprint(parts: Iterable[str]) -> Fingerprint:
    parts = list(parts)
    wide = [hashlib.blake2b(p.encode("utf-8", "surrogatepass"), digest_size=4 * WIDE).digest() for p in parts]
    runs = run_hashes(parts)
    out = Fingerprint(runs=len(runs))
    if wide:
        out.wide = np.frombuffer(b"".join(wide), "<u4").reshape(-1, WIDE).sum(0, dtype=np.uint32)
    for k in range(0, len(runs), CHUNK):
        bits = mixed(runs[k : k + CHUNK, None] * STEPS[None, :]).astype("<u8", copy=False).view("<u2")
        out.lanes += CAUCHY[bits].sum(0, dtype=np.uint64)
    return out


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Estimated share of runs in common, with repeats, 0 to 1; 1 exactly if the fingerprints are equal."""
    if a.runs == b.runs and (a.wide == b.wide).all() and (a.lanes == b.lanes).all():
        return 1.0
    total = a.runs + b.runs
    if not total:
        return 0.0
    apart = float(np.median(np.abs((a.lanes - b.lanes).view(np.int64).astype(np.float64)))) / SCALE
    return min(max(1 - apart / total, 0.0), 1 - 1e-9)


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as many code points from the start of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half] if half else text


def revise(print_: Fingerprint, old: str, new: str) -> Fingerprint:
    """The fingerprint of `new` from that of `old`: paragraphs that differ are deleted and inserted."""
    a, b = paragraphs(old), paragraphs(new)
    k = 0
    while k < len(a) and k < len(b) and a[k] == b[k]:
        k += 1
    return print_ - fingerprint(a[k:]) + fingerprint(b[k:])


COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of (range, doc_id); the row that ends a range is the start of the next one's."""
    before: tuple | None = None
    done: list[tuple] = []
    for batch in batches:
        names = batch.schema.names
        for r, ahead, doc_id, text in zip(*(batch.column(names.index(c)) for c in ("range", "ahead", "doc_id", "text")), strict=True):
            r, ahead, doc_id, text = r.as_py(), ahead.as_py(), doc_id.as_py(), text.as_py() or ""
            own = fingerprint(paragraphs(text))
            if before is not None and before[0] == r:
                _, old_id, old_text, old = before
                new_text = edited(old_text, text)
                new = revise(old, old_text, new_text)
                digest = hashlib.sha256(new_text.encode("utf-8", "surrogatepass")).hexdigest()
                done.append((old_id, len(old_text), digest, old.hex(), new.hex(), likeness(old, new), likeness(old, own)))
            before = None if ahead else (r, doc_id, text, own)
        if done:
            yield _rows(done)
            done = []


def _rows(done: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)


def range_of(place: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are below the place, by halving."""
    if not cuts:
        return F.lit(0)
    bounds = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<long>")
    steps = [1 << b for b in reversed(range(len(cuts).bit_length()))]
    below = lambda at, step: F.coalesce(F.get(bounds, at + step - 1) < place, F.lit(False))
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(below(at, step), at + step).otherwise(at))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text): its fingerprint, and that of its edited text (see `edited`).

    "Next" is by ascending doc_id (nulls first; equal ids by their texts), from
    the last row back to the first; a single row is its own next. A null text
    counts as empty and has no paragraphs. Other columns are left out.

    Texts are shuffled once, to ranges of doc_id of about RANGE bytes, a task
    each. The first row of each range, one text a range, also goes to the end of
    the range before it. Rows of one repeated doc_id are one range.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("place"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    ranges = min(max(partitions(spark), -(-size // RANGE)), MOST_RANGES)
    cuts = docs.agg(F.percentile_approx("place", [k / ranges for k in range(1, ranges)], 10 * ranges).alias("c")).first().c if ranges > 1 else None
    docs = docs.withColumn("range", range_of(F.col("place"), sorted(set(cuts or []))))
    # a row per range: which ones have rows, and where each begins
    first = sorted(docs.groupBy("range").agg(F.min("place").alias("place")).collect())
    ahead = [(place, first[i - 1].range) for i, (_, place) in enumerate(first)]
    starts = spark.createDataFrame(ahead, "place long, to int")
    heads = docs.join(F.broadcast(starts), "place").groupBy("place", "to").agg(F.min_by(F.struct("doc_id", "text"), F.struct(F.col("doc_id"), F.coalesce("text", F.lit("")))).alias("x"))
    rows = docs.select("range", F.lit(False).alias("ahead"), "place", "doc_id", "text").unionByName(
        heads.select(F.col("to").alias("range"), F.lit(True).alias("ahead"), "place", "x.doc_id", "x.text")
    )
    rows = rows.repartitionById(len(first) or 1, F.col("range")) if hasattr(rows, "repartitionById") else rows.repartitionByRange(len(first) or 1, "range")
    rows = rows.sortWithinPartitions("range", "ahead", "place", F.col("doc_id").asc_nulls_first(), F.coalesce("text", F.lit("")))
    return rows.mapInArrow(_neighbours, COLUMNS)

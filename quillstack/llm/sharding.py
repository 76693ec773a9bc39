"""Sharding by a k-d tree: recursive splits at distributed weighted medians.

A node with k shards splits its widest metadata dimension where the bytes below
are in proportion to the shards on either side. A coordinate is a 48-bit whole
number, 32 bits of the scaled value and 16 bits of a hash of the row that break
ties, so that equal values can be split too. The median of every node of a level
is found at once by histograms of 65,536 bins, each refined into the bin that
holds it until the bin is light enough. A histogram has at most that many rows a
node, whatever the input; only the cut of each node comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstack.llm.common import materialize

BINS = 16
#: Shards, and the weight of a bin, as a share of a shard, that ends the search for a median.
SHARDS, TOLERANCE = 24, 0.002
#: Rows that get their slots in one task.
SLOTS = 100_000


def coordinates(docs: DataFrame) -> dict[str, Column]:
    """The dimensions as doubles: place by id, length, language and source."""
    share = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 20)).cast("double")
    return {"id": F.col("doc_id").cast("double"), "length": F.log2(F.col("size").cast("double")), "lang": share("lang"), "source": share("source")}


def _cuts(rows: DataFrame, node: Column, dims: dict[int, str], goals: dict[int, float], tolerance: float) -> dict[int, int]:
    """For each node the coordinate c so that the weight of coordinates <= c is next to its goal."""
    chosen = F.coalesce(*[F.when(F.col("node") == n, F.col(d)) for n, d in dims.items()])
    at = rows.withColumn("node", node).where(F.col("node").isin(*dims)).withColumn("c", chosen)
    low, below = dict.fromkeys(dims, 0), dict.fromkeys(dims, 0.0)
    done: dict[int, int] = {}
    for shift in (48 - BINS, 48 - 2 * BINS, 48 - 3 * BINS):
        open_ = [n for n in dims if n not in done]
        if not open_:
            break
        start = F.coalesce(*[F.when(F.col("node") == n, F.lit(low[n])) for n in open_])
        bin_ = F.shiftright(F.col("c") - start, shift)
        # the first round takes all coordinates; later ones those of the bin that holds the cut
        inside = F.col("node").isin(*open_) & (bin_ >= 0) & (bin_ < (1 << BINS))
        bins = at.where(inside).groupBy("node", bin_.alias("bin")).agg(F.sum("size").cast("double").alias("w"))
        so_far = F.coalesce(*[F.when(F.col("node") == n, F.lit(below[n])) for n in open_])
        goal = F.coalesce(*[F.when(F.col("node") == n, F.lit(goals[n])) for n in open_])
        order = Window.partitionBy("node").orderBy("bin")
        bins = bins.withColumn("upto", so_far + F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        cut = bins.withColumn("ok", F.col("upto") >= goal).groupBy("node").agg(
            F.min_by(F.struct("bin", "w", "upto"), F.struct(~F.col("ok"), F.when(F.col("ok"), F.col("bin")).otherwise(-F.col("bin")))).alias("x")
        )
        for n, (b, w, upto) in cut.collect():
            edge = low[n] + ((b + 1) << shift) - 1
            before = low[n] + (b << shift) - 1
            if w <= tolerance or shift == 0:  # the nearer side of this bin
                done[n] = edge if upto - goals[n] <= goals[n] - (upto - w) else before
            else:
                low[n], below[n] = low[n] + (b << shift), upto - w
    return done


def shards(docs: DataFrame, *, count: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Per row of docs (doc_id, text, lang, source): size, text_crc32, shard 0 to count - 1 and a gapless slot in it.

    Size: UTF-8 bytes of the text (null: none) plus 8; shards have nearly equal
    sums of sizes. Null metadata are a value of their own; repeated rows are
    told apart by nothing, so they fall on one side of a cut unless a hash of
    their position differs, and each gets its own slot. No rows give no rows.
    """
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"), F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialize(rows, "sizes")
    dims = coordinates(rows)
    span = rows.agg(F.sum("size").alias("total"), F.count("*").alias("n"), *[F.min(c).alias(f"lo_{d}") for d, c in dims.items()], *[F.max(c).alias(f"hi_{d}") for d, c in dims.items()]).first()
    total, n_rows = float(span.total or 0), span.n
    for d, c in dims.items():
        lo, hi = span[f"lo_{d}"] or 0.0, span[f"hi_{d}"] or 0.0
        scaled = F.coalesce((c - lo) / (hi - lo) * (2**32 - 1), F.lit(0.0)) if hi > lo else F.lit(0.0)
        rows = rows.withColumn(d, F.shiftleft(scaled.cast("long"), BINS) + F.pmod(F.xxhash64("row"), F.lit(1 << BINS)))
    names = list(dims)
    rows = materialize(rows, "coordinates")
    splits: dict[int, tuple[str, int, int, int]] = {}  # node: dimension, coordinate, nodes on either side
    leaves = {0: (0, count)}  # node: its shards from, to

    def place(at: int, leaf: dict[int, int] | None = None) -> Column:
        if at not in splits:
            return F.lit(leaf[at] if leaf else at)
        dim, cut, left, right = splits[at]
        return F.when(F.col(dim) <= cut, place(left, leaf)).otherwise(place(right, leaf))

    while n_rows and (wide := [k for k, (a, b) in leaves.items() if b - a > 1]):
        placed = rows.withColumn("node", place(0)).where(F.col("node").isin(*wide))
        spread = {r.node: r for r in placed.groupBy("node").agg(F.sum("size").alias("w"), *[(F.max(d) - F.min(d)).alias(d) for d in names]).collect()}
        pick = {k: max(names, key=lambda d: spread[k][d] >> BINS) for k in wide if k in spread}
        goals = {k: float(spread[k].w) * ((leaves[k][1] - leaves[k][0]) // 2) / (leaves[k][1] - leaves[k][0]) for k in pick}
        cuts = _cuts(rows, place(0), pick, goals, tolerance * total / count)
        for k in wide:
            a, b = leaves.pop(k)
            if k not in cuts:  # fewer rows than shards: it stays empty
                leaves[k] = (a, a + 1)
                continue
            left = 2 * len(splits) + 1
            splits[k] = (pick[k], cuts[k], left, left + 1)
            leaves[left], leaves[left + 1] = (a, a + (b - a) // 2), (a + (b - a) // 2, b)
    rows = rows.withColumn("shard", place(0, {k: a for k, (a, _) in leaves.items()}))
    parts = max(1, -(-n_rows // (count * SLOTS)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    counts = counts.select("shard", "part", before.alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    return rows.withColumn("own", own).join(counts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("own") + F.col("before")).cast("long").alias("slot")
    )

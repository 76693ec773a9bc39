"""Joins: lookup, resume, one-to-one and scored matching, containment, set comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstack.operators.components import cut

def lookup(df: DataFrame, dim: DataFrame, key: str, value: str) -> DataFrame:
    """df with `value` of dim; rows without a match stay, with status `failed`."""
    found = df.join(dim.select(key, value), key, "left")
    return found.withColumn("status", F.when(F.col(value).isNull(), "failed").otherwise("ok"))


def todo(targets: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Targets that aren't done yet."""
    return targets.join(done.select(key), key, "left_anti")


def survivors(targets: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    return targets.join(kept.select(key), key, "left_semi")


def numbered(df: DataFrame, keys: Sequence[str], order: str, turn: str) -> DataFrame:
    """df with the number of each row among those of its keys, from 1 in the given order; rows with a null key are left out.

    Rows are dealt out by ranges of the order, numbered within (keys, range), and
    moved on by the rows of the ranges before, so that no window holds all rows
    of one key.
    """
    known = df.dropna(subset=list(keys))
    x = cut(known.repartitionByRange(order).withColumn("_range", F.spark_partition_id()))
    sizes = x.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(*keys, "_range", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(order))
    return x.withColumn("_place", place).join(offsets, [*keys, "_range"]).withColumn(turn, (F.col("_place") + F.col("_before")).cast("long")).drop("_range", "_place", "_before")


def tiered_match(left: DataFrame, right: DataFrame, id_col: str, tiers: Sequence[Sequence[str]], names: Sequence[str]) -> DataFrame:
    """One-to-one pairs by the first tier of keys on which both sides have a row left, and the leftovers.

    Returns left_id, right_id and tier (`left_only` or `right_only` for rows
    without a partner). Within a key rows pair up in order of id. A tier takes
    all its pairs before the next one starts, so the result doesn't depend on
    the order of rows.
    """
    pairs = None
    for keys, name in zip(tiers, names, strict=True):
        a = numbered(left, keys, id_col, "_turn").select(*keys, "_turn", F.col(id_col).alias("left_id"))
        b = numbered(right, keys, id_col, "_turn").select(*keys, "_turn", F.col(id_col).alias("right_id"))
        found = a.join(b, [*keys, "_turn"]).select("left_id", "right_id", F.lit(name).alias("tier"))
        pairs = found if pairs is None else pairs.unionByName(found)
        left = left.join(found.select(F.col("left_id").alias(id_col)), id_col, "left_anti")
        right = right.join(found.select(F.col("right_id").alias(id_col)), id_col, "left_anti")
    none = F.lit(None).cast("long")
    rest = left.select(F.col(id_col).alias("left_id"), none.alias("right_id"), F.lit("left_only").alias("tier"))
    more = right.select(none.alias("left_id"), F.col(id_col).alias("right_id"), F.lit("right_only").alias("tier"))
    return pairs.unionByName(rest).unionByName(more)


def unique_candidate(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Keys with exactly one candidate, and its id."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(id_col).alias(id_col)).where("n = 1").drop("n")


def missing_anchors(anchors: DataFrame, texts: DataFrame, key: str, anchor: str, text: str, place: str) -> DataFrame:
    """Anchors that their document's texts, joined in order, don't contain."""
    whole = texts.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place, text))), lambda x: x[text]), "\n").alias("_whole"))
    return anchors.join(whole, key, "left").where(~F.coalesce(F.contains("_whole", anchor), F.lit(False))).drop("_whole")


def select_todo(targets: DataFrame, done: DataFrame, key: str, only: Sequence[str] = (), redo: bool = False, limit: int = 0) -> DataFrame:
    """Targets not done (all if `redo`) whose key holds any of the substrings, if there are any; with a limit the first by key."""
    out = targets if redo else todo(targets, done, key)
    wanted = [s for s in only if s]
    if wanted:
        out = out.where(F.exists(F.array(*map(F.lit, wanted)), lambda s: F.col(key).contains(s)))
    return out.orderBy(key).limit(limit) if limit else out


def best_table(chunks: DataFrame, inventory: DataFrame, least: int = 12) -> DataFrame:
    """The best scored inventory table of each chunk in its document, if it scores enough.

    chunks: doc_id, chunk_id, content. inventory: doc_id, place, headers, body
    (arrays). Score: 10 a header found, 3 a body cell found, 2 if the headers'
    length is 0.75 to 1.05 of the length of those found.
    """
    both = chunks.join(inventory, "doc_id")
    has = lambda cells: F.filter(cells, lambda x: (x != "") & F.contains("content", x))
    size = lambda cells: F.aggregate(cells, F.lit(0), lambda n, x: n + F.length(x))
    share = size(F.col("headers")) / F.greatest(size(has("headers")), F.lit(1))
    score = 10 * F.size(has("headers")) + 3 * F.size(has("body")) + F.when(share.between(0.75, 1.05), 2).otherwise(0)
    scored = both.withColumn("score", score).where(F.col("score") >= least)
    return scored.groupBy("doc_id", "chunk_id").agg(F.max_by(F.struct("place", "score"), F.struct("score", -F.col("place"))).alias("best")).select("doc_id", "chunk_id", "best.*")


def pair_verdict(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Which documents of a folder are copies of its image groups.

    docs: dir, stem, pages (null: unread). groups: dir, base, size. A document
    is dropped if the group of its stem has its number of pages, or if it is the
    only one of its folder, or has a group of its stem, and the folder's groups
    together have its number. With such a hint but no such number it stays, for review.
    """
    folders = groups.groupBy("dir").agg(F.sum("size").alias("total"))
    alone = docs.groupBy("dir").agg(F.count("*").alias("n_docs"))
    own = groups.groupBy("dir", F.col("base").alias("stem")).agg(F.max("size").alias("size"))
    x = docs.join(own, ["dir", "stem"], "left").join(folders, "dir", "left").join(alone, "dir")
    hint = F.col("size").isNotNull() | (F.col("n_docs") == 1)
    drop = (F.col("pages") == F.col("size")) | (hint & (F.col("pages") == F.col("total")))
    verdict = F.when(F.col("total").isNull(), "keep").when(F.coalesce(drop, F.lit(False)), "drop").when(hint, "review").otherwise("keep")
    return x.withColumn("verdict", verdict)


def compare_sets(expected: Column, found: Column) -> tuple[Column, Column, Column]:
    """(equal, missing sorted, unexpected sorted) of two arrays taken as sets."""
    missing, extra = F.array_sort(F.array_except(expected, found)), F.array_sort(F.array_except(found, expected))
    return (F.size(missing) == 0) & (F.size(extra) == 0), missing, extra


def merged_keywords(old: Column, new: Column) -> tuple[Column, Column]:
    """(changed, keywords): nothing changes if all new ones are there; else the union in order."""
    return F.size(F.array_except(new, old)) > 0, F.array_distinct(F.concat(old, new))


def upsert(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows replace those of the same key."""
    return existing.join(new.select(key), key, "left_anti").unionByName(new)


def patch(existing: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Only the non-null fields of changes are written."""
    fields = [c for c in existing.columns if c != key]
    new = changes.select(key, *[F.col(c).alias(f"_{c}") for c in fields if c in changes.columns])
    joined = existing.join(new, key, "left")
    return joined.select(key, *[F.coalesce(f"_{c}", c).alias(c) if c in changes.columns else F.col(c) for c in fields])


def before_after(before: DataFrame, after: DataFrame, key: str, passed: str) -> DataFrame:
    """Full outer comparison of two runs with a label for each change."""
    x = before.select(key, F.col(passed).alias("before")).join(after.select(key, F.col(passed).alias("after")), key, "full_outer")
    label = F.when(F.col("before").isNull(), "new").when(F.col("after").isNull(), "gone").when(F.col("before") == F.col("after"), "same").when(F.col("after"), "fixed").otherwise("broken")
    return x.withColumn("change", label)

"""Fuzzy joins of names by the share of their common blocks.

The ratio of two names is 2 M / (len a + len b), where M counts the characters
of their longest common block (the earliest in a, then in b) and, likewise, of
the stretches before and behind it. Names are joined on pairs of their rarest
characters, so that no pair of enough likeness is missed and no single
character's names meet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Names of one key that are compared in one task; a more frequent key is compared in blocks.
KEY_ROWS = 2_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), the value being computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def longest_block(a: Column, b: Column) -> Column:
    """struct(size, at) of the longest block of characters that a and b share, the earliest in a; size 0 if none.

    One pass over a: at each place the best block so far is made longer while b contains it.
    """
    start = F.struct(F.lit(1).alias("i"), F.lit(0).alias("size"), F.lit(1).alias("at"))

    def step(s: Column, _: Column) -> Column:
        longer = (s["i"] + s["size"] <= F.length(a)) & F.contains(b, F.substr(a, s["i"], s["size"] + 1))
        hit = F.struct(s["i"].alias("i"), (s["size"] + 1).alias("size"), s["i"].alias("at"))
        return F.when(longer, hit).otherwise(F.struct((s["i"] + 1).alias("i"), s["size"].alias("size"), s["at"].alias("at")))

    return F.aggregate(F.sequence(F.lit(1), F.length(a) + F.least(F.length(a), F.length(b)) + 1), start, step, lambda s: F.struct(s["size"].alias("size"), s["at"].alias("at")))


def block_chars(a: Column, b: Column) -> Column:
    """How many characters lie in common blocks: the longest one, then the same on either side of it.

    Stretches still to be compared are kept on a stack; each block found adds two at most.
    """
    pair = lambda x, y: F.struct(x.alias("a"), y.alias("b"))
    start = F.struct(F.array(pair(a, b)).alias("stack"), F.lit(0).alias("total"))

    def split(s: Column, top: Column, found: Column) -> Column:
        rest = F.slice(s["stack"], F.lit(1), F.size(s["stack"]) - 1)
        place = F.position(F.substr(top["a"], found["at"], found["size"]), top["b"])
        sides = F.array(
            pair(F.substr(top["a"], F.lit(1), found["at"] - 1), F.substr(top["b"], F.lit(1), place - 1)), pair(F.substr(top["a"], found["at"] + found["size"]), F.substr(top["b"], place + found["size"]))
        )
        more = F.filter(sides, lambda p: (p["a"] != "") & (p["b"] != ""))
        stack = F.when(found["size"] > 0, F.concat(rest, more)).otherwise(rest)
        return F.struct(stack.alias("stack"), (s["total"] + found["size"]).alias("total"))

    def step(s: Column, _: Column) -> Column:
        top = F.element_at(s["stack"], -1)
        return F.when(F.size(s["stack"]) == 0, s).otherwise(_let(longest_block(top["a"], top["b"]), lambda found: split(s, top, found)))

    return F.aggregate(F.sequence(F.lit(1), 2 * F.least(F.length(a), F.length(b)) + 1), start, step, lambda s: s["total"])


def block_ratio(a: Column, b: Column) -> Column:
    """2 M / (len a + len b); 1 for two empty names."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 1.0).otherwise(2 * block_chars(a, b) / total)


def least_common(n: Column, m: Column, ratio: float) -> Column:
    """How many characters names of n and m characters have in common at least, if their ratio is enough (a rounding error is forgiven)."""
    return F.ceil(ratio * (n + m) / 2 - 1e-9)


def keyed(names: DataFrame, ratio: float) -> DataFrame:
    """Rows of names with kind, key and first: keys on which names meet all others of at least the ratio.

    names: distinct k, not empty, and other columns. A name's characters, each with its number among
    its equals, are ordered from the rarest on. Two names with c of them in
    common have two common ones among the first n - c + 2 of either, for the
    least c that any partner's length allows; each pair of those is a key. Names so
    short that one common character may do meet on single ones too (kind 1).
    `first` holds the characters that the pairs are taken from.
    """
    letters = F.filter(F.split("k", ""), lambda c: c != "")
    numbered = F.transform(letters, lambda c, i: F.concat(c, F.size(F.filter(F.slice(letters, F.lit(1), i + 1), lambda d: d == c)).cast("string")))
    chars = names.select("*", F.explode(numbered).alias("token"))
    rare = chars.groupBy("token").agg(F.count("*").alias("df"))  # no more rows than there are characters, times the repeats in a name
    own = names.columns
    bags = chars.join(rare, "token").groupBy(*own).agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "token"))), lambda x: x["token"]).alias("tokens"))
    n = F.size("tokens")
    c = F.greatest(F.lit(2), least_common(n, F.ceil(ratio * n / (2 - ratio) - 1e-9), ratio))
    first = F.slice("tokens", F.lit(1), F.greatest(n - c + 2, F.lit(0)).cast("int"))
    pairs = lambda t: F.flatten(F.transform(t, lambda x, i: F.transform(F.slice(t, i + 2, F.size(t)), lambda y: F.concat(x, F.lit("\x00"), y))))
    single = F.when(n <= 2 / ratio - 1, F.col("tokens")).otherwise(F.array().cast("array<string>"))
    parts = bags.select(*own, first.alias("first"), single.alias("single"))
    as_kind = lambda keys, kind: F.transform(keys, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("key")))
    found = parts.select(*own, "first", "single", F.explode(F.concat(as_kind(pairs(F.col("first")), 2), as_kind(F.col("single"), 1))).alias("x"))
    return found.select(*own, "x.kind", "x.key", F.when(F.col("x.kind") == 2, F.col("first")).otherwise(F.col("single")).alias("first"))


def near_pairs(names: DataFrame, pool: DataFrame, ratio: float) -> DataFrame:
    """(k, other, score) of all distinct names k and pool names with a block ratio of at least `ratio` (above 0).

    A pair is compared once, at the first key that both have. Keys of more than
    KEY_ROWS names are compared in blocks, so no task holds all names of one.
    """
    sides = names.select("k", F.lit(True).alias("asks"), F.lit(False).alias("offers")).union(pool.select("k", F.lit(False), F.lit(True)))
    keys = keyed(sides.where("k <> ''").groupBy("k").agg(F.max("asks").alias("asks"), F.max("offers").alias("offers")), ratio)
    x = keys.where("asks").drop("asks", "offers")
    y = keys.where("offers").drop("asks", "offers").withColumnsRenamed({"k": "other", "first": "other_first"})
    crowded = x.groupBy("kind", "key").agg(F.count("*").alias("n")).where(F.col("n") > KEY_ROWS).select("kind", "key", F.ceil(F.col("n") / KEY_ROWS).cast("int").alias("blocks"))
    blocks = F.coalesce("blocks", F.lit(1))
    x = x.join(crowded, ["kind", "key"], "left").select("kind", "key", F.pmod(F.xxhash64("k"), blocks).cast("int").alias("block"), "k", "first")
    y = y.join(crowded, ["kind", "key"], "left").select("kind", "key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "other", "other_first")
    n, m = F.length("k"), F.length("other")
    common = F.array_intersect("first", "other_first")
    once = F.when(F.col("kind") == 2, F.concat(common[0], F.lit("\x00"), common[1]) == F.col("key")).otherwise((n + m <= 2 / ratio) & (common[0] == F.col("key")))
    long = F.when(F.col("kind") == 2, n + m > 2 / ratio).otherwise(True)
    met = x.join(y, ["kind", "key", "block"]).where((2 * F.least(n, m) >= ratio * (n + m) - 1e-9) & long & once).select("k", "other")
    bag = lambda c: F.split(c, "")
    # the count of common characters bounds that of characters in common blocks
    enough = F.aggregate(F.array_distinct(F.filter(bag("k"), lambda z: z != "")), F.lit(0), lambda t, z: t + F.least(F.size(F.filter(bag("k"), lambda w: w == z)), F.size(F.filter(bag("other"), lambda w: w == z)))) >= least_common(n, m, ratio)
    return met.where(enough).withColumn("score", block_ratio(F.col("other"), F.col("k"))).where(F.col("score") >= ratio - 1e-12)


def close_names(names: DataFrame, pool: DataFrame, key: Column | None = None, ratio: float = 0.6, top: int = 3) -> DataFrame:
    """For each name the pool's names of equal key, else its `top` closest names, the best first, ties by the greater name.

    names, pool: id and name; key: a normalised form (the name itself if not
    given). Returns id, match_id, score (1 if the keys are equal) and rank. Equal
    pool names count as one, of the least id; null and empty names match nothing.
    """
    key = F.col("name") if key is None else key
    a = names.where("name <> ''").select("id", F.col("name").alias("k"), key.alias("norm"))
    b = pool.where("name <> ''").groupBy(F.col("name").alias("other"), key.alias("norm")).agg(F.min("id").alias("match_id"))
    equal = a.join(b, "norm").select("id", "k", "other", "match_id", F.lit(1.0).alias("score"))
    rest = a.join(equal.select("id"), "id", "left_anti")
    near = near_pairs(rest, b.select(F.col("other").alias("k")), ratio)
    # a name's best few are found once for all rows of that name
    turn = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("score"), F.desc("other")))
    best = near.withColumn("rank", turn).where(F.col("rank") <= top).join(b.select("other", "match_id"), "other")
    found = rest.select("id", "k").join(best, "k").select("id", "match_id", "score", "rank")
    order = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("other")))
    return equal.withColumn("rank", order).select("id", "match_id", "score", "rank").unionByName(found)


def matched_names(names: DataFrame, pool: DataFrame, key: Column, stem: Column, name_ratio: float = 0.6, stem_ratio: float = 0.7, top: int = 3) -> DataFrame:
    """close_names by name, then by stem for names still without a match: id, match_id, score, rank and tier (equal, name, stem)."""
    by_name = close_names(names, pool, key, name_ratio, top).withColumn("tier", F.when(F.col("score") == 1, "equal").otherwise("name"))
    left = names.join(by_name.select("id"), "id", "left_anti")
    by_stem = close_names(left.withColumn("name", stem), pool.withColumn("name", stem), None, stem_ratio, top).withColumn("tier", F.lit("stem"))
    return by_name.unionByName(by_stem)

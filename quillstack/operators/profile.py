"""Grouped statistics: lengths, nearest-rank percentiles, histograms, priority buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def nearest_ranks(df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Per group: n, min, max, mean and the element at index floor(n * q) of the sorted values.

    Values are counted first, so a group's window holds its distinct values and
    not its rows; nothing is collected into an array.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    group = Window.partitionBy(*keys)
    upto = F.sum("_c").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.withColumns({"_upto": upto, "_n": F.sum("_c").over(group)})
    picks = [F.min(F.when(F.col("_upto") > F.floor(F.col("_n") * q), F.col(value))).alias(name) for name, q in quantiles.items()]
    return ranked.groupBy(*keys).agg(
        F.sum("_c").alias("n"), F.min(value).alias("min"), *picks, F.max(value).alias("max"), F.round(F.sum(F.col(value) * F.col("_c")) / F.sum("_c"), 1).alias("mean")
    )


def length_stats(df: DataFrame, length: Column) -> DataFrame:
    """One row: count, mean rounded to one place, min and max; zeros when empty."""
    zero = F.lit(0)
    x = df.select(length.alias("x"))
    return x.agg(F.count("x").alias("n"), F.coalesce(F.round(F.avg("x"), 1), F.lit(0.0)).alias("mean"), F.coalesce(F.min("x"), zero).alias("min"), F.coalesce(F.max("x"), zero).alias("max"))


def histogram(df: DataFrame, key: Column, name: str) -> DataFrame:
    """Rows by key, most frequent first, ties by key; a null key counts as `?`."""
    return df.groupBy(F.coalesce(key.cast("string"), F.lit("?")).alias(name)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name)


def first_bucket(buckets: Sequence[tuple[str, Column]], other: str) -> Column:
    """The name of the first predicate that holds."""
    out = F.when(buckets[0][1], buckets[0][0])
    for name, holds in buckets[1:]:
        out = out.when(holds, name)
    return out.otherwise(other)


def repeated_heads(df: DataFrame, text: str, length: int = 80, least: int = 3, top: int = 8) -> DataFrame:
    """Starts of texts that occur often, most frequent first."""
    return df.groupBy(F.left(text, F.lit(length)).alias("head")).agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "head").limit(top)


def pattern_errors(df: DataFrame, text: str, patterns: Mapping[str, str]) -> DataFrame:
    """df with the number of errors, of kinds and a tier: heavy (over 10, or 4 kinds), medium (over 3), light, none."""
    counts = {k: F.regexp_count(text, F.lit(p)) for k, p in patterns.items()}
    total = sum(counts.values(), F.lit(0))
    kinds = sum(((c > 0).cast("int") for c in counts.values()), F.lit(0))
    tier = F.when((total > 10) | (kinds >= 4), "heavy").when(total > 3, "medium").when(total > 0, "light").otherwise("none")
    return df.withColumns({"errors": total, "kinds": kinds, "tier": tier})


def pass_rates(df: DataFrame, category: str, passed: Column) -> DataFrame:
    """Per category: total, passes and the rounded percentage, most passes first."""
    out = df.groupBy(category).agg(F.count("*").alias("total"), F.count_if(passed).alias("passes"))
    return out.withColumn("percent", F.round(100.0 * F.col("passes") / F.col("total"), 0).cast("long")).orderBy(F.desc("passes"), category)


def coverage(df: DataFrame, key: Column, name: str, same: Column) -> DataFrame:
    """Per key: total, identical, changed and the share of identical rows in percent."""
    out = df.groupBy(key.alias(name)).agg(F.count("*").alias("total"), F.count_if(same).alias("identical"))
    return out.withColumns({"changed": F.col("total") - F.col("identical"), "percent": F.round(100.0 * F.col("identical") / F.col("total"), 1)})

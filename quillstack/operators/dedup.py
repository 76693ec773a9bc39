"""Exact and rule-based duplicate marking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mark_exact(df: DataFrame, keys: list[str], order: list[Column], id_col: str) -> DataFrame:
    """Adds `canonical_id` (first row of the key group by `order`) and `is_duplicate`.

    The canonical row is found with a partially aggregated `min_by`, so a key
    that holds a third of all rows never gathers in one task; the join back is
    split by AQE if such a key is skewed. Rows with a null key are canonical.
    """
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    first = df.groupBy(*keys).agg(F.min_by(id_col, rank).alias("canonical_id"))
    joined = df.join(first, keys, "left")
    own = F.coalesce("canonical_id", F.col(id_col))
    return joined.withColumns({"canonical_id": own, "is_duplicate": ~own.eqNullSafe(F.col(id_col))})


def by_cheap_key(df: DataFrame, cheap: list[str], costly: list[str], order: list[Column], id_col: str) -> DataFrame:
    """Duplicates by cheap keys first, then by costly ones among the rows that share them: row and `kept_id`."""
    shared = df.groupBy(*cheap).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    marked = mark_exact(df.join(shared, cheap, "left_semi"), [*cheap, *costly], order, id_col)
    return marked.where("is_duplicate").withColumnRenamed("canonical_id", "kept_id")

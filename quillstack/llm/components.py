"""Distributed union-find: connected components of an edge table.

Each round replaces every edge by edges to the least neighbour seen at its ends
(the two star operations that alternate until every vertex points at its
component's least vertex). A hub's edges are summed to a minimum before they
are shuffled, every round is written to the shared folder, and no link or
component reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstack.llm.common import materialize


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges (a, b), any direction, repeats and loops allowed, as (node, component): the least node reachable.

    Only nodes of an edge between two different nodes are returned; edges with a null end are left out.
    """
    links = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialize(links, "links")
    for _ in range(most_rounds):
        # done when every edge leads to the least node of a star: no node with a lesser neighbour has a greater one
        # or a second lesser one
        ends = links.select("a", F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(links.select(F.col("b").alias("a"), F.lit(0).alias("low"), F.lit(1).alias("high")))
        ties = ends.groupBy("a").agg(F.sum("low").alias("low"), F.max("high").alias("high"))
        if not ties.agg(F.count_if(F.col("low") + F.col("high") * F.least("low", F.lit(1)) > 1)).first()[0]:
            break
        # large star: neighbours above a node are tied to the least of its neighbourhood
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: neighbours below a node, and itself, to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        links = materialize(small, "links")
    else:
        raise RuntimeError(f"no fixpoint after {most_rounds} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )

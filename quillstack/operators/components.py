"""Connected components of pairs, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstack.session import shared_root


def cut(df: DataFrame) -> DataFrame:
    """df without its lineage, written to the shared folder of spark.checkpoint.dir."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def components(pairs: DataFrame, most_rounds: int = 50) -> DataFrame:
    """pairs (a, b) as (node, root): the least node that is reachable, for every node of a pair; nulls are left out.

    Each round gives a node the least root among its neighbours' and then that
    root's own, so a chain of n nodes takes about log n rounds. Minima are
    taken before rows are shuffled; no join is a broadcast, so only a count
    reaches the driver.
    """
    known = pairs.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    links = cut(known.select("a", "b").union(known.select("b", "a")).distinct())
    roots = links.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root"))
    roots = cut(roots)
    for _ in range(most_rounds):
        # the least root around a node, which is also proposed to the node's own root
        around = links.join(roots.withColumnsRenamed({"node": "b"}).hint("merge"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("seen"))
        seen = roots.join(around.hint("merge"), "node").withColumn("best", F.least("root", "seen"))
        hooks = seen.select("node", "best").union(seen.select(F.col("root").alias("node"), "best")).groupBy("node").agg(F.min("best").alias("root"))
        jump = hooks.select(F.col("node").alias("root"), F.col("root").alias("up"))
        new = hooks.join(jump.hint("merge"), "root", "left").select("node", F.least("root", F.coalesce("up", "root")).alias("root"))
        new = cut(new)
        changed = new.join(roots.withColumnRenamed("root", "old").hint("merge"), "node").where("root <> old").limit(1).count()
        roots = new
        if not changed:
            return roots
    raise RuntimeError(f"no fixpoint after {most_rounds} rounds")

"""Undirected weighted property graphs as node and edge tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstack.functions import text
from quillstack.operators.components import components

SEP = "<SEP>"


def merge_edges(edges: DataFrame) -> DataFrame:
    """One edge for each unordered pair: weights summed (null or 0 counts as 1), rounded to 2; loops dropped."""
    weight = F.when(F.coalesce("weight", F.lit(0.0)) == 0, 1.0).otherwise(F.col("weight"))
    pair = edges.where(F.col("source") != F.col("target")).select(F.least("source", "target").alias("source"), F.greatest("source", "target").alias("target"), weight.alias("weight"))
    return pair.groupBy("source", "target").agg(F.round(F.sum("weight"), 2).alias("weight"), F.count("*").alias("n"))


def merge_nodes(entities: DataFrame) -> DataFrame:
    """entities (name, type, description, doc_id, pos): the most frequent type (first seen on ties), descriptions and documents as sorted sets."""
    types = entities.groupBy("name", "type").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "pos")).alias("first"))
    # the least struct has the most rows, then the earliest place
    best = types.groupBy("name").agg(F.min_by("type", F.struct(-F.col("n"), "first")).alias("type"))
    rest = entities.groupBy("name").agg(F.array_join(F.array_sort(F.collect_set("description")), SEP).alias("description"), F.array_sort(F.collect_set("doc_id")).alias("sources"))
    return best.join(rest, "name")


def merge_relations(edges: DataFrame) -> DataFrame:
    """edges (source, target, predicate, keywords, weight, description, doc_id, pos) as one for each unordered pair.

    Weights are summed (null or 0 counts as 1) and rounded to 2; the predicate
    is that of the first by doc_id and pos; keywords, descriptions (each of which
    may hold several, joined by SEP) and documents are sorted sets. Loops go.
    """
    weight = F.when(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)) == 0, 1.0).otherwise(F.col("weight").cast("double"))
    pair = edges.where(F.col("source") != F.col("target")).withColumns({"weight": weight, "a": F.least("source", "target"), "b": F.greatest("source", "target")})
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    parts = F.split(F.coalesce("description", F.lit("")), SEP)
    return pair.groupBy(F.col("a").alias("source"), F.col("b").alias("target")).agg(
        F.round(F.sum("weight"), 2).alias("weight"), F.min_by("predicate", F.struct("doc_id", "pos")).alias("predicate"), union("keywords").alias("keywords"),
        F.array_join(union(parts), SEP).alias("description"), F.array_sort(F.collect_set("doc_id")).alias("sources"),
    )


def merge_documents(entities: DataFrame, relations: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) over all documents, names replaced by their aliases (name, canonical).

    entities: name, type, description, doc_id, pos: a node's type is that of its
    first mention. Edges are merged as by merge_relations, and kept if both ends are nodes.
    """
    names = aliases.select("name", "canonical")
    called = entities.join(names, "name", "left").withColumn("name", F.coalesce("canonical", "name"))
    parts = F.split(F.coalesce("description", F.lit("")), SEP)
    nodes = called.groupBy("name").agg(
        F.min_by("type", F.struct("doc_id", "pos")).alias("type"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(parts)))), SEP).alias("description"), F.array_sort(F.collect_set("doc_id")).alias("sources")
    )
    for end in ("source", "target"):
        relations = relations.join(names.select(F.col("name").alias(end), "canonical"), end, "left").withColumn(end, F.coalesce("canonical", end)).drop("canonical")
    return nodes, inside(merge_relations(relations), nodes)


def both_ways(edges: DataFrame) -> DataFrame:
    """Every edge from either end: node, other, weight."""
    there = edges.select(F.col("source").alias("node"), F.col("target").alias("other"), "weight")
    return there.unionByName(edges.select(F.col("target").alias("node"), F.col("source").alias("other"), "weight"))


def degree(edges: DataFrame) -> DataFrame:
    return both_ways(edges).groupBy("node").agg(F.count("*").alias("degree"))


def neighbours(edges: DataFrame) -> DataFrame:
    """Summed weight of each node's neighbours, itself left out."""
    return both_ways(edges).where(F.col("node") != F.col("other")).groupBy("node", "other").agg(F.round(F.sum("weight"), 2).alias("weight"))


def see_also(edges: DataFrame, top: int = 6, existing: DataFrame | None = None) -> DataFrame:
    """The heaviest linkable neighbours of each node that it doesn't link yet; ties by name."""
    found = neighbours(edges).where(text.linkable(F.col("other")))
    if existing is not None:
        found = found.join(existing, ["node", "other"], "left_anti")
    turn = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("weight"), "other"))
    return found.withColumn("rank", turn).where(F.col("rank") <= top)


def inside(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose ends are both nodes."""
    names = nodes.select(F.col("name").alias("_name"))
    return edges.join(names, F.col("source") == F.col("_name"), "left_semi").join(names, F.col("target") == F.col("_name"), "left_semi")


def contract(edges: DataFrame, aliases: DataFrame) -> DataFrame:
    """Edges with their ends replaced by aliases (name, canonical), merged anew."""
    for end in ("source", "target"):
        names = aliases.select(F.col("name").alias(end), F.col("canonical").alias("_canonical"))
        edges = edges.join(names, end, "left").withColumn(end, F.coalesce("_canonical", end)).drop("_canonical")
    return merge_edges(edges)


def canonical(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(name, canonical, turn) of all nodes: names linked by alias pairs (a, b), in any direction and over any chain, are one.

    nodes: name and place. The first of a group by place, then name, is canonical;
    turn numbers the group's nodes from 0 in that order. Pairs of a name that is
    no node still link their other ends, as long as one node is in the group.
    """
    roots = components(pairs).withColumnRenamed("node", "name").hint("merge")
    x = nodes.select("name", "place").join(roots, "name", "left").withColumn("root", F.coalesce("root", "name"))
    first = x.groupBy("root").agg(F.min(F.struct("place", "name")).alias("first")).hint("merge")
    order = Window.partitionBy("root").orderBy("place", "name")
    return x.join(first, "root").select("name", F.col("first.name").alias("canonical"), (F.row_number().over(order) - 1).alias("turn"))


def merge_aliases(nodes: DataFrame, edges: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) with linked nodes merged into the first of their group.

    nodes: name, place, type, description and sources (an array); edges: source,
    target, weight, description, keywords and sources (arrays), one for each
    unordered pair. A merged node has the type of the first, the descriptions of
    all in order of place, joined by SEP, and the sorted union of their sources.
    Edges within a group go; edges that come to join the same two nodes are one:
    weights summed, descriptions in the order of the merged nodes (that of the
    lesser end, then of the greater one), keywords and sources as sorted unions.
    Edges with an end that is no node go, too.
    """
    called = canonical(nodes, pairs)
    # names are as many as nodes, and larger in memory than their tables: none of these joins is a broadcast
    x = nodes.join(called.hint("merge"), "name")
    in_order = lambda value, *by: F.transform(F.array_sort(F.collect_list(F.struct(*by, value.alias("_value")))), lambda r: r["_value"])
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(c, F.array().cast("array<string>"))))))
    said = lambda c: F.coalesce(c, F.lit(""))
    merged = x.groupBy(F.col("canonical").alias("name")).agg(
        F.min_by("type", "turn").alias("type"), F.array_join(in_order(said(F.col("description")), "turn"), SEP).alias("description"), union(F.col("sources")).alias("sources"),
        F.min("place").alias("place"), F.count("*").cast("int").alias("merged"),
    )
    for end in ("source", "target"):
        names = called.select(F.col("name").alias(end), F.col("canonical").alias(f"_{end}"), F.col("turn").alias(f"_{end}_turn"))
        edges = edges.join(names.hint("merge"), end)
    low = F.col("_source") < F.col("_target")
    e = edges.where("_source <> _target").select(
        F.least("_source", "_target").alias("_a"), F.greatest("_source", "_target").alias("_b"),
        F.when(low, F.col("_source_turn")).otherwise(F.col("_target_turn")).alias("_t"), F.when(low, F.col("_target_turn")).otherwise(F.col("_source_turn")).alias("_u"),
        F.when(F.coalesce(F.col("weight"), F.lit(0.0)) == 0, 1.0).otherwise(F.col("weight")).alias("weight"), "description", "keywords", "sources",
    )
    joined = e.groupBy(F.col("_a").alias("source"), F.col("_b").alias("target")).agg(
        F.round(F.sum("weight"), 2).alias("weight"), F.array_join(in_order(said(F.col("description")), "_t", "_u"), SEP).alias("description"), union(F.col("keywords")).alias("keywords"), union(F.col("sources")).alias("sources")
    )
    return merged, joined


def reverse_index(edges: DataFrame, types: DataFrame, source_type: str, target_type: str) -> DataFrame:
    """(key, values): for each node of the one type its neighbours of the other, distinct and sorted, in either direction."""
    kind = types.select("name", F.lower("type").alias("kind"))
    both = both_ways(edges.withColumn("weight", F.lit(1.0)) if "weight" not in edges.columns else edges)
    x = both.join(kind.where(F.col("kind") == source_type.lower()).select(F.col("name").alias("node")), "node", "left_semi")
    x = x.join(kind.where(F.col("kind") == target_type.lower()).select(F.col("name").alias("other")), "other", "left_semi")
    return x.groupBy(F.col("node").alias("key")).agg(F.array_sort(F.collect_set("other")).alias("values"))


def link_graph(pages: DataFrame, targets: Column) -> DataFrame:
    """Distinct (source, target) of pages (name) and an array of link targets; no page links itself."""
    return pages.select(F.col("name").alias("source"), F.explode(F.array_distinct(targets)).alias("target")).where("source <> target").distinct()


def prioritised(nodes: DataFrame, edges: DataFrame, unit: str, most: int | None = None) -> DataFrame:
    """Nodes by type (those of type `unit` first), degree (highest first) and name."""
    x = nodes.join(degree(edges).withColumnRenamed("node", "name"), "name", "left").fillna(0, ["degree"])
    x = x.orderBy(F.lower("type") != unit.lower(), F.desc("degree"), "name")
    return x if most is None else x.limit(most)


def timeline(incident: DataFrame, words: Sequence[str]) -> DataFrame:
    """incident (node, other, predicate, description, weight): each node's edges in order of year, then weight.

    If any edge of a node has one of the words in its predicate only those are
    taken; edges without a year come last.
    """
    year = F.coalesce(*[F.regexp_extract(c, r"(20\d{2}|19\d{2})", 1).try_cast("int") for c in ("description", "other")])
    hit = F.exists(F.array(*[F.lit(w.lower()) for w in words]), lambda w: F.lower("predicate").contains(w)) if words else F.lit(True)
    x = incident.where(text.linkable(F.col("other"))).withColumns({"year": year, "hit": F.coalesce(hit, F.lit(False))})
    any_hit = x.groupBy("node").agg(F.bool_or("hit").alias("any_hit"))
    x = x.join(any_hit, "node").where(F.col("hit") | ~F.col("any_hit"))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.col("year").isNull(), "year", F.desc("weight"), "other"))
    return x.withColumn("place", place).drop("hit", "any_hit")


def name_index(nodes: DataFrame) -> DataFrame:
    """Linkable names, longest first."""
    return nodes.where(text.linkable(F.col("name"))).select("name").distinct().orderBy(F.desc(F.length("name")), "name")

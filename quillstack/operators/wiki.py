"""Chunks and pages of a wiki: admissible chunks, sources, caption plans, finished pages, index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstack.functions import text as T
from quillstack.operators import anchors, graph

#: The number of a table, and words before a figure's number that make it a reference.
TABLE_NUMBER = r"表\s*((?:[0-9A-Z]+\s*\.\s*\d+(?:\s*\.\s*\d+)*(?:-\d+)?))"
FIGURE_NUMBER = r"图\s*\d+(?:\.\d+)*(?:-\d+)?"
REFERENCES = r"如|见|按|参照|示于"


def admissible(chunks: DataFrame, least: int = 20) -> DataFrame:
    """Chunks that aren't switched off and have some text."""
    return chunks.where(F.coalesce("available", F.lit(True)) & (F.length(T.strip(F.coalesce("content", F.lit("")))) >= least))


def junk(content: Column) -> Column:
    """Left-overs of spreadsheets without headers."""
    return content.rlike(r"Unnamed: \d") | content.contains("：nan")


def type_mix(chunks: DataFrame) -> DataFrame:
    """Per document and type: chunks, mean length, formulas."""
    kind = F.coalesce("doc_type", F.lit("text"))
    return chunks.groupBy("doc_id", kind.alias("doc_type")).agg(F.count("*").alias("n"), F.round(F.avg(F.length("content")), 1).alias("mean_length"), F.count_if(T.formula_state(F.col("content")) == "latex").alias("formulas"))


def without_blank_pages(groups: DataFrame, blank: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups with their other pages in order, groups of which none is left): groups (group, pages), blank (rel)."""
    pages = groups.select("group", F.posexplode("pages").alias("pos", "rel"))
    left = pages.join(blank.select("rel"), "rel", "left_anti").groupBy("group").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "rel"))), lambda x: x["rel"]).alias("pages"))
    return left, groups.select("group").join(left.select("group"), "group", "left_anti")


def groups_with(pages: DataFrame, marked: Column) -> DataFrame:
    """All pages of the groups of which any is marked; an unknown mark doesn't count."""
    any_ = pages.groupBy("group").agg(F.bool_or(F.coalesce(marked, F.lit(False))).alias("_any")).where("_any").select("group")
    return pages.join(any_, "group", "left_semi")


def source_texts(nodes: DataFrame, chunks: DataFrame, documents: int = 2, each: int = 4, most: int = 12) -> DataFrame:
    """Texts for a page: the first chunks of a node's first documents, in order."""
    docs = nodes.select("name", F.posexplode("sources").alias("place", "doc_id")).where(F.col("place") < documents)
    first = chunks.withColumn("_rn", F.row_number().over(Window.partitionBy("doc_id").orderBy("pos"))).where(F.col("_rn") <= each)
    x = docs.join(first, "doc_id").groupBy("name").agg(F.array_sort(F.collect_list(F.struct("place", "pos", "content"))).alias("_x"))
    return x.select("name", F.slice(F.transform("_x", lambda t: t["content"]), 1, most).alias("texts"))


def title_by_page(chunks: DataFrame, titles: DataFrame) -> DataFrame:
    """The title of the first of a chunk's pages that has one: chunks (id, positions), titles (page, title)."""
    pages = chunks.select("id", F.posexplode(F.transform("positions", lambda p: F.get(p, F.lit(0)))).alias("place", "page"))
    return pages.join(titles, "page").groupBy("id").agg(F.min_by("title", "place").alias("title"))


def recall_keywords(content: Column) -> Column:
    """Number and name of the caption after a table: 表n, n, name, 表n with name; empty without one."""
    tail = F.regexp_replace(F.regexp_extract(content, r"(?s)^.*</table>(.*)$", 1), r"\s+", "")
    number = F.regexp_extract(tail, TABLE_NUMBER, 1)
    name = F.regexp_replace(F.when(number != "", F.regexp_extract(tail, rf"(?s){TABLE_NUMBER}(.*)$", 2)).otherwise(tail), r"^[^一-鿿]+", "")
    name = F.regexp_extract(F.left(name, F.lit(30)), r"^[^（(]*", 0)
    numbered, named = number != "", name != ""
    table = lambda *x: F.concat(F.lit("表"), number, *x)
    return F.array_distinct(F.array_compact(F.array(F.when(numbered, table()), F.when(numbered, number), F.when(named, name), F.when(numbered & named, table(name)))))


def figure_question(content: Column, questions: Column, titles: Column) -> Column:
    """The question that a figure chunk gets, null where it has some already or doesn't start with its own figure.

    titles: map of figure number to title.
    """
    head = F.left(content, F.lit(24))
    number = F.regexp_extract(head, FIGURE_NUMBER, 0)
    before = F.regexp_extract(head, rf"(?s)^(.*?){FIGURE_NUMBER}", 1)
    key = F.regexp_replace(number, r"\s+", "")
    own = (number != "") & (F.length(before) <= 12) & ~before.rlike(REFERENCES) & F.map_contains_key(titles, key)
    title = F.coalesce(F.try_element_at(titles, key), F.lit(""))
    return F.when((F.coalesce(F.size(questions), F.lit(0)) <= 0) & own, F.when(title != "", F.concat(key, F.lit(" "), title)).otherwise(key))


def line_density(pixels: DataFrame, ratio: float = 0.3) -> DataFrame:
    """Per page the share of rows with a long dark run, and of dark pixels: pixels (page, row, dark array<boolean>)."""
    run = F.aggregate("dark", F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), lambda a, d: F.struct(F.when(d, a["now"] + 1).otherwise(0).alias("now"), F.greatest(a["most"], F.when(d, a["now"] + 1).otherwise(0)).alias("most")), lambda a: a["most"])
    x = pixels.select("page", (run > ratio * F.size("dark")).alias("line"), F.size(F.filter("dark", lambda d: d)).alias("filled"), F.size("dark").alias("width"))
    return x.groupBy("page").agg(F.count_if("line").alias("line_rows"), (F.count_if("line") / F.count("*")).alias("density"), (F.sum("filled") / F.sum("width")).alias("fill"))


def table_pages(densities: DataFrame, density: float = 0.03, fill: float = 0.02, rows: int = 40) -> DataFrame:
    return densities.where(((F.col("density") > density) & (F.col("fill") > fill)) | (F.col("line_rows") > rows))


def link_pages(pages: DataFrame, names: DataFrame) -> DataFrame:
    """pages (name, markdown and others) with the first mention of each other linkable name as a link, longer names first, then by name.

    names: name. Pages meet names by anchors.contains_join, so a page carries
    the names that it holds and no others, however many there are. Null texts are empty.
    """
    x = pages.withColumn("markdown", F.coalesce("markdown", F.lit("")))
    wanted = names.where(T.linkable(F.col("name"))).select(F.col("name").alias("_name")).distinct()
    met = anchors.contains_join(x.select(F.col("name").alias("_page"), "markdown"), "markdown", wanted, "_name").where(F.col("_name") != F.col("_page"))
    longest = F.transform(F.array_sort(F.collect_set(F.struct((-F.length("_name")).alias("n"), "_name"))), lambda s: s["_name"])
    own = met.groupBy("_page").agg(longest.alias("_names"))
    x = x.join(own, F.col("name") == F.col("_page"), "left")
    linked = T.linkify(F.col("markdown"), F.coalesce("_names", F.array().cast("array<string>")), F.coalesce("name", F.lit("")))
    return x.withColumn("markdown", linked).drop("_page", "_names")


def finished(pages: DataFrame, names: Sequence[str] | DataFrame, edges: DataFrame, events: DataFrame | None = None, most_events: int = 20) -> DataFrame:
    """pages (name, markdown) with links, a See-also section of new neighbours and, if events are given, a timeline.

    names: names to link, a table (name) of any size or a list. events: as graph.timeline returns them.
    """
    listed = names if isinstance(names, DataFrame) else pages.sparkSession.createDataFrame([(n,) for n in names], "name string")
    x = link_pages(pages.withColumn("markdown", T.strip_section(F.coalesce("markdown", F.lit("")), "see also")), listed)
    have = x.select(F.col("name").alias("node"), F.explode(T.wikilinks(F.col("markdown"))).alias("other"))
    more = graph.see_also(edges, existing=have).groupBy(F.col("node").alias("name")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "other"))), lambda s: F.concat(F.lit("- [["), s["other"], F.lit("]]"))).alias("_more"))
    x = x.join(more, "name", "left")
    parts = [F.rtrim("markdown"), F.when(F.size("_more") > 0, F.concat(F.lit("\n\n## See also\n"), F.array_join("_more", "\n")))]
    if events is not None:
        line = F.concat(F.lit("- "), F.coalesce(F.concat(F.col("year").cast("string"), F.lit("年、")), F.lit("")), F.lit("[["), F.col("other"), F.lit("]]"))
        lines = events.where(F.col("place") <= most_events).groupBy(F.col("node").alias("name")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))), lambda s: s["line"]).alias("_events"), F.bool_or(F.col("year").isNotNull()).alias("_dated"))
        x = x.join(lines, "name", "left")
        parts.append(F.when(F.size("_events") > 0, F.concat(F.when(F.col("_dated"), F.lit("\n\n## 时间线\n")).otherwise(F.lit("\n\n## 事件关联\n")), F.array_join("_events", "\n"))))
    return x.select("name", F.concat_ws("", *parts).alias("markdown"))


def index_rows(nodes: DataFrame, unit: str) -> DataFrame:
    """(type, place, n, name): distinct names under their type, of which the unit's is the first; place numbers types, n counts names.

    A name is a row, so a type may have any number of them; sort by place and name to write the index.
    """
    names = nodes.select("type", "name").where("type is not null and name is not null").distinct()
    types = names.groupBy("type").agg(F.count("*").alias("n"))
    types = types.withColumn("place", F.row_number().over(Window.orderBy(F.col("type") != unit, "type")))  # a row a type
    return names.join(types, "type").select("type", "place", "n", "name")


def matrix(questions: DataFrame, modes: DataFrame, most_modes: int = 100) -> DataFrame:
    """Every question in every mode; modes are few and checked."""
    if (n := modes.count()) > most_modes:
        raise ValueError(f"{n} modes")
    return questions.join(F.broadcast(modes))


def kg_gain(scores: DataFrame) -> DataFrame:
    """hit5 with the graph less hit5 without it, per case: scores (case_id, use_kg, hit5)."""
    hit = lambda on: F.max(F.when(F.col("use_kg") == on, F.col("hit5").cast("int")))
    return scores.groupBy("case_id").agg((F.coalesce(hit(True), F.lit(0)) - F.coalesce(hit(False), F.lit(0))).alias("gain"))

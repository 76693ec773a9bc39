"""Queries over chunks, pages, scans and cases: what a wiki page and an evaluation are made from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstack.functions import text as T
from quillstack.functions import values as V
from quillstack.operators import evaluate, graph, matching, metadata, runs, state, wiki
from quillstack.session import table

LONG = "long"


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def _in_order(*columns: str | Column) -> Column:
    """Aggregate: structs of the columns, sorted."""
    return F.array_sort(F.collect_list(F.struct(*columns)))


def _each(column: str | Column, field: str) -> Column:
    return F.transform(column, lambda x: x[field])


def table_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as chunks, and turns of the same conversation as tables: their first words are headers, the last ones the body."""
    words = F.split("text", " ")
    tables = _turns(spark, sf_dir).select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("place"), F.slice(words, 1, 3).alias("headers"), F.slice(F.reverse(words), 1, 3).alias("body"))
    chunks = _turns(spark, sf_dir).select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk_id"), F.col("text").alias("content"))
    return matching.best_table(chunks, tables).withColumn("score", F.col("score").cast(LONG))


def merged_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user as tables in order: views and purchases continue one of the same number, with or without its header."""
    header = F.when(F.col("value") > 20, "high").otherwise("low")
    cell = F.col("event_id").cast("string")
    x = table(spark, sf_dir, "events").select(
        "user_id", "event_id", (F.floor("value") % 2).alias("number"), F.col("event_type").isin("view", "purchase").alias("is_continued"), header.alias("header"),
        F.when(F.col("event_id") % 3 > 0, F.array(header, cell)).otherwise(F.array(cell)).alias("rows"), F.array("event_id").alias("positions"),
    )
    found = runs.merge_tables(runs.continued(x, "user_id", "event_id"), "user_id", "event_id")
    return found.select("user_id", F.col("run").cast(LONG).alias("run"), F.array_join("rows", "|").alias("rows"), F.array_join("positions", "|").alias("positions"), "parts")


def finished_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as pages that name others: links, neighbours by lines of one order that aren't linked yet, and the orders of their nation's customers as events."""
    supplier = table(spark, sf_dir, "supplier")
    name = lambda c: F.concat(F.lit("Supplier#"), F.lpad(c.cast("string"), 9, "0"))
    said = F.concat(F.lit("# "), "s_name", F.lit("\nnear "), name((F.col("s_suppkey") * 7 + 1) % 50), F.lit(" and "), name((F.col("s_suppkey") * 3 + 2) % 50), F.lit(", NATION_"), F.col("s_nationkey").cast("string"), F.lit(".\n\n## See also\n- [[old]]\n"))
    pages = supplier.select(F.col("s_name").alias("name"), said.alias("markdown"))
    names = supplier.select(F.col("s_name").alias("name")).unionByName(table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", name(F.col("l_suppkey")).alias("s"), "l_quantity").groupBy("l_orderkey", "s").agg(F.sum("l_quantity").alias("q"))
    edges = lines.join(lines.select("l_orderkey", F.col("s").alias("t"), F.col("q").alias("p")), "l_orderkey").where("s < t").select(F.col("s").alias("source"), F.col("t").alias("target"), F.least("q", "p").alias("weight"))
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey", F.year("o_orderdate").alias("y")).agg(F.max("o_totalprice").alias("weight"), F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("k"))
    incident = supplier.join(orders, F.col("s_nationkey") == F.col("c_nationkey")).select(
        F.col("s_name").alias("node"), F.concat(F.lit("order "), "k").alias("other"), F.lit("bought").alias("predicate"), F.when(F.col("y") % 3 > 0, F.concat(F.lit("in "), F.col("y").cast("string"))).alias("description"), "weight"
    )
    return wiki.finished(pages, names, edges, graph.timeline(incident, []))


def source_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks (lines) of documents for pages named by language and hundred of ids."""
    docs = table(spark, sf_dir, "documents")
    page = F.concat_ws("-", "lang", F.floor(F.col("doc_id") / 100))
    nodes = docs.groupBy(page.alias("name")).agg(_in_order("doc_id").alias("s")).select("name", _each("s", "doc_id").alias("sources"))
    chunks = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "content"))
    return wiki.source_texts(nodes, chunks, documents=3, each=4, most=10).select("name", F.size("texts").cast(LONG).alias("n"), F.md5(F.array_join("texts", "\n")).alias("texts_md5"))


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as positions on pages, of which some have a title."""
    place = F.struct("l_linenumber", "l_partkey", F.array((F.col("l_partkey") % 97).cast("int"), F.col("l_linenumber")).alias("p"))
    chunks = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(place)).alias("x")).select("id", _each("x", "p").alias("positions"))
    titles = table(spark, sf_dir, "part").groupBy(F.col("p_size").cast("int").alias("page")).agg(F.min("p_name").alias("title"))
    return wiki.title_by_page(chunks, titles)


def unblank_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as groups of pages, short turns blank: what is left in order, and groups of which nothing is."""
    x = _turns(spark, sf_dir).select("conv_id", "turn", F.concat_ws("/", "conv_id", "turn").alias("rel"), (F.length("text") < 250).alias("blank"))
    groups = x.groupBy(F.col("conv_id").alias("group")).agg(_in_order("turn", "rel").alias("p")).select("group", _each("p", "rel").alias("pages"))
    left, empty = wiki.without_blank_pages(groups, x.where("blank"))
    return left.select("group", F.array_join("pages", "|").alias("pages")).unionByName(empty.select("group", F.lit(None).cast("string").alias("pages")))


def marked_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the users and days on which any purchase is known to have cost more than a bound."""
    x = table(spark, sf_dir, "events").select("event_id", F.concat_ws("/", "user_id", F.to_date("ts")).alias("group"), F.when(F.col("event_type") == "purchase", F.col("value") > 60).alias("dear"))
    return wiki.groups_with(x, F.col("dear")).select("event_id", "group")


def admissible_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents that aren't switched off and have text, left-overs of spreadsheets marked."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    k = F.length("line") % 9
    content = F.when(k == 0, F.concat(F.lit("Unnamed: "), k.cast("string"), "line")).when(k == 1, F.concat("line", F.lit("：nan"))).when(k == 2, F.concat(F.lit("　 "), "line", F.lit(" "))).otherwise(F.col("line"))
    x = lines.select("doc_id", F.col("pos").cast(LONG).alias("pos"), content.alias("content"), F.when(F.length("line") % 4 > 0, F.length("line") % 4 > 1).alias("available"))
    return wiki.admissible(x, 30).select("doc_id", "pos", wiki.junk(F.col("content")).alias("junk"))


def chunk_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents by source, of languages as types, one of them unknown."""
    lines = table(spark, sf_dir, "documents").select(F.col("source").alias("doc_id"), F.when(F.col("lang") != "es", F.col("lang")).alias("doc_type"), F.explode(F.split("text", "\n")).alias("content"))
    return wiki.type_mix(lines)


def dark_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as rows of pixels, positive components dark, eight rows a page: pages with tables by their long dark runs."""
    pixels = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 8).alias("page"), F.col("vec_id").alias("row"), F.transform("embedding", lambda x: x > 0).alias("dark"))
    found = wiki.table_pages(wiki.line_density(pixels, 0.1), density=0.3, fill=0.5, rows=5)
    return found.select("page", F.col("line_rows").cast(LONG).alias("line_rows"), F.round("density", 6).alias("density"), F.round("fill", 6).alias("fill"))


def type_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts and suppliers by type, small parts first."""
    nodes = table(spark, sf_dir, "part").select(F.col("p_type").alias("type"), F.concat_ws(" ", "p_name", "p_brand").alias("name")).unionByName(table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("type"), F.col("s_name").alias("name")))
    return wiki.index_rows(nodes, "SMALL").withColumn("place", F.col("place").cast(LONG))


def mode_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items under every market segment as a mode."""
    modes = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("mode")).distinct()
    return wiki.matrix(table(spark, sf_dir, "benchmark").select("item_id"), modes)


def graph_gain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as cases: answers play the part of runs with the graph, questions that of runs without."""
    x = _turns(spark, sf_dir).select(F.col("conv_id").alias("case_id"), F.when(F.col("role") != "system", F.col("role") == "assistant").alias("use_kg"), F.contains("text", F.lit("la ")).alias("hit5"))
    return wiki.kg_gain(x).withColumn("gain", F.col("gain").cast(LONG))


def scan_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as scans in the folder of their brand, numbered in two ways or not at all."""
    k = F.col("p_size") % 4
    stem = F.when(k == 0, F.concat("p_name", F.lit("_"), F.col("p_partkey") % 1000)).when(k == 1, F.concat("p_name", F.lit("（"), F.col("p_partkey") % 100, F.lit("）"))).when(k == 2, F.initcap("p_name")).otherwise(F.col("p_partkey").cast("string"))
    scans = table(spark, sf_dir, "part").select(F.concat("p_brand", F.lit("/"), stem, F.lit(".jpg")).alias("rel")).distinct()
    return runs.image_groups(scans, "rel").select("group", "n", F.array_join("pages", "|").alias("pages"))


def sheet_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as rows of a sheet: words and numbers, some cells blank."""
    k = F.col("o_orderkey") % 5
    cells = F.array(F.when(k > 0, F.col("o_orderpriority")), F.when(k > 2, F.col("o_totalprice").cast("string")).when(k == 2, F.col("o_orderstatus")).otherwise(" "), F.when(k % 2 == 0, F.col("o_custkey").cast("string")))
    x = table(spark, sf_dir, "orders").select("o_custkey", (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).alias("row"), cells.alias("cells"))
    return runs.header_row(x, ["o_custkey"], "row", "cells").select("o_custkey", F.col("header").cast(LONG).alias("header"))


def missing_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the next conversation's turns that a conversation's turns, joined, don't hold."""
    x = _turns(spark, sf_dir)
    asked = x.select((F.col("conv_id") - 1).alias("conv_id"), F.explode(F.split("text", r"\s+")).alias("word")).where("word <> ''").distinct()
    return matching.missing_anchors(asked, x.select("conv_id", "turn", "text"), "conv_id", "word", "text", "turn").select("conv_id", "word")


def selected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages not done yet (those with a query are) whose url holds one of two substrings, and all of a third kind done over."""
    x = table(spark, sf_dir, "pages").select("url")
    done = x.where(F.col("url").contains("?"))
    first = matching.select_todo(x, done, "url", ["/en/", "", "www."])
    again = matching.select_todo(x, done, "url", [".org"], redo=True)
    return first.withColumn("why", F.lit("new")).unionByName(again.withColumn("why", F.lit("again")))


def scoped_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as replies of chunks, some empty: texts, totals and three scopes of keywords."""
    chunk = F.struct(F.when(F.col("role") != "system", F.col("text")).alias("content"))
    x = _turns(spark, sf_dir).groupBy("conv_id").agg(_in_order("turn", chunk.alias("c")).alias("x"), F.max("turn").alias("last"))
    reply = evaluate.response_texts(_each("x", "c"), F.when(F.col("conv_id") % 3 == 0, F.col("last") * 10))
    x = x.select("conv_id", reply.alias("r"))
    words = lambda *w: F.array(*map(F.lit, w)).cast("array<string>")
    texts = F.col("r.texts")
    return x.select(
        "conv_id", F.col("r.total").alias("total"), F.size(texts).cast(LONG).alias("n"), evaluate.keyword_scope(texts, words("de", "la"), words("ou", "und")).alias("all_texts"),
        evaluate.keyword_scope(texts, words("de"), words(), 2).alias("first_two"), evaluate.keyword_scope(texts, words(), words("the", "que"), 1).alias("first_one"),
    )


def chosen_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cases: those of a category whose number is in range; ids without a number are out."""
    id_ = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("p-x"), "o_orderkey")).otherwise(F.concat(F.lower("o_orderstatus"), F.lit("-"), "o_orderkey", F.lit("-"), "o_custkey"))
    x = table(spark, sf_dir, "orders").select(id_.alias("id"), F.col("o_orderpriority").alias("category"))
    return evaluate.chosen_cases(x, "2-HIGH", 100, 9000)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as cases, passed if their customers hold enough on average."""
    x = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("held"))
    found = evaluate.summary(x, "c_nationkey", F.col("held") > 4500)
    return found.select("total", "passed", "percent", F.array_join("failed", "|").alias("failed"))


def _relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of part types and supplier numbers, in both directions, some of nothing but themselves."""
    kind, other = F.col("p_type"), F.concat(F.lit("S"), F.col("l_suppkey") % 20)
    turned = F.col("l_partkey") % 2 == 0
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(
        F.when(turned, kind).otherwise(other).alias("source"), F.when(turned | (F.col("l_suppkey") % 20 == 3), other).otherwise(kind).alias("target"), F.concat("l_returnflag", "l_linestatus", "l_partkey").alias("predicate"),
        F.array("l_returnflag", "p_brand").alias("keywords"), F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("weight"), F.concat_ws("<SEP>", "l_linestatus", F.col("p_size") % 5).alias("description"),
        (F.col("l_orderkey") % 500).alias("doc_id"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus").alias("pos"),
    )


def merged_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = graph.merge_relations(_relations(spark, sf_dir))
    return x.select("source", "target", "weight", "predicate", F.array_join("keywords", "|").alias("keywords"), "description", F.size("sources").cast(LONG).alias("n_sources"))


def merged_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes over all documents, numbers of suppliers called by their remainder; edges only between nodes: how many, and their weight."""
    x = _relations(spark, sf_dir)
    entities = x.select(F.col("target").alias("name"), F.col("predicate").alias("type"), "description", "doc_id", "pos").where("name <> 'S5'")
    aliases = table(spark, sf_dir, "supplier").where("s_suppkey < 20").select(F.concat(F.lit("S"), "s_suppkey").alias("name"), F.concat(F.lit("S"), F.col("s_suppkey") % 6).alias("canonical")).where("name <> canonical")
    nodes, edges = graph.merge_documents(entities, x, aliases)
    ends = graph.both_ways(edges).groupBy(F.col("node").alias("name")).agg(F.count("*").alias("n_edges"), F.round(F.sum("weight"), 2).alias("weight"))
    return nodes.join(ends, "name", "left").select("name", "type", "description", F.size("sources").cast(LONG).alias("n_sources"), "n_edges", "weight")


def stale_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose lines have become more since they were extracted, or that never were."""
    n = F.size(F.split("text", "\n"))
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", n.cast(LONG).alias("chunks"))
    cached = docs.where("doc_id % 3 > 0").select("source", "doc_id", F.when(F.col("doc_id") % 3 == 1, F.col("chunks")).otherwise(F.col("chunks") - F.col("doc_id") % 2).alias("chunks"))
    return state.stale(docs, cached, ["source", "doc_id"])


def cache_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of odd documents that no even document has, addressed by content."""
    key = T.cache_key(F.lit("page-1"), F.col("lang"), F.col("text"))
    x = table(spark, sf_dir, "documents").select("doc_id", key.alias("cache_key"))
    return state.misses(x.where("doc_id % 2 = 1"), x.where("doc_id % 2 = 0"))


def import_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands against an import: customers of no known region, orders of no price, folders without a dataset, empty conversations."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation").where("n_regionkey <> 3")
    hosts = table(spark, sf_dir, "pages").select(F.regexp_replace("url", r"^[a-z]+://([^/?#]*\.)?", "").alias("rel"))
    known = {"com": "com", "org": "org"}
    return state.problems({
        "no region": customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left_anti").select("c_name"),
        "dear order": table(spark, sf_dir, "orders").where("o_totalprice > 480000").select("o_orderkey"),
        "no dataset": metadata.unknown_folders(hosts, "rel", known).select("folder"),
    })


def sparse_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of orders as metadata objects without null and empty values."""
    k = F.col("o_orderkey")
    kept = V.sparse_map({"status": F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")), "customer": F.col("o_custkey"), "priority": F.regexp_extract("o_orderpriority", "^[12]-(.*)$", 1), "day": F.when(k % 3 > 0, F.dayofmonth("o_orderdate"))})
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(F.transform(F.map_entries(kept), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|").alias("meta"))


def edge_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicates and keywords of edges whose keywords are the lines of a turn's text, some blank."""
    raw = F.when(F.length("text") % 5 > 0, F.concat(F.lit(" <SEP>"), F.regexp_replace("text", "\n", "　<SEP> "))).when(F.length("text") % 2 == 0, " <SEP>")
    p = T.predicate(raw)
    return _turns(spark, sf_dir).select("conv_id", "turn", p["predicate"].alias("predicate"), F.md5(F.array_join(p["keywords"], "|")).alias("keywords_md5"), F.size(p["keywords"]).cast(LONG).alias("n"))


def summary_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as descriptions: cut to so many tokens, those of many parts left to a model."""
    s = T.summary_input(F.replace("text", F.lit("\n"), F.lit("<SEP>")), 200, 6)
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(s["text"]).alias("text_md5"), s["needs_model"].alias("needs_model"))


def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as rows of cells above a header, some blank."""
    cells = F.array(F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit(" "), "o_orderstatus", F.lit("　"))), F.when(F.col("o_orderkey") % 3 == 1, "NaN").when(F.col("o_orderkey") % 3 == 2, F.col("o_orderpriority")).otherwise(" "))
    x = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(_in_order("o_orderkey", cells.alias("c")).alias("x"))
    return x.select("o_custkey", T.context_text(_each("x", "c")).alias("context"))


def line_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as raw lines: cells by tabs or by blanks, words or mostly numbers, and plain lines; as Markdown tables."""
    k = F.col("o_orderkey") % 6
    by = F.when(k < 3, "\t").otherwise("   ")
    line = F.when(k == 5, F.concat(F.lit("note "), "o_orderkey")).when(k % 3 == 0, F.concat(F.lit("state"), by, F.lit("key "), by, "o_orderstatus")).otherwise(F.concat("o_orderpriority", by, F.lit(" "), "o_orderkey", by, "o_totalprice"))
    x = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(_in_order("o_orderkey", line.alias("l")).alias("x"))
    return x.select("o_custkey", T.lines_markdown(_each("x", "l")).alias("markdown"))


QUERIES = {
    f.__name__: f
    for f in (
        table_match, merged_tables, finished_pages, source_texts, page_titles, unblank_groups, marked_groups, admissible_chunks, chunk_types, dark_pages, type_index, mode_matrix, graph_gain, scan_groups, sheet_headers,
        missing_words, selected_pages, scoped_answers, chosen_cases, run_summary, merged_relations, merged_mentions, stale_extractions, cache_misses, import_problems, sparse_meta, edge_predicates, summary_inputs, contexts, line_tables,
    )
}

_BLANKS = r"[\s\x{3000}\x{a0}]"
_STRIP = r"regexp_replace({}, '^[\s\x{{3000}}\x{{a0}}]+|[\s\x{{3000}}\x{{a0}}]+$', '', 'g')"
_RELATIONS = """r AS (
  SELECT CASE WHEN l_partkey % 2 = 0 THEN p_type ELSE 'S' || (l_suppkey % 20) END AS source, CASE WHEN l_partkey % 2 = 0 OR l_suppkey % 20 = 3 THEN 'S' || (l_suppkey % 20) ELSE p_type END AS target,
    l_returnflag || l_linestatus || l_partkey AS predicate, l_returnflag AS flag, p_brand AS brand, CASE WHEN l_quantity > 10 THEN l_quantity ELSE 1 END AS weight, l_linestatus AS d1, (p_size % 5)::VARCHAR AS d2,
    l_orderkey % 500 AS doc_id, (l_orderkey % 500, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus) AS pos
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

ORACLES: dict[str, str] = {
    "table_match": """
WITH t AS (SELECT conv_id AS doc_id, turn, text, string_split(text, ' ') AS w FROM conversations),
i AS (SELECT doc_id, turn AS place, w[1:3] AS headers, list_reverse(w)[1:3] AS body FROM t),
f AS (SELECT t.doc_id, t.turn AS chunk_id, place, headers, list_filter(headers, lambda x: x <> '' AND contains(text, x)) AS h, list_filter(body, lambda x: x <> '' AND contains(text, x)) AS b FROM t JOIN i USING (doc_id)),
g AS (SELECT *, length(array_to_string(headers, '')) / greatest(length(array_to_string(h, '')), 1) AS share FROM f),
s AS (SELECT doc_id, chunk_id, place, 10 * len(h) + 3 * len(b) + CASE WHEN share BETWEEN 0.75 AND 1.05 THEN 2 ELSE 0 END AS score FROM g)
SELECT doc_id, chunk_id, place, score::BIGINT AS score FROM s WHERE score >= 12 QUALIFY row_number() OVER (PARTITION BY doc_id, chunk_id ORDER BY score DESC, place) = 1
""",
    "merged_tables": """
WITH t AS (
  SELECT user_id, event_id, CASE WHEN value > 20 THEN 'high' ELSE 'low' END AS header, event_type IN ('view', 'purchase') AS marked, floor(value)::BIGINT % 2 AS number, lag(floor(value)::BIGINT % 2) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events),
r AS (SELECT *, sum((NOT coalesce(number = before AND marked, false))::INTEGER) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM t),
f AS (SELECT *, first_value(header) OVER w AS h, row_number() OVER w AS turn FROM r WINDOW w AS (PARTITION BY user_id, run ORDER BY event_id))
SELECT user_id, run::BIGINT AS run, string_agg(CASE WHEN event_id % 3 > 0 AND NOT (turn > 1 AND header = h) THEN header || '|' ELSE '' END || event_id, '|' ORDER BY event_id) AS rows, string_agg(event_id::VARCHAR, '|' ORDER BY event_id) AS positions, count(*) AS parts
FROM f GROUP BY user_id, run
""",
    "finished_pages": r"""
WITH m AS (SELECT s_name, s_nationkey, 'Supplier#' || lpad(((s_suppkey * 7 + 1) % 50)::VARCHAR, 9, '0') AS a, 'Supplier#' || lpad(((s_suppkey * 3 + 2) % 50)::VARCHAR, 9, '0') AS b, 'NATION_' || s_nationkey AS c FROM supplier),
p AS (SELECT *, CASE WHEN a = s_name THEN a ELSE '[[' || a || ']]' END AS la, CASE WHEN b IN (s_name, a) THEN b ELSE '[[' || b || ']]' END AS lb FROM m),
q AS (SELECT l_orderkey, l_suppkey AS s, sum(l_quantity) AS q FROM lineitem GROUP BY ALL),
e AS (SELECT x.s AS a, y.s AS b, least(x.q, y.q) AS w FROM q x JOIN q y ON x.l_orderkey = y.l_orderkey AND x.s <> y.s),
n AS (SELECT 'Supplier#' || lpad(a::VARCHAR, 9, '0') AS node, 'Supplier#' || lpad(b::VARCHAR, 9, '0') AS other, round(sum(w), 2) AS w FROM e GROUP BY ALL),
also AS (SELECT node, other, row_number() OVER (PARTITION BY node ORDER BY w DESC, other) AS rank FROM n JOIN p ON s_name = node WHERE other NOT IN (a, b) QUALIFY rank <= 6),
more AS (SELECT node, string_agg('- [[' || other || ']]', chr(10) ORDER BY rank) AS also FROM also GROUP BY node),
o AS (SELECT c_nationkey, year(o_orderdate) AS y, max(o_totalprice) AS w, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS k FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
line AS (SELECT s_name, 'order ' || k AS other, coalesce(CASE WHEN y % 3 > 0 THEN y END, nullif(regexp_extract(k::VARCHAR, '20\d{2}|19\d{2}'), '')::BIGINT) AS year, w FROM supplier JOIN o ON s_nationkey = c_nationkey),
placed AS (SELECT *, row_number() OVER (PARTITION BY s_name ORDER BY year IS NULL, year, w DESC, other) AS place FROM line QUALIFY place <= 20),
events AS (SELECT s_name, string_agg('- ' || coalesce(year || '年、', '') || '[[' || other || ']]', chr(10) ORDER BY place) AS events, bool_or(year IS NOT NULL) AS dated FROM placed GROUP BY s_name)
SELECT p.s_name AS name, '# ' || p.s_name || chr(10) || 'near ' || la || ' and ' || lb || ', [[' || c || ']].' || CASE WHEN also IS NOT NULL THEN chr(10) || chr(10) || '## See also' || chr(10) || also ELSE '' END
  || CASE WHEN events IS NOT NULL THEN chr(10) || chr(10) || CASE WHEN dated THEN '## 时间线' ELSE '## 事件关联' END || chr(10) || events ELSE '' END AS markdown
FROM p LEFT JOIN more ON node = p.s_name LEFT JOIN events ON events.s_name = p.s_name
""",
    "source_texts": """
WITH d AS (SELECT lang || '-' || (doc_id // 100) AS name, string_split(text, chr(10))[1:4] AS lines, row_number() OVER (PARTITION BY lang, doc_id // 100 ORDER BY doc_id) AS turn, doc_id FROM documents),
t AS (SELECT name, flatten(list(lines ORDER BY doc_id))[1:10] AS texts FROM d WHERE turn <= 3 GROUP BY name)
SELECT name, len(texts) AS n, md5(array_to_string(texts, chr(10))) AS texts_md5 FROM t
""",
    "page_titles": """
WITH t AS (SELECT p_size AS page, min(p_name) AS title FROM part GROUP BY p_size)
SELECT l_orderkey AS id, arg_min(title, (l_linenumber, l_partkey)) AS title FROM lineitem JOIN t ON page = l_partkey % 97 GROUP BY l_orderkey
""",
    "unblank_groups": "SELECT conv_id AS \"group\", string_agg(conv_id || '/' || turn, '|' ORDER BY turn) FILTER (length(text) >= 250) AS pages FROM conversations GROUP BY conv_id",
    "marked_groups": """
SELECT event_id, "group" FROM (SELECT event_id, user_id || '/' || ts::DATE AS "group", count(*) FILTER (event_type = 'purchase' AND value > 60) OVER (PARTITION BY user_id, ts::DATE) AS n FROM events) WHERE n > 0
""",
    "admissible_chunks": f"""
WITH l AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS pos, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
c AS (SELECT *, length(line) % 4 AS a, CASE length(line) % 9 WHEN 0 THEN 'Unnamed: 0' || line WHEN 1 THEN line || '：nan' WHEN 2 THEN '　 ' || line || ' ' ELSE line END AS content FROM l)
SELECT doc_id, pos, length(line) % 9 < 2 OR regexp_matches(line, 'Unnamed: [0-9]') OR contains(line, '：nan') AS junk FROM c WHERE a <> 1 AND length({_STRIP.format("content")}) >= 30
""",
    "chunk_types": r"""
WITH l AS (SELECT source AS doc_id, CASE WHEN lang = 'es' THEN 'text' ELSE lang END AS doc_type, unnest(string_split(text, chr(10))) AS content FROM documents)
SELECT doc_id, doc_type, count(*) AS n, round(avg(length(content)), 1) AS mean_length, count(*) FILTER (regexp_matches(content, '\$[^$\n]+\$|\\frac|\\sum|\\times|\\sqrt|\\begin\{')) AS formulas FROM l GROUP BY ALL
""",
    "dark_pages": """
WITH r AS (SELECT vec_id // 8 AS page, len(embedding) AS width, array_to_string([CASE WHEN x > 0 THEN '1' ELSE '0' END FOR x IN embedding], '') AS bits FROM embeddings),
l AS (SELECT *, list_max([length(x) FOR x IN string_split(bits, '0')]) > 0.1 * width AS line, length(replace(bits, '0', '')) AS dark FROM r),
d AS (SELECT page, count(*) FILTER (line) AS line_rows, count(*) FILTER (line) / count(*) AS density, sum(dark) / sum(width) AS fill FROM l GROUP BY page)
SELECT page, line_rows, round(density, 6)::DOUBLE AS density, round(fill, 6)::DOUBLE AS fill FROM d WHERE (density > 0.3 AND fill > 0.5) OR line_rows > 5
""",
    "type_index": """
WITH n AS (SELECT DISTINCT p_type AS type, p_name || ' ' || p_brand AS name FROM part UNION ALL SELECT 'supplier', s_name FROM supplier)
SELECT type, dense_rank() OVER (ORDER BY type <> 'SMALL', type) AS place, count(*) OVER (PARTITION BY type) AS n, name FROM n
""",
    "mode_matrix": "SELECT item_id, mode FROM benchmark, (SELECT DISTINCT c_mktsegment AS mode FROM customer)",
    "graph_gain": """
SELECT conv_id AS case_id, coalesce(max(contains(text, 'la ')::INTEGER) FILTER (role = 'assistant'), 0)::BIGINT - coalesce(max(contains(text, 'la ')::INTEGER) FILTER (role = 'user'), 0) AS gain FROM conversations GROUP BY conv_id
""",
    "scan_groups": r"""
WITH s AS (SELECT p_brand, p_name, p_partkey, p_size % 4 AS k, array_to_string([upper(x[1]) || lower(x[2:]) FOR x IN string_split(p_name, ' ')], ' ') AS title FROM part),
f AS (SELECT DISTINCT p_brand, CASE k WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN title ELSE p_brand END AS base, CASE k WHEN 0 THEN p_partkey % 1000 WHEN 1 THEN p_partkey % 100 WHEN 3 THEN p_partkey END AS page,
  p_brand || '/' || CASE k WHEN 0 THEN p_name || '_' || (p_partkey % 1000) WHEN 1 THEN p_name || '（' || (p_partkey % 100) || '）' WHEN 2 THEN title ELSE p_partkey::VARCHAR END || '.jpg' AS rel FROM s)
SELECT p_brand || '/' || base AS "group", count(*) AS n, string_agg(rel, '|' ORDER BY page IS NULL, page, lower(rel), rel) AS pages FROM f GROUP BY ALL
""",
    "sheet_headers": """
WITH t AS (SELECT o_custkey, o_orderkey % 5 AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS r FROM orders)
SELECT o_custkey, coalesce(min(r) FILTER (r < 6 AND k IN (2, 3)), 0)::BIGINT AS header FROM t GROUP BY o_custkey
""",
    "missing_words": r"""
WITH w AS (SELECT DISTINCT conv_id - 1 AS conv_id, unnest(string_split_regex(text, '\s+')) AS word FROM conversations),
t AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS whole FROM conversations GROUP BY conv_id)
SELECT conv_id, word FROM w LEFT JOIN t USING (conv_id) WHERE word <> '' AND NOT coalesce(contains(whole, word), false)
""",
    "selected_pages": """
SELECT url, 'new' AS why FROM pages WHERE NOT contains(url, '?') AND (contains(url, '/en/') OR contains(url, 'www.')) UNION ALL SELECT url, 'again' FROM pages WHERE contains(url, '.org')
""",
    "scoped_answers": """
WITH c AS (SELECT conv_id, list(CASE WHEN role = 'system' THEN '' ELSE text END ORDER BY turn) AS t, max(turn) AS last FROM conversations GROUP BY conv_id),
j AS (SELECT *, array_to_string(t, chr(10)) AS a, array_to_string(t[1:2], chr(10)) AS b FROM c)
SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN last * 10 ELSE len(t) END AS total, len(t) AS n, contains(a, 'de') AND contains(a, 'la') AND (contains(a, 'ou') OR contains(a, 'und')) AS all_texts, contains(b, 'de') AS first_two,
  contains(t[1], 'the') OR contains(t[1], 'que') AS first_one FROM j
""",
    "chosen_cases": """
SELECT lower(o_orderstatus) || '-' || o_orderkey || '-' || o_custkey AS id, o_orderpriority AS category FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '2-HIGH' AND o_orderkey BETWEEN 100 AND 9000
""",
    "run_summary": """
WITH n AS (SELECT c_nationkey AS k, avg(c_acctbal) > 4500 AS ok FROM customer GROUP BY 1)
SELECT count(*) AS total, count(*) FILTER (ok) AS passed, round(100.0 * count(*) FILTER (ok) / count(*))::BIGINT AS percent, coalesce(string_agg(k::VARCHAR, '|' ORDER BY k) FILTER (NOT ok), '') AS failed FROM n
""",
    "merged_relations": f"""
WITH {_RELATIONS}
SELECT least(source, target) AS source, greatest(source, target) AS target, round(sum(weight), 2) AS weight, arg_min(predicate, pos) AS predicate, array_to_string(list_sort(list_distinct(flatten(list([flag, brand])))), '|') AS keywords,
  array_to_string(list_sort(list_distinct(flatten(list([d1, d2])))), '<SEP>') AS description, count(DISTINCT doc_id) AS n_sources FROM r WHERE source <> target GROUP BY least(source, target), greatest(source, target)
""",
    "merged_mentions": f"""
WITH {_RELATIONS}, alias AS (SELECT 'S' || s_suppkey AS name, 'S' || (s_suppkey % 6) AS called FROM supplier WHERE s_suppkey < 20),
e AS (SELECT coalesce(called, target) AS name, predicate, d1, d2, doc_id, pos FROM r LEFT JOIN alias ON name = target WHERE target <> 'S5'),
n AS (SELECT name, arg_min(predicate, pos) AS type, array_to_string(list_sort(list_distinct(flatten(list([d1, d2])))), '<SEP>') AS description, count(DISTINCT doc_id) AS n_sources FROM e GROUP BY name),
c AS (SELECT coalesce(x.called, source) AS s, coalesce(y.called, target) AS t, weight FROM r LEFT JOIN alias x ON x.name = source LEFT JOIN alias y ON y.name = target),
m AS (SELECT least(s, t) AS s, greatest(s, t) AS t, round(sum(weight), 2) AS w FROM c WHERE s <> t AND s IN (SELECT name FROM n) AND t IN (SELECT name FROM n) GROUP BY ALL),
b AS (SELECT name, count(*) AS n_edges, round(sum(w), 2) AS weight FROM (SELECT s AS name, w FROM m UNION ALL SELECT t, w FROM m) GROUP BY name)
SELECT n.name, type, description, n_sources, n_edges, weight FROM n LEFT JOIN b ON b.name = n.name
""",
    "stale_extractions": """
SELECT source, doc_id, len(string_split(text, chr(10))) AS chunks FROM documents WHERE doc_id % 3 = 0 OR (doc_id % 3 = 2 AND doc_id % 2 = 1)
""",
    "cache_misses": """
WITH k AS (SELECT doc_id, sha256('page-1' || chr(31) || coalesce(lang, '') || chr(31) || coalesce(text, '')) AS cache_key FROM documents)
SELECT doc_id, cache_key FROM k WHERE doc_id % 2 = 1 AND cache_key NOT IN (SELECT cache_key FROM k WHERE doc_id % 2 = 0)
""",
    "import_problems": r"""
SELECT 'no region' AS "check", c_name AS subject FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 3)
UNION ALL SELECT 'dear order', o_orderkey::VARCHAR FROM orders WHERE o_totalprice > 480000
UNION ALL SELECT DISTINCT 'no dataset', split_part(regexp_replace(url, '^[a-z]+://([^/?#]*\.)?', ''), '/', 1) FROM pages WHERE split_part(regexp_replace(url, '^[a-z]+://([^/?#]*\.)?', ''), '/', 1) NOT IN ('com', 'org')
""",
    "sparse_meta": r"""
SELECT o_orderkey, concat_ws('|', CASE WHEN o_orderstatus <> 'O' THEN 'status=' || o_orderstatus END, 'customer=' || o_custkey, CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 'priority=' || o_orderpriority[3:] END,
  CASE WHEN o_orderkey % 3 > 0 THEN 'day=' || day(o_orderdate) END) AS meta FROM orders
""",
    "edge_predicates": f"""
WITH t AS (SELECT conv_id, turn, CASE WHEN length(text) % 5 > 0 THEN [lower({_STRIP.format("x")}) FOR x IN string_split(text, chr(10))] ELSE [] END AS w FROM conversations),
f AS (SELECT conv_id, turn, list_filter(w, lambda x: x <> '') AS w FROM t)
SELECT conv_id, turn, coalesce(w[1], 'related') AS predicate, md5(coalesce(array_to_string(w, '|'), '')) AS keywords_md5, len(w) AS n FROM f
""",
    "summary_inputs": """
SELECT doc_id, md5(t) AS text_md5, len(string_split(t, '<SEP>')) > 6 AS needs_model FROM (SELECT doc_id, left(replace(text, chr(10), '<SEP>'), 400) AS t FROM documents)
""",
    "contexts": """
SELECT o_custkey, coalesce(string_agg(CASE o_orderkey % 3 WHEN 1 THEN o_orderstatus ELSE o_orderstatus || ' ' || o_orderpriority END, '; ' ORDER BY o_orderkey) FILTER (o_orderkey % 3 > 0), '') AS context FROM orders GROUP BY o_custkey
""",
    # the rows of each delimiter, the place of the first of numbers, then header, rule, rows and what is left
    "line_tables": r"""
WITH l AS (
  SELECT o_custkey, o_orderkey AS k, o_orderkey % 6 AS m, CASE WHEN o_orderkey % 3 = 0 THEN ['state', 'key', o_orderstatus] ELSE [o_orderpriority, o_orderkey::VARCHAR, o_totalprice::VARCHAR] END AS cells FROM orders),
n AS (SELECT *, count(*) FILTER (m < 3) OVER c AS tabs, count(*) FILTER (m IN (3, 4)) OVER c AS gaps FROM l WINDOW c AS (PARTITION BY o_custkey)),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY k) AS place, list_count([1 FOR x IN cells IF regexp_matches(x, '^[+-]?[0-9]+(\.[0-9]+)?$')]) * 2 > 3 AS data FROM n WHERE m <> 5 AND (m < 3) = (tabs >= gaps)),
h AS (SELECT o_custkey, min(place) FILTER (data) AS first FROM r GROUP BY o_custkey),
b AS (SELECT o_custkey, CASE WHEN first = 1 THEN 0 ELSE coalesce(first, 2) - 1 END AS head FROM h),
made AS (SELECT r.o_custkey, '| ' || coalesce(any_value(array_to_string(cells, ' | ')) FILTER (place = head), '列1 | 列2 | 列3') || ' |' || chr(10) || '| --- | --- | --- |'
    || coalesce(string_agg(chr(10) || '| ' || array_to_string(cells, ' | ') || ' |', '' ORDER BY place) FILTER (place > head), '') AS made, string_agg(array_to_string(cells, chr(9)), chr(10) ORDER BY place) FILTER (place < head) AS above FROM r JOIN b ON b.o_custkey = r.o_custkey GROUP BY r.o_custkey),
plain AS (SELECT o_custkey, string_agg('note ' || k, chr(10) ORDER BY k) FILTER (m = 5) AS plain FROM l GROUP BY o_custkey)
SELECT plain.o_custkey, CASE WHEN made IS NULL THEN '```' || chr(10) || coalesce(plain, '') || chr(10) || '```' || chr(10)
  ELSE made || coalesce(chr(10) || chr(10) || '```' || chr(10) || nullif(concat_ws(chr(10), above, plain), '') || chr(10) || '```', '') || chr(10) END AS markdown
FROM plain LEFT JOIN made ON made.o_custkey = plain.o_custkey
""",
}

"""Queries over graphs, evaluation, retrieval, conversations, events and the small dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstack.functions import text as T
from quillstack.functions import values as V
from quillstack.operators import evaluate, graph, matching, profile, retrieval, runs, state
from quillstack.session import table

LONG = "long"


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and suppliers as a weighted graph, weights from the quantity."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("part"), F.col("l_partkey").cast("string")).alias("source"), F.concat(F.lit("supplier"), F.col("l_suppkey").cast("string")).alias("target"), F.col("l_quantity").alias("weight")
    )


def edge_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.merge_edges(_edges(spark, sf_dir))


def degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.degree(edge_merge(spark, sf_dir))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.neighbours(edge_merge(spark, sf_dir))


def see_also(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.see_also(edge_merge(spark, sf_dir)).select("node", "other", F.col("rank").cast(LONG).alias("rank"))


def contract_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers contracted to their nations."""
    aliases = table(spark, sf_dir, "supplier").select(F.concat(F.lit("supplier"), F.col("s_suppkey").cast("string")).alias("name"), F.concat(F.lit("nation"), F.col("s_nationkey").cast("string")).alias("canonical"))
    return graph.contract(_edges(spark, sf_dir), aliases)


def endpoint_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges whose part and supplier are both among the listed nodes."""
    parts = table(spark, sf_dir, "part").where("p_size < 10").select(F.concat(F.lit("part"), F.col("p_partkey").cast("string")).alias("name"))
    suppliers = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.concat(F.lit("supplier"), F.col("s_suppkey").cast("string")).alias("name"))
    return graph.inside(edge_merge(spark, sf_dir), parts.unionByName(suppliers)).select("source", "target")


def node_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a brand as mentions of one entity."""
    mentions = table(spark, sf_dir, "part").select(F.col("p_brand").alias("name"), F.col("p_type").alias("type"), F.col("p_name").alias("description"), F.col("p_partkey").alias("doc_id"), F.lit(0).alias("pos"))
    x = graph.merge_nodes(mentions)
    return x.select("name", "type", "description", F.size("sources").cast(LONG).alias("n_sources"))


def prioritised_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "supplier").select(F.concat(F.lit("supplier"), F.col("s_suppkey").cast("string")).alias("name"), F.when(F.col("s_nationkey") < 5, "Unit").otherwise("other").alias("type"))
    return graph.prioritised(nodes, edge_merge(spark, sf_dir), "unit", 20).select("name", "type", F.col("degree").cast(LONG).alias("degree"))


def reverse_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions to the suppliers' nations in them, from undirected edges."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    edges = nation.join(region, nation.n_regionkey == region.r_regionkey).select(F.col("n_name").alias("source"), F.col("r_name").alias("target"), F.lit(1.0).alias("weight"))
    types = nation.select(F.col("n_name").alias("name"), F.lit("Nation").alias("type")).unionByName(region.select(F.col("r_name").alias("name"), F.lit("REGION").alias("type")))
    return graph.reverse_index(edges, types, "region", "nation").select("key", F.array_join("values", "|").alias("values"))


def link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages named by their first menu entry and the entries that they link."""
    links = F.regexp_extract_all("html", F.lit('href="/([^"]+)"'), 1)
    return graph.link_graph(table(spark, sf_dir, "pages").select(F.get(links, F.lit(0)).alias("name"), links.alias("targets")), F.col("targets"))


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders in order of year, urgent ones only where there are any."""
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("customer"), F.col("o_custkey").cast("string")).alias("node"), F.concat(F.lit("order"), F.col("o_orderkey").cast("string")).alias("other"), F.col("o_orderpriority").alias("predicate"),
        F.when(F.col("o_orderkey") % 5 > 0, F.concat(F.lit("in "), F.year("o_orderdate").cast("string"))).alias("description"), F.col("o_totalprice").alias("weight"),
    )
    return graph.timeline(orders, ["urgent"]).select("node", "other", "year", F.col("place").cast(LONG).alias("place"))


def dim_lookup_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = table(spark, sf_dir, "nation").where("n_nationkey <> 7").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return matching.lookup(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), dim, "s_nationkey", "n_name")


def unique_candidate_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.unique_candidate(table(spark, sf_dir, "part"), ["p_brand", "p_size", "p_type"], "p_partkey")


def group_pair_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as documents of `p_size` pages in the folder of their brand; lineitems of every other part as its group's pages."""
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("dir"), F.col("p_partkey").cast("string").alias("stem"), F.when(F.col("p_partkey") % 7 > 0, F.col("p_size").cast(LONG)).alias("pages"))
    groups = table(spark, sf_dir, "lineitem").where("l_partkey % 2 = 0").groupBy(F.col("l_partkey").cast("string").alias("base")).agg(F.count("*").alias("size"))
    groups = groups.join(parts.select(F.col("stem").alias("base"), "dir"), "base")
    return matching.pair_verdict(parts, groups).select("dir", "stem", "verdict")


def set_diff_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of a brand's large parts expected, of its small ones found."""
    sets = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.collect_set(F.when(F.col("p_size") > 45, F.col("p_name"))).alias("e"), F.collect_set(F.when(F.col("p_size") < 5, F.col("p_name"))).alias("f"))
    equal, missing, extra = matching.compare_sets(F.col("e"), F.col("f"))
    return sets.select("p_brand", equal.alias("passed"), F.array_join(missing, "|").alias("missing"), F.array_join(extra, "|").alias("unexpected"))


def subset_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("old"), F.array_sort(F.collect_set(F.when(F.col("p_size") > 48, F.col("p_name")))).alias("new"))
    changed, words = matching.merged_keywords(F.col("old"), F.col("new"))
    return sets.select("p_brand", changed.alias("changed"), F.array_join(words, "|").alias("keywords"))


def last_ok_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.last_ok(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "purchase", ["event_id", "value"])


def never_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").withColumn("key", F.expr("user_id * 100 + event_id % 100"))
    return state.only_failed(log, "key", F.col("event_type") == "signup")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as steps of an import: one document a user."""
    status = F.create_map(*[F.lit(x) for kv in {"signup": "uploaded", "view": "meta_done", "click": "parse_requested", "purchase": "done", "error": "failed"}.items() for x in kv])
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("rel"), "event_id", "ts", F.element_at(status, F.col("event_type")).alias("status"), F.when(F.col("event_type") == "error", F.col("props")).alias("error"))


def state_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.reduce_states(event_log(spark, sf_dir), "rel", ["ts", "event_id"], 86400.0, "ts").select("rel", "status", "error", "events")


def gate_first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.first_failure_gate(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], F.col("event_type") != "error").select("event_id", "gate")


def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three events of a user in a row as repeats of a case."""
    x = table(spark, sf_dir, "events").withColumn("case_id", F.floor(F.col("event_id") / 3))
    return evaluate.majority(x, ["case_id"], F.col("value") > 20)


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json(T.json_object(F.concat(F.lit("note: "), F.col("props"), F.lit(" end"))), "k int")
    return table(spark, sf_dir, "events").groupBy(parsed["k"].alias("k")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


def before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' shares of errors in even and odd events as two runs."""
    x = table(spark, sf_dir, "events").groupBy("user_id", (F.col("event_id") % 2).alias("run")).agg((F.count_if(F.col("event_type") == "error") * 5 <= F.count("*")).alias("passed"))
    return matching.before_after(x.where("run = 0"), x.where("run = 1"), "user_id", "passed")


def gaps_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of line numbers with a large quantity."""
    x = table(spark, sf_dir, "lineitem").where("l_quantity > 20").select("l_orderkey", F.col("l_linenumber").cast(LONG).alias("line"))
    return runs.islands(x, ["l_orderkey"], "line")


def run_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns in a row by speakers of the same first letter and parity."""
    x = table(spark, sf_dir, "conversations").withColumn("side", F.concat(F.col("role"), (F.length("text") > 300).cast("string")))
    new = F.col("side") != runs.previous("side", ["conv_id"], "turn")
    x = runs.runs(x, ["conv_id"], "turn", new)
    return x.groupBy("conv_id", "run").agg(F.first("side").alias("side"), F.min("turn").alias("first_turn"), F.count("*").alias("turns"), F.md5(runs.merged(x, ["conv_id"], "turn", "text")).alias("text_md5"))


def page_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "conversations")
    return x.groupBy("conv_id").agg(F.md5(runs.merged(x, ["conv_id"], "turn", "text", "\n\n")).alias("text_md5"), F.count("*").alias("pages"), F.max("turn").alias("last")).withColumn("complete", F.col("last") + 1 == F.col("pages"))


def page_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.page_anchor(F.col("text"), 20).alias("anchor"))


def record_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction records made of turns: an entity for users, a relation for assistants."""
    word = F.regexp_extract("text", "([A-Za-z]+)", 1)
    entity = F.concat(F.lit('("entity"<|>'), word, F.lit("<|>"), F.col("role"), F.lit("<|> a &amp; b )"))
    relation = F.concat(F.lit('("relationship"<|>'), word, F.lit("<|>m"), F.lit("<|>says<|>talk<|>"), F.col("turn").cast("string"), F.lit(")"))
    x = table(spark, sf_dir, "conversations").select("conv_id", "turn", T.record(F.when(F.col("role") == "user", entity).otherwise(relation)).alias("r"))
    return x.select("conv_id", "turn", "r.*")


def cell_ditto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of turns in which every third cell repeats the one above."""
    row = F.concat(F.lit("| "), F.col("role"), F.lit(" | "), F.when(F.col("turn") % 3 == 2, "〃").otherwise(F.col("turn").cast("string")), F.lit(" |"))
    x = table(spark, sf_dir, "conversations").select("conv_id", "turn", row.alias("row"))
    return x.groupBy("conv_id").agg(T.expand_dittos(runs.merged(x, ["conv_id"], "turn", "row")).alias("table"))


def answer_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = lambda *w: F.array(*map(F.lit, w))
    x = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    return x.select("conv_id", "turn", evaluate.grade(T.answer_form(F.col("text")), words("en"), words("ou", "st", "ge"), words("zwölf")).alias("grade"))


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "embeddings")
    return rows, rows.where("vec_id % 50 = 0")


def retrieval_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, queries = _vectors(spark, sf_dir)
    return retrieval.cosine_topk(rows, queries, "vec_id", "embedding", 10).select("query", "hit", "score", F.col("rank").cast(LONG).alias("rank"))


def hit_mrr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hit@5, hit@10 and the mean reciprocal rank, a vector of the query's label being right."""
    labels = table(spark, sf_dir, "embeddings")
    top = retrieval_topk(spark, sf_dir).join(labels.select(F.col("vec_id").alias("query"), F.col("label").alias("want")), "query").join(labels.select(F.col("vec_id").alias("hit"), "label"), "hit")
    first = top.groupBy("query").agg(F.coalesce(F.min(F.when(F.col("label") == F.col("want"), F.col("rank"))), F.lit(0)).alias("r"))
    r = F.col("r")
    return first.agg(F.count("*").alias("n"), F.count_if((r > 0) & (r <= 5)).alias("hit5"), F.count_if(r > 0).alias("hit10"), F.round(evaluate.mrr(r), 6).alias("mrr"))


def window_ab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the best vector of another label is within the first 8, and within the first 64."""
    rows, queries = _vectors(spark, sf_dir)
    top = retrieval.cosine_topk(rows, queries, "vec_id", "embedding", 64)
    labels = table(spark, sf_dir, "embeddings")
    top = top.join(labels.select(F.col("vec_id").alias("query"), F.col("label").alias("want")), "query").join(labels.select(F.col("vec_id").alias("hit"), "label"), "hit").where("label = (want + 3) % 10")
    at = lambda pool: top.where(F.col("rank") <= pool).groupBy("query").agg(F.min("rank").cast(LONG).alias("rank"))
    return evaluate.window_flip(at(8), at(64), "query")


def hybrid_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pool of 64 by cosine, ranked anew with agreement of labels as term similarity and tag feature."""
    rows, queries = _vectors(spark, sf_dir)
    top = retrieval.cosine_topk(rows, queries, "vec_id", "embedding", 64).drop("rank")
    labels = table(spark, sf_dir, "embeddings")
    top = top.join(labels.select(F.col("vec_id").alias("query"), F.col("label").alias("want")), "query").join(labels.select(F.col("vec_id").alias("hit"), "label"), "hit").withColumnRenamed("score", "vtsim")
    same = (F.col("label") == F.col("want")).cast("double")
    tags = lambda c: F.create_map(F.concat(F.lit("t"), (F.col(c) % 3).cast("string")), F.lit(2.0))
    final = F.round(retrieval.hybrid(same, F.col("vtsim"), 0.7, retrieval.tag_feature(tags("want"), tags("label"), 0.01)), 6)
    return retrieval.rerank(top, 64, "vtsim", final, 5).select("query", "hit", "score", F.col("rank").cast(LONG).alias("rank"))


def anchor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as cases (their first words as keywords), documents ranked by id as results."""
    words = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda w: F.length(w) > 4)
    cases = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("case_id"), F.array(F.lit("1,000")).alias("numbers"), F.slice(words, 1, 3).alias("keywords"), F.lit(2).alias("min_keywords"))
    n = cases.agg(F.max("case_id") + 1).first()[0]
    ranked = table(spark, sf_dir, "documents").select((F.col("doc_id") % n).alias("case_id"), (F.floor(F.col("doc_id") / n) + 1).alias("rank"), "text")
    x = evaluate.score_retrieval(cases, ranked)
    return x.select("case_id", "hit5", "hit10", F.col("mrr_rank").cast(LONG).alias("mrr_rank"), "numeric_exact", F.col("kw_hits").cast(LONG).alias("kw_hits"), F.col("kw_needed").cast(LONG).alias("kw_needed"), "passed")


def order_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not of the archive: grouping sets over orders."""
    x = table(spark, sf_dir, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return x


def tumbling_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not of the archive: events by hour."""
    x = table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"), "event_type").agg(F.count("*").alias("n"))
    return x.select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "event_type", "n")


QUERIES = {
    f.__name__: f
    for f in (
        edge_merge, degree, neighbours, see_also, contract_nodes, endpoint_semi, node_merge, prioritised_nodes, reverse_index, link_graph, timeline, dim_lookup_missing,
        unique_candidate_reuse, group_pair_verdict, set_diff_names, subset_update, last_ok_wins, never_ok, state_machine, gate_first_failure, majority_vote, json_props,
        before_after, gaps_islands, run_merge, page_assembly, page_anchors, record_parse, cell_ditto, answer_grades, retrieval_topk, hit_mrr, window_ab, hybrid_score,
        anchor_scores, order_rollup, tumbling_events,
    )
}

_EDGES = "e AS (SELECT 'part' || l_partkey AS source, 'supplier' || l_suppkey AS target, round(sum(l_quantity), 2) AS weight, count(*) AS n FROM lineitem GROUP BY 1, 2)"
_BOTH = "b AS (SELECT source AS node, target AS other, weight FROM e UNION ALL SELECT target, source, weight FROM e)"
_TOP = """v AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings),
    s AS (SELECT q.vec_id AS query, r.vec_id AS hit, q.label AS want, r.label, round(list_cosine_similarity(q.v, r.v), 6) AS score FROM v q JOIN v r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id),
    t AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, hit) AS rank FROM s)"""
_LOG = """g AS (SELECT user_id AS rel, event_id, ts, CASE event_type WHEN 'signup' THEN 'uploaded' WHEN 'view' THEN 'meta_done' WHEN 'click' THEN 'parse_requested' WHEN 'purchase' THEN 'done' ELSE 'failed' END AS status,
    CASE WHEN event_type = 'error' THEN props END AS error FROM events)"""
ORACLES = {
    "edge_merge": f"WITH {_EDGES} SELECT * FROM e",
    "degree": f"WITH {_EDGES}, {_BOTH} SELECT node, count(*) AS degree FROM b GROUP BY node",
    "neighbours": f"WITH {_EDGES}, {_BOTH} SELECT node, other, round(sum(weight), 2) AS weight FROM b GROUP BY 1, 2",
    "see_also": f"WITH {_EDGES}, {_BOTH} SELECT node, other, rank FROM (SELECT node, other, row_number() OVER (PARTITION BY node ORDER BY weight DESC, other) AS rank FROM b) WHERE rank <= 6",
    "contract_nodes": """SELECT least(s, t) AS source, greatest(s, t) AS target, round(sum(w), 2) AS weight, count(*) AS n FROM (SELECT 'part' || l_partkey AS s, 'nation' || s_nationkey AS t, l_quantity AS w
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) GROUP BY 1, 2""",
    "endpoint_semi": "SELECT DISTINCT 'part' || l_partkey AS source, 'supplier' || l_suppkey AS target FROM lineitem JOIN part ON l_partkey = p_partkey AND p_size < 10 JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 5000",
    "node_merge": """WITH t AS (SELECT p_brand, p_type, count(*) AS n, min(p_partkey) AS f FROM part GROUP BY 1, 2), b AS (SELECT p_brand, arg_min(p_type, (-n, f)) AS type FROM t GROUP BY 1)
        SELECT p_brand AS name, any_value(type) AS type, array_to_string(list_sort(list_distinct(list(p_name))), '<SEP>') AS description, count(DISTINCT p_partkey) AS n_sources FROM part JOIN b USING (p_brand) GROUP BY 1""",
    "prioritised_nodes": f"""WITH {_EDGES}, {_BOTH}, g AS (SELECT node, count(*) AS degree FROM b GROUP BY 1) SELECT name, type, coalesce(degree, 0) AS degree FROM (SELECT 'supplier' || s_suppkey AS name,
        CASE WHEN s_nationkey < 5 THEN 'Unit' ELSE 'other' END AS type FROM supplier) LEFT JOIN g ON node = name ORDER BY type <> 'Unit', degree DESC, name LIMIT 20""",
    "reverse_index": "SELECT r_name AS key, string_agg(DISTINCT n_name, '|' ORDER BY n_name) AS values FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1",
    "link_graph": """SELECT DISTINCT source, target FROM (SELECT l[1] AS source, unnest(l) AS target FROM (SELECT regexp_extract_all(html, 'href="/([^"]+)"', 1) AS l FROM pages)) WHERE source <> target""",
    "timeline": """WITH o AS (SELECT 'customer' || o_custkey AS node, 'order' || o_orderkey AS other, CASE WHEN o_orderkey % 5 > 0 THEN year(o_orderdate) ELSE try_cast(nullif(regexp_extract('order' || o_orderkey, '(20[0-9]{2}|19[0-9]{2})', 1), '') AS BIGINT) END AS year,
        o_totalprice AS w, contains(lower(o_orderpriority), 'urgent') AS hit FROM orders), a AS (SELECT *, bool_or(hit) OVER (PARTITION BY node) AS any_hit FROM o)
        SELECT node, other, year::INTEGER AS year, row_number() OVER (PARTITION BY node ORDER BY year IS NULL, year, w DESC, other) AS place FROM a WHERE hit OR NOT any_hit""",
    "dim_lookup_missing": "SELECT s_suppkey, s_nationkey, n_name, CASE WHEN n_name IS NULL THEN 'failed' ELSE 'ok' END AS status FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_nationkey <> 7",
    "unique_candidate_reuse": "SELECT p_brand, p_size, p_type, min(p_partkey) AS p_partkey FROM part GROUP BY 1, 2, 3 HAVING count(*) = 1",
    "group_pair_verdict": """WITH d AS (SELECT p_brand AS dir, p_partkey AS stem, CASE WHEN p_partkey % 7 > 0 THEN p_size END AS pages, count(*) OVER (PARTITION BY p_brand) AS n_docs FROM part),
        g AS (SELECT l_partkey AS base, p_brand AS dir, count(*) AS size FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_partkey % 2 = 0 GROUP BY 1, 2), f AS (SELECT dir, sum(size) AS total FROM g GROUP BY 1)
        SELECT d.dir, d.stem::VARCHAR AS stem, CASE WHEN total IS NULL THEN 'keep' WHEN coalesce(pages = size OR ((size IS NOT NULL OR n_docs = 1) AND pages = total), false) THEN 'drop'
          WHEN size IS NOT NULL OR n_docs = 1 THEN 'review' ELSE 'keep' END AS verdict FROM d LEFT JOIN g ON d.dir = g.dir AND d.stem = g.base LEFT JOIN f ON d.dir = f.dir""",
    "set_diff_names": """WITH s AS (SELECT p_brand, coalesce(list(DISTINCT p_name) FILTER (p_size > 45), []) AS e, coalesce(list(DISTINCT p_name) FILTER (p_size < 5), []) AS f FROM part GROUP BY 1),
        x AS (SELECT p_brand, list_sort(list_filter(e, lambda a: NOT list_contains(f, a))) AS m, list_sort(list_filter(f, lambda a: NOT list_contains(e, a))) AS u FROM s)
        SELECT p_brand, len(m) = 0 AND len(u) = 0 AS passed, array_to_string(m, '|') AS missing, array_to_string(u, '|') AS unexpected FROM x""",
    "subset_update": """WITH s AS (SELECT p_brand, list_sort(list(DISTINCT p_type)) AS o, list_sort(coalesce(list(DISTINCT p_name) FILTER (p_size > 48), [])) AS n FROM part GROUP BY 1)
        SELECT p_brand, len(list_filter(n, lambda a: NOT list_contains(o, a))) > 0 AS changed, array_to_string(o || list_filter(n, lambda a: NOT list_contains(o, a)), '|') AS keywords FROM s""",
    "last_ok_wins": "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1",
    "never_ok": "SELECT key FROM (SELECT user_id * 100 + event_id % 100 AS key, event_type FROM events) GROUP BY key HAVING count(*) FILTER (event_type = 'signup') = 0",
    "state_machine": f"""WITH {_LOG}, r AS (SELECT rel, arg_max(status, (ts, event_id)) AS status, arg_max_null(CASE WHEN status = 'failed' THEN error END, (ts, event_id)) AS error, count(*) AS events, epoch(max(ts)) - epoch(min(ts)) AS span FROM g GROUP BY 1)
        SELECT rel, CASE WHEN status NOT IN ('done', 'failed') AND span > 86400 THEN 'wait_timeout' ELSE status END AS status, error, events FROM r""",
    "gate_first_failure": """SELECT event_id, CASE WHEN coalesce(before, 1) = 0 THEN 'not_run' WHEN event_type <> 'error' THEN 'done' ELSE 'failed' END AS gate FROM (SELECT event_id, event_type,
        min((event_type <> 'error')::INTEGER) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM events)""",
    "majority_vote": "SELECT event_id // 3 AS case_id, count(*) AS runs, count(*) FILTER (value > 20) AS passes, count(*) FILTER (value > 20) >= 2 AS majority, bool_or(value > 20) AS any_run FROM events GROUP BY 1",
    "json_props": "SELECT json_extract(props, '$.k')::INTEGER AS k, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1",
    "before_after": """WITH x AS (SELECT user_id, event_id % 2 AS run, count(*) FILTER (event_type = 'error') * 5 <= count(*) AS passed FROM events GROUP BY 1, 2)
        SELECT user_id, a.passed AS before, b.passed AS after, CASE WHEN a.passed IS NULL THEN 'new' WHEN b.passed IS NULL THEN 'gone' WHEN a.passed = b.passed THEN 'same' WHEN b.passed THEN 'fixed' ELSE 'broken' END AS change
        FROM (SELECT * FROM x WHERE run = 0) a FULL JOIN (SELECT * FROM x WHERE run = 1) b USING (user_id)""",
    "gaps_islands": """SELECT l_orderkey, min(line)::BIGINT AS first, max(line)::BIGINT AS last, count(*) AS size FROM (SELECT *, line - row_number() OVER (PARTITION BY l_orderkey ORDER BY line) AS i
        FROM (SELECT DISTINCT l_orderkey, l_linenumber AS line FROM lineitem WHERE l_quantity > 20)) GROUP BY l_orderkey, i""",
    "run_merge": """WITH x AS (SELECT *, role || (length(text) > 300)::VARCHAR AS side FROM conversations), y AS (SELECT *, coalesce(side <> lag(side) OVER (PARTITION BY conv_id ORDER BY turn), true) AS new FROM x),
        z AS (SELECT *, sum(new::INTEGER) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS run FROM y)
        SELECT conv_id, run, any_value(side) AS side, min(turn) AS first_turn, count(*) AS turns, md5(string_agg(text, chr(10) ORDER BY turn)) AS text_md5 FROM z GROUP BY 1, 2""",
    "page_assembly": "SELECT conv_id, md5(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS text_md5, count(*) AS pages, max(turn) AS last, max(turn) + 1 = count(*) AS complete FROM conversations GROUP BY 1",
    "page_anchors": r"""SELECT conv_id, turn, left(list_filter(list_transform(string_split(text, chr(10)), lambda l: regexp_replace(l, '^\s+|\s+$', '', 'g')),
        lambda l: length(regexp_replace(l, '[^\x{4e00}-\x{9fff}A-Za-z0-9]', '', 'g')) >= 4 AND NOT regexp_full_match(l, '[|:\-\s]+'))[1], 20) AS anchor FROM conversations""",
    "record_parse": """SELECT conv_id, turn, CASE WHEN w = '' AND role = 'user' THEN NULL WHEN role = 'user' THEN 'entity' ELSE 'relationship' END AS kind, CASE WHEN role = 'user' THEN nullif(w, '') ELSE least(w, 'M') END AS name,
        CASE WHEN role <> 'user' THEN greatest(w, 'M') END AS other, CASE WHEN role = 'user' AND w <> '' THEN upper(role) END AS type, CASE WHEN role <> 'user' THEN 'says' WHEN w <> '' THEN 'a & b' END AS description,
        CASE WHEN role <> 'user' THEN 'talk' END AS keywords, CASE WHEN role <> 'user' THEN turn::DOUBLE END AS weight FROM (SELECT conv_id, turn, role, upper(regexp_extract(text, '([A-Za-z]+)', 1)) AS w FROM conversations)""",
    "answer_grades": """SELECT conv_id, turn, CASE WHEN contains(a, 'zwölf') THEN 'forbidden' WHEN NOT contains(a, 'en') THEN 'missing' WHEN NOT (contains(a, 'ou') OR contains(a, 'st') OR contains(a, 'ge')) THEN 'none_of' ELSE 'pass' END AS grade
        FROM (SELECT conv_id, turn, lower(translate(text, '～＞％ *#`', '~>%')) AS a FROM conversations WHERE role = 'assistant')""",
    "retrieval_topk": f"WITH {_TOP} SELECT query, hit, score, rank FROM t WHERE rank <= 10",
    "hit_mrr": f"""WITH {_TOP}, f AS (SELECT query, coalesce(min(rank) FILTER (label = want AND rank <= 10), 0) AS r FROM t GROUP BY 1)
        SELECT count(*) AS n, count(*) FILTER (r BETWEEN 1 AND 5) AS hit5, count(*) FILTER (r > 0) AS hit10, round(sum(CASE WHEN r > 0 THEN 1.0 / r ELSE 0 END) / count(*), 6)::DOUBLE AS mrr FROM f""",
    "window_ab": f"""WITH {_TOP}, x AS (SELECT query, min(rank) FILTER (rank <= 8) AS narrow, min(rank) FILTER (rank <= 64) AS wide FROM t WHERE label = (want + 3) % 10 AND rank <= 64 GROUP BY 1)
        SELECT query, narrow, wide, (narrow IS NULL) <> (wide IS NULL) AS flipped FROM x""",
    "hybrid_score": f"""WITH {_TOP}, h AS (SELECT query, hit, round(0.3 * (label = want)::INTEGER + 0.7 * score + CASE WHEN label % 3 = want % 3 THEN 0.01 ELSE 0 END, 6)::DOUBLE AS final FROM t WHERE rank <= 64),
        r AS (SELECT query, hit, final AS score, row_number() OVER (PARTITION BY query ORDER BY final DESC, hit) AS rank FROM h) SELECT * FROM r WHERE rank <= 5""",
    "anchor_scores": """WITH c AS (SELECT item_id AS case_id, list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda w: length(w) > 4)[1:3] AS kw FROM benchmark),
        m AS (SELECT max(item_id) + 1 AS n FROM benchmark),
        r AS (SELECT doc_id % n AS case_id, doc_id // n + 1 AS rank, regexp_replace(lower(text), '([0-9]),+', '\\1', 'g') AS t FROM documents, m WHERE doc_id // n < 10),
        h AS (SELECT c.case_id, kw, rank, contains(t, '1000') AS num, list_filter(kw, lambda k: contains(t, k)) AS f FROM c LEFT JOIN r USING (case_id)),
        g AS (SELECT case_id, any_value(len(kw)) AS nk, min(rank) FILTER (num OR len(f) > 0) AS fr, coalesce(bool_or(num), false) AS num, len(list_distinct(flatten(list(coalesce(f, []))))) AS kh FROM h GROUP BY 1)
        SELECT case_id, coalesce(fr, 0) BETWEEN 1 AND 5 AS hit5, fr IS NOT NULL AS hit10, coalesce(fr, 0) AS mrr_rank, num AS numeric_exact, kh AS kw_hits, CASE WHEN nk > 0 THEN 2::BIGINT ELSE 0 END AS kw_needed,
          (num OR fr IS NOT NULL) AND (nk = 0 OR kh >= 2) AS passed FROM g""",
    "order_rollup": "SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)",
    "tumbling_events": "SELECT strftime(ts, '%Y-%m-%d %H') AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}

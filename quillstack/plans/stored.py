"""Queries that write tables, logs and texts to the shared folder and read them again, faults included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstack.operators.components import cut
from quillstack.session import fresh_path, table
from quillstack.sources import files, sinks

LONG = "long"


def catalogue_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a catalogue in CSV with fixed columns: quotes, commas and empty fields; read as strings, then typed."""
    title = F.trim(F.regexp_extract("html", r"<h1>([^<]*)</h1>", 1))
    x = table(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("rel"), F.regexp_extract("html", r'lang="(\w+)"', 1).alias("dataset_key"), F.concat(F.lit('"'), title, F.lit('", "x')).alias("title"),
        F.nullif(F.regexp_extract("url", r"/(\d+)", 1), F.lit("")).alias("year"), F.when(F.length("html") % 3 == 0, "").otherwise("short, too").alias("skip_reason"),
    )
    path = fresh_path(spark, "catalogue")
    columns = ["rel", "dataset_key", "title", "year", "skip_reason"]
    sinks.write_csv(x, path, columns)
    return files.entries(files.catalogue_csv(spark, path, ", ".join(f"{c} string" for c in columns)))


def tolerant_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as a log of JSON lines of which some are cut off, blank or arrays; what can be read, and which keys are done."""
    row = F.to_json(F.struct(F.concat_ws("/", "conv_id", F.col("turn") % 2).alias("rel"), (F.length("text") % 2 == 0).alias("ok"), "text"))
    k = F.length("text") % 7
    line = F.when(k == 0, F.left(row, F.length(row) - 1)).when(k == 1, " ").when(k == 2, F.concat(F.lit("["), row, F.lit("]"))).when(k == 3, F.concat(F.lit("  "), row, F.lit(" "))).otherwise(row)
    path = fresh_path(spark, "log")
    table(spark, sf_dir, "conversations").select(line.alias("value")).write.text(path)
    log = files.tolerant_jsonl(spark, path, "rel string, ok boolean, text string")
    done = files.done_keys(log).withColumn("done", F.lit(True))
    return log.join(done, "rel", "left").select("rel", F.md5("text").alias("text_md5"), F.coalesce("done", F.lit(False)).alias("done"))


def case_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as evaluation cases in JSON lines, blank lines between, read by the strict loader, which fills what is left out."""
    odd = F.col("p_size") % 2 == 1
    words = F.split("p_name", " ")
    gold = F.struct(F.when(odd, F.array(F.col("p_size").cast("string"))).alias("numbers"), F.when(~odd, words).alias("keywords"), F.array("p_brand").alias("source_rel"))
    case = F.struct(
        F.concat(F.lit("c-"), "p_partkey").alias("id"), F.lower("p_type").alias("tier"), F.when(odd, "structured").otherwise("free").alias("layer"), F.col("p_name").alias("question"), F.array("p_brand").alias("datasets"),
        F.when(F.col("p_size") > 25, F.col("p_size") > 40).alias("use_kg"), F.when(odd, F.col("p_brand")).alias("meta_filter"), gold.alias("gold"), F.when(F.col("p_size") > 10, F.struct((F.col("p_size") % 3).alias("min_keywords"))).alias("threshold"),
    )
    path = fresh_path(spark, "cases")
    part = table(spark, sf_dir, "part")
    part.select(F.concat(F.to_json(case), F.when(odd, "\n ").otherwise("")).alias("value")).write.text(path)
    tiers = ["economy", "standard", "medium", "small", "large", "promo"]
    x = files.cases(spark, path, tiers, ["structured", "free"], part.select(F.col("p_brand").alias("rel")).distinct())
    anchors = F.concat_ws("|", "gold.numbers", "gold.keywords")
    return x.select("id", "tier", "layer", "use_kg", "meta_filter", anchors.alias("anchors"), F.col("threshold.min_keywords").cast(LONG).alias("min_keywords"))


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and types of parts as a vocabulary text; descriptions hold commas, some lines three columns."""
    tag = F.when(F.col("p_size") == 7, F.concat("p_type", F.lit("\tmore"))).otherwise(F.concat(F.lit(" "), "p_type"))
    x = table(spark, sf_dir, "part").select(F.concat("p_name", F.lit(", "), "p_brand").alias("description"), tag.alias("tag"))
    path = fresh_path(spark, "vocabulary")
    sinks.write_vocabulary(x, path)
    return files.two_columns(spark, path).groupBy("description", "tag").agg(F.count("*").alias("n"))


def written_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of documents in a folder for each language: bytes by a scan of the files, lines and characters by reading them."""
    path = fresh_path(spark, "texts")
    sinks.write_documents(table(spark, sf_dir, "documents"), path, "lang", "text")
    sizes = files.files(spark, path, ["txt"]).groupBy(F.regexp_extract("rel", r"^lang=([^/]*)/", 1).alias("lang")).agg(F.sum("length").alias("n_bytes"))
    lines = spark.read.text(path).groupBy("lang").agg(F.count("*").alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))
    return sizes.join(lines, "lang")


def patched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of orders in which rows are replaced, added and patched in place."""
    path = fresh_path(spark, "orders")
    x = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    x.write.parquet(path)
    high = x.where("o_orderpriority = '2-HIGH'")
    new = high.withColumn("o_orderstatus", F.lit("N")).unionByName(high.withColumns({"o_orderkey": -F.col("o_orderkey") - 1, "o_orderpriority": F.lit(None).cast("string")}))
    sinks.upsert_table(spark.read.parquet(path), new, "o_orderkey", path)
    changes = x.where("o_totalprice > 200000").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "Z").alias("o_orderstatus"), F.when(F.col("o_orderpriority") == "5-LOW", "0").alias("o_orderpriority"))
    sinks.patch_table(spark.read.parquet(path), changes, "o_orderkey", path)
    return spark.read.parquet(path)


def archived_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced after its archive was made, then rolled back: each state's totals by status."""
    path, archive = fresh_path(spark, "orders"), fresh_path(spark, "archive")
    x = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    seen = lambda at, name: cut(spark.read.parquet(at).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).withColumn("state", F.lit(name)))
    sinks.write_table(x, path)
    sinks.write_table(x.where("o_orderpriority <> '5-LOW'"), path, archive)
    states = seen(path, "replaced").unionByName(seen(archive, "archive"))
    sinks.roll_back(spark, path, archive)
    return states.unionByName(seen(path, "restored"))


def batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written in four batches of which two are repeated: each is there once."""
    path = fresh_path(spark, "batches")
    x = table(spark, sf_dir, "events").select("event_id", "event_type", "value", (F.col("event_id") % 4).alias("part"))
    for number in (0, 1, 1, 2, 3, 2):
        sinks.write_batch(x.where(F.col("part") == number).drop("part"), path, number)
    found = sinks.read_batches(spark, path, "event_id long, event_type string, value double")
    return found.groupBy("batch", "event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


def tag_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents get the tag weights of their source: its languages, each with its number of documents; sources of one language give none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("doc_name"), "lang", F.create_map(F.lit("old"), F.lit(1)).alias("tag_feas"))
    counts = docs.groupBy("doc_name", "lang").agg(F.count("*").cast("int").alias("n"))
    tags = counts.groupBy("doc_name").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "n")))).alias("tag_feas")).where(F.size("tag_feas") > 3)
    written = F.array_join(F.transform(F.map_entries("tag_feas"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), "|")
    return sinks.backfill_tags(docs, tags).select("doc_id", "doc_name", written.alias("tags"))


QUERIES = {f.__name__: f for f in (catalogue_round, tolerant_log, case_lines, vocabulary, written_texts, patched_orders, archived_orders, batch_log, tag_backfill)}

ORACLES: dict[str, str] = {
    "catalogue_round": r"""
SELECT url AS rel, regexp_extract(html, 'lang="(\w+)"', 1) AS dataset_key, '"' || trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)) || '", "x' AS title,
  nullif(regexp_extract(url, '/(\d+)', 1), '') AS year, CASE WHEN length(html) % 3 > 0 THEN 'short, too' END AS skip_reason FROM pages
""",
    "tolerant_log": """
WITH t AS (SELECT conv_id || '/' || (turn % 2) AS rel, length(text) AS n, text FROM conversations WHERE length(text) % 7 > 2)
SELECT rel, md5(text) AS text_md5, bool_or(n % 2 = 0) OVER (PARTITION BY rel) AS done FROM t
""",
    "case_lines": """
SELECT 'c-' || p_partkey AS id, lower(p_type) AS tier, CASE WHEN p_size % 2 = 1 THEN 'structured' ELSE 'free' END AS layer, p_size > 40 AS use_kg, CASE WHEN p_size % 2 = 1 THEN p_brand END AS meta_filter,
  CASE WHEN p_size % 2 = 1 THEN p_size::VARCHAR ELSE replace(p_name, ' ', '|') END AS anchors, CASE WHEN p_size > 10 THEN p_size % 3 ELSE 1 END::BIGINT AS min_keywords FROM part
""",
    "vocabulary": "SELECT p_name || ', ' || p_brand AS description, p_type AS tag, count(*) AS n FROM part WHERE p_size <> 7 GROUP BY ALL",
    "written_texts": """
SELECT lang, sum(strlen(text) + 1)::BIGINT AS n_bytes, sum(len(string_split(text, chr(10))))::BIGINT AS n_lines, sum(length(replace(text, chr(10), '')))::BIGINT AS n_chars FROM documents GROUP BY lang
""",
    "patched_orders": """
WITH u AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN 'N' ELSE o_orderstatus END AS s, o_totalprice, o_orderpriority AS p, o_orderstatus AS old FROM orders
  UNION ALL SELECT -o_orderkey - 1, o_orderstatus, o_totalprice, NULL, NULL FROM orders WHERE o_orderpriority = '2-HIGH')
SELECT o_orderkey, CASE WHEN o_orderkey >= 0 AND o_totalprice > 200000 AND old = 'F' THEN 'Z' ELSE s END AS o_orderstatus, o_totalprice,
  CASE WHEN o_orderkey >= 0 AND o_totalprice > 200000 AND p = '5-LOW' THEN '0' ELSE p END AS o_orderpriority FROM u
""",
    "archived_orders": """
SELECT state, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders, (SELECT unnest(['replaced', 'archive', 'restored']) AS state)
WHERE state <> 'replaced' OR o_orderpriority <> '5-LOW' GROUP BY ALL
""",
    "batch_log": "SELECT event_id % 4 AS batch, event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY ALL",
    "tag_backfill": """
WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL),
t AS (SELECT source, string_agg(lang || '=' || n, '|' ORDER BY lang) AS tags FROM c GROUP BY source HAVING count(*) > 3)
SELECT doc_id, d.source AS doc_name, tags FROM documents d LEFT JOIN t ON t.source = d.source
""",
}

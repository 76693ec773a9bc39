"""Queries over documents and pages: duplicates, profiles, flags, metadata, text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstack.functions import text as T
from quillstack.functions import values as V
from quillstack.operators import anchors, dedup, matching, metadata, profile
from quillstack.session import table

LONG = "long"
STRIPPED = r"regexp_replace({}, '^[\s\x{{3000}}]+|[\s\x{{3000}}]+$', '', 'g')"
FLAG_SQL = r"""CASE WHEN length(b) = 0 THEN 'empty'
    WHEN len(regexp_extract_all(b, '[\x{4e00}-\x{9fff}A-Za-z0-9]')) / length(b) < 0.3 THEN 'noise' WHEN length(b) < 50 THEN 'fragment' END"""


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("digest"))
    return dedup.mark_exact(docs, ["digest"], [F.length("source"), F.col("doc_id")], "doc_id").select("doc_id", "digest", "canonical_id", "is_duplicate")


def dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All but the first of each exact text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return dedup.mark_exact(docs, ["digest"], [F.col("doc_id")], "doc_id").where("is_duplicate").select("doc_id", F.col("canonical_id").alias("first_id"))


def same_folder_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies within a folder by size, then content; marked names lose."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("dir"), F.col("n_chars").alias("size"), F.md5("text").alias("digest"))
    return dedup.by_cheap_key(docs, ["dir", "size"], ["digest"], [F.col("doc_id") % 3 == 0, F.col("doc_id")], "doc_id").select("doc_id", "dir", "kept_id")


def prefix_dup_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.repeated_heads(table(spark, sf_dir, "documents"), "text")


def length_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", F.length("text").cast(LONG).alias("x"))
    ranks = profile.nearest_ranks(docs, ["lang"], "x", {"p50": 0.5, "p90": 0.9, "p99": 0.99})
    over = docs.groupBy("lang").agg(F.count_if(F.col("x") > 2048).alias("over_2048"), F.count_if(F.col("x") > 4096).alias("over_4096"), F.count_if(F.col("x") < 30).alias("under_30"))
    return ranks.drop("mean").join(over, "lang")


def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.length_stats(table(spark, sf_dir, "documents"), F.length("text")).select("n", "mean", F.col("min").cast(LONG).alias("min"), F.col("max").cast(LONG).alias("max"))


def line_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("doc_id", F.col("line_no").cast(LONG).alias("line_no"), T.chunk_flag(F.col("line")).alias("flag")).where("flag is not null")


def quality_flags_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = T.chunk_flag(F.col("text"))
    docs = table(spark, sf_dir, "documents").select("lang", flag.alias("flag"))
    return docs.groupBy("lang").agg(F.count("*").alias("n"), *[F.count_if(F.col("flag") == f).alias(f) for f in ("empty", "noise", "fragment")])


def priority_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    bucket = profile.first_bucket(
        [("A-toxic", F.col("toxic") == 1), ("B-poor", F.col("quality") == 0), ("C-unjudged", F.col("quality").isNull()), ("D-short", F.col("n_chars") < 200)], "F-ok"
    )
    return profile.histogram(docs, bucket, "bucket")


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.histogram(table(spark, sf_dir, "labels"), F.col("quality"), "quality")


def error_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = profile.pattern_errors(table(spark, sf_dir, "documents"), "text", {"shout": "!!", "hash": "###", "amp": "&&&", "star": r"\*\*\*", "per": "%%%"})
    return docs.select("doc_id", F.col("errors").cast(LONG).alias("errors"), F.col("kinds").cast(LONG).alias("kinds"), "tier").where("errors > 0")


def copy_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of documents of each source that are the canonical copy of their text."""
    return profile.coverage(exact_dedup(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id"), F.col("source"), "source", ~F.col("is_duplicate"))


def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", V.hash_bucket(F.col("doc_id")).cast(LONG).alias("bucket")).where("bucket < 10")


def match_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.match_form(F.col("text"))).alias("match_md5"), F.md5(T.answer_form(F.col("text"))).alias("answer_md5"))


def numeric_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = F.filter(F.split("text", "[ \n]"), T.numeric_cell)
    return table(spark, sf_dir, "documents").select("doc_id", F.size(cells).cast(LONG).alias("n_cells")).where("n_cells > 0")


def meta_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    both = metadata.metadata_filter(docs, [{"key": "lang", "op": "=", "value": "de"}, {"key": "source", "op": "=", "value": "src3"}])
    either = metadata.metadata_filter(docs, [{"key": "lang", "op": "=", "value": "es"}, {"key": "source", "op": "=", "value": "src1"}], "or")
    fields = V.sparse_map({"lang": F.col("lang"), "source": F.col("source"), "none": F.lit(""), "size": F.col("n_chars")})
    x = both.withColumn("logic", F.lit("and")).unionByName(either.withColumn("logic", F.lit("or")))
    return x.select("logic", "doc_id", F.size(fields).cast(LONG).alias("n_fields"), F.concat_ws(";", F.array_sort(F.transform(F.map_entries(fields), lambda e: F.concat(e["key"], F.lit("="), e["value"])))).alias("fields"))


def metadata_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue columns from the path of a page's url, taken as a file."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.regexp_extract("url", r"://([^?#]*)", 1), F.element_at(F.array(*map(F.lit, (".pdf", ".DOC", ".xlsx", "_dup.pdf"))), (F.col("page_id") % 4 + 1).cast("int"))).alias("rel"))
    out = metadata.derive(pages, "rel", 2026, {"en": "english", "de": "german"}, "other")
    return out.select("page_id", "sub_category", "doc_category", "source_format", "quality", "year", "is_marked_copy")


def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.md5(T.html_strip(F.col("html"))).alias("stripped_md5"))


def media_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions put after a table, by page id and the page's first link."""
    title = F.regexp_extract("html", r'href="/([A-Za-z]+)', 1)
    content = F.concat(F.lit("<table><tr></tr></table> 表 "), F.col("page_id").cast("string"), F.lit(".1 "), title, F.lit("，abc 表9"))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(T.media_keywords(content, F.lit("table")), "|").alias("keywords"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct links from a page to the targets it names."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("source"), F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1))).alias("target"))
    return pages


def anchor_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "benchmark").select("item_id", F.left("text", F.lit(60)).alias("anchor"))
    return anchors.contains_join(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", wanted, "anchor").select("item_id", "doc_id")


def resume_left_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.todo(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


def survivor_left_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return matching.survivors(table(spark, sf_dir, "documents").select("doc_id", "lang"), good, "doc_id")


def multiset_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even against odd ids, by language and source, then size and content."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat("lang", F.lit("/"), "source").alias("name"), "n_chars", F.md5("text").alias("digest"))
    return matching.tiered_match(docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1"), "doc_id", [["name", "n_chars", "digest"], ["name", "n_chars"], ["name"]], ["identical", "same_size", "same_name"])


def qc_pass_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return profile.pass_rates(judged, "lang", F.col("quality") == 1)


def chunk_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sections (a heading for their first line) cut into chunks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("## "), "text").alias("md"))
    return docs.select("doc_id", F.posexplode(T.chunks(F.col("md"))).alias("pos", "chunk"))


def linkify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link the names of a page's own menu in its stripped text."""
    names = F.array_distinct(F.regexp_extract_all("html", F.lit('href="/([A-Za-z]+)'), 1))
    pages = table(spark, sf_dir, "pages").select("page_id", T.html_strip(F.col("html")).alias("md"), names.alias("names"))
    linked = T.linkify(F.col("md"), F.col("names"), F.lit(""))
    return pages.select("page_id", linked.alias("linked"), F.size(T.wikilinks(linked)).cast(LONG).alias("n_links"))


def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.safe_file_name(F.col("url"), 40).alias("file_name"), T.safe_sheet_name(F.col("url")).alias("sheet_name"))


def token_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.token_estimate(F.col("text")).cast(LONG).alias("tokens"), F.md5(T.token_cut(F.col("text"), 64)).alias("cut_md5"))


def keyword_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a document has a keyword, or enough of its letters."""
    return table(spark, sf_dir, "documents").select("doc_id", V.coverage_hit(F.col("text"), F.lit("zwölfköpfig")).alias("hit")).where("hit")


QUERIES = {
    f.__name__: f
    for f in (
        exact_dedup, dup_groups, same_folder_dedup, prefix_dup_heads, length_profile, length_stats, line_flags, quality_flags_by_lang, priority_buckets, category_counts,
        error_tiers, copy_coverage, hash_sample, match_normalise, numeric_cells, meta_filter, metadata_derive, html_strip, media_keywords, page_links, anchor_hits,
        resume_left_anti, survivor_left_semi, multiset_match, qc_pass_rates, chunk_pack, linkify, safe_names, token_estimates, keyword_coverage,
    )
}

_DEDUP = """d AS (SELECT doc_id, source, sha256(text) AS digest FROM documents),
    c AS (SELECT digest, arg_min(doc_id, (length(source), doc_id)) AS canonical_id FROM d GROUP BY digest)"""
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)).replace("'", "''")
ORACLES = {
    "exact_dedup": f"WITH {_DEDUP} SELECT d.doc_id, d.digest, c.canonical_id, d.doc_id <> c.canonical_id AS is_duplicate FROM d JOIN c USING (digest)",
    "dup_groups": """SELECT doc_id, first_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS first_id FROM documents) WHERE doc_id <> first_id""",
    "same_folder_dedup": """SELECT doc_id, source AS dir, kept_id FROM (SELECT doc_id, source, first_value(doc_id) OVER (PARTITION BY source, n_chars, md5(text) ORDER BY doc_id % 3 = 0, doc_id) AS kept_id FROM documents)
        WHERE doc_id <> kept_id""",
    "prefix_dup_heads": "SELECT left(text, 80) AS head, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) >= 3 ORDER BY n DESC, head LIMIT 8",
    "length_profile": """WITH g AS (SELECT lang, list(length(text) ORDER BY length(text)) AS l, count(*) AS n FROM documents GROUP BY lang)
        SELECT lang, n, l[1] AS min, l[floor(n * 0.5)::BIGINT + 1] AS p50, l[floor(n * 0.9)::BIGINT + 1] AS p90, l[floor(n * 0.99)::BIGINT + 1] AS p99, l[n] AS max,
          len(list_filter(l, lambda x: x > 2048)) AS over_2048, len(list_filter(l, lambda x: x > 4096)) AS over_4096, len(list_filter(l, lambda x: x < 30)) AS under_30 FROM g""",
    "length_stats": "SELECT count(text) AS n, round(avg(length(text)), 1) AS mean, min(length(text)) AS min, max(length(text)) AS max FROM documents",
    "line_flags": rf"""SELECT doc_id, line_no, flag FROM (SELECT doc_id, line_no, {FLAG_SQL} AS flag FROM (SELECT doc_id, line_no, {STRIPPED.format('line')} AS b
        FROM (SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)))) WHERE flag IS NOT NULL""",
    "quality_flags_by_lang": rf"""SELECT lang, count(*) AS n, count(*) FILTER (flag = 'empty') AS empty, count(*) FILTER (flag = 'noise') AS noise, count(*) FILTER (flag = 'fragment') AS fragment
        FROM (SELECT lang, {FLAG_SQL} AS flag FROM (SELECT lang, {STRIPPED.format('text')} AS b FROM documents)) GROUP BY lang""",
    "priority_buckets": """SELECT CASE WHEN toxic = 1 THEN 'A-toxic' WHEN quality = 0 THEN 'B-poor' WHEN quality IS NULL THEN 'C-unjudged' WHEN n_chars < 200 THEN 'D-short' ELSE 'F-ok' END AS bucket,
        count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""",
    "category_counts": "SELECT coalesce(quality::VARCHAR, '?') AS quality, count(*) AS n FROM labels GROUP BY 1",
    "error_tiers": r"""SELECT doc_id, errors, kinds, CASE WHEN errors > 10 OR kinds >= 4 THEN 'heavy' WHEN errors > 3 THEN 'medium' WHEN errors > 0 THEN 'light' ELSE 'none' END AS tier FROM (
        SELECT doc_id, list_sum(c)::BIGINT AS errors, len(list_filter(c, lambda x: x > 0)) AS kinds FROM (
        SELECT doc_id, [len(regexp_extract_all(text, p)) FOR p IN ['!!', '###', '&&&', '\*\*\*', '%%%']] AS c FROM documents)) WHERE errors > 0""",
    "copy_coverage": f"""WITH {_DEDUP}, x AS (SELECT d.source, d.doc_id = c.canonical_id AS same FROM d JOIN c USING (digest))
        SELECT source, count(*) AS total, count(*) FILTER (same) AS identical, count(*) - count(*) FILTER (same) AS changed, round(100.0 * count(*) FILTER (same) / count(*), 1) AS percent FROM x GROUP BY source""",
    "hash_sample": """SELECT doc_id, bucket FROM (SELECT doc_id, list_reduce([0::BIGINT] || list_transform(string_split(sha256(doc_id::VARCHAR), ''), lambda c: (instr('0123456789abcdef', c) - 1)::BIGINT),
        lambda a, d: (a * 16 + d) % 100) AS bucket FROM documents) WHERE bucket < 10""",
    "match_normalise": rf"""SELECT doc_id, md5(regexp_replace(translate(lower(text), '{_WIDE}', '{_NARROW}'), '([\p{{Nd}}²³¹⁰⁴-⁹₀-₉]),+', '\1', 'g')) AS match_md5,
        md5(lower(translate(text, '～＞％ *#`', '~>%'))) AS answer_md5 FROM documents""",
    "numeric_cells": r"""SELECT doc_id, n_cells FROM (SELECT doc_id, len(list_filter(string_split_regex(text, '[ \n]'), lambda c: regexp_full_match(c, '[+-]?[0-9]+(\.[0-9]+)?'))) AS n_cells FROM documents) WHERE n_cells > 0""",
    "meta_filter": """WITH x AS (SELECT 'and' AS logic, * FROM documents WHERE lang = 'de' AND source = 'src3' UNION ALL SELECT 'or', * FROM documents WHERE lang = 'es' OR source = 'src1')
        SELECT logic, doc_id, 3::BIGINT AS n_fields, 'lang=' || lang || ';size=' || n_chars || ';source=' || source AS fields FROM x""",
    "metadata_derive": r"""WITH p AS (SELECT page_id, regexp_extract(url, '://([^?#]*)', 1) || ['.pdf', '.DOC', '.xlsx', '_dup.pdf'][page_id % 4 + 1] AS rel FROM pages),
        s AS (SELECT *, CASE WHEN len(string_split(rel, '/')) > 2 THEN regexp_replace(string_split(rel, '/')[2], '^[0-9]+-', '') END AS sub_category,
          ['pdf', 'word', 'excel', 'pdf'][page_id % 4 + 1] AS source_format, try_cast(nullif(regexp_extract(rel, '[0-9]{4}'), '') AS INTEGER) AS y FROM p)
        SELECT page_id, sub_category, CASE sub_category WHEN 'en' THEN 'english' WHEN 'de' THEN 'german' ELSE 'other' END AS doc_category, source_format,
          CASE WHEN source_format IN ('word', 'excel') THEN 'high' ELSE 'medium' END AS quality, CASE WHEN y BETWEEN 1949 AND 2026 THEN y::VARCHAR END AS year, page_id % 4 = 3 AS is_marked_copy FROM s""",
    "html_strip": r"""SELECT page_id, md5(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?i)<\s*br\s*/?\s*>', ' ', 'g'), '<[^>]+>', ' ', 'g'),
        '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '&nbsp;', ' '), '&quot;', '"'), '&#39;', ''''), '[\s\x{3000}]+', ' ', 'g'), '^ | $', '', 'g')) AS stripped_md5 FROM pages""",
    "media_keywords": r"""SELECT page_id, CASE WHEN t = '' THEN n ELSE n || '|' || n || ' ' || left(t, 24) || CASE WHEN length(left(t, 24)) <= 16 THEN '|' || n || left(t, 24) ELSE '' END END AS keywords
        FROM (SELECT page_id, '表' || page_id || '.1' AS n, regexp_extract(html, 'href="/([A-Za-z]+)', 1) AS t FROM pages)""",
    "page_links": """SELECT DISTINCT page_id AS source, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS target FROM pages""",
    "anchor_hits": "SELECT item_id, doc_id FROM documents d JOIN benchmark b ON contains(d.text, left(b.text, 60))",
    "resume_left_anti": "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "survivor_left_semi": "SELECT doc_id, lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1)",
    "multiset_match": """WITH d AS (SELECT doc_id, lang || '/' || source AS name, n_chars, md5(text) AS digest FROM documents),
        a1 AS (SELECT *, row_number() OVER (PARTITION BY name, n_chars, digest ORDER BY doc_id) AS t FROM d WHERE doc_id % 2 = 0), b1 AS (SELECT *, row_number() OVER (PARTITION BY name, n_chars, digest ORDER BY doc_id) AS t FROM d WHERE doc_id % 2 = 1),
        p1 AS (SELECT a1.doc_id AS l, b1.doc_id AS r FROM a1 JOIN b1 USING (name, n_chars, digest, t)),
        a2 AS (SELECT *, row_number() OVER (PARTITION BY name, n_chars ORDER BY doc_id) AS t2 FROM a1 WHERE doc_id NOT IN (SELECT l FROM p1)), b2 AS (SELECT *, row_number() OVER (PARTITION BY name, n_chars ORDER BY doc_id) AS t2 FROM b1 WHERE doc_id NOT IN (SELECT r FROM p1)),
        p2 AS (SELECT a2.doc_id AS l, b2.doc_id AS r FROM a2 JOIN b2 USING (name, n_chars, t2)),
        a3 AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id) AS t3 FROM a2 WHERE doc_id NOT IN (SELECT l FROM p2)), b3 AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id) AS t3 FROM b2 WHERE doc_id NOT IN (SELECT r FROM p2)),
        p3 AS (SELECT a3.doc_id AS l, b3.doc_id AS r FROM a3 JOIN b3 USING (name, t3))
        SELECT l AS left_id, r AS right_id, 'identical' AS tier FROM p1 UNION ALL SELECT l, r, 'same_size' FROM p2 UNION ALL SELECT l, r, 'same_name' FROM p3
        UNION ALL SELECT doc_id, NULL, 'left_only' FROM a3 WHERE doc_id NOT IN (SELECT l FROM p3) UNION ALL SELECT NULL, doc_id, 'right_only' FROM b3 WHERE doc_id NOT IN (SELECT r FROM p3)""",
    "qc_pass_rates": "SELECT lang, count(*) AS total, count(*) FILTER (quality = 1) AS passes, round(100.0 * count(*) FILTER (quality = 1) / count(*), 0)::BIGINT AS percent FROM labels JOIN documents USING (doc_id) GROUP BY lang",
    "safe_names": r"""SELECT page_id, left(regexp_replace(url, '[\\/:*?"<>|\s]+', '_', 'g'), 40) AS file_name, left(regexp_replace(url, '[\\/:*?\[\]]', '_', 'g'), 31) AS sheet_name FROM pages""",
    "token_estimates": "SELECT doc_id, greatest(length(text) // 2, 1) AS tokens, md5(left(text, 128)) AS cut_md5 FROM documents",
    "keyword_coverage": """SELECT doc_id, hit FROM (SELECT doc_id, contains(text, 'zwölfköpfig') OR len(list_filter(string_split('zwölfköpfig', ''), lambda c: contains(text, c))) / 11 >= 0.7 AS hit FROM documents) WHERE hit""",
}

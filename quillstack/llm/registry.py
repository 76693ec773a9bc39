"""Registered queries of the subpackage: one per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstack.llm import bpe, fill_middle, fingerprints, html_extract, jaccard_join, learned_partitions, line_dedup, packing, periodic_runs, quality_rules, secret_scans, sharding, url_filters
from quillstack.llm.common import load

#: Where the public tokenizers lie; parameters of the operators.
PACKING = {
    "tokenizer": public_tokenizers.path("byte_bpe_50k.json"), "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN
}
BPE = {"ranks": public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(load(spark, sf_dir, "pages"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.scan(load(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), **PACKING).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, bad) of pages whose text is that of a labelled document: of low quality or toxic.

    A page's heading repeats the start of its text, so the text is what follows
    it. Texts are compared by 64-bit hash, without white space. Ids of pages and
    documents have nothing to do with each other.
    """
    same = lambda text: F.xxhash64(F.translate(text, " \t\n\x0b\x0c\r\u00a0", ""))
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    labels = load(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    known = load(spark, sf_dir, "documents").select("doc_id", same(F.col("text")).alias("key")).join(labels, "doc_id").groupBy("key").agg(F.max("bad").alias("bad"))
    found = html_extract.extract(load(spark, sf_dir, "pages")).where(F.instr("text", "\n") > 0)
    return found.select("page_id", same(F.substr("text", F.instr("text", "\n"))).alias("key")).join(known, "key").select("page_id", "bad")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(load(spark, sf_dir, "pages"), page_outcomes(spark, sf_dir))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of nearly equal bytes; a k-d tree has no law for one more shard, so grown_shard is null."""
    return sharding.shards(load(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    scored = quality_rules.score(docs, keep_text=False)
    return quality_rules.judge(scored, quality_rules.cutoffs(scored, labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(load(spark, sf_dir, "documents"), **BPE)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.lines(load(spark, sf_dir, "documents")).drop("text_key")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(load(spark, sf_dir, "documents"), size=4, percent=85)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(load(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(load(spark, sf_dir, "documents"))


def op12_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.search(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.transform(load(spark, sf_dir, "documents")))


QUERIES = {
    f.__name__: f
    for f in (op1_html_extraction, op2_secret_scans, op3_packing, op4_url_filters, op5_sharding, op6_quality_rules, op7_bpe, op8_line_dedup, op9_jaccard_join, op10_fingerprints, op11_periodic_runs, op12_learned_partitions, op13_fill_middle)
}
#: op9: all pairs of documents that share a shingle, and the least id reachable by links. op13: lists of units, cut and joined again.
#: The others' results come from hashes, training or tokenizers, or need a search over all periods.
ORACLES: dict[str, str] = {
    "op9_jaccard_join": r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, [w FOR w IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+') IF w <> ''] AS w
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS shingle
  FROM words),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reached(doc_id, low) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT links.b, reached.low FROM reached JOIN links ON links.a = reached.doc_id WHERE reached.low < links.b)
SELECT r.doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(low)::BIGINT AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
""",
    "op13_fill_middle": r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d
  FROM documents),
draws AS (
  SELECT *, len(u)::BIGINT AS n, [('0x' || substr(d, 8 * k + 1, 8))::UBIGINT::BIGINT FOR k IN range(4)] AS h FROM units),
cuts AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM draws),
parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle, coalesce(array_to_string(u[b + 1:n], ''), '') AS suffix FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
""",
}

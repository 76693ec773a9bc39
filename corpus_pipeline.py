"""The corpus pipeline: documents to packed token sequences in five stages.

Every stage takes (spark, docs, sf_dir), sees all that the one before it kept
and returns the columns of documents; the last returns packed pieces. Stages
are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstack.llm import jaccard_join, line_dedup, packing, quality_rules, secret_scans
from quillstack.llm.common import load, materialize
from quillstack.llm.registry import PACKING


def carried(docs: DataFrame, *own: str) -> DataFrame:
    """docs with all columns but its own in a struct `_held`, so that their names can't be those of a stage's results."""
    held = F.struct(F.lit(0).alias("_"), *[F.col(c) for c in docs.columns if c not in own])
    return docs.select(*own, held.alias("_held"))


def restored(df: DataFrame, names: list[str], changed: dict[str, Column] | None = None) -> DataFrame:
    """The columns `names` of carried documents, in order, some of them changed."""
    held = set(df.schema["_held"].dataType.names)
    now = lambda c: F.col("_held").getField(c) if c in held else F.col(c)
    return df.select(*[(changed or {}).get(c, now(c)).alias(c) for c in names])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; cutoffs come from the labels.

    Null, empty and short texts are rejected; repeated rows share their fate; a
    null language is a stratum of its own. No rows give no rows.
    """
    scored = quality_rules.score(carried(docs, "doc_id", "text", "lang"))
    fitted = quality_rules.cutoffs(scored, load(spark, sf_dir, "labels"))
    kept = quality_rules.judge(scored, fitted).where("kept")
    return restored(kept.select("doc_id", "text", "lang", "_held"), docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, and documents that have none left (see line_dedup.dedup for nulls and the like)."""
    return line_dedup.dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by word shingles the one of least doc_id stays; of rows repeated with their id and text one.

    Unlike texts under one id all stay or go with that id. Which of several rows
    with one id and text stays is decided by their other columns, so a task that
    is run again takes the same one. Documents without words link with nothing
    and stay, as those without an id do. No rows give no rows.
    """
    found = jaccard_join.join(docs)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    # _held as a whole: of its fields one by one, the optimizer infers twice as many constraints with each
    others = F.to_json("_held", {"ignoreNullFields": "false"})
    turn = F.row_number().over(Window.partitionBy("doc_id", F.sha2("text", 256)).orderBy(others))
    one = carried(docs, "doc_id", "text").join(kept, "doc_id", "left_semi").withColumn("_turn", turn).where("_turn = 1").drop("_turn")
    return restored(one, docs.columns).unionByName(docs.where("doc_id is null"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; all documents stay, repeated rows too. n_chars is counted anew.

    Null texts become empty ones. No rows give no rows.
    """
    found = secret_scans.scan(carried(docs, "doc_id", "text"), keep=["_held"], redacted=True).select("doc_id", "_held", "redacted")
    return restored(found, docs.columns, {"text": F.col("redacted"), "n_chars": F.length("redacted").cast("long")})


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents: null and empty texts are their end mark alone, repeated rows are packed each. No rows give no pieces."""
    return packing.pack(docs, **PACKING).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("packing", packed),
]
#: Hash-based stages, training and tokenizers can't be stated in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

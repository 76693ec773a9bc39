"""Writers: catalogues, logs, keyed tables, reports, vocabularies, archive and rollback."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from quillstack.operators.matching import patch, upsert


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """The columns in a fixed order with a header; null as empty, others left out."""
    df.select(*columns).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_batch(df: DataFrame, path: str, number: int) -> None:
    """A batch of a stream as JSON lines under its number. Written again after a failure it takes its own place, so it is there once."""
    df.write.mode("overwrite").json(f"{path}/batch={number}")


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A writer that appends every batch once, however often it is tried; start it to run. Read with read_batches."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, number: write_batch(df, path, number))


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all batches that were written to their end, with `batch`; those of a batch that broke off aren't seen."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    marks = fs.globStatus(jvm.org.apache.hadoop.fs.Path(at, "batch=*/_SUCCESS")) or []
    whole = [m.getPath().getParent().toString() for m in marks]
    if not whole:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("long"))
    return spark.read.schema(f"{schema}, batch long").option("basePath", path).json(whole)


def write_table(df: DataFrame, path: str, archive: str | None = None) -> None:
    """Replaces a table; a copy of the old one is kept first if a place for it is named."""
    spark = df.sparkSession
    if archive is not None:
        spark.read.parquet(path).write.mode("errorifexists").parquet(archive)
    df.write.mode("overwrite").parquet(path)


def roll_back(spark: SparkSession, path: str, archive: str) -> None:
    spark.read.parquet(archive).write.mode("overwrite").parquet(path)


def _swapped(df: DataFrame, path: str) -> None:
    """Writes df beside the table at path, which df may be read from, and puts it in its place; the old one goes last."""
    spark = df.sparkSession
    jvm = spark._jvm
    fresh, old = f"{path}-{uuid.uuid4().hex}", f"{path}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(fresh)
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at(path)) and not fs.rename(at(path), at(old)):
        raise RuntimeError(f"{path} can't be moved; the new table is at {fresh}")
    if not fs.rename(at(fresh), at(path)):
        fs.rename(at(old), at(path))
        raise RuntimeError(f"{path} can't be replaced; the new table is at {fresh}")
    fs.delete(at(old), True)


def upsert_table(existing: DataFrame, new: DataFrame, key: str, path: str) -> None:
    """New rows replace those of their key; `existing` may be the table at path."""
    _swapped(upsert(existing, new, key), path)


def patch_table(existing: DataFrame, changes: DataFrame, key: str, path: str) -> None:
    """Fields that aren't null in changes replace those of their key; `existing` may be the table at path."""
    _swapped(patch(existing, changes, key), path)


def write_vocabulary(df: DataFrame, path: str) -> None:
    df.select(F.concat_ws("\t", "description", "tag").alias("value")).write.mode("overwrite").text(path)


def write_documents(df: DataFrame, path: str, stem: str, text: str) -> None:
    """Texts in a folder for each stem."""
    df.select(stem, F.col(text).alias("value")).write.mode("overwrite").partitionBy(stem).text(path)


def markdown_report(title: str, tables: dict[str, DataFrame], rows: int = 1000) -> str:
    """Small aggregates as one text; a table of more than `rows` rows is refused, not cut."""
    out = [f"# {title}"]
    for name, df in tables.items():
        found = df.limit(rows + 1).collect()
        if len(found) > rows:
            raise ValueError(f"{name} has more than {rows} rows; aggregate it first")
        line = lambda cells: "| " + " | ".join("" if c is None else str(c) for c in cells) + " |"
        out += ["", f"## {name}", "", line(df.columns), line(["---"] * len(df.columns)), *map(line, found)]
    return "\n".join(out) + "\n"


def backfill_tags(chunks: DataFrame, tags: DataFrame) -> DataFrame:
    """Chunks with the tag weights of their document: tags (doc_name, tag_feas map)."""
    new = tags.select("doc_name", F.col("tag_feas").alias("_tags"))
    held = chunks.drop("tag_feas") if "tag_feas" in chunks.columns else chunks
    return held.join(new, "doc_name", "left").withColumnRenamed("_tags", "tag_feas")

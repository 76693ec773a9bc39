"""Helpers shared by the operators: shared work tables and table access."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no checkpoint folder (tests, one machine).
LOCAL_CHECKPOINTS = "/tmp/checkpoints/quillstack"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found and not re.match(r"local(\[|$)", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (found or LOCAL_CHECKPOINTS).rstrip("/")


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Writes df as a table in the shared folder and reads it back.

    It cuts lineage and survives lost executors. The tables of one application
    lie under <shared>/quillstack/<application id>/ and may be removed with it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillstack/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

"""Session defaults and table access shared by every query."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no shared folder (tests, one machine).
LOCAL_SHARED = "/tmp/checkpoints/quillstack"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a scale-factor directory, read lazily by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it; a local master may do without."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if not named and not re.match(r"local(\[|$)", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return named or LOCAL_SHARED


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder; it can be removed with the application."""
    return f"{shared_root(spark)}/quillstack/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"

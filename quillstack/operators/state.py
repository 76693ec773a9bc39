"""Resumable per-document state, as a batch reduction of an event log, and gates before side effects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: States in order; the last three are terminal.
STATES = ("pending", "uploaded", "meta_done", "parse_requested", "done", "failed", "wait_timeout")


def last_ok(log: DataFrame, key: str, order: list[str], ok: Column, value: list[str]) -> DataFrame:
    """The last successful row of each key, by a partially aggregated max."""
    return log.where(ok).groupBy(key).agg(F.max_by(F.struct(*value), F.struct(*order)).alias("_x")).select(key, "_x.*")


def only_failed(log: DataFrame, key: str, ok: Column) -> DataFrame:
    """Keys that never succeeded."""
    return log.select(key).distinct().join(log.where(ok).select(key), key, "left_anti")


def reduce_states(log: DataFrame, key: str, order: list[str], timeout_s: float | None = None, ts: str | None = None) -> DataFrame:
    """The state of each key after its last event: status, error (cleared by any other status) and number of events.

    With a timeout, a key whose last status isn't terminal and whose events span more is `wait_timeout`.
    """
    rank = F.struct(*order)
    out = log.groupBy(key).agg(F.max_by("status", rank).alias("status"), F.max_by(F.when(F.col("status") == "failed", F.col("error")), rank).alias("error"), F.count("*").alias("events"), *([F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")] if ts else []))
    if timeout_s is not None and ts:
        late = ~F.col("status").isin("done", "failed") & (F.col("last_ts").cast("timestamp").cast("double") - F.col("first_ts").cast("timestamp").cast("double") > timeout_s)
        out = out.withColumn("status", F.when(late, "wait_timeout").otherwise(F.col("status")))
    return out


def problems(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One table of (check, subject) from several tables of offending subjects."""
    out = None
    for name, bad in checks.items():
        x = bad.select(F.lit(name).alias("check"), F.col(bad.columns[0]).cast("string").alias("subject"))
        out = x if out is None else out.unionByName(x)
    return out


def require_none(found: DataFrame, shown: int = 20) -> None:
    """Raises with the first problems before anything with side effects is started."""
    rows = found.orderBy("check", "subject").limit(shown).collect()
    if rows:
        raise RuntimeError("; ".join(f"{r.check}: {r.subject}" for r in rows))


def stale(existing: DataFrame, cached: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose cached chunk count is missing or smaller than the present one."""
    x = existing.join(cached.select(*keys, F.col("chunks").alias("_cached")), keys, "left")
    return x.where(F.coalesce("_cached", F.lit(-1)) < F.col("chunks")).drop("_cached")


def misses(wanted: DataFrame, cache: DataFrame, key: str = "cache_key") -> DataFrame:
    """Only what the cache table doesn't hold goes to the expensive call."""
    return wanted.join(cache.select(key), key, "left_anti")

"""Waiting for documents to reach a terminal state: a batch reduction of polls, and the same over a stream with timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.window import Window

#: What a poll may bring: an answer, a broken connection, an expired session, another refusal, or no such document.
KINDS = ("answer", "transient", "unauthorised", "refused", "missing")
#: Names of a run that is over, well and badly, in both spellings of the service.
DONE, FAILED = ("DONE", "3"), ("FAIL", "4")
OUT = "rel long, status string, polls long, faults long, logins long, error string"
STATE = "first double, deadline double, polls long, faults long, logins long, error string, over boolean"


def backoff(faults: Column) -> Column:
    """Seconds to wait after so many faults in a row: a quarter, doubled each time, five at most."""
    return F.least(0.25 * F.pow(F.lit(2.0), faults - 1), F.lit(5.0))


def outcome(kind: Column, run: Column, progress: Column) -> Column:
    """done, failed or null of a single poll; transient faults and expired sessions decide nothing."""
    ended = F.when(run.isin(*DONE) | (progress >= 1), "done").when(run.isin(*FAILED) | (progress < 0), "failed")
    return F.when(kind == "answer", ended).when(kind.isin("refused", "missing"), "failed")


def wait(polls: DataFrame, timeout_s: float, now: Column | None = None) -> DataFrame:
    """The result of waiting for each `rel`: status, polls until then, faults in a row before it, logins and the last error.

    polls: rel, ts (timestamp), seq (order of equal times), kind, run, progress,
    error. A document is given `timeout_s` from its first poll; the first poll
    before that which ends it decides. Without one it is `wait_timeout` once the
    time `now` (the latest poll of all if not given) has reached its deadline, with the
    last error, else `waiting`.
    """
    order = Window.partitionBy("rel").orderBy("ts", "seq")
    at = F.col("ts").cast("double")
    x = polls.withColumns({"_at": at, "_end": outcome(F.col("kind"), F.col("run"), F.coalesce("progress", F.lit(0.0)))})
    x = x.withColumn("_deadline", F.min("_at").over(Window.partitionBy("rel")) + timeout_s).where("_at < _deadline")
    ended = F.max(F.col("_end").isNotNull()).over(order.rowsBetween(Window.unboundedPreceding, -1))
    x = x.withColumn("_late", F.coalesce(ended, F.lit(False))).where("not _late")
    fault = F.col("kind").isin("transient", "unauthorised")
    x = x.withColumn("_good", F.count_if(~fault).over(order))  # faults since the last poll that was none share a number
    last = F.struct("ts", "seq")
    per = x.groupBy("rel", "_good").agg(F.count_if(fault).alias("faults"), F.count("*").alias("polls"), F.count_if(F.col("kind") == "unauthorised").alias("logins"), F.max_by("_end", last).alias("end"), F.max_by("error", F.when(F.col("error").isNotNull(), last)).alias("error"), F.max(last).alias("last"), F.max("_deadline").alias("deadline"))
    one = per.groupBy("rel").agg(F.max_by("end", "last").alias("end"), F.sum("polls").alias("polls"), F.max_by("faults", "last").alias("faults"), F.sum("logins").alias("logins"), F.max_by("error", F.when(F.col("error").isNotNull(), F.col("last"))).alias("error"), F.max("deadline").alias("deadline"))
    clock = polls.agg(F.max(at).alias("_now"))
    one = one.withColumn("_now", now) if now is not None else one.join(F.broadcast(clock))  # a single row
    status = F.coalesce("end", F.when(F.col("_now") >= F.col("deadline"), "wait_timeout").otherwise("waiting"))
    return one.select("rel", status.alias("status"), "polls", "faults", "logins", F.when(status != "done", F.col("error")).alias("error"))


class Waiting(StatefulProcessor):
    """One value a document, and a timer at its deadline that ends the wait however silent the document is."""

    def __init__(self, timeout_s: float):
        self.timeout_s = timeout_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("wait", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        value = self.state.get()
        first, deadline, polls, faults, logins, error, over = value if value is not None else (None, None, 0, 0, 0, None, False)
        batch = pd.concat(list(rows)).sort_values(["at", "seq"])
        status = "waiting"
        for r in batch.itertuples():
            if over:
                break
            if first is None:
                first, deadline = r.at, r.at + self.timeout_s
                self.handle.registerTimer(int(deadline * 1000))
            if r.at >= deadline:  # the timer fires when the watermark is there
                break
            polls += 1
            faults = faults + 1 if r.kind in ("transient", "unauthorised") else 0
            logins += r.kind == "unauthorised"
            error = r.error if isinstance(r.error, str) else error
            if isinstance(r.end, str):
                status, over = r.end, True
                self.handle.deleteTimer(int(deadline * 1000))
        if value is not None and value[6]:
            return
        self.state.update((first, deadline, polls, faults, logins, error, over))
        yield _row(key, status, polls, faults, logins, None if status == "done" else error)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first, deadline, polls, faults, logins, error, over = self.state.get()
        if not over:
            self.state.update((first, deadline, polls, faults, logins, error, True))
            yield _row(key, "wait_timeout", polls, faults, logins, error)

    def close(self) -> None:
        pass


def _row(key, *values) -> pd.DataFrame:
    names = [c.split()[0] for c in OUT.split(", ")]
    return pd.DataFrame({n: [v] for n, v in zip(names, (key[0], *values), strict=True)})


def watch(polls: DataFrame, timeout_s: float, late: str = "0 seconds") -> DataFrame:
    """The same as `wait` over a stream, in update mode: a row for each document that a batch or its deadline changes.

    Polls of a document come in order of time, later than the watermark. The
    session needs the RocksDB state store. A document that has ended keeps one
    row of state, so that later polls of it say nothing new.
    """
    end = outcome(F.col("kind"), F.col("run"), F.coalesce("progress", F.lit(0.0)))
    x = polls.withWatermark("ts", late).select(F.col("rel").cast("long").alias("rel"), "ts", F.col("ts").cast("double").alias("at"), F.col("seq").cast("long").alias("seq"), "kind", end.alias("end"), "error")
    return x.groupBy("rel").transformWithStateInPandas(Waiting(timeout_s), OUT, "Update", "EventTime")

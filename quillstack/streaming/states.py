"""The import state machine over a stream of events, and its windowed counts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "ts string, event_id long, status string, error string, events long"
OUT = "rel long, status string, error string, events long"


def track(events: DataFrame, timeout_s: int | None = None) -> DataFrame:
    """The latest state of each `rel` that a micro-batch changed; the last one written is that of the batch reduction.

    events: rel, event_id, ts, status, error. State is one row a key: the
    status of the event of greatest (ts, event_id), its error if it failed, and
    the number of events. With a timeout a key that hears nothing for so long in
    a state that isn't terminal becomes `wait_timeout`.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else ("", -1, "pending", None, 0)
        if state.hasTimedOut:
            state.remove()
            if last[2] not in ("done", "failed"):
                yield pd.DataFrame({"rel": [key[0]], "status": ["wait_timeout"], "error": [None], "events": [last[4]]})
            return
        seen = last[4]
        for batch in batches:
            seen += len(batch)
            top = batch.sort_values(["ts", "event_id"]).iloc[-1]
            if (str(top.ts), int(top.event_id)) >= (last[0], last[1]):
                last = (str(top.ts), int(top.event_id), top.status, top.error if top.status == "failed" else None, seen)
        last = (*last[:4], seen)
        state.update(last)
        if timeout_s is not None:
            state.setTimeoutDuration(timeout_s * 1000)
        yield pd.DataFrame({"rel": [key[0]], "status": [last[2]], "error": [last[3]], "events": [seen]})

    mode = GroupStateTimeout.ProcessingTimeTimeout if timeout_s is not None else GroupStateTimeout.NoTimeout
    keyed = events.select(F.col("rel").cast("long"), "event_id", F.col("ts").cast("string").alias("ts"), "status", "error")
    return keyed.groupBy("rel").applyInPandasWithState(step, OUT, STATE, "update", mode)


def windowed_counts(events: DataFrame, every: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by window and type; later ones than the watermark are dropped."""
    x = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return x.groupBy(F.window("ts", every), "event_type").agg(F.count("*").alias("n"))


def first_only(events: DataFrame, key: str, late: str = "1 day") -> DataFrame:
    """Resume by key: a key that was seen within the watermark isn't passed on again."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark([key])

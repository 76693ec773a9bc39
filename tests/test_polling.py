from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from quillstack.streaming import polling

SCHEMA = "rel long, ts timestamp, seq long, kind string, run string, progress double, error string"
START = dt.datetime(2024, 1, 1)


def made(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for rel in range(n):
        at = rng.uniform(0, 200)
        for seq in range(rng.randint(1, 14)):
            kind = rng.choices(polling.KINDS, [6, 3, 2, 0.2, 0.2])[0]
            run, progress = rng.choices([("RUNNING", 0.2), ("1", 0.5), ("DONE", 1.0), ("3", 0.0), ("FAIL", 0.1), ("RUNNING", -1.0), (None, None)], [9, 9, 1, 1, 0.5, 0.5, 3])[0]
            rows.append((rel, START + dt.timedelta(seconds=round(at, 1)), rel * 100 + seq, kind, run if kind == "answer" else None, progress if kind == "answer" else None, None if kind == "answer" else f"{kind} {seq}"))
            at += rng.choice([5, 5, 5, 40])
    return rows


def plain(rows, timeout):
    """A loop over each document's polls, as a single waiter runs."""
    now, out, by = max(r[1] for r in rows), {}, {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        by.setdefault(r[0], []).append(r)
    for rel, own in by.items():
        deadline = own[0][1] + dt.timedelta(seconds=timeout)
        status, polls, faults, logins, error = None, 0, 0, 0, None
        for _, ts, _, kind, run, progress, err in own:
            if ts >= deadline or status:
                break
            polls, error = polls + 1, err or error
            if kind in ("transient", "unauthorised"):
                faults, logins = faults + 1, logins + (kind == "unauthorised")
                continue
            faults = 0
            if kind != "answer" or run in ("FAIL", "4") or (progress or 0) < 0:
                status = "failed"
            if kind == "answer" and (run in ("DONE", "3") or (progress or 0) >= 1):
                status = "done"
        status = status or ("wait_timeout" if now >= deadline else "waiting")
        out[rel] = (status, polls, faults, logins, None if status == "done" else error)
    return out


def test_batch(spark):
    for seed, timeout in ((1, 60.0), (2, 20.0), (3, 1000.0)):
        rows = made(seed)
        got = {r.rel: tuple(r)[1:] for r in polling.wait(spark.createDataFrame(rows, SCHEMA), timeout).collect()}
        assert got == plain(rows, timeout)
    assert polling.wait(spark.createDataFrame([], SCHEMA), 5.0).count() == 0


def test_backoff(spark):
    assert [r[0] for r in spark.range(1, 8).select(polling.backoff(F.col("id"))).collect()] == [0.25, 0.5, 1, 2, 4, 5, 5]


def test_stream_equals_batch(spark, tmp_path):
    """A replayed stream ends each document as the batch version does; silent ones end by their timers."""
    rows = made(5, 25)
    last_ts = max(r[1] for r in rows) + dt.timedelta(hours=1)
    rows.append((999, last_ts, 99900, "answer", "DONE", 1.0, None))  # moves the watermark past every deadline
    df = spark.createDataFrame(rows, SCHEMA)
    cut = sorted(r[1] for r in rows)
    for a, b in ((cut[0], cut[len(cut) // 2]), (cut[len(cut) // 2], last_ts), (last_ts, last_ts + dt.timedelta(hours=1))):
        df.where((F.col("ts") >= a) & (F.col("ts") < b)).coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    last: dict = {}
    try:
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = polling.watch(stream, 60.0).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "ck"))
        query = query.foreachBatch(lambda batch, n: last.update({r.rel: tuple(r)[1:] for r in batch.collect()})).trigger(availableNow=True).start()
        assert query.awaitTermination(150)
    finally:
        spark.conf.unset(provider)
    want = {r.rel: tuple(r)[1:] for r in polling.wait(df, 60.0).collect()}
    assert last == want and {"done", "failed", "wait_timeout"} <= {v[0] for v in want.values()}

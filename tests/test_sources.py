from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillstack import schemas
from quillstack.plans import linked
from quillstack.sources import files, pages, sinks
from quillstack.streaming import states


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a/b.pdf", "ds", None), ("c", "", "2020")], "rel string, dataset_key string, year string")
    sinks.write_csv(df, str(tmp_path / "c"), ["rel", "dataset_key", "year"])
    back = files.catalogue_csv(spark, str(tmp_path / "c"), "rel string, dataset_key string, year string")
    assert sorted(map(tuple, back.collect())) == [("a/b.pdf", "ds", ""), ("c", "", "2020")]
    assert files.entries(back).where("year is null").count() == 1


def test_jsonl(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"rel": "a", "ok": true}\n\nbad\n{"rel": "b", "ok": false}\n[1]\n')
    log = files.tolerant_jsonl(spark, str(tmp_path / "x.jsonl"), "rel string, ok boolean")
    assert sorted(map(tuple, log.collect())) == [("a", True), ("b", False)]
    assert [r.rel for r in files.done_keys(log).collect()] == ["a"]
    assert files.tolerant_jsonl(spark, str(tmp_path / "none"), "rel string").count() == 0


GOOD = '{"id": "1", "tier": "t", "layer": "l", "question": "q", "datasets": ["d"], "gold": {"numbers": ["1"], "keywords": [], "source_rel": ["r"]}}'


@pytest.mark.parametrize(
    ("lines", "message"),
    [([GOOD, GOOD], "line 1: duplicate id"), ([GOOD.replace('"t"', '"?"')], "line 1: unknown tier"), (["", GOOD.replace('["1"]', "[]")], "line 2: no anchors"), ([GOOD.replace('["r"]', '["s"]')], "line 1: unknown source s")],
)
def test_case_faults(spark, tmp_path, lines, message):
    (tmp_path / "c").write_text("\n".join(lines))
    with pytest.raises(ValueError, match=message):
        files.cases(spark, str(tmp_path / "c"), ["t"], ["l"], spark.createDataFrame([("r",)], "rel string"))


def test_cases(spark, tmp_path):
    (tmp_path / "c").write_text(GOOD)
    x = files.cases(spark, str(tmp_path / "c"), ["t"], ["l"]).first()
    assert (x.id, x.use_kg, x.threshold.min_keywords) == ("1", False, 1)


def test_questions(spark, tmp_path):
    (tmp_path / "q").write_text('[{"id": "a", "text": "t"}, {"id": "b"}]')
    with pytest.raises(ValueError, match="a: dataset_ids.*; b: text"):
        files.questions(spark, str(tmp_path / "q"))


def test_two_columns(spark, tmp_path):
    (tmp_path / "v").write_text("one,a\ntwo,b\nno\nx\ty\tz\n")
    assert sorted(map(tuple, files.two_columns(spark, str(tmp_path / "v")).collect())) == [("one", "a"), ("two", "b")]


def test_file_scan(spark, tmp_path):
    for name in ("a/X.PDF", "a/skip/b.pdf", "c.txt", "d.xls"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(bytes.fromhex("D0CF11E000"))
    found = files.files(spark, str(tmp_path), ["pdf", "xls"], ["skip"], content=True)
    assert sorted((r.rel, r.old) for r in found.select("rel", files.legacy_workbook(F.col("content")).alias("old")).collect()) == [("a/X.PDF", True), ("d.xls", True)]
    assert {r.name: r.paths for r in files.by_name(found).collect()} == {"X.PDF": ["a/X.PDF"], "d.xls": ["d.xls"]}


def test_paged_source(spark):
    class Numbers(pages.PagedSource):
        page_size, pages_each = 10, 2

        @classmethod
        def name(cls):
            return "numbers"

        def schema(self):
            return "n int"

        def total(self):
            return 45

        def fetch(self, page, size):
            return [(i,) for i in range(page * size, min((page + 1) * size, 45))]

    df = pages.read_pages(spark, Numbers)
    assert sorted(r.n for r in df.collect()) == list(range(45))


def test_model_calls(spark):
    def call(row):
        if row["id"] == 2:
            raise RuntimeError("no")
        return {"text": f"t{row['id']}"}

    out = pages.call_model(spark.range(1, 4), call, "text string", retries=2, wait_s=0)
    assert sorted((r.id, r.text, r.error) for r in out.collect()) == [(1, "t1", None), (2, None, "RuntimeError: no"), (3, "t3", None)]


def test_archive_and_rollback(spark, tmp_path):
    t, a = str(tmp_path / "t"), str(tmp_path / "a")
    spark.range(3).write.parquet(t)
    sinks.write_table(spark.range(5), t, archive=a)
    assert spark.read.parquet(t).count() == 5
    sinks.roll_back(spark, t, a)
    assert spark.read.parquet(t).count() == 3
    assert sinks.markdown_report("T", {"x": spark.range(1)}).endswith("| id |\n| --- |\n| 0 |\n")


def test_stream_equals_batch(spark, tmp_path):
    """The last state written for each key is that of the batch reduction."""
    from quillstack.operators import state

    log = linked.event_log(spark, "/root/testdata/sf0.001")
    want = {r.rel: (r.status, r.error, r.events) for r in state.reduce_states(log, "rel", ["ts", "event_id"]).collect()}
    rows = log.withColumn("ts", F.col("ts").cast("string"))
    for part in range(3):
        rows.where(f"event_id % 3 = {part}").coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    last: dict = {}

    def keep(batch, number):
        last.update({r.rel: (r.status, r.error, r.events) for r in batch.collect()})

    query = states.track(stream).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "ck")).foreachBatch(keep).trigger(availableNow=True).start()
    query.awaitTermination()
    assert last == want


def test_schemas(spark):
    for ddl in (schemas.ENTRY, schemas.TRIAGE, schemas.TRANSCRIPTION, schemas.CHUNK, schemas.QUESTION, schemas.CASE, schemas.STATE, schemas.DOCUMENT):
        assert spark.createDataFrame([], ddl).count() == 0


def test_batches_once(spark, tmp_path):
    """A batch that is written and then fails is written again on restart, and is there once; half a batch isn't read."""
    spark.range(40).repartition(4).write.json(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    real, calls = sinks.write_batch, []

    def killed(df, path, number):
        real(df, path, number)
        calls.append(number)
        if number == 2 and calls.count(2) == 1:
            raise RuntimeError("killed after the write")

    sinks.write_batch = killed
    try:
        query = sinks.append_stream(stream(), out, ck).trigger(availableNow=True).start()
        with pytest.raises(Exception, match="killed"):
            query.awaitTermination()
        assert sinks.append_stream(stream(), out, ck).trigger(availableNow=True).start().awaitTermination(120)
    finally:
        sinks.write_batch = real
    assert calls.count(2) == 2
    got = sinks.read_batches(spark, out, "id long")
    assert sorted(r.id for r in got.collect()) == list(range(40)) and got.select("batch").distinct().count() == len(set(calls))
    (tmp_path / "out" / "batch=2" / "_SUCCESS").unlink()
    assert sinks.read_batches(spark, out, "id long").where("batch = 2").count() == 0
    assert sinks.read_batches(spark, str(tmp_path / "none"), "id long").count() == 0

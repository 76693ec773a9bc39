from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline as C
from quillstack.llm import secret_scans
from quillstack.llm.common import load, materialize
from quillstack.llm.registry import PACKING
from quillstack.llm import packing as K
from tests.llm.conftest import CLASHES
from tests.llm.test_jaccard import plain as plain_join
from tests.llm.test_packing import check
from tests.llm.test_quality import plain as plain_quality
from tests.llm.test_secrets import plain_base

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    """Every stage against a plain version on its own input."""
    docs = load(spark, SF, "documents")
    names = docs.columns
    by = lambda df: {r.doc_id: r.text for r in df.collect()}
    before = by(docs)
    kept = materialize(C.quality(spark, docs, SF), "t")
    assert kept.columns == names
    assert set(by(kept)) == {i for i, t in before.items() if not plain_quality(t)[5]}  # too few labels to prove a cutoff
    cut = materialize(C.lines(spark, kept, SF), "t")
    assert cut.columns == names
    for r in cut.collect():
        lines = before[r.doc_id].split("\n")
        assert all(x in lines for x in r.text.split("\n"))
        assert r.n_chars == len(r.text)
    one = materialize(C.near_duplicates(spark, cut, SF), "t")
    assert one.columns == names
    assert sorted(by(one)) == sorted(i for i, _, c in plain_join(sorted(by(cut).items()), 5, 80) if i == c)
    clean = materialize(C.secrets(spark, one, SF), "t")
    assert clean.columns == names
    texts = by(one)
    assert set(by(clean)) == set(texts)
    for i, t in by(clean).items():
        base = plain_base(texts[i])
        assert (t == texts[i]) or "<SECRET>" in t
        assert not plain_base(t)
        assert base or not secret_scans.base_spans(texts[i])
    packed = C.packed(spark, clean, SF).collect()
    check(packed, by(clean), K.Encoder(PACKING["tokenizer"], None, PACKING["pattern"]))


def test_run(spark):
    assert [name for name, _ in C.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "secret scans", "packing"]
    assert C.run(spark, SF).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_clashing_columns(spark, odd, none, tmp_path):
    """Other columns come through every stage with their values, whatever their names."""
    spark.createDataFrame([(1, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = materialize(odd, "t")
    for name, stage in C.STAGES[:-1]:
        out = materialize(stage(spark, docs, str(tmp_path)), "t")
        assert out.columns == docs.columns, name
        assert out.count() > 0, name
        for r in out.collect():
            assert all(r[c] == "clash" for c in CLASHES), name
            assert r.n_chars == (None if r.text is None else len(r.text)), name
        assert stage(spark, none, str(tmp_path)).count() == 0, name


def test_odd(spark, odd, none, tmp_path):
    for k, docs in enumerate((odd, none)):
        sf = str(tmp_path / str(k))
        docs.write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(1, 1, None), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        ids = {r.doc_id for r in C.run(spark, sf).collect()}
        assert ids <= {1, 2, 6, 7, None}


def test_repeated_ids(spark):
    """Of rows with one id and text the same one stays whatever their order; unlike texts under one id aren't lost."""
    one, two = "one two three four five six seven eight", "other words of a text that is not like it at all"
    rows = [(1, one, "b"), (1, one, "a"), (1, two, "c"), (2, one, "d"), (3, "nine ten", None), (3, None, None)]
    found = [sorted(map(str, C.near_duplicates(spark, spark.createDataFrame(x, "doc_id long, text string, source string").repartition(n), "").collect())) for x, n in ((rows, 1), (rows[::-1], 3))]
    assert found[0] == found[1]
    assert len(found[0]) == 4 and sum("one two" in x for x in found[0]) == 1


def test_wide(spark):
    """With many other columns, the optimizer's constraints don't double with each of them."""
    rows = spark.createDataFrame([(1, "one two three four five six", "a")], "doc_id long, text string, source string")
    docs = materialize(rows.withColumns({f"c{i}": F.lit("x") for i in range(12)}), "t")
    assert C.near_duplicates(spark, docs, "")._jdf.queryExecution().optimizedPlan().constraints().size() < 500

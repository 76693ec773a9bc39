from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from quillstack.llm import fill_middle as M
from quillstack.llm.registry import ORACLES, op13_fill_middle
from tests.oracle import connect, difference


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, d = len(units), sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h[3] % 100 < 20
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, n, "spm" if spm else "psm", len(prefix), len(middle), sha(output), sha(text)


def compare(docs):
    got = sorted((tuple(r) for r in M.digests(M.transform(docs)).collect()), key=str)
    assert got == sorted((plain(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)
    return got


def test_whole_table(spark):
    assert not difference(op13_fill_middle(spark, "/root/testdata/sf0.01"), connect("/root/testdata/sf0.01"), ORACLES["op13_fill_middle"])
    got = compare(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_odd(odd, none, make):
    compare(odd)
    assert M.transform(none).count() == 0
    # marks in texts, broken marks at the cuts, code points beyond the basic plane, line ends
    texts = ["<P>", "a<S>b", "x<M", "<S", "><", "<<P", "\U0001f600a\U0001f600", "é\r\nb\u0085", "a", " ", "\n", "<P<S<M<", "á" * 5]
    compare(make([(100 * k + j, t) for j, t in enumerate(texts) for k in range(40)], clash=True))


def test_long_text(make):
    compare(make([(k, "word, " * 300_000 + "x" * 2_000_000) for k in (2, 3)]))


def test_parts(make):
    """The operator's own columns: the parts make up the text, whatever the rates."""
    docs = make([(k, f"text {k} of\nseveral words!") for k in range(200)])
    got = M.restored(M.transform(docs, rate=100, spm=50, salt="other:")).where("form <> 'plain'")
    assert got.where(F.concat("prefix", "middle", "suffix") != F.col("text")).count() == 0
    assert got.where("restored <> text or restored is null").count() == 0 and got.count() == 200
    assert M.transform(docs, rate=0).where("form <> 'plain' or output <> text").count() == 0


def test_one_exchange(spark, make):
    """Units aren't shuffled: the only exchange is that of the texts by row, made once and used three times."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = M.digests(M.transform(make([(1, "a b")])))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("ReusedExchange") == 2 and plan.count("- Exchange ") == plan.count("- Exchange hashpartitioning(row") == 1

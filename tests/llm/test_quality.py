from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from quillstack.llm import quality_rules as Q
from quillstack.llm.common import load


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w)


def counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_whole_table(spark):
    for r in Q.score(load(spark, "/root/testdata/sf0.01", "documents")).collect():
        assert counts(r) == plain(r.text)


def test_odd(odd, none, spark):
    for r in Q.score(odd).collect():
        assert counts(r) == plain(r.text)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    scored = Q.score(none)
    assert Q.judge(scored, Q.cutoffs(scored, labels)).count() == 0
    scored = Q.score(odd)
    assert Q.judge(scored, Q.cutoffs(scored, labels)).where("kept = base_failed").count() == 0


def test_log_tail(spark):
    for n, k in ((10, 0), (400, 0), (400, 3), (5000, 40), (8000, 79)):
        exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.01) + (n - i) * math.log(0.99)) for i in range(k + 1))
        got = spark.range(1).select(Q.log_tail(F.lit(float(n)), F.lit(float(k)), 0.01).alias("x")).first().x
        assert abs(got - math.log(exact)) < 1e-6


def test_large_tail(spark):
    """Ten million losses of a billion: as the normal approximation has it, in a short array."""
    n, p, z = 10**9, 0.01, 3.0
    k = round(n * p - z * math.sqrt(n * p * (1 - p)))
    got = spark.range(1).select(Q.log_tail(F.lit(float(n)), F.lit(float(k)), p).alias("x")).first().x
    assert abs(got - math.log(0.5 * math.erfc(z / math.sqrt(2)))) < 0.01


def test_risk_is_controlled(spark):
    """The accepted cutoff is the least that the exact test proves, and none is accepted without enough labels."""
    rows = [(i, "en", 100, 200, 20 if i % 500 == 0 else 1, 10, 0, 0, False) for i in range(3000)] + [(5000 + i, "de", 100, 200, 1, 10, 0, 0, False) for i in range(50)]
    scored = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, base_failed boolean")
    labels = scored.select("doc_id", F.lit(1).alias("quality"))
    table, strata = Q.cutoffs(scored, labels)
    found = {r.stratum: r for r in table.collect()}
    assert strata == 2
    assert set(found) == {"en"}
    level = math.log(Q.ERROR / (2 * 3))
    tail = lambda k: math.log(sum(math.comb(3000, i) * 0.01**i * 0.99 ** (3000 - i) for i in range(k + 1)))
    assert tail(6) <= level  # losing the six documents of many symbols is proven safe
    assert found["en"].symbols == 1
    judged = Q.judge(scored, (table, strata))
    assert judged.where("not kept").count() == 6

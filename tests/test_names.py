from __future__ import annotations

import difflib
import random

from pyspark.sql import functions as F

from quillstack.operators import names as N

WORDS = ["report", "annual", "dam", "survey", "plan", "2019", "2020", "final", "v2", "图纸", "大坝", "总结", "(copy)", "a", "b"]


def made(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        s = rng.choice(["_", " ", "-", ""]).join(rng.choices(WORDS, k=rng.randint(1, 4)))
        if rng.random() < 0.5:
            s = "".join(c for c in s if rng.random() > 0.15)
        out.append(s + rng.choice([".pdf", ".doc", ""]))
    return out + ["a", "b", "ab", "ba", "aab", "x", ""]


def pairs(a, b, ratio):
    return {(x, y) for x in set(a) for y in set(b) if x and y and difflib.SequenceMatcher(None, y, x).ratio() >= ratio}


def test_block_ratio(spark):
    """The recursion equals that of matching blocks on unlike and self-overlapping names."""
    rng = random.Random(1)
    rows = [("".join(rng.choices("ab", k=rng.randint(0, 9))), "".join(rng.choices("abc", k=rng.randint(0, 9)))) for _ in range(200)]
    rows += list(zip(made(2, 150), made(3, 150), strict=True)) + [("", ""), ("", "x"), ("ab" * 40, "ba" * 45)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", N.block_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    for r in got:
        assert abs(r.r - difflib.SequenceMatcher(None, r.a, r.b).ratio()) < 1e-12, r


def test_no_pair_is_lost(spark, monkeypatch):
    a, b = made(4, 120), made(5, 150)
    x, y = (spark.createDataFrame([(t,) for t in z], "k string") for z in (a, b))
    for ratio in (0.6, 0.9):
        got = [(r.k, r.other) for r in N.near_pairs(x, y, ratio).collect()]
        assert len(got) == len(set(got)) and set(got) == pairs(a, b, ratio)
    monkeypatch.setattr(N, "KEY_ROWS", 3)  # crowded keys in blocks
    got = [(r.k, r.other) for r in N.near_pairs(x, y, 0.6).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs(a, b, 0.6)


def test_top(spark):
    """As difflib chooses: the best three, ties by the greater name."""
    a, b = made(6, 60), sorted(set(made(7, 80)) - {""})
    names = spark.createDataFrame(list(enumerate(a)), "id long, name string")
    pool = spark.createDataFrame(list(enumerate(b)), "id long, name string")
    got: dict = {}
    for r in N.close_names(names, pool).collect():
        got.setdefault(r.id, []).append((r.rank, b[r.match_id]))
    for i, name in enumerate(a):
        want = [name] if name in b else difflib.get_close_matches(name, b, 3, 0.6) if name else []
        assert [m for _, m in sorted(got.get(i, []))] == want, name


def test_tiers(spark):
    names = spark.createDataFrame([(1, "Plan-A.wps"), (2, "survy of dams.pdf"), (3, "q.wps"), (4, None), (5, "")], "id long, name string")
    pool = spark.createDataFrame([(10, "plan a.pdf"), (11, "survey of dams.doc"), (12, "q.pdfx"), (13, None), (14, "plan a.pdf")], "id long, name string")
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    got = N.matched_names(names, pool, F.regexp_replace(F.lower(stem), "[^a-z]", ""), stem)
    assert sorted((r.id, r.match_id, r.tier) for r in got.collect()) == [(1, 10, "equal"), (2, 11, "name"), (3, 12, "equal")]
    assert N.close_names(names.limit(0), pool).count() == 0 and N.close_names(names, pool.limit(0)).count() == 0


def test_keys_are_spread(spark):
    """Pairs of rare characters: no key holds a third of the names, though single characters are in most of them."""
    rng = random.Random(8)
    a = {"".join(rng.choices("etaoinshrdlucmfw ", weights=range(18, 1, -1), k=rng.randint(8, 20))) for _ in range(800)}
    keys = N.keyed(spark.createDataFrame([(t,) for t in a], "k string"), 0.6).groupBy("key").agg(F.countDistinct("k").alias("n"))
    assert keys.agg(F.max("n")).first()[0] < 0.3 * len(a)

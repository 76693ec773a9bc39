from __future__ import annotations

import random

from pyspark.sql import functions as F

from quillstack.operators import graph, retrieval
from quillstack.operators.components import components


def plain_components(pairs):
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components(spark):
    """Chains, hubs, rings and lone pairs."""
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    rng.shuffle(chain)
    hub = [(500 + i, 499) for i in range(40)]
    lots = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    for pairs in (chain, [*hub, *lots, (1, 1), (7, 3)], [*chain, (130, 2)]):
        df = spark.createDataFrame([*pairs, (None, 5)], "a long, b long")
        assert {r.node: r.root for r in components(df).collect()} == plain_components(pairs)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_best_by_terms(spark):
    """Equal to ranking every row that shares a term, whatever the number of seeds."""
    rng = random.Random(4)
    bags = {i: sorted({min(int(rng.paretovariate(0.6)), 60) for _ in range(rng.randint(0, 12))}) for i in range(300)}
    queries = {q: {rng.choice([1, 2, 3, *range(1, 70)]): rng.choice([1.0, 2.0, 5.0, 0.5]) for _ in range(rng.randint(1, 8))} for q in range(25)}
    rows = spark.createDataFrame([(i, f"t{t}") for i, b in bags.items() for t in b], "id long, term string")
    asked = spark.createDataFrame([(q, f"t{t}", w) for q, ts in queries.items() for t, w in ts.items()], "query long, term string, weight double")
    want = set()
    for q, ts in queries.items():
        scores = {i: sum(w for t, w in ts.items() if t in b) / sum(ts.values()) for i, b in bags.items()}
        best = sorted(((-s, i) for i, s in scores.items() if s > 0))[:5]
        want |= {(q, i, r + 1, round(-s, 9)) for r, (s, i) in enumerate(best)}
    for seeds in (None, 1, 10_000):
        got = retrieval.best_by_terms(rows, asked, "id", 5, seeds)
        assert {(r.query, r.hit, r["rank"], round(r.tksim, 9)) for r in got.collect()} == want
    assert retrieval.best_by_terms(rows.limit(0), asked, "id", 5).count() == 0


def test_frequent_terms_stay_out(spark):
    """A term of every row isn't joined with its rows where rarer ones decide."""
    rows = spark.range(2000).select(F.col("id"), F.explode(F.array(F.lit("the"), F.concat(F.lit("w"), (F.col("id") % 200).cast("string")))).alias("term"))
    asked = spark.createDataFrame([(1, "the", 0.5), (1, "w7", 3.0), (2, "the", 1.0)], "query long, term string, weight double")
    got = retrieval.best_by_terms(rows, asked, "id", 3).orderBy("query", "rank").collect()
    assert [(r.query, r.hit) for r in got] == [(1, 7), (1, 207), (1, 407), (2, 0), (2, 1), (2, 2)]
    assert [r.tksim for r in got][:3] == [1.0] * 3


def test_merge_aliases(spark):
    """A chain of aliases is one node; descriptions keep the order of the merged nodes, edges within go."""
    nodes = spark.createDataFrame(
        [("b", 0, "X", "of b", ["s2"]), ("a", 1, "Y", "of a", ["s1", "s2"]), ("c", 2, "Z", None, None), ("d", 3, "W", "of d", ["s9"])], "name string, place int, type string, description string, sources array<string>"
    )
    edges = spark.createDataFrame(
        [("a", "d", 1.5, "a-d", ["k2"], ["s1"]), ("d", "b", 2.0, "d-b", ["k1"], ["s3"]), ("c", "d", None, "c-d", ["k1"], None), ("a", "b", 9.0, "in", [], []), ("d", "q", 1.0, "?", [], [])],
        "source string, target string, weight double, description string, keywords array<string>, sources array<string>",
    )
    pairs = spark.createDataFrame([("c", "a"), ("a", "x"), ("x", "b"), ("e", "f")], "a string, b string")
    n, e = graph.merge_aliases(nodes, edges, pairs)
    assert [tuple(r) for r in n.orderBy("name").collect()] == [("b", "X", "of b<SEP>of a<SEP>", ["s1", "s2"], 0, 3), ("d", "W", "of d", ["s9"], 3, 1)]
    assert [tuple(r) for r in e.collect()] == [("b", "d", 4.5, "d-b<SEP>a-d<SEP>c-d", ["k1", "k2"], ["s1", "s3"])]


def test_pre_score(spark):
    assert spark.range(1).select(retrieval.pre_score(F.lit(2.0), F.lit(0.5))).first()[0] == 0.502


def test_cosine_blocks(spark, monkeypatch):
    """The same rows in one block or many, in any number of queries; equal vectors by key, null ones and those of another length last."""
    rng = random.Random(6)
    vectors = [[round(rng.uniform(-1, 1), rng.choice([0, 1, 6])) for _ in range(3)] for _ in range(240)]
    vectors = [v if any(v) else [1.0, 0.0, 0.0] for v in vectors] + [None, [1.0, None, 2.0], [1.0, 2.0]]
    df = spark.createDataFrame(list(enumerate(vectors)), "id long, v array<float>")
    dot = retrieval.dot
    pairs = df.select(F.col("id").alias("query"), F.col("v").alias("a")).join(df.select(F.col("id").alias("hit"), F.col("v").alias("b")), F.col("query") != F.col("hit"))
    a, b = F.col("a"), F.col("b")
    scored = pairs.select("query", "hit", F.round(dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), 6).alias("score")).collect()
    for k in (5, 300):
        want = set()
        for q in range(len(vectors)):
            best = sorted((r for r in scored if r.query == q), key=lambda r: (-9 if r.score is None else r.score, -r.hit), reverse=True)[:k]
            want |= {(q, r.hit, r.score, i + 1) for i, r in enumerate(best)}
        for sizes in ((4096, 32_768), (50, 60)):
            monkeypatch.setattr(retrieval, "BLOCK_QUERIES", sizes[0])
            monkeypatch.setattr(retrieval, "BLOCK_ROWS", sizes[1])
            got = retrieval.cosine_topk(df, df, "id", "v", k)
            assert {(r.query, r.hit, r.score, r["rank"]) for r in got.collect()} == want


def test_floor_of_whole_scores(spark, monkeypatch):
    """Frequent terms that can't outweigh rows of a rarer one make no candidates; equal queries are answered once."""
    kept = []
    monkeypatch.setattr(retrieval, "cut", lambda df: kept.append(df.localCheckpoint()) or kept[-1])
    rows = spark.range(2000).select(F.col("id"), F.explode(F.array(F.lit("the"), F.lit("of"), F.concat(F.lit("w"), (F.col("id") % 200).cast("string")))).alias("term"))
    asked = spark.createDataFrame([(q, t, 3.0) for q in (1, 2, 3) for t in ("the", "of", "w7")], "query long, term string, weight double")
    got = retrieval.best_by_terms(rows, asked, "id", 3).orderBy("query", "rank").collect()
    assert [(r.query, r.hit, r.tksim) for r in got] == [(q, 7 + 200 * i, 1.0) for q in (1, 2, 3) for i in range(3)]
    assert [df.count() for df in kept if "hit" in df.columns] == [10]


def test_merged_names_stay_out_of_the_driver(spark):
    """No join of nodes or edges with the names of merged nodes is a broadcast, small as the tables are."""
    nodes = spark.createDataFrame([("a", 0, "X", "of a", ["s1"]), ("b", 1, "Y", "of b", None)], "name string, place int, type string, description string, sources array<string>")
    edges = spark.createDataFrame([("a", "b", 1.0, "a-b", ["k"], ["s"])], "source string, target string, weight double, description string, keywords array<string>, sources array<string>")
    for df in graph.merge_aliases(nodes, edges, spark.createDataFrame([("b", "a")], "a string, b string")):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_common_terms_never_meet(spark, monkeypatch):
    """Pairs of a query and a row aren't joined, so they are on no disk; the same in one block or many, for arrays of terms, repeated keys and weights that aren't whole."""
    rng = random.Random(9)
    vocabulary = [f"t{i}" for i in range(40)]
    bags = [(rng.randrange(150), rng.sample(vocabulary, min(40, int(rng.paretovariate(0.5))))) for _ in range(400)] + [(None, ["t1"]), (7, []), (8, None), (9, [None, "t2"])]
    weights = [0.1, 0.2, 0.3, 0.7]
    queries = {q: {t: rng.choice(weights) for t in rng.sample([*vocabulary, "zz"], rng.randint(1, 9))} for q in range(40)}
    queries[90] = {"zz": 1.0}
    held: dict = {}
    for i, ts in bags:
        held.setdefault(i, set()).update(ts or [])
    want = set()
    for q, ts in queries.items():
        scores = {i: sum(w for t, w in ts.items() if t in held[i]) / sum(ts.values()) for i in held if i is not None}
        best = sorted((-round(s, 12), i) for i, s in scores.items() if s > 0)[:3]
        want |= {(q, i, r + 1, round(-s, 9)) for r, (s, i) in enumerate(best)}
    rows = spark.createDataFrame(bags, "id long, terms array<string>")
    asked = spark.createDataFrame([(q, t, w) for q, ts in queries.items() for t, w in ts.items()], "query long, term string, weight double")
    found = lambda df: {(r.query, r.hit, r["rank"], round(r.tksim, 9)) for r in df.collect()}
    for sizes in ((2_000_000, 8_000_000, 2_000_000, 4_000_000), (60, 700, 1, 1), (60, 700, 300, 20_000)):
        for name, n in zip(("BLOCK_ASKED", "BLOCK_TERMS", "CELLS", "DENSE"), sizes, strict=True):
            monkeypatch.setattr(retrieval, name, n)
        assert found(retrieval.best_by_terms(rows, asked, "id", 3)) == want
    plans = []
    monkeypatch.setattr(retrieval, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df.localCheckpoint())
    assert found(retrieval.best_by_terms(rows.select("id", F.explode("terms").alias("term")).distinct(), asked, "id", 3)) == want
    assert not any("Join" in p for p in plans)

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstack.llm import learned_partitions as P
from quillstack.llm.registry import op12_learned_partitions

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, k=20, every=20):
    """Brute force: {query: [(vec_id, score)]}, best first, ties to the lesser id."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        score = (x * x[q]).sum(1)
        order = [j for j in np.lexsort((ids, -score)) if j != q][:k]
        out[int(ids[q])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def check(found, rows, least, k=20):
    want, got = exact(rows, k), {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert got.keys() == want.keys()
    hit = total = 0
    values = dict(rows)
    for q, top in want.items():
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, len(top) + 1))
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        assert q not in {i for _, i, _ in mine} and len({i for _, i, _ in mine}) == len(mine)
        for _, i, s in mine:
            assert abs(s - float((np.array(values[i], float) * np.array(values[q], float)).sum())) < 1e-9
        hit, total = hit + len({i for i, _ in top} & {i for _, i, _ in mine}), total + len(top)
    assert hit >= least * total, hit / total
    return hit / total


def table(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in rows], SCHEMA)


def test_whole_table(spark):
    """Recall against brute force on a whole table of uniform vectors, the hardest kind."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    check(op12_learned_partitions(spark, "/root/testdata/sf0.1"), rows, 0.9)


def test_clusters(spark, monkeypatch):
    """Clustered vectors of unlike lengths: few of many parts are visited, recall stays."""
    rng = np.random.default_rng(1)
    monkeypatch.setattr(P, "PART_ROWS", 200)
    centres = rng.standard_normal((25, 16)) * 3
    rows = [(i, np.float32(centres[i % 25] * (1 + i % 3) + rng.standard_normal(16))) for i in range(4000)]
    index = P.fit(np.array([v for _, v in rows], float), 4000, 20)
    assert index.parts == 20 and index.probes <= 6
    check(P.search(table(spark, rows), F.col("vec_id") % 20 == 0), rows, 0.93)


def test_crowded(spark, monkeypatch):
    """A third of all rows are one vector, another third near copies: blocks are bounded, nothing is lost."""
    monkeypatch.setattr(P, "BLOCK", 100)
    monkeypatch.setattr(P, "PART_ROWS", 150)
    rng = np.random.default_rng(2)
    one = rng.standard_normal(8)
    rows = [(i, np.float32(one if i % 3 == 0 else one + 1e-3 * rng.standard_normal(8) if i % 3 == 1 else rng.standard_normal(8))) for i in range(1500)]
    check(P.search(table(spark, rows), F.col("vec_id") % 20 == 0), rows, 0.9)


def test_ties_and_few(spark):
    same = [(i, [1.0, 2.0]) for i in range(100)]
    check(P.search(table(spark, same), F.col("vec_id") % 20 == 0), same, 1)
    few = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (7, [3.0, 3.0])]
    check(P.search(table(spark, few), F.col("vec_id") % 20 == 0), few, 1)
    assert P.search(table(spark, few[:1]), F.col("vec_id") % 20 == 0).count() == 0
    assert P.search(table(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert P.search(table(spark, [(1, [1.0]), (2, [2.0])]), F.col("vec_id") % 20 == 0).count() == 0


def test_odd(spark):
    """Vectors that take no part, repeated rows and ids, a shorter vector, clashing columns."""
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 7) + 1, float(i % 5) - 2.0]) for i in range(60)]
    bad = [(100, None), (120, [0.0, 0.0]), (140, [nan, 1.0]), (160, [inf, 1.0]), (180, [None, 1.0]), (200, []), (None, [1.0, 1.0])]
    df = spark.createDataFrame([*good, *good[:30], *bad], "vec_id long, embedding array<float>")
    df = df.withColumns({c: F.lit("clash") for c in ("v", "ids", "part", "parts", "query_id", "score", "rank", "b", "q", "turn")})
    check(P.search(df, F.col("vec_id") % 20 == 0), good, 1)
    short = P.search(spark.createDataFrame([(0, [2.0]), (1, [3.0, 5.0])], "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in short] == [(0, 1, 1, 6.0)]


@pytest.mark.parametrize("parts", [2, 3, 7, 16])
def test_balance(parts):
    """Parts differ by a few nodes at most, and cut fewer edges than parts drawn by lot."""
    rng = np.random.default_rng(parts)
    x = rng.standard_normal((800, 5))
    graph = P.nearest(x, x, 8, itself=True)
    own = P.balanced_parts(graph, parts)
    sizes = np.bincount(own, minlength=parts)
    assert sizes.max() - sizes.min() <= 6
    cut = lambda p: np.mean(p[:, None] != p[graph])
    assert cut(own) < 0.75 * cut(rng.permutation(own))


def test_gradient():
    """The network learns separable parts."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((600, 6)) + 4 * np.eye(6)[np.arange(600) % 6]
    index = P.Index([], 6, 1, 1.0)
    P.train(index, x, np.arange(600) % 6, np.eye(6)[np.arange(600) % 6])
    assert np.mean(index.home(x) == np.arange(600) % 6) > 0.95
    assert np.mean(index.route(x)[:, 0] == np.arange(600) % 6) > 0.95

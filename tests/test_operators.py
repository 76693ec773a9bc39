from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillstack.operators import evaluate, graph, matching, metadata, profile, retrieval, runs, state


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_nearest_ranks(spark):
    df = spark.createDataFrame([("a", x) for x in (5, 1, 1, 9)] + [("b", 3), ("b", None)], "k string, x int")
    assert rows(profile.nearest_ranks(df, ["k"], "x", {"p50": 0.5}), "k") == [("a", 4, 1, 5, 9, 4.0), ("b", 1, 3, 3, 3, 3.0)]


def test_length_stats_empty(spark):
    assert rows(profile.length_stats(spark.createDataFrame([], "x int"), F.col("x"))) == [(0, 0.0, 0, 0)]


def test_metadata_filter(spark):
    df = spark.createDataFrame([("a", "1"), ("b", None)], "k string, v string")
    assert metadata.metadata_filter(df, [{"key": "v", "op": "!=", "value": "2"}]).count() == 1
    with pytest.raises(ValueError, match="nope"):
        metadata.metadata_filter(df, [{"key": "nope", "op": "=", "value": "1"}])
    assert metadata.filter_payload({"conditions": [1]}) == {"method": "manual", "manual": [1]}


def test_needs_transcription(spark):
    df = spark.createDataFrame(
        [(1, True, "blank", "handwritten", None, None), (2, True, "x", "mixed", None, None), (3, True, "x", "printed", "ok", None), (4, True, "x", "printed", "ok", False), (5, False, "x", "mixed", "low", False)],
        "id int, ok boolean, c string, w string, q string, r boolean",
    )
    assert [r.id for r in df.where(metadata.needs_transcription(*map(F.col, ("ok", "c", "w", "q", "r")))).collect()] == [2, 4]


def test_best_table(spark):
    chunks = spark.createDataFrame([(1, 1, "head one | head two | 5"), (1, 2, "nothing")], "doc_id int, chunk_id int, content string")
    inventory = spark.createDataFrame([(1, 0, ["head one"], ["9"]), (1, 1, ["head one", "head two"], ["5"])], "doc_id int, place int, headers array<string>, body array<string>")
    assert rows(matching.best_table(chunks, inventory)) == [(1, 1, 1, 25)]


def test_pair_verdict(spark):
    docs = spark.createDataFrame([("d", "a", 2), ("d", "b", 9), ("e", "x", None), ("f", "y", 1)], "dir string, stem string, pages int")
    groups = spark.createDataFrame([("d", "a", 2), ("d", "c", 1), ("e", "z", 4)], "dir string, base string, size int")
    assert rows(matching.pair_verdict(docs, groups).select("stem", "verdict"), "stem") == [("a", "drop"), ("b", "keep"), ("x", "review"), ("y", "keep")]


def test_missing_anchors(spark):
    texts = spark.createDataFrame([(1, 0, "ab"), (1, 1, "cd")], "doc int, pos int, text string")
    anchors = spark.createDataFrame([(1, "b\nc"), (1, "x"), (2, "a")], "doc int, anchor string")
    assert rows(matching.missing_anchors(anchors, texts, "doc", "anchor", "text", "pos"), "doc") == [(1, "x"), (2, "a")]


def test_patch_and_upsert(spark):
    old = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "id int, x string, y string")
    assert rows(matching.patch(old, spark.createDataFrame([(1, None, "z")], "id int, x string, y string"), "id"), "id") == [(1, "a", "z"), (2, "c", "d")]
    assert rows(matching.upsert(old, spark.createDataFrame([(2, "n", None)], "id int, x string, y string"), "id"), "id") == [(1, "a", "b"), (2, "n", None)]


def test_graph(spark):
    edges = spark.createDataFrame([("b", "a", 1.0), ("a", "b", None), ("a", "a", 5.0), ("a", "cc", 0.0)], "source string, target string, weight double")
    assert rows(graph.merge_edges(edges), "source", "target") == [("a", "b", 2.0, 2), ("a", "cc", 1.0, 1)]
    aliases = spark.createDataFrame([("b", "cc")], "name string, canonical string")
    assert rows(graph.contract(edges, aliases).select("source", "target", "weight")) == [("a", "cc", 3.0)]
    assert rows(graph.see_also(graph.merge_edges(edges)).select("node", "other"), "node") == [("a", "cc")]


def test_timeline_fallback(spark):
    incident = spark.createDataFrame([("n", "other one", "flood", "in 2010", 1.0), ("n", "other two", "x", "none", 9.0), ("m", "other", "x", "1999", 1.0)], "node string, other string, predicate string, description string, weight double")
    assert rows(graph.timeline(incident, ["Flood"]).select("node", "other", "year"), "node", "place") == [("m", "other", 1999), ("n", "other one", 2010)]


def test_islands_and_runs(spark):
    df = spark.createDataFrame([("a", n) for n in (1, 2, 2, 4)], "k string, n int")
    assert rows(runs.islands(df, ["k"], "n").select("first", "last", "size"), "first") == [(1, 2, 2), (4, 4, 1)]


def test_continued_tables(spark):
    df = spark.createDataFrame(
        [(1, 1, "A.1", False, "h", ["h", "r1"], [[1]]), (1, 2, "A.1", True, "h", ["h", "r2"], [[2]]), (1, 3, "A.2", True, "g", ["g"], [[3]])],
        "doc int, pos int, number string, is_continued boolean, header string, rows array<string>, positions array<array<int>>",
    )
    merged = runs.merge_tables(runs.continued(df, "doc", "pos"), "doc", "pos").orderBy("run").collect()
    assert [(r.rows, r.positions, r.parts) for r in merged] == [(["h", "r1", "r2"], [[1], [2]], 2), (["g"], [[3]], 1)]


def test_header_row(spark):
    grid = spark.createDataFrame([("s", 0, ["title", None]), ("s", 1, ["a", "b", "1"]), ("s", 2, ["1", "2", "3"]), ("t", 0, ["1", "2"])], "sheet string, row int, cells array<string>")
    assert rows(runs.header_row(grid, ["sheet"], "row", "cells"), "sheet") == [("s", 1), ("t", 0)]


def test_image_groups(spark):
    files = spark.createDataFrame([("d/x_10.png",), ("d/x_2.png",), ("d/X.png",), ("e/1.png",)], "rel string")
    assert {r.group: r.pages for r in runs.image_groups(files, "rel").collect()} == {"d/x": ["d/x_2.png", "d/x_10.png"], "d/X": ["d/X.png"], "e/e": ["e/1.png"]}


def test_scores(spark):
    cases = spark.createDataFrame([("a", ["1,000"], ["Dam"], 1), ("b", [], ["x", "y"], 2), ("c", ["7"], [], 0)], "case_id string, numbers array<string>, keywords array<string>, min_keywords int")
    ranked = spark.createDataFrame([("a", 6, "１000 DAM"), ("b", 1, "x"), ("b", 11, "y")], "case_id string, rank int, text string")
    got = {r.case_id: r for r in evaluate.score_retrieval(cases, ranked).collect()}
    assert (got["a"].hit5, got["a"].hit10, got["a"].mrr_rank, got["a"].numeric_exact, got["a"].passed) == (False, True, 6, True, True)
    assert (got["b"].hit5, got["b"].kw_hits, got["b"].passed) == (True, 1, False)
    assert (got["c"].mrr_rank, got["c"].passed) == (0, False)
    assert spark.createDataFrame([(1,), (2,), (0,)], "r int").agg(evaluate.mrr(F.col("r")).alias("m")).first().m == 0.5


def test_gate_and_flip(spark):
    df = spark.createDataFrame([("w", 1, True), ("w", 2, False), ("w", 3, True)], "g string, n int, ok boolean")
    assert [r.gate for r in evaluate.first_failure_gate(df, "g", ["n"], F.col("ok")).orderBy("n").collect()] == ["done", "failed", "not_run"]


def test_retrieval(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0]), (3, [2.0, 2.0])], "id int, v array<float>")
    assert [(r.hit, r.score) for r in retrieval.cosine_topk(df, df.where("id = 0"), "id", "v", 2).orderBy("rank").collect()] == [(1, 0.707107), (3, 0.707107)]
    bags = retrieval.term_bags(spark.createDataFrame([(1, "Dam wall", "dam")], "id int, c string, t string"), "id", {"content": F.col("c"), "title": F.col("t")})
    assert rows(bags, "term") == [(1, "dam", 3.0), (1, "wall", 1.0)]


def test_states(spark):
    log = spark.createDataFrame([(1, 1, "failed", "e"), (1, 2, "done", None), (2, 1, "failed", "x")], "rel int, seq int, status string, error string")
    assert rows(state.reduce_states(log, "rel", ["seq"]), "rel") == [(1, "done", None, 2), (2, "failed", "x", 1)]
    bad = state.problems({"missing": spark.createDataFrame([("r",)], "rel string")})
    with pytest.raises(RuntimeError, match="missing: r"):
        state.require_none(bad)
    state.require_none(bad.where("false"))


def plain_sheets(titles):
    import re

    used, out = set(), []
    for t in titles:
        base = re.sub(r"\s+", "", re.sub(r"[\\/:*?\[\]]", "", t or ""))[:31].rstrip("; ；,，-(") or "Sheet1"
        name, k = base, 1
        while name.lower() in used:
            name, k = base[: 31 - len(f"~{k}")] + f"~{k}", k + 1
        used.add(name.lower())
        out.append(name)
    return out


def test_sheet_names(spark):
    """Names stay unique in any case, also where a title looks like a numbered one."""
    books = {
        "one": ["a", "a~1", "A", "a", "A~1", "a~1~1"],
        "two": ["x" * 40, "X" * 35, "x" * 31, "x" * 29 + "~1", "", None, "sheet1", ":*?", "; (-"],
        "three": ["b c\td", "bcd", "B:C:D-", "大坝，", "大坝", "\u3000大 坝"],
    }
    titles = spark.createDataFrame([(b, i, t) for b, ts in books.items() for i, t in enumerate(ts)] + [(None, 0, "q"), (None, 1, "Q")], "book string, place int, title string")
    got = runs.sheet_names(titles, "book", "place", F.col("title")).orderBy("book", "place").collect()
    for b, ts in {**books, None: ["q", "Q"]}.items():
        assert [r.sheet for r in got if r.book == b] == plain_sheets(ts), b


def test_numbered(spark):
    """Numbers follow the order within each key, also where one key has most rows; the order may be of strings."""
    import random

    rows_ = [(("hot" if i % 4 else f"k{i % 7}") if i % 11 else None, i, f"{i:05d}") for i in range(900)]
    random.Random(3).shuffle(rows_)
    df = spark.createDataFrame(rows_, "k string, id long, s string")
    for order in ("id", "s"):
        got = matching.numbered(df, ["k"], order, "turn").collect()
        by: dict = {}
        for r in sorted(got, key=lambda r: r[order]):
            by.setdefault(r.k, []).append(r.turn)
        assert all(v == list(range(1, len(v) + 1)) for v in by.values()) and sum(map(len, by.values())) == sum(k is not None for k, _, _ in rows_)


def plain_runs(tables, aggressive):
    out, run, base = [], 0, None
    for number, marked, header in tables:
        same = bool(number) and base is not None and number == base[0]
        if not (same and (marked or (aggressive and header == base[1]))):
            run, base = run + 1, (number, header)
        out.append(run)
    return out


@pytest.mark.parametrize("aggressive", [False, True])
def test_continued_tables(spark, aggressive):
    """One document with most of the tables, many short ones, null numbers and headers."""
    import random

    rng = random.Random(6)
    docs = {d: [(rng.choice(["1", "1", "2", "", None]), rng.random() < 0.4, rng.choice(["h", "h", "g", None])) for _ in range(400 if d == 0 else rng.randint(1, 9))] for d in range(25)}
    rows_ = [(d, i // 7, i, *t) for d, ts in docs.items() for i, t in enumerate(ts)]
    rng.shuffle(rows_)
    df = spark.createDataFrame(rows_, "doc long, page int, place int, number string, is_continued boolean, header string")
    got = runs.continued(df, "doc", ["page", "place"], aggressive).orderBy("doc", "place").collect()
    for d, ts in docs.items():
        assert [r.run for r in got if r.doc == d] == plain_runs(ts, aggressive)


def test_sheet_names_many(spark):
    """Thousands of sheets of one book, with cut names and titles with numbers of their own, are named as one after the other is."""
    import random

    rng = random.Random(5)
    books = {
        "same": ["Plan"] * 1200,
        "cut": [rng.choice(["y" * 27, "Y" * 28, "y" * 28 + "z"]) + rng.choice(["", "a", "bc", "bcd"]) for _ in range(1300)],
        "own": [rng.choice(["p", "P~1", "p~2", "p~1~1", "q" * 30, "q" * 29 + "~1", "ΑΣ", "ας~1", "ασ"]) for _ in range(700)],
    }
    rows_ = [(b, i, t) for b, ts in books.items() for i, t in enumerate(ts)]
    rng.shuffle(rows_)
    titles = spark.createDataFrame(rows_, "book string, place int, title string")
    got = runs.sheet_names(titles, "book", "place", F.col("title")).orderBy("book", "place").collect()
    for b, ts in books.items():
        assert [r.sheet for r in got if r.book == b] == plain_sheets(ts), b

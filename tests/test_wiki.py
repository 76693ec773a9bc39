from __future__ import annotations

from pyspark.sql import functions as F

from quillstack.operators import graph, wiki


def test_chunks(spark):
    df = spark.createDataFrame([("a", "x" * 30, None), ("b", "x" * 30, False), ("c", " x ", True)], "id string, content string, available boolean")
    assert [r.id for r in wiki.admissible(df).collect()] == ["a"]
    assert spark.range(1).select(wiki.junk(F.lit("Unnamed: 3")), wiki.junk(F.lit("a：nan")), wiki.junk(F.lit("ok"))).first()[:] == (True, True, False)


def test_blank_pages(spark):
    groups = spark.createDataFrame([("g", ["1", "2", "3"]), ("h", ["2"])], "group string, pages array<string>")
    left, empty = wiki.without_blank_pages(groups, spark.createDataFrame([("2",)], "rel string"))
    assert [tuple(r) for r in left.collect()] == [("g", ["1", "3"])]
    assert [r.group for r in empty.collect()] == ["h"]
    pages = spark.createDataFrame([("g", 1, None), ("g", 2, True), ("h", 3, None)], "group string, n int, bad boolean")
    assert wiki.groups_with(pages, F.col("bad")).count() == 2


def test_sources_and_titles(spark):
    nodes = spark.createDataFrame([("n", ["d2", "d1", "d3"])], "name string, sources array<string>")
    chunks = spark.createDataFrame([(d, p, f"{d}{p}") for d in ("d1", "d2", "d3") for p in range(6)], "doc_id string, pos int, content string")
    assert wiki.source_texts(nodes, chunks).first().texts == ["d20", "d21", "d22", "d23", "d10", "d11", "d12", "d13"]
    titles = spark.createDataFrame([(7, "t7"), (9, "t9")], "page int, title string")
    assert wiki.title_by_page(spark.createDataFrame([("c", [[3], [9], [7]])], "id string, positions array<array<int>>"), titles).first().title == "t9"


def test_captions(spark):
    kw = lambda c: spark.range(1).select(wiki.recall_keywords(F.lit(c)).alias("k")).first().k
    assert kw("<table></table> 表 D.0.1-2 项目 特性表（续）") == ["表D.0.1-2", "D.0.1-2", "项目特性表", "表D.0.1-2项目特性表"]
    assert kw("no table") == []
    q = lambda c, have: spark.range(1).select(wiki.figure_question(F.lit(c), F.array(*map(F.lit, have)).cast("array<string>"), F.create_map(F.lit("图3.1"), F.lit("剖面"))).alias("q")).first().q
    assert (q("（c）图 3.1 x", []), q("如图3.1所示", []), q("图3.1", ["q"]), q("图9", [])) == ("图3.1 剖面", None, None, None)


def test_pages(spark):
    edges = spark.createDataFrame([("dam one", "river", 2.0), ("dam one", "lake", 1.0)], "source string, target string, weight double")
    pages = spark.createDataFrame([("dam one", "The river.\n## See also\nold\n## Next\nx")], "name string, markdown string")
    incident = spark.createDataFrame([("dam one", "lake", "p", "in 2010", 1.0)], "node string, other string, predicate string, description string, weight double")
    out = wiki.finished(pages, ["dam one", "river", "lake"], edges, graph.timeline(incident, [])).first().markdown
    assert out == "The [[river]].\n## Next\nx\n\n## See also\n- [[lake]]\n\n## 时间线\n- 2010年、[[lake]]"
    nodes = spark.createDataFrame([("b", "z"), ("a", "z"), ("c", "unit")], "name string, type string")
    assert [(r.type, r.n, r.name) for r in wiki.index_rows(nodes, "unit").orderBy("place", "name").collect()] == [("unit", 1, "c"), ("z", 2, "a"), ("z", 2, "b")]


def test_raster_and_gain(spark):
    px = spark.createDataFrame([(1, 0, [True] * 4), (1, 1, [False, True, False, True])], "page int, row int, dark array<boolean>")
    r = wiki.line_density(px, 0.5).first()
    assert (r.line_rows, r.density, r.fill) == (1, 0.5, 0.75)
    assert wiki.table_pages(wiki.line_density(px, 0.5)).count() == 1
    scores = spark.createDataFrame([("a", True, True), ("a", False, False), ("b", True, False)], "case_id string, use_kg boolean, hit5 boolean")
    assert sorted((x.case_id, x.gain) for x in wiki.kg_gain(scores).collect()) == [("a", 1), ("b", 0)]


def test_link_pages(spark):
    """The same as folding over all names, longest first, while a page meets only those it holds."""
    import random

    rng = random.Random(9)
    words = ["dam", "dam wall", "wall", "大坝", "大坝图纸", "river", "e", "ab12", "old river dam"]
    pages = [(rng.choice(words) + str(i % 3), " ".join(rng.choice([*words, "and", "[[river]]", "."]) for _ in range(rng.randint(0, 12)))) for i in range(40)] + [("none", None)]
    df = spark.createDataFrame(pages, "name string, markdown string")
    names = spark.createDataFrame([(w,) for w in [*words, *words, "dam0", "zzz", None]], "name string")
    order = sorted(set(words) | {"dam0", "zzz"}, key=lambda w: (-len(w), w))
    from quillstack.functions import text as T

    whole = df.select("name", T.linkify(F.coalesce("markdown", F.lit("")), F.array(*map(F.lit, order)), F.col("name")).alias("markdown"))
    assert sorted(tuple(r) for r in wiki.link_pages(df, names).collect()) == sorted(tuple(r) for r in whole.collect())


def test_names_that_may_match_are_no_rows(spark):
    """Names whose words are in every page, though none holds them, meet no page; those that are held become links."""
    pages = spark.range(200).selectExpr("concat('doc ', id) name", "concat('Of the dam ', id, ' and the wall ', id, '.') markdown")
    names = spark.range(400).selectExpr("explode(array(concat('the wall and the dam ', id), concat('dam ', id, ' and'))) name")
    linked = wiki.link_pages(pages, names)
    assert {tuple(r) for r in linked.collect()} == {(f"doc {i}", f"Of the [[dam {i} and]] the wall {i}.") for i in range(200)}
    # pairs found with their names, these with the number of their parts, and pages with what they hold
    assert linked._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 3

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillstack.functions import text as T
from quillstack.functions import values as V


def one(spark, column, **cells):
    """The column's value over one row of cells."""
    df = spark.range(1)
    for name, cell in cells.items():
        df = df.withColumn(name, F.lit(cell) if not isinstance(cell, list) else F.array(*map(F.lit, cell)).cast("array<string>"))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "want"),
    [("ＡＢ１,２３４", "ab1234"), ("1,,000", "1000"), ("a,b", "a,b"), ("3³,5", "3³5"), ("12，5", "125"), (None, "")],
)
def test_match_form(spark, text, want):
    assert one(spark, T.match_form(F.col("c").cast("string")), c=text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("", "empty"), ("　 \n", "empty"), ("!!!!!!!a", "noise"), ("a" * 49, "fragment"), ("a" * 50, None), (None, "empty")],
)
def test_chunk_flag(spark, text, want):
    assert one(spark, T.chunk_flag(F.col("c").cast("string")), c=text) == want


@pytest.mark.parametrize(
    ("content", "kind", "want"),
    [
        ("<table><caption>续表A.0.1 土壤表</caption></table>", "table", ["表A.0.1", "表A.0.1 土壤表", "表A.0.1土壤表"]),
        ("<table><tr></tr></table> 表 2. 抛物线通过算法", "table", ["表2", "表2 抛物线", "表2抛物线"]),
        ("见图6所示", "image", ["图6"]),
        ("图 3-1 总平面图，正文", "image", ["图3-1", "图3-1 总平面图", "图3-1总平面图"]),
        ("no caption", "table", []),
        ("图1", "text", []),
        (None, "image", []),
    ],
)
def test_media_keywords(spark, content, kind, want):
    assert one(spark, T.media_keywords(F.col("c").cast("string"), F.col("k")), c=content, k=kind) == want


@pytest.mark.parametrize(
    ("stem", "parent", "want"),
    [
        ("10", "批复", ("批复", 10)), ("记录_2", "x", ("记录", 2)), ("记录第3页", "x", ("记录", 3)), ("记录（4）", "x", ("记录", 4)), ("记录 5", "x", ("记录", 5)), ("表2025", "", ("表2", 25)),
        ("微信图片_20250101120000_7", "组", ("组", 202501011200007)), ("无页", "x", ("无页", None)), ("7", "", ("扫描件", 7)),
    ],
)
def test_page_suffix(spark, stem, parent, want):
    base, page = want
    if stem == "表2025":
        base, page = "表2", 25  # the shortest base whose last one to three digits are a page
    x = one(spark, T.page_suffix(F.col("s"), F.col("p")), s=stem, p=parent)
    assert (x.base, None if x.page is None else int(x.page)) == (base, page)


def test_despace(spark):
    assert one(spark, T.despace_numbers(F.col("c")), c="2022 年 12 月 2 日 14: 30 30 % 5746 | 5923") == "2022年12月2日14:30 30% 5746 | 5923"


def test_dittos_chain(spark):
    table = "| a | 1 |\n|---|---|\n| b | 2 |\n| “〃” | 同上 |\n| 〃 | 3 |\nend"
    assert one(spark, T.expand_dittos(F.col("c")), c=table) == "| a | 1 |\n|---|---|\n| b | 2 |\n| b | 2 |\n| b | 3 |\nend"


@pytest.mark.parametrize(
    ("raw", "text", "low", "error"),
    [
        ("CONF: HIGH | NOTES: -\nbody", "body", False, None), ("conf: low | NOTES: faint\nbody", "body", True, None), ("```\nCONF: LOW\nx\n```", "x", True, None), ('{"text": "t", "low_conf": true}', "t", True, None),
        ("plain", "plain", True, None), ("", None, True, "empty"), ("CONF: HIGH", None, True, "no body"), ("{bad", None, True, "no text"),
    ],
)
def test_transcription(spark, raw, text, low, error):
    x = one(spark, T.transcription(F.col("c")), c=raw)
    assert (x.text, x.low_conf, x.error) == (text, low, error)


def test_verdict(spark):
    v = T.verdict(F.col("c"), ["图纸", "照片"], [("图纸", ["图", "平面"])], "其他")
    assert one(spark, v, c='x {"category": "平面图", "confidence": "7"} y')[:1] + one(spark, v, c='{"category": "?", "confidence": "bad"}')[4:] == ("图纸", 0.0)
    assert one(spark, v, c="nothing") is None


def test_linkify(spark):
    link = T.linkify(F.col("c"), F.col("n"), F.col("own"))
    assert one(spark, link, c="alpha beta alpha", n=["alpha beta", "alpha", "beta"], own="x") == "[[alpha beta]] [[alpha]]"
    assert one(spark, link, c="see [[the alpha]] and alpha", n=["alpha"], own="x") == "see [[the alpha]] and [[alpha]]"
    assert one(spark, link, c="alpha", n=["alpha", "a1", "abcdef"], own="alpha") == "alpha"


def test_records(spark):
    r = T.record(F.col("c"))
    assert one(spark, r, c='("entity"<|>Dam<|>site<|>a &amp; "b")').asDict() == {"kind": "entity", "name": "DAM", "other": None, "type": "SITE", "description": "a & b", "keywords": None, "weight": None}
    x = one(spark, r, c='("relationship"<|>b<|>a<|>d<|>k<|>2.5)')
    assert (x.name, x.other, x.weight) == ("A", "B", 2.5)
    assert one(spark, r, c='("relationship"<|>b<|>a<|>d<|>k<|>much)').weight == 1.0
    assert one(spark, r, c='("entity"<|>x)') is None


def test_chunks(spark):
    md = "intro line\n\n## One\n" + "\n".join(f"row {i}" for i in range(12)) + "\n## Two\n"
    assert one(spark, T.chunks(F.col("c"), 10, 600, 5), c=md) == ["intro line", "## One\n" + "\n".join(f"row {i}" for i in range(10)), "## One\nrow 10\nrow 11"]


def test_questions(spark):
    df = spark.createDataFrame([("T", ["a", "b"], [["x", "1"], ["x", "y"], ["2", "3"]])], "t string, h array<string>, r array<array<string>>")
    x = df.select(T.question_pairs(F.col("t"), F.col("h"), F.col("r")).alias("q")).first().q
    assert [tuple(p) for p in x] == [("T中，第1列的数值是多少？", "a=x | b=1"), ("T中，第0列的数值是多少？", "a=2 | b=3")]


@pytest.mark.parametrize(("cell", "want"), [("+1.5", True), ("--1", False), ("1.", False), (" 7 ", True), ("", False), (None, False)])
def test_numeric_cell(spark, cell, want):
    assert one(spark, T.numeric_cell(F.col("c").cast("string")), c=cell) is want


@pytest.mark.parametrize(("path", "want"), [("a/2010/x", 2010), ("a/TB0207/2010", None), ("1948/x", None), ("x", None)])
def test_year(spark, path, want):
    assert one(spark, V.parse_year(F.col("c"), 2026), c=path) == want


def test_values(spark):
    assert one(spark, V.serial_date(F.lit(43333.0))) == "2018-08-21"
    assert one(spark, V.serial_date(F.lit(40752.0), plus_one=True)) == "2011-07-29"
    assert one(spark, V.serial_date(F.lit(100.0))) is None
    assert [one(spark, V.clean_cell(F.col("c")), c=c) for c in ("3.0", "3.5", " ", "a\x07b", "1e20")] == ["3", "3.5", None, "a b", "1e20"]
    assert [one(spark, V.backoff(F.lit(n))) for n in (1, 2, 9)] == [0.25, 0.5, 5.0]
    assert one(spark, V.parse_event(F.col("c"), "2021", "洪水", {"甲": "2010"}), c="2021/7-20洪水/x") == "2021-07"
    assert one(spark, V.parse_event(F.col("c"), "2021", "洪水", {"甲": "2010"}), c="x/甲/y") == "2010"
    assert one(spark, T.strip_think(F.col("c")), c="a</think> b</think> c ") == "c"
    assert one(spark, T.strip_think_open(F.col("c")), c="a <think> b") == "a"
    assert one(spark, T.stream_answer(F.col("c")), c='data:{"data":{"answer":"a"}}\nbad\ndata:{\ndata: {"data":{"answer":"b"}}') == "ab"

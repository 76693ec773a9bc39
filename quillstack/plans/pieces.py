"""Queries of the smaller text, value and catalogue functions, on texts made of the tables' columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstack.functions import text as T
from quillstack.functions import values as V
from quillstack.operators import evaluate, metadata, profile, wiki
from quillstack.session import table
from quillstack.sources import files

LONG = "long"
#: Folders, extensions and the like that the queries use as vocabularies.
FOLDERS = {"en": "english", "de": "german", "fr": "french"}


def say(*parts: str | Column) -> Column:
    """A text of literals and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def path_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of urls as paths of another system."""
    raw = F.concat(F.translate("url", "/", "\\"), F.lit(" fixed_a.Tar.GZ"))
    x = table(spark, sf_dir, "pages").select("page_id", T.slashes(raw).alias("path"))
    return x.select("page_id", "path", T.base_name(F.col("path")).alias("base"), T.stem(F.col("path")).alias("stem"), T.lookup_name(F.concat(F.lit("Fixed_ "), T.base_name(F.col("path")))).alias("lookup"))


def first_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = turns(spark, sf_dir)
    return x.select("conv_id", "turn", F.md5(T.first_present(F.when(F.col("turn") % 3 == 0, ""), F.when(F.col("turn") % 3 == 1, F.col("role")), F.col("text"))).alias("field_md5"))


def table_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = say("see D.0.", F.col("turn"), "-", F.col("conv_id") % 5, " and D.0.", F.col("turn") % 2, ", D.0.", F.col("turn"), "-", F.col("conv_id") % 5, " not D.1.2 ")
    return turns(spark, sf_dir).select("conv_id", "turn", F.array_join(T.table_numbers(F.concat(content, "text")), "|").alias("numbers"))


def despaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    text = say(F.year(d), " 年 ", F.month(d), "  月 ", F.dayofmonth(d), " 日 ", k % 24, " : ", k % 60, " 共 ", k % 7, " 人 ", k % 100, " % ", k % 9, " 8 x")
    return table(spark, sf_dir, "orders").select("o_orderkey", T.despace_numbers(text).alias("text"))


def unfenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = turns(spark, sf_dir)
    fenced = F.when(F.col("turn") % 2 == 0, say(" ```json\n", F.col("text"), "\n``` ")).otherwise(F.col("text"))
    return x.select("conv_id", "turn", F.md5(T.strip_fence(fenced)).alias("text_md5"))


def thoughts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("turn") % 3 == 0, say("<think>a ", F.col("role"), "</think> x <think>b</think>\n", F.col("text"))).when(F.col("turn") % 3 == 1, say(F.col("role"), " <think>open ", F.col("text"))).otherwise(F.col("text"))
    return turns(spark, sf_dir).select("conv_id", "turn", F.md5(T.strip_think(raw)).alias("last_md5"), F.md5(T.strip_think_open(raw)).alias("open_md5"))


def transcriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with a CONF line, a JSON envelope, neither, or nothing."""
    k, body = F.col("turn") % 6, F.regexp_replace("text", r"[^A-Za-z ]", "")
    raw = (
        F.when(k == 0, say("CONF: HIGH | NOTES: - \n", body)).when(k == 1, say("conf: low NOTES: | faint \n", body)).when(k == 2, say("```json\n{\"text\": \"", body, "\", \"low_conf\": true}\n```"))
        .when(k == 3, body).when(k == 4, F.lit("  ")).otherwise(F.lit("CONF: HIGH\n \n"))
    )
    x = turns(spark, sf_dir).select("conv_id", "turn", T.transcription(raw).alias("r"))
    return x.select("conv_id", "turn", F.md5("r.text").alias("text_md5"), "r.low_conf", "r.notes", "r.error")


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("turn") % 4
    name = F.when(k == 0, "letter").when(k == 1, "old letters of a friend").when(k == 2, "some bill").otherwise("thing")
    reply = F.when(F.col("conv_id") % 7 == 0, F.lit("none")).otherwise(say('so: {"category": " ', name, ' ", "title_hint": " t', F.col("turn"), ' ", "handwriting": ', (F.col("turn") % 2 == 0), ', "confidence": "', F.col("turn") / 4, '"} end'))
    v = T.verdict(reply, ["letter", "invoice"], [("letter", ["letters"]), ("invoice", ["bill", "debt"])], "other")
    return turns(spark, sf_dir).select("conv_id", "turn", v.alias("v")).select("conv_id", "turn", "v.category", "v.title_hint", "v.date_hint", "v.handwriting", "v.confidence")


def page_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("turn") % 6
    name = F.when(k == 0, F.col("conv_id").cast("string")).when(k == 1, say("scan_", F.col("turn"))).when(k == 2, say("report 第", F.col("turn"), "页")).when(k == 3, say("map（", F.col("turn"), "）")).when(k == 4, say("微信图片_2021010", F.col("turn") % 9, "1200")).otherwise(say(F.col("role")))
    s = T.page_suffix(name, F.when(F.col("conv_id") % 2 == 0, "folder"))
    return turns(spark, sf_dir).select("conv_id", "turn", s["base"].alias("base"), s["page"].cast("string").alias("page"))


def marked_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = say(F.col("role"), " <SEP> a, ", F.col("turn"), ",, <SEP>; ", F.col("conv_id"))
    return turns(spark, sf_dir).select("conv_id", "turn", F.array_join(T.split_markers(text, [",", ";", "<SEP>"]), "|").alias("parts"))


def templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = F.create_map(F.lit("who"), F.col("role"), F.lit("n"), F.col("turn").cast("string"), F.lit("none"), F.lit(None).cast("string"))
    return turns(spark, sf_dir).select("conv_id", "turn", T.fill_template(F.lit("{who} {n}/{n} {none}{other}"), values).alias("text"))


def leakless(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = say("first\nCONF: ", F.col("role"), "\n\n  \nlast ", F.col("turn"), "\nNOTES: x")
    return turns(spark, sf_dir).select("conv_id", "turn", T.drop_lines(text, "^(CONF|NOTES):").alias("text"))


def sectionless(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = say("# ", F.col("role"), "\nbody\n\n## See also\n- [[a]]\n- ", F.col("turn"), F.when(F.col("turn") % 2 == 0, "\n## Next\nrest").otherwise(""))
    return turns(spark, sf_dir).select("conv_id", "turn", T.strip_section(text, "see also").alias("text"))


def cache_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a conversation's turns, and a stable signature of them as edges."""
    edge = F.struct(F.lit("a").alias("source"), F.col("role").alias("target"), F.when(F.col("turn") % 2 == 0, "says").alias("predicate"), (F.col("turn") % 3).alias("weight"))
    x = turns(spark, sf_dir).groupBy("conv_id").agg(F.collect_list(edge).alias("edges"))
    return x.select("conv_id", T.edge_signature(F.col("edges")).alias("signature"), T.cache_key(F.lit("v1"), F.col("conv_id").cast("string"), F.lit(None).cast("string")).alias("cache_key"))


def value_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (F.col("p_size") % 20).cast("string")
    return table(spark, sf_dir, "part").select("p_partkey", T.value_check(say(F.col("p_name"), " 1", F.col("p_partkey") % 10, "mm 7 mm"), F.concat(n, F.lit("mm")), n).alias("found"))


def description_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("turn") % 4
    text = F.when(k == 0, say("Image: ", F.col("turn"))).when(k == 1, say("Prompt: describe ", F.col("text"))).when(k == 2, F.lit("图片：水位线 ab")).otherwise(F.col("text"))
    return turns(spark, sf_dir).select("conv_id", "turn", T.description_flag(text, ["PROMPT:"], ["Image:", "图片："]).alias("flag"))


def layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("turn") % 4
    text = F.when(k == 0, F.lit("a\nb\nc\nd\nlong line\nf")).when(k == 1, F.lit("<caption>x</caption><caption>y")).when(k == 2, F.lit("| a | b |")).otherwise(F.col("text"))
    return turns(spark, sf_dir).select("conv_id", "turn", F.array_join(T.layout_issues(text), "|").alias("issues"))


def formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("turn") % 4
    text = F.when(k == 0, say("value $x_", F.col("turn"), "$ here")).when(k == 1, F.lit("式中 a 为")).when(k == 2, F.lit("式中 \\frac{1}{2}")).otherwise(F.col("text"))
    return turns(spark, sf_dir).select("conv_id", "turn", T.formula_state(text).alias("state"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of raw lines, blank ones counted, and spreadsheets' values cleaned."""
    k = F.col("l_linenumber") % 3
    line = F.when(k == 0, say("a\t ", F.col("l_quantity").cast("int"), " \tnan")).when(k == 1, say("x y  ", F.col("l_partkey"), "   NaN")).otherwise(F.lit("one cell"))
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", T.row_cells(line).alias("cells"), V.clean_cell(F.when(k == 0, say(F.col("l_partkey"), ".0")).when(k == 1, " ").otherwise(say("a\x07", F.col("l_suppkey")))).alias("clean"))
    return x.select("l_orderkey", "l_linenumber", F.array_join("cells", "|").alias("cells"), F.size(F.filter("cells", T.blank_cell)).cast(LONG).alias("blank"), "clean")


def grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nation's suppliers as a Markdown table, and questions on its numeric rows."""
    row = F.array("s_name", F.col("s_suppkey").cast("string"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey").cast("string")).otherwise("n/a"))
    x = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", row.alias("r")))), lambda s: s["r"]).alias("rows"))
    heads, title = F.array(F.lit("name"), F.lit("key"), F.lit("nation")), say("Nation ", F.col("s_nationkey"))
    pairs = T.question_pairs(title, heads, F.col("rows"))
    return x.select("s_nationkey", F.md5(T.table_document(title, heads, F.col("rows"))).alias("table_md5"), F.size(pairs).cast(LONG).alias("n_pairs"), F.array_join(F.transform(pairs, lambda p: F.concat(p["question"], F.lit("~"), p["answer"])), "^").alias("pairs"))


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = say('data: {"code": 0, "data": {"answer": "', F.col("role"), F.col("turn"), '"}}')
    x = turns(spark, sf_dir).groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", part.alias("p")))), lambda s: s["p"]), "\n\n").alias("body"))
    return x.select("conv_id", T.stream_answer(F.concat("body", F.lit("\n: note\ndata: true\ndata: {broken"))).alias("answer"))


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall keywords of a table's caption, and the question of a figure chunk."""
    k = F.col("p_partkey")
    tail = F.when(k % 3 == 0, say("表 ", k % 50, ".", k % 7, " 水位 表（单位）")).when(k % 3 == 1, F.lit(" no number 流量")).otherwise("")
    figure = F.when(k % 4 == 0, say("图 ", k % 9, " 说明")).when(k % 4 == 1, say("如图 ", k % 9)).otherwise("文")
    titles = F.create_map(F.lit("图3"), F.lit("大坝"), F.lit("图4"), F.lit(""))
    asked = F.when(k % 5 == 0, F.array(F.lit("q")))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(wiki.recall_keywords(F.concat(F.lit("<table>表 9.9 x</table>"), tail)), "|").alias("keywords"), wiki.figure_question(figure, asked, titles).alias("question"))


def event_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    path = F.when(k % 3 == 0, say("a/2021/", k % 12 + 1, "-", k % 28 + 1, "flood/x")).when(k % 3 == 1, say("a/storm/2020-", k)).otherwise(say("b/", k))
    return table(spark, sf_dir, "pages").select("page_id", V.parse_event(path, "2021", "flood", {"storm": "the storm", "b": "bee"}).alias("event"))


def serials(spark: SparkSession, sf_dir: str) -> DataFrame:
    serial = F.col("o_orderkey") * 3 + 19000
    return table(spark, sf_dir, "orders").select("o_orderkey", V.serial_date(serial).alias("day"), V.serial_date(serial + 0.5, plus_one=True).alias("next"), V.backoff(F.col("o_orderkey") % 9 + 1).alias("wait"))


def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two encodings of a run's state, envelopes' codes and tags in common, by event."""
    k = F.col("event_id")
    run = F.element_at(F.array(*map(F.lit, ("3", "DONE", "4", "FAIL", "1", "x"))), (k % 6 + 1).cast("int"))
    code = F.element_at(F.array(*map(F.lit, ("0", "102", "x", "00"))), (k % 4 + 1).cast("int"))
    tags = F.array(F.col("event_type"), (k % 3).cast("string"), F.lit("1"))
    x = table(spark, sf_dir, "events")
    return x.select("event_id", V.run_done(run).alias("done"), V.run_failed(run).alias("failed"), V.code_ok(code).alias("ok"), V.tag_overlap(tags, F.array(F.lit("click"), F.lit("1"), F.lit("2"))).cast(LONG).alias("tags"))


def first_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.array((F.col("l_partkey") % 40).cast(LONG), F.col("l_linenumber").cast(LONG))
    x = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(place).alias("positions"))
    return x.select("l_orderkey", V.first_page(F.col("positions")).alias("page"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset, type, junk and marked copies of urls as paths, rows numbered in the order of datasets."""
    k = F.col("page_id")
    rel = say(F.element_at(F.array(*map(F.lit, ("en", "de", "xx", "__MACOSX"))), (k % 4 + 1).cast("int")), "/", F.regexp_extract("url", "://([^/?#]*)", 1), "/", F.when(k % 5 == 0, "~$").otherwise(""), F.when(k % 7 == 0, "图纸").otherwise("f"), k, F.when(k % 3 == 0, "_dup").otherwise(""), F.when(k % 11 == 0, ".zip").when(k % 2 == 0, ".xlsx").otherwise(".pdf"))
    x = table(spark, sf_dir, "pages").select("page_id", rel.alias("rel"))
    form = metadata.source_format(F.col("rel"), "_dup")
    x = x.select(
        "page_id", metadata.classify(F.col("rel"), FOLDERS).alias("dataset"), form.alias("format"), metadata.doc_type(F.col("rel"), form, ["图纸", "竣工图"]).alias("doc_type"),
        metadata.junk_file(F.col("rel"), ["__MACOSX"], ["f5.pdf"], ["zip", "rar"]).alias("junk"), metadata.marked_copy(F.col("rel")).alias("marked"),
    )
    return metadata.in_order(x, "dataset", ["german", "english"], "page_id")


def to_transcribe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that need a transcription, of those without a reason to skip, not done yet."""
    k = F.col("turn")
    x = turns(spark, sf_dir).select(
        F.when(F.col("conv_id") % 9 > 0, say(F.col("conv_id"), "/", k)).alias("rel"), F.when(k % 5 == 0, "large").alias("skip_reason"), F.when(F.col("conv_id") % 2 == 0, "a").otherwise("b").alias("dataset_key"),
        (k % 4 > 0).alias("ok"), F.when(k % 3 == 0, "blank").otherwise("text").alias("content"), F.when(k % 2 == 0, "mixed").otherwise("printed").alias("writing"), F.when(F.col("role") == "user", "low").alias("quality"), F.when(k % 6 == 1, False).alias("readable"),
    )
    done = x.where(F.col("rel").endswith("1")).select("rel")
    x = metadata.pending(x, done, "rel", "a")
    return x.where(metadata.needs_transcription(*[F.col(c) for c in ("ok", "content", "writing", "quality", "readable")])).select("rel")


def typed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "nation").select(F.col("n_name").alias("rel"), F.when(F.col("n_nationkey") % 2 == 0, "").otherwise("1999").alias("year"), F.lit("").alias("location"), F.lit("").alias("title"))
    return files.entries(x)


def name_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = F.concat_ws("/", "p_brand", F.regexp_replace("p_type", " ", "_"), F.concat((F.col("p_size") % 10).cast("string"), F.lit(".pdf")))
    x = files.by_name(table(spark, sf_dir, "part").select(rel.alias("rel")).distinct())
    return x.select("name", F.size("paths").cast(LONG).alias("n"), F.md5(F.array_join("paths", "|")).alias("paths_md5"))


def workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.unhex(F.when(F.col("p_partkey") % 3 == 0, "D0CF11E0A1").when(F.col("p_partkey") % 3 == 1, "504B0304"))
    return table(spark, sf_dir, "part").select("p_partkey", files.legacy_workbook(head).alias("legacy"))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested figures of a brand as rows, then counted by the top folder of their type."""
    x = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("figures"))
    x = files.explode_inventory(x, "figures")
    return profile.histogram(x, F.substring_index("item", " ", 1), "folder").join(x.groupBy(F.substring_index("item", " ", 1).alias("folder")).agg(F.max("place").cast(LONG).alias("last")), "folder")


def graded_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built-in checks of answers: all keywords, any keyword, half of them, refusals."""
    words = F.array(*map(F.lit, ("the", "de", "en")))
    x = turns(spark, sf_dir).where("role = 'assistant'").withColumn("k", F.size(evaluate.keywords_found(words, F.col("text"))))
    refusal, refused = F.col("turn") % 5 == 1, F.contains("text", F.lit("ou"))
    return x.select("conv_id", "turn", F.col("k").cast(LONG).alias("found"), (F.col("k") == 3).alias("every"), (F.col("k") > 0).alias("any"), evaluate.grade_share(F.col("k"), F.lit(3), refusal, refused).alias("passed"))


QUERIES = {
    f.__name__: f
    for f in (
        path_names, first_fields, table_numbers, despaced, unfenced, thoughts, transcriptions, verdicts, page_suffixes, marked_parts, templates, leakless, sectionless, cache_keys, value_checks,
        description_flags, layouts, formulas, cells, grids, streamed, captions, event_names, serials, run_states, first_pages, catalogue, to_transcribe, typed_entries, name_paths, workbooks,
        inventory, graded_answers,
    )
}

_TRIM = r"regexp_replace({}, '^[\s\x{{3000}}\x{{a0}}]+|[\s\x{{3000}}\x{{a0}}]+$', '', 'g')"
ORACLES = {
    "path_names": r"""WITH p AS (SELECT page_id, url || ' fixed_a.Tar.GZ' AS path FROM pages), b AS (SELECT *, split_part(path, '/', -1) AS base FROM p)
        SELECT page_id, path, base, regexp_replace(base, '^(.+)\.[^.]*$', '\1') AS stem, lower(regexp_replace(replace('Fixed_ ' || base, ' ', ''), '^fixed_', '')) AS lookup FROM b""",
    "first_fields": "SELECT conv_id, turn, md5(CASE WHEN turn % 3 = 1 THEN role ELSE text END) AS field_md5 FROM conversations",
    "table_numbers": r"""SELECT conv_id, turn, array_to_string(list_sort(list_distinct(regexp_extract_all(left('see D.0.' || turn || '-' || (conv_id % 5) || ' and D.0.' || (turn % 2) || ', D.0.' || turn || '-' || (conv_id % 5) || ' not D.1.2 ' || text, 2000),
        '(D\.0\.[0-9]+(?:-[0-9]+)?)', 1))), '|') AS numbers FROM conversations""",
    "despaced": r"""WITH t AS (SELECT o_orderkey, year(o_orderdate::DATE) || ' 年 ' || month(o_orderdate::DATE) || '  月 ' || day(o_orderdate::DATE) || ' 日 ' || (o_orderkey % 24) || ' : ' || (o_orderkey % 60) || ' 共 ' || (o_orderkey % 7) || ' 人 ' || (o_orderkey % 100) || ' % ' || (o_orderkey % 9) || ' 8 x' AS t FROM orders)
        SELECT o_orderkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '([0-9])\s+([年月日时分秒])', '\1\2', 'g'), '([年月日时分秒])\s+([0-9])', '\1\2', 'g'), '([0-9])\s*:\s+([0-9])', '\1:\2', 'g'),
          '([0-9])\s+([%℃°])', '\1\2', 'g'), '([0-9])\s+([米元方级人次台名处条款项次兆])', '\1\2', 'g') AS text FROM t""",
    "unfenced": f"SELECT conv_id, turn, md5(CASE WHEN turn % 2 = 0 THEN {_TRIM.format('text')} WHEN starts_with({_TRIM.format('text')}, '```') THEN 'x' ELSE {_TRIM.format('text')} END) AS text_md5 FROM conversations",
    "thoughts": f"SELECT conv_id, turn, md5(CASE turn % 3 WHEN 1 THEN role || ' <think>open ' || {_TRIM.format('text')} ELSE {_TRIM.format('text')} END) AS last_md5, md5(CASE turn % 3 WHEN 1 THEN role ELSE {_TRIM.format('text')} END) AS open_md5 FROM conversations",
    "transcriptions": f"""WITH t AS (SELECT conv_id, turn, turn % 6 AS k, regexp_replace(text, '[^A-Za-z ]', '', 'g') AS b FROM conversations), u AS (SELECT *, {_TRIM.format('b')} AS s FROM t)
        SELECT conv_id, turn, md5(CASE WHEN s = '' THEN NULL WHEN k IN (0, 1, 3) THEN s WHEN k = 2 THEN b END) AS text_md5, CASE WHEN s = '' THEN true ELSE k <> 0 END AS low_conf,
          CASE WHEN s = '' OR k IN (0, 2, 4, 5) THEN '' WHEN k = 1 THEN 'faint' ELSE 'no CONF line' END AS notes,
          CASE WHEN k = 4 OR (k = 3 AND s = '') THEN 'empty' WHEN k = 5 OR (s = '' AND k < 2) THEN 'no body' WHEN s = '' THEN 'no text' END AS error FROM u""",
    "verdicts": """SELECT conv_id, turn, CASE WHEN conv_id % 7 > 0 THEN ['letter', 'letter', 'invoice', 'other'][turn % 4 + 1] END AS category, CASE WHEN conv_id % 7 > 0 THEN 't' || turn END AS title_hint, CASE WHEN conv_id % 7 > 0 THEN '' END AS date_hint,
        CASE WHEN conv_id % 7 > 0 THEN turn % 2 = 0 END AS handwriting, CASE WHEN conv_id % 7 > 0 THEN least(turn / 4, 1.0)::DOUBLE END AS confidence FROM conversations""",
    "page_suffixes": """WITH t AS (SELECT conv_id, turn, turn % 6 AS k, role, CASE WHEN conv_id % 2 = 0 THEN 'folder' ELSE '扫描件' END AS up FROM conversations)
        SELECT conv_id, turn, CASE k WHEN 0 THEN up WHEN 1 THEN 'scan' WHEN 2 THEN 'report' WHEN 3 THEN 'map' WHEN 4 THEN up ELSE role END AS base,
          CASE k WHEN 0 THEN conv_id::VARCHAR WHEN 4 THEN '2021010' || (turn % 9) || '1200' WHEN 5 THEN NULL ELSE turn::VARCHAR END AS page FROM t""",
    "marked_parts": "SELECT conv_id, turn, role || '|a|' || turn || '|' || conv_id AS parts FROM conversations",
    "templates": "SELECT conv_id, turn, role || ' ' || turn || '/' || turn || ' {other}' AS text FROM conversations",
    "leakless": "SELECT conv_id, turn, 'first' || chr(10) || 'last ' || turn AS text FROM conversations",
    "sectionless": "SELECT conv_id, turn, '# ' || role || chr(10) || 'body' || CASE WHEN turn % 2 = 0 THEN chr(10) || '## Next' || chr(10) || 'rest' ELSE '' END AS text FROM conversations",
    "cache_keys": "SELECT conv_id, string_agg(DISTINCT 'a|' || role || '|' || CASE WHEN turn % 2 = 0 THEN 'says' ELSE '' END || '|' || (turn % 3), chr(10) ORDER BY 'a|' || role || '|' || CASE WHEN turn % 2 = 0 THEN 'says' ELSE '' END || '|' || (turn % 3)) AS signature, sha256('v1' || chr(31) || conv_id || chr(31)) AS cache_key FROM conversations GROUP BY 1",
    "value_checks": "SELECT p_partkey, CASE WHEN contains(t, n || 'mm') THEN 'exact' WHEN contains(t, n) THEN 'number' ELSE 'missing' END AS found FROM (SELECT p_partkey, p_name || ' 1' || (p_partkey % 10) || 'mm 7 mm' AS t, (p_size % 20)::VARCHAR AS n FROM part)",
    "description_flags": r"""WITH t AS (SELECT conv_id, turn, turn % 4 AS k, CASE turn % 4 WHEN 0 THEN 'Image: ' || turn WHEN 1 THEN 'Prompt: describe ' || text WHEN 2 THEN '图片：水位线 ab' ELSE text END AS t FROM conversations),
        u AS (SELECT *, replace(replace(t, 'Image:', ''), '图片：', '') AS b FROM t)
        SELECT conv_id, turn, CASE WHEN contains(upper(t), 'PROMPT:') THEN 'LEAK' WHEN len(regexp_extract_all(b, '[\x{4e00}-\x{9fff}]')) < 3 AND len(regexp_extract_all(b, '[A-Za-z]')) <= 5 THEN 'EMPTY' END AS flag FROM u""",
    "layouts": """WITH t AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN replace('a~b~c~d~long line~f', '~', chr(10)) WHEN 1 THEN '<caption>x</caption><caption>y' WHEN 2 THEN '| a | b |' ELSE text END AS t FROM conversations), l AS (SELECT *, string_split(t, chr(10)) AS ls FROM t)
        SELECT conv_id, turn, array_to_string(list_filter([CASE WHEN len(ls) > 5 AND len(list_filter(ls, lambda x: length(trim(x)) <= 2)) > 0.3 * len(ls) THEN 'vertical' END, CASE WHEN length(t) < 120 AND NOT contains(t, '|') THEN 'tiny' END,
          CASE WHEN len(regexp_extract_all(t, '<caption')) > 1 THEN 'captions' END], lambda x: x IS NOT NULL), '|') AS issues FROM l""",
    "formulas": r"""SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'latex' WHEN 1 THEN 'suspect' WHEN 2 THEN 'latex' ELSE CASE WHEN regexp_matches(text, '\$[^$\n]+\$|\\frac|\\sum|\\times|\\sqrt|\\begin\{') THEN 'latex' WHEN contains(text, '式中') THEN 'suspect' END END AS state FROM conversations""",
    "cells": """SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN 'a|' || l_quantity::INTEGER || '|nan' WHEN 1 THEN 'x y|' || l_partkey || '|NaN' END AS cells, CASE WHEN l_linenumber % 3 < 2 THEN 1::BIGINT END AS blank,
        CASE l_linenumber % 3 WHEN 0 THEN l_partkey::VARCHAR WHEN 2 THEN 'a ' || l_suppkey END AS clean FROM lineitem""",
    "grids": """WITH r AS (SELECT s_nationkey AS n, s_suppkey AS k, s_name AS a, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey::VARCHAR ELSE 'n/a' END AS c FROM supplier)
        SELECT n AS s_nationkey, md5('# 表：Nation ' || n || chr(10) || chr(10) || '| name | key | nation |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || a || ' | ' || k || ' | ' || c || ' |', chr(10) ORDER BY k) || chr(10)) AS table_md5,
          count(*) FILTER (k % 2 = 0) AS n_pairs, coalesce(string_agg('Nation ' || n || '中，第1列的数值是多少？~name=' || a || ' | key=' || k || ' | nation=' || c, '^' ORDER BY k) FILTER (k % 2 = 0), '') AS pairs FROM r GROUP BY n""",
    "streamed": "SELECT conv_id, string_agg(role || turn, '' ORDER BY turn) AS answer FROM conversations GROUP BY 1",
    "captions": """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '表' || x || '|' || x || '|水位表|表' || x || '水位表' WHEN 1 THEN '流量' ELSE '' END AS keywords,
        CASE WHEN p_partkey % 4 = 0 AND p_partkey % 5 > 0 THEN CASE p_partkey % 9 WHEN 3 THEN '图3 大坝' WHEN 4 THEN '图4' END END AS question FROM (SELECT p_partkey, (p_partkey % 50) || '.' || (p_partkey % 7) AS x FROM part)""",
    "event_names": "SELECT page_id, CASE page_id % 3 WHEN 0 THEN '2021-' || lpad((page_id % 12 + 1)::VARCHAR, 2, '0') WHEN 1 THEN 'the storm' ELSE 'bee' END AS event FROM pages",
    "serials": """SELECT o_orderkey, CASE WHEN s BETWEEN 20000 AND 60000 THEN (DATE '1899-12-30' + s::INTEGER)::VARCHAR END AS day, CASE WHEN s + 0.5 BETWEEN 20000 AND 60000 THEN (DATE '1899-12-30' + s::INTEGER + 1)::VARCHAR END AS next,
        least(0.25 * pow(2, o_orderkey % 9), 5.0)::DOUBLE AS wait FROM (SELECT o_orderkey, o_orderkey * 3 + 19000 AS s FROM orders)""",
    "run_states": """SELECT event_id, event_id % 6 < 2 AS done, event_id % 6 IN (2, 3) AS failed, event_id % 4 IN (0, 3) AS ok,
        len(list_distinct(list_filter([event_type, (event_id % 3)::VARCHAR, '1'], lambda x: x IN ('click', '1', '2')))) AS tags FROM events""",
    "first_pages": "SELECT l_orderkey, min(l_partkey % 40) AS page FROM lineitem GROUP BY 1",
    "catalogue": r"""WITH p AS (SELECT page_id, page_id % 4 AS k, page_id % 11 = 0 AS zip, CASE WHEN page_id % 11 = 0 THEN 'zip' WHEN page_id % 2 = 0 THEN 'xlsx' ELSE 'pdf' END AS ext, page_id % 3 = 0 AS dup,
          CASE WHEN page_id % 5 = 0 THEN '~$' ELSE '' END || CASE WHEN page_id % 7 = 0 THEN '图纸' ELSE 'f' END || page_id || CASE WHEN page_id % 3 = 0 THEN '_dup' ELSE '' END AS stem FROM pages)
        SELECT page_id, ['english', 'german'][k + 1] AS dataset, CASE ext WHEN 'zip' THEN 'unknown' WHEN 'xlsx' THEN 'excel' ELSE CASE WHEN dup THEN 'merged_pdf' ELSE 'pdf' END END AS format,
          CASE WHEN ext = 'xlsx' THEN '表格' WHEN page_id % 7 = 0 THEN '图纸' ELSE '文本' END AS doc_type, CASE WHEN k = 3 THEN 'junk_dir' WHEN stem || '.' || ext = 'f5.pdf' THEN 'junk_name' WHEN starts_with(stem, '~$') THEN 'temporary' WHEN zip THEN 'archive' END AS junk, dup AS marked FROM p""",
    "to_transcribe": """SELECT rel FROM (SELECT CASE WHEN conv_id % 9 > 0 THEN conv_id || '/' || turn END AS rel, conv_id, turn, role FROM conversations) WHERE rel IS NOT NULL AND turn % 5 > 0 AND conv_id % 2 = 0 AND NOT ends_with(rel, '1')
        AND turn % 4 > 0 AND turn % 3 > 0 AND (turn % 2 = 0 OR role = 'user' OR turn % 6 = 1)""",
    "typed_entries": "SELECT n_name AS rel, CASE WHEN n_nationkey % 2 > 0 THEN '1999' END AS year, NULL::VARCHAR AS location, '' AS title FROM nation",
    "name_paths": "SELECT name, count(*) AS n, md5(string_agg(rel, '|' ORDER BY rel)) AS paths_md5 FROM (SELECT DISTINCT (p_size % 10) || '.pdf' AS name, p_brand || '/' || replace(p_type, ' ', '_') || '/' || (p_size % 10) || '.pdf' AS rel FROM part) GROUP BY 1",
    "workbooks": "SELECT p_partkey, p_partkey % 3 = 0 AS legacy FROM part",
    "inventory": """WITH f AS (SELECT DISTINCT p_brand, p_type FROM part), g AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_type) - 1 AS place FROM f)
        SELECT split_part(p_type, ' ', 1) AS folder, count(*) AS n, max(place) AS last FROM g GROUP BY 1""",
    "graded_answers": """WITH x AS (SELECT conv_id, turn, text, contains(text, 'the')::INTEGER + contains(text, 'de')::INTEGER + contains(text, 'en')::INTEGER AS k FROM conversations WHERE role = 'assistant')
        SELECT conv_id, turn, k::BIGINT AS found, k = 3 AS every, k > 0 AS any, CASE WHEN turn % 5 = 1 THEN contains(text, 'ou') AND k >= 1 ELSE k >= 2 END AS passed FROM x""",
}

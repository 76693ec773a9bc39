"""Text functions as column expressions: normalising, stripping, captions, records, chunks.

Every function takes and returns columns, stays in the JVM and returns null for
a null input unless it says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Full-width ASCII and its half-width counterparts, from a rule.
WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))
# HTML entities that are decoded, in order.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"))
# Words and punctuation that end a caption's title, and its greatest length.
TITLE_STOPS = ("通过", "所示", "如下", "详见", "其中", "见表", "见图", "见 ", "如 ")
TITLE_PUNCTUATION = "，。；、,;:：!？\n\r\t）)】》］"
TITLE_LENGTH = 24
# Marks that repeat the cell above.
DITTO = ("〃", "同上")
# The number of a table or figure.
NUMBER = r"\s*[0-9A-Z][0-9.\-]*"
BLANKS = r"[\s　]+"
# Where a blank is inside a date, time or quantity, and what takes its place.
NUMBER_BLANKS = (
    (r"(?<=\d)\s+(?=[年月日时分秒])", ""),
    (r"(?<=[年月日时分秒])\s+(?=\d)", ""),
    (r"(?<=\d)\s*:\s+(?=\d)", ":"),
    (r"(?<=\d)\s+(?=[%℃°])", ""),
    (r"(?<=\d)\s+(?=[米元方级人次台名处条款项次兆])", ""),
)
# Names of photos by time stamp, and endings that hold a page number, in the order they are tried.
PHOTO_NAME = r"^微信图片[_\-]?\d{8,14}(?:[_\-]\d{1,4})*$"
PAGE_ENDINGS = (r"[_-](\d{1,4})", r"第(\d{1,4})页", r"[（(](\d{1,4})[）)]", r"\s+(\d{1,4})", r"(\d{1,3})")


def strip(c: Column) -> Column:
    """Without white space at either end, the ideographic blank included."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def present(c: Column) -> Column:
    """Null where empty."""
    return F.when(c != "", c)


def first_present(*columns: Column) -> Column:
    """The first column that is neither null nor empty."""
    return F.coalesce(*[present(c) for c in columns])


def slashes(path: Column) -> Column:
    return F.translate(path, "\\", "/")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """The file name without its last extension."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def lookup_name(name: Column) -> Column:
    """A name for fuzzy lookup: lower case, without blanks and the prefix of repaired files."""
    return F.lower(F.regexp_replace(F.regexp_replace(name, r"\s+", ""), r"^fixed_", ""))


def match_form(c: Column) -> Column:
    """For matching: lower case, half width, commas after a digit dropped. Null counts as empty."""
    narrow = F.translate(F.lower(F.coalesce(c, F.lit(""))), WIDE, NARROW)
    return F.regexp_replace(narrow, r"(?<=[\p{Nd}²³¹⁰⁴-⁹₀-₉]),+", "")


def answer_form(c: Column) -> Column:
    """For grading answers: three full-width signs narrowed, blanks and markup dropped, lower case."""
    return F.lower(F.translate(F.coalesce(c, F.lit("")), "～＞％ *#`", "~>%"))


def html_strip(c: Column) -> Column:
    """Tags and line breaks to blanks, entities decoded, white space collapsed."""
    out = F.regexp_replace(F.regexp_replace(c, r"(?i)<\s*br\s*/?\s*>", " "), r"<[^>]+>", " ")
    for name, char in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    return strip(F.regexp_replace(out, BLANKS, " "))


def caption_title(tail: Column) -> Column:
    """The title at the start of what follows a caption's number."""
    kept = F.regexp_extract(html_strip(tail), rf"(?s)^[^{TITLE_PUNCTUATION}]*", 0)
    kept = F.regexp_extract(kept, rf"(?s)^(.*?)(?:[图表]{NUMBER}|$)", 1)
    for word in TITLE_STOPS:
        kept = F.substring_index(kept, word, 1)
    bare = F.regexp_replace(F.regexp_replace(kept, BLANKS, ""), r"^[）)】》］、，,;:：]+", "")
    return F.left(bare, F.lit(TITLE_LENGTH))


def caption_keywords(kind: str, number: Column, title: Column) -> Column:
    """Keyword forms of a caption: number, number and title with a blank, and without one if the title is short."""
    bare = F.regexp_replace(F.regexp_replace(number, BLANKS, ""), r"[.\-]+$", "")
    bare = F.when(bare.startswith(kind), bare).otherwise(F.concat(F.lit(kind), bare))
    title = F.coalesce(title, F.lit(""))
    forms = F.array(bare, F.when(title != "", F.concat(bare, F.lit(" "), title)), F.when((title != "") & (F.length(title) <= 16), F.concat(bare, title)))
    return F.when(F.length(bare) > len(kind), F.array_distinct(F.array_compact(forms))).otherwise(F.array().cast("array<string>"))


def media_keywords(content: Column, kind: Column) -> Column:
    """Caption keywords of a table or image chunk; an empty array for other kinds or without a caption.

    Tables: the caption tag, else the number after the closing tag, else the
    first number anywhere. Images: the first figure number.
    """
    content = F.coalesce(content, F.lit(""))
    any_table, any_figure = rf"(?s)^.*?(表{NUMBER})(.*)$", rf"(?s)^.*?(图{NUMBER})(.*)$"
    caption = F.regexp_replace(F.regexp_replace(html_strip(F.regexp_extract(content, r"(?is)<caption[^>]*>(.*?)</caption>", 1)), BLANKS, ""), r"^续", "")
    after = rf"(?s)^.*?</table>\s*(表{NUMBER})(.*)$"
    named = caption_keywords("表", F.regexp_extract(caption, any_table, 1), caption_title(F.regexp_replace(caption, rf"(?s)^(.*?)表{NUMBER}(.*)$", "$1$2")))
    table = (
        F.when(caption.rlike(rf"表{NUMBER}"), named)
        .when(content.rlike(after), caption_keywords("表", F.regexp_extract(content, after, 1), caption_title(F.regexp_extract(content, after, 2))))
        .when(content.rlike(any_table), caption_keywords("表", F.regexp_extract(content, any_table, 1), caption_title(F.regexp_extract(content, any_table, 2))))
    )
    figure = F.when(content.rlike(any_figure), caption_keywords("图", F.regexp_extract(content, any_figure, 1), caption_title(F.regexp_extract(content, any_figure, 2))))
    is_table = (kind == "table") | content.contains("</table>")
    return F.coalesce(F.when(is_table, table).when(kind == "image", figure), F.array().cast("array<string>"))


def table_numbers(content: Column, limit: int = 2000) -> Column:
    """Distinct table numbers of the form D.0.n(-m) in the first `limit` characters, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.left(content, F.lit(limit)), F.lit(r"(D\.0\.\d+(?:-\d+)?)"), 1)))


def despace_numbers(c: Column) -> Column:
    """Blanks inside dates, times and quantities removed; separate numbers are left apart."""
    for pattern, by in NUMBER_BLANKS:
        c = F.regexp_replace(c, pattern, by)
    return c


def strip_fence(c: Column) -> Column:
    """Without a code fence around the whole."""
    bare = strip(c)
    inside = strip(F.regexp_replace(F.regexp_replace(bare, r"^```[^\n]*(?:\n|$)", ""), r"(?:^|\n)\s*```\s*$", ""))
    return F.when(bare.startswith("```"), inside).otherwise(bare)


def strip_think(c: Column) -> Column:
    """What follows the last closing tag of a thinking block."""
    return strip(F.substring_index(c, "</think>", -1))


def strip_think_open(c: Column) -> Column:
    """Thinking blocks removed; from a block that isn't closed on, nothing stays."""
    return strip(F.regexp_replace(F.regexp_replace(c, r"(?s)<think>.*</think>", ""), r"(?s)<think>.*$", ""))


def json_object(c: Column) -> Column:
    """The text from the first brace to the last, if it parses as JSON; else null."""
    found = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    return F.when(F.try_parse_json(found).isNotNull() & (found != ""), found)


def transcription(raw: Column) -> Column:
    """struct(text, low_conf, notes, error) of a reply with a CONF line, a JSON envelope or neither."""
    body = strip_fence(raw)
    head, rest = F.regexp_extract(body, r"^[^\n]*", 0), strip(F.regexp_replace(body, r"^[^\n]*\n?", ""))
    level = F.upper(F.regexp_extract(head, r"(?i)^CONF:\s*(HIGH|LOW)\b", 1))
    note = strip(F.regexp_replace(strip(F.regexp_extract(head, r"NOTES:(.*)$", 1)), r"^\|+", ""))
    note = F.when(note.isin("-", "—", "无", "->"), "").otherwise(note)
    parsed = F.from_json(json_object(body), "text string, low_conf boolean, notes string")

    def result(text: Column, low: Column, notes: Column, error: Column) -> Column:
        return F.struct(text.cast("string").alias("text"), low.alias("low_conf"), notes.alias("notes"), error.cast("string").alias("error"))

    none, empty = F.lit(None), F.lit("")
    envelope = F.when(F.coalesce(strip(parsed["text"]), empty) == "", result(none, F.lit(True), empty, F.lit("no text"))).otherwise(
        result(parsed["text"], F.coalesce(parsed["low_conf"], F.lit(False)), F.coalesce(parsed["notes"], empty), none)
    )
    return (
        F.when(F.coalesce(body, empty) == "", result(none, F.lit(True), empty, F.lit("empty")))
        .when(body.startswith("{"), envelope)
        .when((level != "") & (rest == ""), result(none, F.lit(True), empty, F.lit("no body")))
        .when(level != "", result(rest, level == "LOW", note, none))
        .otherwise(result(body, F.lit(True), F.lit("no CONF line"), none))
    )


def verdict(reply: Column, categories: Sequence[str], hints: Sequence[tuple[str, Sequence[str]]], other: str) -> Column:
    """struct(category, title_hint, date_hint, handwriting, confidence), null where no JSON object is found."""
    x = F.from_json(json_object(reply), "category string, title_hint string, date_hint string, handwriting boolean, confidence string")
    name = F.trim(F.coalesce(x["category"], F.lit("")))
    snapped = F.when(name.isin(*categories), name)
    for category, words in hints:
        snapped = snapped.when(F.exists(F.array(*map(F.lit, words)), lambda w: name.contains(w)), category)
    confidence = F.coalesce(F.least(F.greatest(x["confidence"].try_cast("double"), F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    text = lambda k: F.trim(F.coalesce(x[k], F.lit("")))
    return F.when(
        json_object(reply).isNotNull(),
        F.struct(snapped.otherwise(other).alias("category"), text("title_hint").alias("title_hint"), text("date_hint").alias("date_hint"), F.coalesce(x["handwriting"], F.lit(False)).alias("handwriting"), confidence.alias("confidence")),
    )


def page_suffix(name: Column, parent: Column) -> Column:
    """struct(base, page) of a scan's file stem.

    Pure digits and camera time stamps take the parent's name and their digits
    as page; else the first of five endings that leaves a base; else no page.
    """
    fallback = F.when(F.coalesce(parent, F.lit("")) == "", "扫描件").otherwise(parent)
    stamp = name.rlike(PHOTO_NAME)
    out = F.when(stamp | name.rlike(r"^\d+$"), F.struct(fallback.alias("base"), F.regexp_replace(name, r"\D", "").cast("decimal(38,0)").alias("page")))
    for ending in PAGE_ENDINGS:
        base = F.regexp_replace(F.regexp_extract(name, rf"^(.+?){ending}$", 1), r"[\s\-_]+$", "")
        out = out.when(base != "", F.struct(base.alias("base"), F.regexp_extract(name, rf"^(.+?){ending}$", 2).cast("decimal(38,0)").alias("page")))
    return out.otherwise(F.struct(name.alias("base"), F.lit(None).cast("decimal(38,0)").alias("page")))


def clean_string(c: Column) -> Column:
    """Stripped, common entities decoded, quotes and control characters removed."""
    out = strip(c)
    for name, char in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    return F.regexp_replace(out, "[\"\\x00-\\x1f\\x7f-\\u009f]", "")


def split_markers(c: Column, markers: Sequence[str]) -> Column:
    """Non-empty stripped parts between any of the literal markers."""
    if not markers:
        return F.array(c)
    pattern = "|".join("\\Q" + m + "\\E" for m in markers)
    return F.filter(F.transform(F.split(c, pattern), strip), lambda x: x != "")


def record(text: Column, field: str = "<|>") -> Column:
    """struct(kind, name, other, type, description, keywords, weight) of an extraction record, null if it is neither kind."""
    inner = F.regexp_replace(F.regexp_replace(strip(text), r"^\(", ""), r"\)$", "")
    f = F.split(inner, "\\Q" + field + "\\E")
    part = lambda i: clean_string(F.get(f, F.lit(i)))
    name = lambda i: F.upper(part(i))
    last = F.element_at(f, -1)
    weight = float_literal(last)
    null = F.lit(None).cast("string")
    entity = F.struct(
        F.lit("entity").alias("kind"), name(1).alias("name"), null.alias("other"), name(2).alias("type"), part(3).alias("description"), null.alias("keywords"), F.lit(None).cast("double").alias("weight")
    )
    relation = F.struct(
        F.lit("relationship").alias("kind"), F.least(name(1), name(2)).alias("name"), F.greatest(name(1), name(2)).alias("other"), null.alias("type"), part(3).alias("description"), part(4).alias("keywords"), weight.alias("weight")
    )
    return F.when((F.size(f) >= 4) & (F.get(f, F.lit(0)) == '"entity"') & (strip(name(1)) != ""), entity).when((F.size(f) >= 5) & (F.get(f, F.lit(0)) == '"relationship"'), relation)


def float_literal(c: Column, otherwise: float = 1.0) -> Column:
    """The number that a text spells, with an optional sign and point; else a default."""
    return F.when(c.rlike(r"^[-+]?[0-9]*\.?[0-9]+$"), c.try_cast("double")).otherwise(otherwise)


def predicate(keywords: Column) -> Column:
    """struct(predicate, keywords) of an edge's keywords: stripped, lower case, the first one or `related`."""
    words = F.filter(F.transform(F.split(F.coalesce(keywords, F.lit("")), "<SEP>"), lambda x: F.lower(strip(x))), lambda x: x != "")
    return F.struct(F.coalesce(F.get(words, F.lit(0)), F.lit("related")).alias("predicate"), words.alias("keywords"))


def summary_input(description: Column, tokens: int = 512, parts: int = 12) -> Column:
    """struct(text, needs_model): a merged description cut to so many tokens; one of more parts is for a model to sum up."""
    kept = token_cut(description, tokens)
    return F.struct(kept.alias("text"), (F.size(F.split(kept, "<SEP>")) > parts).alias("needs_model"))


def fill_template(template: Column, values: Column) -> Column:
    """`{key}` replaced by the map's value, for every key."""
    return F.aggregate(F.map_entries(values), template, lambda acc, e: F.replace(acc, F.concat(F.lit("{"), e["key"], F.lit("}")), F.coalesce(e["value"], F.lit(""))))


def token_estimate(c: Column) -> Column:
    return F.greatest(F.floor(F.length(c) / 2).cast("int"), F.lit(1))


def token_cut(c: Column, tokens: int) -> Column:
    return F.left(c, F.lit(2 * tokens))


def drop_lines(c: Column, pattern: str) -> Column:
    """Without the lines that match, and without blank lines."""
    return F.array_join(F.filter(F.split(c, "\n"), lambda x: ~x.rlike(pattern) & (strip(x) != "")), "\n")


def page_anchor(text: Column, length: int) -> Column:
    """The start of the first line with four useful characters that is no table rule; null if there is none."""
    useful = lambda x: F.length(F.regexp_replace(x, r"[^一-鿿A-Za-z0-9]", ""))
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: (useful(x) >= 4) & ~x.rlike(r"^[|:\-\s]+$"))
    return F.left(F.get(lines, F.lit(0)), F.lit(length))


def wikilinks(markdown: Column) -> Column:
    """Distinct targets of [[links]], stripped, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(markdown, F.lit(r"\[\[([^\]]+)\]\]"), 1), strip))


def linkable(name: Column) -> Column:
    """Whether a name may be linked: two characters or more, no hash and no short code."""
    n = strip(F.coalesce(name, F.lit("")))
    return (F.length(n) >= 2) & ~n.rlike(r"^[0-9a-fA-F]{6,}$") & ~n.rlike(r"^[A-Za-z]{1,2}\d{1,3}$")


def linkify(markdown: Column, names: Column, own: Column) -> Column:
    """The first mention of each other linkable name, in the order given, becomes [[name]]; none inside a link.

    The text is kept as a list of alternating plain and linked parts, so a
    later name is only looked for in plain parts.
    """

    def add(parts: Column, name: Column) -> Column:
        at = F.array_position(F.transform(parts, lambda p: p.contains(name) & ~p.startswith("[[")), F.lit(True)).cast("int")
        part = F.get(parts, at - 1)
        before = F.left(part, F.instr(part, name) - 1)
        after = F.substr(part, F.instr(part, name) + F.length(name))
        pieces = F.array(before, F.concat(F.lit("[["), name, F.lit("]]")), after)
        new = F.concat(F.slice(parts, F.lit(1), at - 1), pieces, F.slice(parts, at + 1, F.size(parts)))
        return F.when((at > 0) & linkable(name) & (name != own), new).otherwise(parts)

    links = F.split(F.regexp_replace(markdown, r"(\[\[[^\]]*\]\])", "\u0000$1\u0000"), "\u0000")
    return F.array_join(F.aggregate(names, links, add), "")


def strip_section(markdown: Column, title: str) -> Column:
    """Without the section of that heading, up to the next heading of level one or two."""
    return F.regexp_replace(markdown, rf"(?is)\n*##\s*{title}.*?(?=\n##?\s|\z)", "")


def safe_file_name(c: Column, length: int = 80) -> Column:
    return F.left(F.regexp_replace(c, r'[\\/:*?"<>|\s]+', "_"), F.lit(length))


def safe_sheet_name(c: Column, length: int = 31) -> Column:
    return F.left(F.regexp_replace(c, r"[\\/:*?\[\]]", "_"), F.lit(length))


def chunk_flag(content: Column, short: int = 50) -> Column:
    """empty, noise (under 30 % letters, digits and ideographs), fragment (shorter than `short`) or null."""
    bare = strip(F.coalesce(content, F.lit("")))
    n, valid = F.length(bare), F.regexp_count(bare, F.lit(r"[一-鿿A-Za-z0-9]"))
    return F.when(n == 0, "empty").when(valid / n < 0.3, "noise").when(n < short, "fragment")


def description_flag(content: Column, leaks: Sequence[str], labels: Sequence[str]) -> Column:
    """LEAK where a prompt marker shows; EMPTY where little is left without the labels; else null."""
    upper, bare = F.upper(content), content
    for label in labels:
        bare = F.replace(bare, F.lit(label), F.lit(""))
    little = (F.regexp_count(bare, F.lit(r"[一-鿿]")) < 3) & (F.regexp_count(bare, F.lit("[A-Za-z]")) <= 5)
    return F.when(F.exists(F.array(*map(F.lit, leaks)), lambda m: upper.contains(m)), "LEAK").when(little, "EMPTY")


def layout_issues(content: Column) -> Column:
    """Names of structural anomalies of a table chunk."""
    lines = F.split(content, "\n")
    short = F.size(F.filter(lines, lambda x: F.length(F.trim(x)) <= 2))
    found = F.array(
        F.when((F.size(lines) > 5) & (short > 0.3 * F.size(lines)), "vertical"),
        F.when((F.length(content) < 120) & ~content.contains("|"), "tiny"),
        F.when(F.regexp_count(content, F.lit("<caption")) > 1, "captions"),
    )
    return F.array_compact(found)


# Fixed value: what counts as a formula in LaTeX.
FORMULA = r"\$[^$\n]+\$|\\frac|\\sum|\\times|\\sqrt|\\begin\{"


def formula_state(content: Column) -> Column:
    """latex, suspect (a formula is announced but none is there) or null."""
    return F.when(content.rlike(FORMULA), "latex").when(content.contains("式中"), "suspect")


def numeric_cell(c: Column) -> Column:
    """One optional sign, then digits with an optional fraction."""
    return F.coalesce(F.trim(c).rlike(r"^[+-]?\d+(\.\d+)?$"), F.lit(False))


def blank_cell(c: Column) -> Column:
    return c.isNull() | (F.lower(strip(c)).isin("", "nan"))


def row_cells(line: Column) -> Column:
    """Cells of a raw line: split at tabs, else at two blanks or more; null if neither gives two cells."""
    tabs, gaps = F.split(line, "\t"), F.split(line, "  +")
    return F.transform(F.when(F.size(tabs) >= 2, tabs).when(F.size(gaps) >= 2, gaps), strip)


def lines_markdown(lines: Column) -> Column:
    """Raw lines (an array) as a Markdown table, what isn't part of it in a fence below; without any table all in a fence.

    The delimiter with more rows makes the table, the tab if both have as many;
    the rows of the other one are left out. The row before the first of mostly
    numeric cells is the header; if that is the first row, columns are numbered;
    without numeric rows the first is the header. Rows above the header go to the
    fence, cells joined by tabs, then lines of one cell.
    """
    by_tab = F.filter(lines, lambda x: x.contains("\t"))
    gaps = F.filter(lines, lambda x: ~x.contains("\t") & x.rlike("  +"))
    plain = F.filter(lines, lambda x: ~x.contains("\t") & ~x.rlike("  +"))
    cut = lambda rows, by: F.transform(rows, lambda x: F.transform(F.split(x, by), strip))
    rows = F.when(F.size(by_tab) >= F.size(gaps), cut(by_tab, "\t")).otherwise(cut(gaps, "  +"))
    numeric = F.transform(rows, lambda r: 2 * F.size(F.filter(r, numeric_cell)) > F.size(r))
    data = F.array_position(numeric, F.lit(True)).cast("int")  # from 1, 0 without
    head = F.when(data == 0, 1).otherwise(data - 1)  # from 1, 0 for numbered columns
    numbered = F.transform(F.sequence(F.lit(1), F.greatest(F.size(F.get(rows, F.lit(0))), F.lit(1))), lambda i: F.concat(F.lit("列"), i.cast("string")))
    headers = F.when(head == 0, numbered).otherwise(F.get(rows, head - 1))
    above = F.transform(F.slice(rows, F.lit(1), F.greatest(head - 1, F.lit(0))), lambda r: F.array_join(r, "\t"))
    rest = F.concat(above, plain)
    fence = F.when(F.size(rest) > 0, F.concat(F.lit("\n\n```\n"), F.array_join(rest, "\n"), F.lit("\n```"))).otherwise("")
    made = F.concat(markdown_table(headers, F.slice(rows, head + 1, F.greatest(F.size(rows) - head, F.lit(0)))), fence, F.lit("\n"))
    return F.when(F.size(rows) == 0, F.concat(F.lit("```\n"), F.array_join(plain, "\n"), F.lit("\n```\n"))).otherwise(made)


def context_text(rows: Column) -> Column:
    """Texts of rows of cells above a header: cells joined by blanks, rows by semicolons, blank ones left out."""
    filled = F.transform(rows, lambda r: F.array_join(F.transform(F.filter(r, lambda c: ~blank_cell(c)), strip), " "))
    return F.array_join(F.filter(filled, lambda x: x != ""), "; ")


def markdown_table(headers: Column, rows: Column) -> Column:
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    rule = line(F.transform(headers, lambda _: F.lit("---")))
    return F.array_join(F.concat(F.array(line(headers), rule), F.transform(rows, line)), "\n")


def table_document(title: Column, headers: Column, rows: Column) -> Column:
    return F.concat(F.lit("# 表："), title, F.lit("\n\n"), markdown_table(headers, rows), F.lit("\n"))


def question_pairs(title: Column, headers: Column, rows: Column) -> Column:
    """array of struct(question, answer) for rows of which at least half the cells are numeric."""
    numbers = lambda r: F.filter(F.transform(r, lambda c, i: F.when(numeric_cell(c), i)), lambda i: i.isNotNull())
    good = F.filter(rows, lambda r: (F.size(r) > 0) & (2 * F.size(numbers(r)) >= F.size(r)))

    def pair(r: Column) -> Column:
        named = F.array_join(F.zip_with(headers, r, lambda h, v: F.when(h.isNotNull() & v.isNotNull(), F.concat(h, F.lit("="), v))), " | ")
        asked = F.concat(title, F.lit("中，第"), F.get(numbers(r), F.lit(0)).cast("string"), F.lit("列的数值是多少？"))
        plain = F.concat(title, F.lit("的相关数据是多少？"))
        return F.struct(
            F.when(F.size(headers) > 0, F.coalesce(asked, plain)).otherwise(plain).alias("question"),
            F.when(F.size(headers) > 0, named).otherwise(F.array_join(r, " | ")).alias("answer"),
        )

    return F.transform(good, pair)


def expand_dittos(text: Column) -> Column:
    """Ditto cells of pipe tables take the cell above, which may itself have been expanded."""
    rule = r"^:?-+:?$"
    real = lambda c: (F.trim(c) != "") & ~F.trim(c).rlike(rule) & ~F.trim(c).isin(*DITTO)
    mark = lambda c: F.regexp_replace(F.trim(c), "^[“”‘’\"']+|[“”‘’\"']+$", "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("above"))

    def step(acc: Column, line: Column) -> Column:
        cells = F.split(F.trim(line), r"\|")
        above = acc["above"]
        usable = (F.size(above) == F.size(cells)) & F.exists(F.slice(above, 2, F.greatest(F.size(above) - 2, F.lit(0))), lambda c: (F.trim(c) != "") & ~F.trim(c).rlike(rule))
        filled = F.transform(cells, lambda c, i: F.when((i > 0) & (i < F.size(cells) - 1) & F.trim(mark(c)).isin(*DITTO) & real(F.get(above, i)), F.concat(F.lit(" "), F.trim(F.get(above, i)), F.lit(" "))).otherwise(c))
        new = F.when(usable, filled).otherwise(cells)
        written = F.when(usable, F.array_join(filled, "|")).otherwise(line)
        table = F.trim(line).startswith("|")
        return F.struct(
            F.array_append(acc["done"], F.when(table, written).otherwise(line)).alias("done"),
            F.when(table, new).otherwise(F.array().cast("array<string>")).alias("above"),
        )

    return F.array_join(F.aggregate(F.split(text, "\n"), start, step, lambda acc: acc["done"]), "\n")


def chunks(markdown: Column, most_lines: int = 10, most_chars: int = 600, least_chars: int = 40) -> Column:
    """Sections at `## ` headings, their non-blank lines packed up to a number of lines or characters; short ones dropped."""
    none = F.array().cast("array<string>")
    start = F.struct(F.lit("").alias("head"), none.alias("buffer"), F.lit(0).alias("n"), none.alias("out"))

    def flushed(acc: Column) -> Column:
        whole = F.concat(F.when(acc["head"] != "", F.concat(acc["head"], F.lit("\n"))).otherwise(""), F.array_join(acc["buffer"], "\n"))
        return F.when(F.size(acc["buffer"]) > 0, F.array_append(acc["out"], whole)).otherwise(acc["out"])

    def step(acc: Column, line: Column) -> Column:
        grown = F.struct(acc["head"].alias("head"), F.array_append(acc["buffer"], line).alias("buffer"), (acc["n"] + F.length(line)).alias("n"), acc["out"].alias("out"))
        full = (F.size(grown["buffer"]) >= most_lines) | (grown["n"] >= most_chars)
        emptied = F.struct(acc["head"].alias("head"), none.alias("buffer"), F.lit(0).alias("n"), flushed(grown).alias("out"))
        opened = F.struct(line.alias("head"), none.alias("buffer"), F.lit(0).alias("n"), flushed(acc).alias("out"))
        return F.when(line.startswith("## "), opened).when(strip(line) == "", acc).when(full, emptied).otherwise(grown)

    packed = F.aggregate(F.split(markdown, "\n"), start, step, flushed)
    return F.filter(F.transform(packed, strip), lambda c: F.length(c) >= least_chars)


def edge_signature(edges: Column) -> Column:
    """Stable text of an array of struct(source, target, predicate, weight): distinct lines, sorted."""
    line = lambda e: F.concat_ws("|", e["source"], e["target"], F.coalesce(e["predicate"], F.lit("")), F.coalesce(e["weight"].cast("string"), F.lit("")))
    return F.array_join(F.array_sort(F.array_distinct(F.transform(edges, line))), "\n")


def cache_key(*parts: Column) -> Column:
    """sha-256 of the parts with a unit separator between them."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def value_check(text: Column, whole: Column, number: Column) -> Column:
    """exact where the whole value is in the text, number where only its digits are, else missing."""
    return F.when(text.contains(whole), "exact").when(text.contains(number), "number").otherwise("missing")


def stream_answer(body: Column) -> Column:
    """The answer of an event stream: `data:` lines parsed as JSON, their answers joined, bad lines left out."""
    data = F.filter(F.split(body, "\n"), lambda x: F.trim(x).startswith("data:"))
    parts = F.transform(data, lambda x: F.get_json_object(F.regexp_replace(F.trim(x), "^data:", ""), "$.data.answer"))
    return F.array_join(F.filter(parts, lambda p: p.isNotNull()), "")

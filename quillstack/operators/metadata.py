"""Catalogue columns derived from paths, and filters over metadata. Vocabularies are parameters."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.functions.text import stem
from quillstack.functions.values import parse_year

#: Formats by extension.
FORMATS = {"pdf": "pdf", "doc": "word", "docx": "word", "xls": "excel", "xlsx": "excel"}


def source_format(path: Column, merged_tag: str | None = None) -> Column:
    out = F.when(F.lit(False), "")
    extension = F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))
    for ext, name in FORMATS.items():
        out = out.when(extension == ext, name)
    out = out.otherwise("unknown")
    return out if merged_tag is None else F.when((out == "pdf") & path.contains(merged_tag), "merged_pdf").otherwise(out)


def quality(format_: Column) -> Column:
    return F.when(format_.isin("word", "excel"), "high").otherwise("medium")


def doc_type(path: Column, format_: Column, drawing_words: Sequence[str]) -> Column:
    drawing = functools.reduce(operator.or_, [path.contains(w) for w in drawing_words], F.lit(False))
    return F.when(format_ == "excel", "表格").when(drawing, "图纸").otherwise("文本")


def classify(path: Column, folders: Mapping[str, str]) -> Column:
    """Dataset of the first path segment; null where unknown (see `unknown_folders`)."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in folders.items() for x in kv]), F.substring_index(path, "/", 1))


def unknown_folders(df: DataFrame, path: str, folders: Mapping[str, str]) -> DataFrame:
    """(folder, n): every first segment without a dataset and its rows; state.require_none makes an error of them."""
    return df.where(classify(F.col(path), folders).isNull()).groupBy(F.substring_index(path, "/", 1).alias("folder")).agg(F.count("*").alias("n"))


def derive(df: DataFrame, path: str, latest_year: int, categories: Mapping[str, str] | None = None, unknown: str = "未知") -> DataFrame:
    """df with sub_category, doc_category, source_format, quality, year and is_marked_copy."""
    segments = F.split(path, "/")
    sub = F.when(F.size(segments) > 2, F.regexp_replace(F.get(segments, F.lit(1)), r"^\d+-", ""))
    table = F.create_map(*[F.lit(x) for kv in (categories or {"": ""}).items() for x in kv])
    form = source_format(F.col(path))
    return df.withColumns(
        {
            "sub_category": sub,
            "doc_category": F.coalesce(F.try_element_at(table, sub), F.lit(unknown)),
            "source_format": form,
            "quality": quality(form),
            "year": parse_year(F.col(path), latest_year).cast("string"),
            "is_marked_copy": marked_copy(F.col(path)),
        }
    )


def marked_copy(path: Column) -> Column:
    return F.lower(stem(path)).rlike("_dupx?$")


def metadata_filter(df: DataFrame, conditions: Sequence[Mapping[str, str]], logic: str = "and") -> DataFrame:
    """Rows that meet the conditions {key, op, value}; an unknown key or operator is an error, never ignored."""
    ops = {"=": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "contains": lambda a, b: a.contains(b)}
    unknown = [c for c in conditions if c["key"] not in df.columns or c["op"] not in ops]
    if unknown or logic not in ("and", "or"):
        raise ValueError(f"unknown conditions {unknown} or logic {logic!r}")
    tests = [F.coalesce(ops[c["op"]](F.col(c["key"]), F.lit(c["value"])), F.lit(False)) for c in conditions]
    return df.where(functools.reduce(operator.and_ if logic == "and" else operator.or_, tests)) if tests else df


def filter_payload(payload: Mapping) -> dict:
    """A filter request in one form: conditions under `manual`, an existing one wins; the method defaults to manual."""
    out = {k: v for k, v in payload.items() if k != "conditions"}
    out.setdefault("method", "manual")
    if "conditions" in payload:
        out.setdefault("manual", payload["conditions"])
    return out


def needs_transcription(row_ok: Column, content: Column, writing: Column, quality_: Column, readable: Column) -> Column:
    """Not blank, and handwritten, of low quality or unreadable; an unknown readability doesn't count."""
    hand = F.coalesce(writing.isin("handwritten", "mixed"), F.lit(False))
    poor = F.coalesce(quality_ == "low", F.lit(False)) | ~F.coalesce(readable, F.lit(True))
    return F.coalesce(row_ok, F.lit(False)) & (F.coalesce(content, F.lit("")) != "blank") & (hand | poor)


def pending(df: DataFrame, done: DataFrame, key: str, dataset: str | None = None) -> DataFrame:
    """Rows with a key, without a reason to skip, not done, of one dataset if named."""
    out = df.where((F.coalesce(F.col(key), F.lit("")) != "") & F.col("skip_reason").isNull()).join(done.select(key), key, "left_anti")
    return out if dataset is None else out.where(F.col("dataset_key") == dataset)


def in_order(df: DataFrame, key: str, order: Sequence[str], then: str) -> DataFrame:
    """By the place of the key in a list, unknown ones last."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(key))
    return df.orderBy(F.coalesce(place, F.lit(0)) == 0, place, then)


def junk_file(path: Column, folders: Sequence[str], names: Sequence[str], extensions: Sequence[str]) -> Column:
    """junk_dir, junk_name, temporary, archive or null."""
    name = F.substring_index(path, "/", -1)
    inside = F.arrays_overlap(F.split(path, "/"), F.array(*map(F.lit, folders)).cast("array<string>"))
    return F.when(inside, "junk_dir").when(name.isin(*names), "junk_name").when(name.startswith("~$"), "temporary").when(F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).isin(*extensions), "archive")

"""Dates, numbers, arrays, maps and JSON as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_year(path: Column, latest: int, earliest: int = 1949) -> Column:
    """The first run of four digits if it is a year in range; later runs aren't tried. `latest` is a parameter, not the clock."""
    found = F.regexp_extract(path, r"\d{4}", 0).try_cast("int")
    return F.when(found.between(earliest, latest), found)


def year_in_text(text: Column) -> Column:
    return F.regexp_extract(text, r"(20\d{2}|19\d{2})", 1).try_cast("int")


def parse_event(path: Column, year: str, suffix: str, names: Mapping[str, str]) -> Column:
    """`year`-MM from a `d-d<suffix>` fragment of a path of that year; else the name of a path segment that is listed."""
    month = F.regexp_extract(path, rf"(\d{{1,2}})-\d{{1,2}}{suffix}", 1)
    dated = F.when(path.contains(year) & (month != ""), F.concat(F.lit(f"{year}-"), F.lpad(month, 2, "0")))
    if not names:
        return dated
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(dated, F.get(F.filter(F.transform(F.split(path, "/"), lambda s: F.try_element_at(table, s)), lambda v: v.isNotNull()), F.lit(0)))


def serial_date(serial: Column, plus_one: bool = False) -> Column:
    """ISO date of a spreadsheet serial from 20000 to 60000, else null; `plus_one` adds a day from serial 60 on."""
    whole = F.floor(serial).cast("int")
    return F.when(serial.between(20000, 60000), F.date_format(F.date_add(F.to_date(F.lit("1899-12-30")), whole + int(plus_one)), "yyyy-MM-dd"))


def clean_cell(c: Column) -> Column:
    """Blank to null, control characters to blanks, whole numbers without a fraction."""
    bare = F.regexp_replace(c, r"[\x00-\x1f\x7f]", " ")
    number = bare.try_cast("double")
    whole = number.isNotNull() & (number == F.floor(number)) & (F.abs(number) < 1e15)
    return F.when(F.lower(F.trim(bare)).isin("", "nan"), None).when(whole, number.cast("long").cast("string")).otherwise(bare)


def backoff(attempt: Column, base: float = 0.25, most: float = 5.0) -> Column:
    """Seconds to wait after so many errors in a row."""
    return F.least(base * F.pow(F.lit(2.0), attempt - 1), F.lit(most))


def coverage_hit(answer: Column, keyword: Column, least_length: int = 6, share: float = 0.7) -> Column:
    """The keyword is in the answer, or is long and enough of its characters are."""
    chars = F.filter(F.split(keyword, ""), lambda x: x != "")
    found = F.size(F.filter(chars, lambda x: answer.contains(x)))
    return answer.contains(keyword) | ((F.length(keyword) >= least_length) & (found / F.length(keyword) >= share))


def first_page(positions: Column) -> Column:
    """The least page of [[page, ...], ...]; null without positions."""
    return F.array_min(F.transform(positions, lambda p: F.get(p, F.lit(0))))


def sparse_map(columns: Mapping[str, Column]) -> Column:
    """A string map without null and empty values."""
    keys, values = F.array(*map(F.lit, columns)), F.array(*[c.cast("string") for c in columns.values()])
    return F.map_filter(F.map_from_arrays(keys, values), lambda _, v: v.isNotNull() & (v != ""))


def tag_overlap(keywords: Column, expected: Column) -> Column:
    return F.size(F.array_intersect(keywords, expected))


def hash_bucket(c: Column, modulus: int = 100) -> Column:
    """The sha-256 of the text as a whole number, modulo a small one, exactly: hex digits are folded."""
    digits = F.transform(F.filter(F.split(F.sha2(c.cast("string"), 256), ""), lambda x: x != ""), lambda x: F.conv(x, 16, 10).cast("int"))
    return F.aggregate(digits, F.lit(0), lambda acc, d: (acc * 16 + d) % modulus)


def run_done(run: Column) -> Column:
    return F.lower(run.cast("string")).isin("3", "done")


def run_failed(run: Column) -> Column:
    return F.lower(run.cast("string")).isin("4", "fail")


def code_ok(code: Column) -> Column:
    """An envelope's integer-like code is zero; anything else is an error."""
    return F.coalesce(code.cast("string").try_cast("int") == 0, F.lit(False))

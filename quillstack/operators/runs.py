"""Ordered groups: islands of consecutive numbers, runs of equal keys, header rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from quillstack.operators.components import cut

#: Characters that sheet names may not hold, and those that are cut at their ends.
FORBIDDEN, CUT_END = r"[\\/:*?\[\]]", r"[; ；,，\-(]+$"


def islands(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """First, last and size of each stretch of consecutive whole numbers of a key; repeats count once."""
    x = df.select(*keys, number).distinct()
    island = F.col(number) - F.row_number().over(Window.partitionBy(*keys).orderBy(number))
    return x.withColumn("_i", island).groupBy(*keys, "_i").agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count("*").alias("size")).drop("_i")


def runs(df: DataFrame, keys: Sequence[str], order: str, starts: Column) -> DataFrame:
    """df with `run`, counted from 1 for each key: a row where `starts` holds (or the first) opens a new one.

    `starts` may use lag() over the keys' order through `previous`.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("run", F.sum(F.when(F.coalesce(starts, F.lit(True)), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def previous(column: str, keys: Sequence[str], order: str) -> Column:
    return F.lag(column).over(Window.partitionBy(*keys).orderBy(order))


def merged(df: DataFrame, keys: Sequence[str], order: str, value: str, separator: str = "\n") -> Column:
    """Aggregate: values joined in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]), separator)


def dealt(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """df dealt out by ranges of keys and order, with the number of the range in `_range`, for `carried` and `counted`."""
    return cut(df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))


def _over_ranges(df: DataFrame, keys: Sequence[str], own: Column, before: Column, name: str, local: Column, join: Callable[[Column, Column], Column]) -> DataFrame:
    """df with `name`, made of what a row has within its range and of what the ranges of its key before it hand on."""
    each = df.groupBy(*keys, "_range").agg(own.alias("_own"))
    handed = each.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_range").alias("_to"), before.alias("_handed"))
    same = F.col("_range") == F.col("_to")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    x = df.withColumn("_local", local).join(handed, same, "left")
    return x.withColumn(name, join(F.col("_local"), F.col("_handed"))).drop("_local", "_handed", "_to", *[f"_key{i}" for i in range(len(keys))])


def carried(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """dealt rows with the last value that isn't null among the rows before them in their key; no window holds all rows of a key."""
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    local = F.last("_value", ignorenulls=True).over(Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    own = F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*order)))
    return _over_ranges(df.withColumn("_value", value), keys, own, F.last("_own", ignorenulls=True).over(before), name, local, F.coalesce).drop("_value")


def counted(df: DataFrame, keys: Sequence[str], order: Sequence[str], starts: Column, name: str) -> DataFrame:
    """dealt rows with the number of rows up to and with them in their key for which `starts` holds."""
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    local = F.count_if("_starts").over(Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    add = lambda a, b: a + F.coalesce(b, F.lit(0))
    return _over_ranges(df.withColumn("_starts", starts), keys, F.count_if("_starts"), F.sum("_own").over(before), name, local, add).drop("_starts")


def continued(df: DataFrame, doc: str, order: str | Sequence[str], aggressive: bool = False) -> DataFrame:
    """Runs of a table and its continuations: the number of the one before and marked as continued, or, if `aggressive`, with the header of the run's first table.

    df: doc, the columns of order, number, is_continued, header. A null or empty
    number continues nothing. Documents are cut into ranges; what a range ends
    with is handed on, so a document with most of all tables is many tasks.
    """
    order = [order] if isinstance(order, str) else list(order)
    x = dealt(df, [doc], order)
    x = carried(x, [doc], order, F.struct("number"), "_before")
    same = (F.col("number") == F.col("_before.number")) & (F.col("number").cast("string") != "")
    x = x.withColumn("_first", ~F.coalesce(same, F.lit(False)))
    marked = F.coalesce("is_continued", F.lit(False))
    # the header of a run's first table is that of the last one that opened a run or isn't marked: unmarked ones stay only if theirs is equal
    x = carried(x, [doc], order, F.when(F.col("_first") | ~marked, F.struct("header")), "_base")
    fits = F.col("header").eqNullSafe(F.col("_base.header")) if aggressive else F.lit(False)
    return counted(x, [doc], order, F.col("_first") | ~(marked | fits), "run").drop("_before", "_first", "_base", "_range")


def merge_tables(df: DataFrame, doc: str, order: str) -> DataFrame:
    """One row for each run: the first table's rows, then the others' without a repeated header; positions in order."""
    parts = F.array_sort(F.collect_list(F.struct(order, "header", "rows", "positions")))
    first = F.get(parts, F.lit(0))
    body = F.transform(parts, lambda p, i: F.when((i > 0) & (F.get(p["rows"], F.lit(0)) == first["header"]), F.slice(p["rows"], F.lit(2), F.size(p["rows"]))).otherwise(p["rows"]))
    return df.groupBy(doc, "run").agg(F.flatten(body).alias("rows"), F.flatten(F.transform(parts, lambda p: p["positions"])).alias("positions"), F.count("*").alias("parts"))


def header_row(grid: DataFrame, sheet: Sequence[str], row: str, cells: str, within: int = 6) -> DataFrame:
    """Per sheet the first of the first rows with two cells or more, at least half of them text; else the first row."""
    filled = F.filter(cells, lambda c: c.isNotNull() & (F.trim(c) != ""))
    words = F.size(F.filter(filled, lambda c: c.try_cast("double").isNull()))
    good = (F.col(row) < within) & (F.size(filled) >= 2) & (2 * words >= F.size(filled))
    return grid.groupBy(*sheet).agg(F.coalesce(F.min(F.when(good, F.col(row))), F.lit(0)).alias("header"))


def image_groups(files: DataFrame, path: str) -> DataFrame:
    """Scans by folder and base name, pages in numeric order, those without a number last."""
    from quillstack.functions.text import page_suffix, stem

    folder = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    x = files.select(F.col(path).alias("rel"), folder.alias("folder"), page_suffix(stem(F.col(path)), F.substring_index(folder, "/", -1)).alias("s"))
    pages = F.array_sort(F.collect_list(F.struct(F.col("s.page").isNull().alias("none"), "s.page", F.lower("rel").alias("low"), "rel")))
    key = F.concat_ws("/", F.when(F.col("folder") != "", F.col("folder")), "s.base")
    return x.groupBy(key.alias("group")).agg(F.transform(pages, lambda p: p["rel"]).alias("pages"), F.count("*").alias("n"))


def sheet_base(title: Column, length: int = 31) -> Column:
    """A title without forbidden characters and white space, cut to the length, without the ending that a cut may leave; never empty."""
    bare = F.regexp_replace(F.regexp_replace(title, FORBIDDEN, ""), r"(?U)[\s\x1c-\x1f]+", "")
    base = F.regexp_replace(F.left(bare, F.lit(length)), CUT_END, "")
    return F.when(base != "", base).otherwise("Sheet1")


def sheet_names(titles: DataFrame, workbook: str, order: str, title: str, length: int = 31) -> DataFrame:
    """titles with `sheet`: legal names that are unique in their workbook, in any case, in order of `order`.

    A name that an earlier sheet has, as its own or by its number, gets the first
    of `~1`, `~2` and so on that none has. Null titles count as empty. The first
    of equal names keeps it. The others with the same characters left before `~`
    and one digit are counted in order and take ~1 to ~9, those behind them are
    counted anew with one character less for two digits, and so on. Only names
    that can meet a title with a `~` of its own depend on all of them: these
    families, told apart by the first characters, are named row by row in a
    sorted partition.
    """
    base = sheet_base(F.coalesce(title, F.lit("")), length)
    rows = titles.withColumn("_base", base).withColumn("_low", F.lower("_base"))
    most = rows.groupBy(workbook).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    digits = len(str(most or 1))
    # equal for a name and all that it may become; a final sigma is lower-cased by what follows it
    family = F.left(F.translate(F.substring_index("_low", "~", 1), "ς", "σ"), F.lit(max(length - 1 - digits, 0)))
    rows = rows.withColumn("_family", family)
    largest = rows.groupBy(workbook, "_family").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    marked = rows.where(F.contains("_low", F.lit("~"))).select(F.col(workbook).alias("_book"), F.col("_family").alias("_kin")).distinct()
    kin = F.col(workbook).eqNullSafe(F.col("_book")) & (F.col("_family") == F.col("_kin"))
    plain, mixed = rows.join(marked, kin, "left_anti"), rows.join(marked, kin, "left_semi")
    # whether a row still needs a number is part of the key, so that numbers count only those that do
    turn = F.row_number().over(Window.partitionBy(workbook, "_low").orderBy(order))
    x = plain.withColumn("sheet", F.when(turn == 1, F.col("_base")))
    for d in range(1, len(str(largest or 1)) + 1):
        stem = F.left("_base", F.lit(length - 1 - d))
        turn = F.row_number().over(Window.partitionBy(workbook, F.lower(stem), F.col("sheet").isNull()).orderBy(order))
        numbered = F.concat(stem, F.lit("~"), (turn + 10 ** (d - 1) - 1).cast("string"))
        x = x.withColumn("sheet", F.coalesce("sheet", F.when(turn <= 9 * 10 ** (d - 1), numbered)))
    one = mixed.repartition(workbook, "_family").sortWithinPartitions(workbook, "_family", order)
    one = one.select(F.struct(*titles.columns).alias("_row"), F.struct(workbook, "_family").alias("_of"), "_base")
    held = StructType([one.schema["_row"], StructField("sheet", StringType())])
    found = one.mapInArrow(_namer(length), held).select(*[F.col("_row").getField(c).alias(c) for c in titles.columns], "sheet")
    return x.select(*titles.columns, "sheet").unionByName(found)


def _namer(length: int) -> Callable:
    """Names the rows of one family after the other; memory is that of a family's names."""

    def named(batches):
        import pyarrow as pa

        now, used, nexts = None, set(), {}
        for batch in batches:
            sheets = []
            for of, base in zip(batch["_of"].to_pylist(), batch["_base"].to_pylist(), strict=True):
                if of != now:
                    now, used, nexts = of, set(), {}
                sheet, d = base, 0
                while sheet.lower() in used:
                    # the number to try next for a stem and its count of digits; those before are taken for good
                    stem = base[: length - 1 - d]
                    n = nexts.get((stem, d), 10 ** (d - 1) if d else 0)
                    if not d or n == 10**d:
                        d += 1
                        continue
                    sheet = f"{stem}~{n}"
                    nexts[stem, d] = n + 1
                used.add(sheet.lower())
                sheets.append(sheet)
            yield pa.RecordBatch.from_arrays([batch["_row"], pa.array(sheets, pa.string())], ["_row", "sheet"])

    return named

"""Readers: catalogues, logs, question sets, vocabularies, file scans. All lazy, all by Spark's readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from quillstack import schemas


def catalogue_csv(spark: SparkSession, path: str, schema: str = schemas.ENTRY) -> DataFrame:
    """A CSV with a header, all columns strings; empty fields stay empty strings."""
    return spark.read.option("header", True).schema(schema).csv(path).fillna("")


def entries(df: DataFrame, nullable: Sequence[str] = ("year", "location", "skip_reason", "duplicate_of", "flood_event")) -> DataFrame:
    """Typed entries of catalogue rows: empty to null in the nullable columns."""
    return df.withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in nullable if c in df.columns})


def tolerant_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines; blank and malformed lines are left out. No such file gives no rows."""
    try:
        lines = spark.read.text(path)
        lines.schema  # noqa: B018  resolves the path
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)
    parsed = lines.where(F.try_parse_json("value").isNotNull() & F.trim("value").startswith("{"))
    return parsed.select(F.from_json("value", schema if isinstance(schema, str) else schema.simpleString()).alias("x")).select("x.*")


def done_keys(log: DataFrame, key: str = "rel") -> DataFrame:
    return log.where("ok").select(key).distinct()


def cases(spark: SparkSession, path: str, tiers: Sequence[str], layers: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """Evaluation cases of a JSON-lines file; the first line with a fault is reported and nothing is returned.

    Checked: required fields, tier and layer, unique ids, datasets, that there
    are numbers or keywords, that only structured cases have a filter, and
    that sources are known if `known` (rel) is given. Lines are numbered within
    the file, which is read as one partition: case files are small by nature.
    """
    text = spark.read.text(path, wholetext=True)
    lines = text.select(F.posexplode(F.split("value", "\n")).alias("line", "value")).where(F.trim("value") != "")
    x = lines.select((F.col("line") + 1).alias("line"), F.from_json("value", schemas.CASE).alias("c")).select("line", "c.*")
    count = x.groupBy("id").agg(F.count("*").alias("_n"))
    x = x.join(count, "id", "left")
    none = lambda c: F.coalesce(F.size(c), F.lit(0)) < 1
    fault = (
        F.when(F.col("id").isNull() | F.col("question").isNull(), "missing field")
        .when(~F.coalesce(F.col("tier").isin(*tiers), F.lit(False)), "unknown tier")
        .when(~F.coalesce(F.col("layer").isin(*layers), F.lit(False)), "unknown layer")
        .when(F.col("_n") > 1, "duplicate id")
        .when(none("datasets"), "no datasets")
        .when(none("gold.numbers") & none("gold.keywords"), "no anchors")
        .when(F.col("meta_filter").isNotNull() & (F.col("layer") != "structured"), "filter outside the structured layer")
    )
    x = x.withColumn("fault", fault)
    faults = x.where("fault is not null").select("line", "fault")
    if known is not None:
        sources = x.select("line", F.explode("gold.source_rel").alias("rel"))
        faults = faults.unionByName(sources.join(known, "rel", "left_anti").select("line", F.concat(F.lit("unknown source "), "rel").alias("fault")))
    first = faults.orderBy("line").limit(1).collect()
    if first:
        raise ValueError(f"line {first[0].line}: {first[0].fault}")
    return x.drop("fault", "_n", "line").withColumns({"use_kg": F.coalesce("use_kg", F.lit(False)), "threshold": F.coalesce("threshold", F.struct(F.lit(1).alias("min_keywords")))})


def questions(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of questions; all that lack a required field are reported together."""
    x = spark.read.option("multiLine", True).schema(schemas.QUESTION).json(path)
    required = ("id", "text", "dataset_ids", "use_kg", "expected_keywords", "category")
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in required]))
    bad = x.select(F.coalesce("id", F.lit("?")).alias("id"), missing.alias("m")).where(F.size("m") > 0).collect()  # a hand-written set
    if bad or x.isEmpty():
        raise ValueError("; ".join(f"{r.id}: {', '.join(r.m)}" for r in bad) or "no questions")
    return x


def _missing(error: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(error) or "does not exist" in str(error)


def keyed_object(spark: SparkSession, path: str, value: str, default: DataFrame | None = None) -> DataFrame:
    """A JSON object of objects as rows (key, value fields); the default, if there is one, where there is no such file.

    The file is read as one row: for states and manifests, which are small.
    """
    try:
        text = spark.read.text(path, wholetext=True)
    except Exception as error:
        if default is None or not _missing(error):
            raise
        return default
    return text.select(F.explode(F.from_json("value", f"map<string, {value}>")).alias("key", "v")).select("key", "v.*")


def two_columns(spark: SparkSession, path: str) -> DataFrame:
    """A vocabulary text of two columns: split at tabs if no fewer lines have one than have one comma; other lines are left out."""
    lines = spark.read.text(path)
    tabs, commas = F.split("value", "\t"), F.split("value", ",")
    n = lines.agg(F.count_if(F.col("value").contains("\t")).alias("t"), F.count_if(F.size(commas) == 2).alias("c")).first()
    parts = tabs if n.t >= n.c else commas
    return lines.select(parts.alias("p")).where(F.size("p") == 2).select(F.trim(F.get("p", F.lit(0))).alias("description"), F.trim(F.get("p", F.lit(1))).alias("tag"))


def files(spark: SparkSession, root: str, extensions: Sequence[str], skip: Sequence[str] = (), content: bool = False) -> DataFrame:
    """Files below root with one of the extensions, in any case, outside the folders to skip: rel, length and, if asked, content.

    The content isn't read unless it is selected. No such root gives no rows.
    """
    glob = "*.{" + ",".join("".join(f"[{c.lower()}{c.upper()}]" for c in e) for e in extensions) + "}"
    try:
        x = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    except Exception as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], "rel string, length long" + (", content binary" if content else ""))
    rel = F.regexp_replace(F.substring_index("path", root.rstrip("/"), -1), "^/", "")
    inside = F.arrays_overlap(F.split("rel", "/"), F.array(*map(F.lit, skip)).cast("array<string>"))
    return x.withColumn("rel", rel).where(~inside).select("rel", "length", *(["content"] if content else []))


def by_name(files_: DataFrame) -> DataFrame:
    """All paths of each file name, sorted."""
    return files_.groupBy(F.substring_index("rel", "/", -1).alias("name")).agg(F.array_sort(F.collect_list("rel")).alias("paths"))


def legacy_workbook(content: Column) -> Column:
    """Whether the bytes start like a compound document."""
    return F.coalesce(F.hex(F.substring(content, 1, 4)) == "D0CF11E0", F.lit(False))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of each file with their numbers."""
    x = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return x.select("path", F.posexplode(F.split("value", "\n")).alias("line", "text"))


def explode_inventory(df: DataFrame, column: str) -> DataFrame:
    """Nested lists of a document's figures or tables as rows with their place."""
    if not isinstance(df.schema[column].dataType, ArrayType):
        raise TypeError(column)
    return df.select("*", F.posexplode(column).alias("place", "item")).drop(column)

"""Fill-in-middle transformation, relationally: units of a text are rows, cuts are found by joins.

A text's matches become rows of (document, ordinal), a window sums their
lengths, and the two cuts that a document asks for are joined to the running
sums by ordinal. Only then are the three parts taken from the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstack.llm.common import partitions

#: A run of letters, or any other code point.
UNIT = "[A-Za-z]+|[^A-Za-z]"
#: Marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text in a partition, and partitions at most (beyond them they grow, and their rows are sorted on disk).
RANGE, MOST_PARTITIONS = 16_000_000, 50_000


def draws(doc_id: Column, salt: str = "1:") -> list[Column]:
    """Four numbers below 2^32 from the hash of the salt and the decimal doc_id (nothing for a null)."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substr(digest, F.lit(8 * k + 1), F.lit(8)), 16, 10).cast("long") for k in range(4)]


def count_units(text: Column) -> Column:
    """How many matches of UNIT the text has: a run of letters is one, as any other code point is."""
    return F.length(F.regexp_replace(text, "[A-Za-z]+", "a")).cast("long")


def joined(form: Column, text: Column, prefix: Column, middle: Column, suffix: Column) -> Column:
    """The parts in the order of the form, each after its mark; a plain text as it is."""
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(text)


def restored(df: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """df with `restored`, the text that its output was made from by the form. Marks can't occur in the parts."""
    second = F.when(F.col(form) == "psm", SUFFIX).otherwise(PREFIX)
    x = df.withColumn("_at", F.position(second, F.col(output)))
    x = x.withColumns({"_first": F.substr(output, F.lit(4), F.col("_at") - 4), "_rest": F.substr(output, F.col("_at") + 3)})
    x = x.withColumn("_at", F.position(F.lit(MIDDLE), F.col("_rest")))
    x = x.withColumns({"_then": F.substr("_rest", F.lit(1), F.col("_at") - 1), "_middle": F.substr("_rest", F.col("_at") + 3)})
    whole = F.when(F.col(form) == "psm", F.concat("_first", "_middle", "_then")).when(F.col(form) == "spm", F.concat("_then", "_middle", "_first")).otherwise(F.col(output))
    return x.withColumn("restored", whole).drop("_at", "_first", "_rest", "_then", "_middle")


def transform(docs: DataFrame, rate: int = 90, spm: int = 20, salt: str = "1:") -> DataFrame:
    """docs (doc_id, text) as doc_id, text, n, form, prefix, middle, suffix and output, a row for each row.

    n: units of the text. `rate` percent of the documents, by a hash of doc_id,
    are cut before two of their units, also drawn by hash; `spm` percent of those
    start with the suffix. The parts are null in plain texts: those not drawn,
    empty ones and those that hold a mark. Null texts count as empty; rows with
    a null doc_id draw by the salt alone, repeated rows have equal results, no
    rows give none. Other columns are left out.

    Texts are shuffled once, by row; units are never shuffled, and a document's
    are a sorted run of one partition, so that no text is too long for it.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = min(max(partitions(spark), -(-size // RANGE)), MOST_PARTITIONS)
    # one exchange for the three branches below: each uses all three of its columns
    base = docs.withColumn("row", F.monotonically_increasing_id()).repartition(n, "row")

    h = draws(F.col("doc_id"), salt)
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    form = F.when((F.col("text") == "") | marked | (h[2] % 100 >= rate), "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    drawn = base.select("row", "doc_id", "text", count_units(F.col("text")).alias("n")).select("*", (h[0] % (F.col("n") + 1)).alias("x"), (h[1] % (F.col("n") + 1)).alias("y"))
    # a cut after c units lies at the end of unit c - 1; one after none at 0, which no row has. The request holds both cuts
    # of a row, so that it meets the units where they are; those behind the last cut leave in the join
    # (numbers that can't be null: a filter on them would be pushed below the exchange, which would then be made twice)
    known = lambda c: F.coalesce(c - 1, F.lit(-1).cast("long"))
    cuts = drawn.select(F.col("row").alias("of"), known(F.least("x", "y")).alias("low"), known(F.greatest("x", "y")).alias("high"))
    units = base.select("row", "doc_id", F.posexplode_outer(F.regexp_extract_all("text", F.lit(UNIT), 0)).alias("ordinal", "unit")).select("row", "doc_id", "ordinal", F.length("unit").alias("size"))
    asked = units.join(cuts.hint("shuffle_hash"), (F.col("row") == F.col("of")) & (F.coalesce("ordinal", F.lit(0)) <= F.col("high"))).drop("of")
    so_far = Window.partitionBy("row", "doc_id").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    ends = asked.withColumn("end", F.sum("size").over(so_far))
    at = lambda c: F.max(F.when(F.col("ordinal") == F.col(c), F.col("end")))
    offsets = ends.groupBy("row").agg(at("low").alias("first"), at("high").alias("last"))

    cut = drawn.join(offsets.hint("shuffle_hash"), "row", "left").select("doc_id", "text", "n", form.alias("form"), F.coalesce("first", F.lit(0)).alias("first"), F.coalesce("last", F.lit(0)).alias("last"))
    when = lambda c: F.when(F.col("form") != "plain", c)
    parts = cut.select(
        "doc_id", "text", "n", "form",
        when(F.substr("text", F.lit(1), F.col("first"))).alias("prefix"), when(F.substr("text", F.col("first") + 1, F.col("last") - F.col("first"))).alias("middle"), when(F.substr("text", F.col("last") + 1)).alias("suffix"),
    )
    return parts.withColumn("output", joined(*[F.col(c) for c in ("form", "text", "prefix", "middle", "suffix")]))


def digests(made: DataFrame) -> DataFrame:
    """Counts and hashes of transform's rows; restored_sha256 is that of the text rebuilt from the output and the form."""
    counted = made.select("doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"), "output")
    return restored(counted).withColumns({"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2("restored", 256)}).drop("output", "restored")

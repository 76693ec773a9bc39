"""Quality rules with thresholds whose false rejections are controlled.

Every document gets counts of its words, symbols, repeated lines and repeated
word windows. Each rule rejects a document whose share of something exceeds a
cutoff. Cutoffs come from labelled documents: in each stratum the cutoffs of a
fixed grid are tried from the most lenient on, and one is accepted if the exact
binomial test rejects "more than `risk` of the good documents are lost" at the
level `error`, divided by the number of rules and strata (Bonferroni); the order
on the grid is fixed beforehand, so steps along it need no further correction.
Without enough labels for a proof a rule rejects nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstack.llm.common import materialize

#: Limits of the base rules.
LEAST_WORDS, MOST_REPEATED = 20, 30
#: The white space between words, and the symbols that are counted.
BLANK, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
WINDOW = 8
#: Parameters of the risk control, and the number of steps of a share on the grid of cutoffs.
RISK, ERROR, GRID = 0.01, 0.05, 200
#: Strata up to which the table of cutoffs, STRATA x rules small rows, is broadcast.
STRATA = 1000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def rules() -> dict[str, Column]:
    """The shares that the rules look at, 0 to 1."""
    share = lambda a, b: F.least(F.coalesce(F.col(a) / F.when(F.col(b) > 0, F.col(b)), F.lit(0.0)), F.lit(1.0))
    return {"symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words")}


def score(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), n_lines and base_failed.

    A null or empty text has no words, and fails. Repeated rows get equal
    counts. Columns of docs that have one of these names are replaced. All is
    a narrow map in the JVM: windows are compared by 64-bit hashes in one row.
    The result is written, with or without the text, and read again; else the
    optimizer would put the counts' expressions into every use of them.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.drop(*COUNTS, "n_lines", "base_failed", "_hashes", "_windows", "_sorted")
    d = d.withColumn("_lines", lines).withColumns(
        {
            "_hashes": F.transform(words, lambda w: F.xxhash64(w)),
            "word_chars": F.length(F.translate(text, BLANK, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        }
    )
    d = d.withColumns({"n_words": F.size("_hashes").cast("long"), "n_lines": F.size("_lines").cast("long")})
    d = d.withColumn("n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("_lines"))).drop("_lines")
    last = F.col("n_words").cast("int") - WINDOW + 1
    window = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(*[F.element_at("_hashes", i + k) for k in range(WINDOW)]))
    d = d.withColumn("_windows", F.when(last >= 1, window)).drop("_hashes")
    # only texts with a repeated window are looked at further: their windows with positions, sorted by hash
    pairs = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), pairs)).drop("_windows")
    n = F.size("_sorted")
    same = lambda x, j, k: F.coalesce(F.get("_sorted", j + k)["h"] == x["h"], F.lit(False))
    starts = F.array_sort(F.transform(F.filter("_sorted", lambda x, j: same(x, j, -1) | same(x, j, 1)), lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda acc, i: F.struct((i + WINDOW).alias("upto"), (acc["n"] + i + WINDOW - F.greatest(i, acc["upto"])).alias("n")),
        lambda acc: acc["n"],
    )
    d = d.withColumn("n_repeat_words", F.when(n > 0, covered).otherwise(0).cast("long")).drop("_sorted")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    d = d.withColumn("base_failed", failed)
    return materialize(d if keep_text else d.drop("text"), "scores")


def log_gamma(x: Column) -> Column:
    """log of the gamma function for x >= 1, by Stirling's series from x + 10 on."""
    product = F.log(x)
    for i in range(1, 10):
        product = product + F.log(x + i)
    y = x + 10
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - product


def log_tail(n: Column, k: Column, risk: float) -> Column:
    """log P(X <= k) for X binomial (n, risk) and k below n * risk.

    The terms are summed from k downwards as far as they matter, ten times the
    square root of k: 32,000 of them for ten million.
    """
    odds = (1 - risk) / risk
    top = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * math.log(risk) + (n - k) * math.log1p(-risk)
    steps = F.least(k, 40 + F.ceil(10 * F.sqrt(k)).cast("double"))
    parts = F.when(steps >= 1, F.sequence(F.lit(0), steps.cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    added = F.aggregate(
        parts.cast("array<double>"),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda acc, j: _add(acc, acc["term"] * odds * (k - j) / (n - k + j + 1)),
        lambda acc: top + F.log(acc["sum"]),
    )
    return F.when(k >= n, F.lit(0.0)).otherwise(added)


def _add(acc: Column, term: Column) -> Column:
    return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))


def stratum() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit(""))


def cutoffs(scored: DataFrame, labels: DataFrame, *, risk: float = RISK, error: float = ERROR, grid: int = GRID) -> DataFrame:
    """(stratum, one column per rule): the cutoff in grid steps, null where none is proven.

    labels: doc_id and quality (1 good). A document with several labels is good
    if all say so. Labelled documents are counted by stratum, rule and grid
    step before anything is gathered: at most `grid` + 1 rows each.
    """
    good = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    shares = rules()
    held = scored.where(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    steps = F.array(*[F.struct(F.lit(r).alias("rule"), F.ceil(c * grid).cast("int").alias("step")) for r, c in shares.items()])
    counts = held.select(stratum().alias("stratum"), F.explode(steps).alias("x")).groupBy("stratum", "x.rule", "x.step").agg(F.count("*").alias("n"))
    # every step of the grid is a cutoff: steps above it are rejected, the most lenient comes first
    over = counts.groupBy("stratum", "rule").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("step", "n"))).alias("by"))
    tested = over.select("stratum", "rule", "n", F.explode(F.sequence(F.lit(0), F.lit(grid))).alias("cut"), "by")
    lost = F.aggregate(F.map_entries("by"), F.lit(0).cast("long"), lambda acc, e: acc + F.when(e["key"] > F.col("cut"), e["value"]).otherwise(0))
    tested = tested.select("stratum", "rule", "n", "cut", lost.alias("k"))
    strata = tested.agg(F.count_distinct("stratum")).first()[0]
    level = math.log(error / max(1, strata * len(shares)))
    # the tail grows with k, so only numbers near risk * n need the sum
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    proven = F.when(k < n * risk, log_tail(n, k, risk) <= level).otherwise(F.lit(False))
    walk = Window.partitionBy("stratum", "rule").orderBy(F.desc("cut"))
    passed = tested.withColumn("ok", F.min(proven).over(walk.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    best = passed.where("ok").groupBy("stratum", "rule").agg(F.min("cut").alias("cut"))
    return best.groupBy("stratum").pivot("rule", list(shares)).agg(F.first("cut")), strata


def judge(scored: DataFrame, fitted: tuple[DataFrame, int], grid: int = GRID) -> DataFrame:
    """scored with `kept`: false if the base rules fail, or a share is above its proven cutoff."""
    table, strata = fitted
    shares = rules()
    names = {r: f"_cut_{r}" for r in shares}
    table = table.select(F.col("stratum").alias("_stratum"), *[F.col(r).alias(c) for r, c in names.items()])
    table = F.broadcast(table) if strata <= STRATA else table
    rejected = F.lit(False)
    for r, share in shares.items():
        rejected = rejected | F.coalesce(F.ceil(share * grid) > F.col(names[r]), F.lit(False))
    joined = scored.join(table, stratum() == F.col("_stratum"), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("_stratum", *names.values())

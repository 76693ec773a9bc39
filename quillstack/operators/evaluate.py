"""Scoring of ranked retrieval and of answers, as grouped aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstack.functions.text import match_form


def found(anchors: Column, text: Column) -> Column:
    """The anchors that the text contains, both in matching form; empty anchors are never found."""
    return F.filter(anchors, lambda a: (F.coalesce(a, F.lit("")) != "") & F.contains(match_form(text), match_form(a)))


def keywords_found(anchors: Column, text: Column) -> Column:
    """As they are, without normalising."""
    return F.filter(anchors, lambda a: (a != "") & text.contains(a))


def hits(cases: DataFrame, ranked: DataFrame, depth: int = 10) -> DataFrame:
    """A row per case: which anchors the first `depth` texts contain, and the first rank with any.

    cases: case_id, numbers, keywords, min_keywords. ranked: case_id, rank, text.
    """
    x = cases.join(ranked.where(F.col("rank") <= depth), "case_id", "left")
    x = x.select("case_id", "rank", found(F.col("numbers"), F.col("text")).alias("n"), found(F.col("keywords"), F.col("text")).alias("k"))
    any_ = (F.size("n") > 0) | (F.size("k") > 0)
    return x.groupBy("case_id").agg(
        F.min(F.when(any_, F.col("rank"))).alias("first_rank"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("n", F.array().cast("array<string>")))))).alias("numbers_found"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("k", F.array().cast("array<string>")))))).alias("keywords_found"),
    )


def decide_pass(numeric: Column, hit: Column, keywords: Column, least: Column) -> Column:
    """An anchor was found, and enough keywords if any are asked for."""
    return (numeric | hit) & ((F.coalesce(least, F.lit(0)) == 0) | (keywords >= least))


def score_retrieval(cases: DataFrame, ranked: DataFrame) -> DataFrame:
    """hit5, hit10, mrr_rank (0 without a hit), numeric_exact, kw_hits, kw_needed and passed per case."""
    x = cases.join(hits(cases, ranked), "case_id")
    rank = F.coalesce("first_rank", F.lit(0))
    needed = F.when(F.size("keywords") > 0, F.coalesce("min_keywords", F.lit(1))).otherwise(0)
    x = x.select(
        "case_id", ((rank > 0) & (rank <= 5)).alias("hit5"), (rank > 0).alias("hit10"), rank.alias("mrr_rank"),
        ((F.size("numbers") > 0) & (F.size("numbers_found") > 0)).alias("numeric_exact"), F.size("keywords_found").alias("kw_hits"), needed.alias("kw_needed"),
    )
    return x.withColumn("passed", decide_pass(F.col("numeric_exact"), F.col("hit10"), F.col("kw_hits"), F.col("kw_needed")))


def mrr(ranks: Column) -> Column:
    """Mean reciprocal rank; rank 0 counts as 0, no rows as 0."""
    return F.coalesce(F.sum(F.when(ranks > 0, 1.0 / ranks).otherwise(0.0)) / F.count(F.lit(1)), F.lit(0.0))


def majority(runs: DataFrame, keys: list[str], passed: Column, least: int = 2) -> DataFrame:
    """Per case: passes of its repeats, whether they are a majority, and whether any passed."""
    return runs.groupBy(*keys).agg(F.count("*").alias("runs"), F.count_if(passed).alias("passes"), (F.count_if(passed) >= least).alias("majority"), F.bool_or(passed).alias("any_run"))


def grade(answer: Column, must: Column, must_any: Column, forbid: Column) -> Column:
    """forbidden, then missing, then none_of, else pass."""
    has = lambda w: answer.contains(w)
    return F.when(F.exists(forbid, has), "forbidden").when(~F.forall(must, has), "missing").when((F.size(must_any) > 0) & ~F.exists(must_any, has), "none_of").otherwise("pass")


def grade_share(hits: Column, total: Column, refusal: Column, refused: Column) -> Column:
    """Half of the keywords and one at least; a case that must be refused needs a refusal word and a keyword."""
    return F.when(refusal, refused & (hits >= 1)).otherwise((hits >= 1) & (hits / F.greatest(total, F.lit(1)) >= 0.5))


def keyword_scope(texts: Column, every: Column, some: Column, first: int | None = None) -> Column:
    """Whether the texts (an array; the first ones only if asked) hold all of one list of words and, if there are any, one of the other."""
    whole = F.array_join(texts if first is None else F.slice(texts, 1, first), "\n")
    has = lambda w: whole.contains(w)
    return F.forall(every, has) & ((F.size(some) == 0) | F.exists(some, has))


def response_texts(chunks: Column, total: Column) -> Column:
    """struct(texts, total) of a reply: an array of structs with content, and a total that may be missing."""
    texts = F.transform(F.coalesce(chunks, F.array().cast("array<struct<content:string>>")), lambda c: F.coalesce(c["content"], F.lit("")))
    return F.struct(texts.alias("texts"), F.coalesce(total, F.size(texts)).cast("long").alias("total"))


def chosen_cases(cases: DataFrame, category: str | None = None, first: int = 0, last: int = 2**31 - 1) -> DataFrame:
    """Cases of a category, if one is named, whose id has a number in range after its first dash."""
    number = F.get(F.split("id", "-"), F.lit(1)).try_cast("int")
    out = cases.where(number.between(first, last))
    return out if category is None else out.where(F.col("category") == category)


def summary(results: DataFrame, key: str, passed: Column) -> DataFrame:
    """One row: total, passed, the rate in whole percent and the sorted keys of those that failed. For reports, of few rows."""
    rate = F.when(F.count("*") > 0, F.round(100.0 * F.count_if(passed) / F.count("*"), 0)).otherwise(0.0)
    return results.agg(F.count("*").alias("total"), F.count_if(passed).alias("passed"), rate.cast("long").alias("percent"), F.array_sort(F.collect_list(F.when(~passed, F.col(key)))).alias("failed"))


def first_failure_gate(df: DataFrame, group: str, order: list[str], ok: Column) -> DataFrame:
    """done, failed or not_run: after a group's first failure nothing runs."""
    before = F.min(ok.cast("int")).over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("gate", F.when(F.coalesce(before, F.lit(1)) == 0, "not_run").when(ok, "done").otherwise("failed"))


def window_flip(narrow: DataFrame, wide: DataFrame, key: str) -> DataFrame:
    """Ranks of a target under two candidate windows, and whether only one of them has it."""
    x = narrow.select(key, F.col("rank").alias("narrow")).join(wide.select(key, F.col("rank").alias("wide")), key, "full_outer")
    return x.withColumn("flipped", F.col("narrow").isNull() != F.col("wide").isNull())

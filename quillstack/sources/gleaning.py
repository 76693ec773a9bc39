"""Extraction by a model in rounds: a first answer, then more of it while the model says that there is more.

Answers are kept in a table by the hash of the whole conversation. Each round
asks only for conversations that the table doesn't have, each of them once, and
goes on with the rows that want another round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.operators.components import cut
from quillstack.sources.pages import call_model

HISTORY = "array<struct<role: string, content: string>>"
CACHE = "key string, answer string"
#: Fixed value: what an answer holds if the service failed.
ERROR = "**ERROR**"


def message(role: str, content: Column) -> Column:
    return F.array(F.struct(F.lit(role).alias("role"), content.alias("content")))


def conversation_key(history: Column, model: str) -> Column:
    """The content address of a conversation with a model."""
    return F.sha2(F.concat(F.lit(model + "\n"), F.to_json(history)), 256)


def spoken(answer: Column) -> Column:
    """An answer without the thoughts before it."""
    return F.regexp_replace(answer, r"(?s)^.*</think>", "")


def read_cache(like: DataFrame, path: str) -> DataFrame:
    """The answers kept at the path; none where nothing was written yet."""
    spark = like.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(path).dropDuplicates(["key"])


def ask(df: DataFrame, call: Callable[[list[dict]], str], cache: str, model: str = "model", parallel: int | None = None) -> DataFrame:
    """df (with `history`) with `answer` and `error` of each conversation.

    `call` gets the messages and returns the answer. It is asked once for each
    conversation that the cache lacks, whatever the rows that have it; failures,
    and answers with an error mark, are tried again and then not kept. Its answers
    are written before they are used, so nothing later asks again.
    """
    asked = df.withColumn("_key", conversation_key(F.col("history"), model))
    known = read_cache(df, cache)
    new = asked.groupBy(F.col("_key").alias("key")).agg(F.first("history").alias("history")).join(known, "key", "left_anti")

    def one(row: dict) -> dict:
        answer = call([{"role": m["role"], "content": m["content"]} for m in row["history"]])
        if ERROR in answer:
            raise ValueError(answer)
        return {"answer": answer}

    said = cut(call_model(new, one, "answer string", parallel=parallel))
    said.where("error is null").select("key", spoken(F.col("answer")).alias("answer")).write.mode("append").parquet(cache)
    failed = said.where("error is not null").select("key", "error")
    return asked.join(read_cache(df, cache), F.col("_key") == F.col("key"), "left").drop("key").join(failed, F.col("_key") == F.col("key"), "left").drop("key", "_key")


def glean(
    chunks: DataFrame, call: Callable[[list[dict]], str], cache: str, more: str, whether: str, rounds: int = 2, model: str = "model", parallel: int | None = None
) -> DataFrame:
    """chunks (id, prompt) as id, result (all answers joined), gleanings and error.

    After the first answer, `more` asks for what is missing, at most `rounds`
    times; in between `whether` asks if there is more, and only a yes goes on. A
    row whose call fails stops with what it has. Null prompts count as empty.
    """
    x = chunks.select("id", message("user", F.coalesce("prompt", F.lit(""))).alias("history"))
    x = ask(x, call, cache, model, parallel).withColumns({"result": F.coalesce("answer", F.lit("")), "gleanings": F.lit(0)})
    over = []
    for k in range(rounds):
        x = cut(x)
        over.append(x.where("error is not null").select("id", "result", "gleanings", "error"))
        x = x.where("error is null").withColumn("history", F.concat("history", message("assistant", F.col("answer")), message("user", F.lit(more)))).drop("answer", "error")
        x = cut(ask(x, call, cache, model, parallel))
        got = F.coalesce("answer", F.lit(""))
        x = x.withColumns({"result": F.concat("result", got), "gleanings": F.col("gleanings") + F.col("error").isNull().cast("int")})
        if k + 1 == rounds:
            break
        over.append(x.where("error is not null").select("id", "result", "gleanings", "error"))
        x = x.where("error is null").withColumn("history", F.concat("history", message("assistant", F.col("answer")), message("user", F.lit(whether)))).drop("answer", "error")
        x = cut(ask(x, call, cache, model, parallel))
        yes = F.lower(F.regexp_replace(F.regexp_replace(F.trim("answer"), "^\"+|\"+$", ""), "^'+|'+$", "")) == "yes"
        on = F.col("error").isNull() & yes
        over.append(x.where(~F.coalesce(on, F.lit(False))).select("id", "result", "gleanings", "error"))
        x = x.where(on).withColumn("answer", F.lit("yes"))
    over.append(x.select("id", "result", "gleanings", "error"))
    out = over[0]
    for part in over[1:]:
        out = out.unionByName(part)
    return out

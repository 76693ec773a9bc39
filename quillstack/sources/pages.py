"""A paginated service as a Spark data source, and calls to models as a mapped function.

Both take the call as a function, so they run offline with a stub.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class PageRange(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, source: PagedSource):
        self.source = source

    def partitions(self) -> list[PageRange]:
        total, size, each = self.source.total(), self.source.page_size, self.source.pages_each
        pages = -(-total // size)
        return [PageRange(k, min(k + each, pages)) for k in range(0, pages, each)] or [PageRange(0, 0)]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        for page in range(partition.first, partition.last):
            rows = self.source.fetch(page, self.source.page_size)
            yield from rows
            if len(rows) < self.source.page_size:  # a short page is the last
                return


class PagedSource(DataSource):
    """Base of a paginated source: a subclass gives name(), schema(), total() and fetch(page, size) -> list of tuples."""

    page_size = 100
    pages_each = 10

    def total(self) -> int:
        raise NotImplementedError

    def fetch(self, page: int, size: int) -> list[tuple]:
        raise NotImplementedError

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self)


def read_pages(spark: SparkSession, source: type[PagedSource], **options: str) -> DataFrame:
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(**options).load()


def call_model(
    df: DataFrame, call: Callable[[dict], dict], schema: str, *, retries: int = 3, wait_s: float = 0.25, parallel: int | None = None
) -> DataFrame:
    """A row's call through an injected function; after the last retry the row has the error instead of a result.

    `schema`: the fields of the call's answer; `error string` is added. The
    number of partitions bounds the calls at once.
    """
    names = [f.strip().split()[0] for f in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                error = None
                for attempt in range(retries):
                    try:
                        found = call(row)
                        out.append({**row, **{k: found.get(k) for k in names}, "error": None})
                        break
                    except Exception as e:  # noqa: BLE001  a row's failure is its result
                        error = f"{type(e).__name__}: {e}"
                        if isinstance(e, TimeoutError) or attempt + 1 == retries:
                            out.append({**row, **dict.fromkeys(names), "error": error})
                            break
                        time.sleep(min(wait_s * 2**attempt, 5) * (1 + random.random() / 4))
            yield pd.DataFrame(out, columns=[*batch.columns, *names, "error"])

    held = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return (df.repartition(parallel) if parallel else df).mapInPandas(run, f"{held}, {schema}, error string")

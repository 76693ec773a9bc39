"""Hybrid retrieval over vectors and weighted terms; weights and windows are parameters."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from quillstack.operators.components import cut

#: Queries and rows of a block, and queries of a block that are compared with its rows at a time.
BLOCK_QUERIES, BLOCK_ROWS, CHUNK = 4096, 32_768, 64
#: Of term similarity: terms of the queries and of the rows of a block, and numbers of the sums and of the matrix of frequent terms that are in memory at once.
BLOCK_ASKED, BLOCK_TERMS, CELLS, DENSE = 2_000_000, 8_000_000, 2_000_000, 4_000_000
#: So many blocks of rows as long as each has so many terms, for the sake of several cores; one in SIZED rows is asked for its number of terms.
LEAST_BLOCKS, LEAST_TERMS, SIZED = 24, 500_000, 64
#: Weights of a row's fields in its bag of terms.
FIELD_WEIGHTS = {"content": 1.0, "title": 2.0, "keywords": 5.0, "question": 6.0}


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def cosine_topk(rows: DataFrame, queries: DataFrame, key: str, vector: str, k: int, digits: int = 6) -> DataFrame:
    """The k rows of the greatest rounded cosine for each query, itself left out; ties by key.

    Rows and queries, any number of each, are dealt to blocks, and every pair of
    blocks is a task that multiplies them as matrices, CHUNK queries at a time,
    and keeps k rows a query (more only where the rounding is in doubt). Scores
    are sums in order of the components, whatever the block. Vectors that are
    null, hold nulls or differ in length have a null score, which comes last.
    """
    query = queries.where(F.col(key).isNotNull()).select(F.col(key).alias("query"), F.col(vector).cast("array<double>").alias("_v"))
    hit = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("hit"), F.col(vector).cast("array<double>").alias("_w"))
    across, down = max(1, -(-query.count() // BLOCK_QUERIES)), max(1, -(-hit.count() // BLOCK_ROWS))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    query = query.withColumn("_i", block("query", across)).withColumn("_j", every(down))
    hit = hit.withColumn("_j", block("hit", down)).withColumn("_i", every(across))
    schema = StructType([query.schema["query"], hit.schema["hit"], StructField("score", DoubleType())])
    near = query.groupBy("_i", "_j").cogroup(hit.groupBy("_i", "_j")).applyInArrow(_nearest(k, digits), schema)
    near = near.withColumn("score", F.round("score", digits))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "hit"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k)


def _nearest(k: int, digits: int) -> Callable:
    """Of two tables of vectors, those rows that can be among a query's k of greatest rounded cosine."""

    def vectors(column):
        """Indexes and matrix of the vectors of each length that hold no null."""
        import numpy as np
        import pyarrow as pa

        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        ends, flat = column.offsets.to_numpy(), column.values
        sizes = np.diff(ends)
        holes = np.concatenate([[0], np.cumsum(flat.is_null().to_numpy(zero_copy_only=False))])
        whole = column.is_valid().to_numpy(zero_copy_only=False) & (holes[ends[1:]] == holes[ends[:-1]])
        values = flat.to_numpy(zero_copy_only=False)
        found = {}
        for n in np.unique(sizes[whole]):
            at = np.flatnonzero(whole & (sizes == n))
            found[int(n)] = at, values[ends[at][:, None] + np.arange(n)]
        return found

    def summed(terms, n):
        import numpy as np

        out = np.zeros(n)
        for t in terms:
            out += t
        return out

    def nearest(queries, rows):
        import numpy as np
        import pyarrow as pa

        asked, hits = queries["query"].to_numpy(), rows["hit"].to_numpy()
        left, right, out = vectors(queries["_v"]), vectors(rows["_w"]), []
        place = np.empty(len(hits), dtype=np.int64)
        place[np.argsort(hits, kind="stable")] = np.arange(len(hits))
        norm = lambda m: np.sqrt(summed((m[:, d] * m[:, d] for d in range(m.shape[1])), len(m)))
        # of each query: its length, and its row in the matrix of that length
        kind, at = np.full(len(asked), -1), np.zeros(len(asked), dtype=np.int64)
        for n, (i, _) in left.items():
            kind[i], at[i] = n, np.arange(len(i))
        with np.errstate(all="ignore"):
            norms = {n: (norm(left[n][1]), norm(right[n][1])) for n in left if n in right}
            for n in np.unique(kind):
                some = np.flatnonzero(kind == n)
                n = int(n) if n in norms else -1
                if n >= 0:
                    (_, q), (cols, r), (qn, rn) = left[n], right[n], norms[n]
                    unit_q, unit_r = q / qn[:, None], r / rn[:, None]
                    row_of = np.zeros(len(hits), dtype=np.int64)
                    row_of[cols] = np.arange(len(cols))
                    scored = np.zeros(len(hits), dtype=bool)
                    scored[cols] = True
                for first in range(0, len(some), CHUNK):
                    mine = some[first : first + CHUNK]
                    # null scores are below all others, NaN above, as Spark sorts them
                    s = np.full((len(mine), len(hits)), -5.0)
                    if n >= 0:
                        t = unit_q[at[mine]] @ unit_r.T
                        t[~np.isfinite(t)] = 5.0
                        if len(cols) == len(hits):
                            s = t
                        else:
                            s[:, cols] = t
                    s[asked[mine][:, None] == hits[None, :]] = -9.0
                    cut = np.partition(s, len(hits) - k, axis=1)[:, len(hits) - k] if len(hits) > k else np.full(len(mine), -5.0)
                    i, j = np.nonzero(s >= np.maximum(cut - 3 * 10.0**-digits, -5.0)[:, None])
                    exact = np.full(len(i), np.nan)
                    null = np.ones(len(i), dtype=bool)
                    if n >= 0:
                        null = ~scored[j]
                        for part in np.array_split(np.flatnonzero(~null), max(1, len(i) // 500_000)):
                            a, b = at[mine[i[part]]], row_of[j[part]]
                            exact[part] = summed((q[a, d] * r[b, d] for d in range(n)), len(part)) / (qn[a] * rn[b])
                    # the rounded score lies between low and high, which differ only where it is in doubt
                    steps = np.where(null, -1e12, np.where(np.isnan(exact), 1e12, np.clip(exact, -9e2, 9e2) * 10.0**digits))
                    low, high = np.floor(steps + 0.499), np.floor(steps + 0.501)
                    order = np.lexsort((place[j], -low, i))
                    turn = np.arange(len(i)) - np.searchsorted(i[order], i[order])
                    floor = np.full(len(mine), -np.inf)
                    at_k = order[turn == k - 1]
                    floor[i[at_k]] = low[at_k]
                    top = high[order]
                    keep = order[(turn < k) | (top > floor[i[order]]) | ((top > low[order]) & (top == floor[i[order]]))]
                    out.append((mine[i[keep]], j[keep], exact[keep], null[keep]))
        i, j, score, null = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0, bool))
        return pa.table({"query": queries["query"].take(pa.array(i)), "hit": rows["hit"].take(pa.array(j)), "score": pa.array(score, pa.float64(), mask=null)})

    return nearest


def term_bags(df: DataFrame, key: str, fields: Mapping[str, Column], weights: Mapping[str, float] = FIELD_WEIGHTS) -> DataFrame:
    """(key, term, weight): terms of each field, weighted by the field and summed."""
    weighted = [F.transform(F.filter(F.split(F.lower(c), r"\W+"), lambda t: t != ""), _pairer(weights[name])) for name, c in fields.items()]
    return df.select(key, F.explode(F.concat(*weighted)).alias("t")).groupBy(key, "t.term").agg(F.sum("t.weight").alias("weight"))


def _pairer(weight: float):
    return lambda t: F.struct(t.alias("term"), F.lit(weight).alias("weight"))


def term_similarity(bags: DataFrame, queries: DataFrame, key: str) -> DataFrame:
    """(query, hit, tksim): the share of a query's term weight that a row has. Joined on terms."""
    total = queries.groupBy("query").agg(F.sum("weight").alias("total"))
    common = queries.select("query", "term", F.col("weight").alias("w")).join(bags.select(key, "term"), "term")
    return common.groupBy("query", key).agg(F.sum("w").alias("w")).join(total, "query").select("query", F.col(key).alias("hit"), (F.col("w") / F.col("total")).alias("tksim"))


def best_by_terms(bags: DataFrame, queries: DataFrame, key: str, k: int, seeds: int | None = None) -> DataFrame:
    """(query, hit, tksim, rank): the k rows of greatest term similarity for each query, ties by key; the same as ranking all of term_similarity.

    bags: key, term or, which takes less to move, key, terms (array); queries:
    query, term, weight (positive); terms distinct in each query. Rows without
    a key and those that share no term with a query aren't found. Equal queries are
    answered once. Queries and rows, any number of each, are dealt to blocks, and every
    pair of blocks is a task that sums the weights in its memory. Pairs that share a
    term are never rows: a block returns a query's k best, with more of those that
    equal the last one while all blocks together have less than `seeds` (4 k if not given).
    """
    seeds = 4 * k if seeds is None else seeds
    terms = F.col("terms") if "terms" in bags.columns else F.array("term")
    rows = bags.where(F.col(key).isNotNull()).select(F.col(key).alias("hit"), terms.alias("terms"))
    each = queries.select("query", "term", F.col("weight").cast("double").alias("w"))
    alike = each.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("term", "w"))).alias("bag")).groupBy("bag").agg(F.min("query").alias("one"), F.collect_list("query").alias("queries"))
    alike = cut(alike)
    asked = alike.select(F.col("one").alias("query"), F.col("bag.term").alias("terms"), F.col("bag.w").alias("ws"), F.aggregate("bag", F.lit(0.0), lambda acc, t: acc + t["w"]).alias("total"))
    # only the number of blocks depends on the sizes of some rows
    some = F.pmod(F.xxhash64("hit"), F.lit(SIZED)) == 0
    wide = SIZED * (rows.agg(F.sum(F.when(some, F.size("terms")))).first()[0] or 0)
    across = max(1, -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK_ASKED))
    down = max(1, -(-wide // BLOCK_TERMS), min(LEAST_BLOCKS, wide // LEAST_TERMS))
    block = lambda c, n: F.pmod(F.xxhash64(F.lit(7), c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = asked.withColumn("_i", block("query", across)).withColumn("_j", every(down))
    rows = rows.withColumn("_j", block("hit", down)).withColumn("_i", every(across))
    schema = StructType([asked.schema["query"], rows.schema["hit"], StructField("tksim", DoubleType())])
    near = asked.groupBy("_i", "_j").cogroup(rows.groupBy("_i", "_j")).applyInArrow(_heaviest(k, max(k, seeds // down)), schema)
    by = Window.partitionBy("query").orderBy(F.desc(F.round("tksim", 12)))
    hopeful = cut(near.withColumn("place", F.rank().over(by)).where(F.col("place") <= k).drop("place"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc(F.round("tksim", 12)), "hit"))
    best = hopeful.withColumn("rank", rank).where(F.col("rank") <= k).withColumnRenamed("query", "one")
    return best.join(alike.select("one", F.explode("queries").alias("query")), "one").select("query", "hit", "tksim", "rank")


def _heaviest(k: int, most: int) -> Callable:
    """Of a table of queries and one of rows, the rows that can be among a query's k of greatest rounded term similarity."""

    def flat(column):
        """Of each chunk of lists: the row of each element, and the elements."""
        import numpy as np

        first = 0
        for chunk in column.chunks:
            yield np.repeat(np.arange(first, first + len(chunk)), chunk.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)), chunk.flatten()
            first += len(chunk)

    def heaviest(queries, rows):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        none = pa.table({"query": queries["query"].slice(0, 0), "hit": rows["hit"].slice(0, 0), "tksim": pa.array([], pa.float64())})
        if not queries.num_rows or not rows.num_rows:
            return none
        asking, asked = (np.concatenate(x) for x in zip(*((i, t.to_numpy(zero_copy_only=False)) for i, t in flat(queries["terms"])), strict=True))
        known = pc.drop_null(pc.unique(pa.chunked_array([t for _, t in flat(queries["terms"])])))
        weights = np.concatenate([w.to_numpy(zero_copy_only=False) for _, w in flat(queries["ws"])])
        place = lambda t: pc.index_in(t, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
        asked = np.concatenate([place(t) for _, t in flat(queries["terms"])])
        total = queries["total"].to_numpy()
        # rows by key; of repeated keys the terms are taken together
        hits = rows["hit"].to_numpy()
        _, at, row = np.unique(hits, return_index=True, return_inverse=True)
        n = len(at)
        pairs = []
        for i, t in flat(rows["terms"]):
            t = place(t)
            pairs.append((t.astype(np.int64) * n + row[i])[t >= 0])
        pairs = np.unique(np.concatenate(pairs))
        held = (pairs % n).astype(np.int32)
        ends = np.searchsorted(pairs, np.arange(len(known) + 1) * n)
        del pairs
        df = np.diff(ends)
        use = (asked >= 0) & (df[asked] > 0)
        asking, asked, weights = asking[use], asked[use], weights[use]
        if not len(asked):
            return none
        # sums of whole numbers are exact in single precision
        kind = np.float32 if (weights == np.floor(weights)).all() and total.max() < 2**24 else np.float64
        weights = weights.astype(kind)
        # terms of many queries and rows are summed by a product of matrices
        gain = np.bincount(asked, minlength=len(known)) / len(total) * (df + 300.0)
        dense = np.argsort(-gain)[: max(1, DENSE // n)]
        dense = dense[gain[dense] > n / 10]
        column = np.full(len(known), -1)
        column[dense] = np.arange(len(dense))
        matrix = np.zeros((len(dense), n), dtype=kind)
        for j, t in enumerate(dense):
            matrix[j, held[ends[t] : ends[t + 1]]] = 1
        column = column[asked]
        starts = np.searchsorted(asking, np.arange(len(total) + 1))
        out, step = [], max(1, min(CHUNK, CELLS // n))
        for first in range(0, len(total), step):
            count = min(step, len(total) - first)
            mine = slice(starts[first], starts[first + count])
            left, often = np.zeros((count, len(dense)), dtype=kind), column[mine] >= 0
            left[asking[mine][often] - first, column[mine][often]] = weights[mine][often]
            s = left @ matrix
            for q, t, w in zip((asking[mine][~often] - first).tolist(), asked[mine][~often].tolist(), weights[mine][~often], strict=True):
                s[q, held[ends[t] : ends[t + 1]]] += w
            # k of the greatest of some parts of the rows reach what is cut, so the k best rows do
            parts = n // 16 if n > 64 * k else 0
            top = s[:, : parts * 16].reshape(count, 16, parts).max(axis=1) if parts else s
            least = np.partition(top, top.shape[1] - k, axis=1)[:, top.shape[1] - k] if top.shape[1] >= k else np.zeros(count)
            least = np.maximum(least - 4e-12 * total[first : first + count], 1e-300).astype(kind)
            i, j = np.nonzero((s >= least[:, None]) & (s > 0))
            exact = s[i, j].astype(np.float64) / total[first + i]
            # the rounded score lies between low and high, which differ only where it is in doubt
            low, high = np.floor(exact * 1e12 + 0.499), np.floor(exact * 1e12 + 0.501)
            order = np.lexsort((j, -low, i))
            turn = np.arange(len(i)) - np.searchsorted(i[order], i[order])
            floor = np.full(count, -np.inf)
            at_k = order[turn == k - 1]
            floor[i[at_k]] = low[at_k]
            bottom, up = floor[i[order]], high[order]
            keep = order[((turn < most) & (low[order] >= bottom)) | (up > bottom) & (turn >= most) & (up > low[order]) | ((up > low[order]) & (up == bottom))]
            out.append((first + i[keep], at[j[keep]], exact[keep]))
        i, j, score = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"query": queries["query"].take(pa.array(i)), "hit": rows["hit"].take(pa.array(j)), "tksim": pa.array(score, pa.float64())})

    return heaviest


def pre_score(tksim: Column, vtsim: Column, text_weight: float = 0.001, vector_weight: float = 1.0) -> Column:
    """The score by which the candidate pool is cut: text_weight * term similarity + vector_weight * vector similarity."""
    return text_weight * tksim + vector_weight * vtsim


def hybrid(tksim: Column, vtsim: Column, vector_weight: float, rank_feature: Column) -> Column:
    """(1 - w) * term similarity + w * vector similarity + rank feature."""
    return (1 - vector_weight) * tksim + vector_weight * vtsim + rank_feature


def tag_feature(query_tags: Column, row_tags: Column, scale: float = 10.0) -> Column:
    """Cosine of two sparse tag maps, scaled; 0 where either is empty."""
    keys = F.array_intersect(F.map_keys(query_tags), F.map_keys(row_tags))
    product = F.aggregate(keys, F.lit(0.0), lambda acc, k: acc + F.element_at(query_tags, k).cast("double") * F.element_at(row_tags, k).cast("double"))
    norm = lambda m: F.sqrt(F.aggregate(F.map_values(m), F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))
    return F.coalesce(scale * product / F.when(norm(query_tags) * norm(row_tags) > 0, norm(query_tags) * norm(row_tags)), F.lit(0.0))


def rerank(scored: DataFrame, pool: int, pre: str, final: Column, k: int) -> DataFrame:
    """The `pool` best rows by pre-score, ranked anew by the final score, k of them; ties by hit."""
    by = Window.partitionBy("query")
    cut = scored.withColumn("pre_rank", F.row_number().over(by.orderBy(F.desc(pre), "hit"))).where(F.col("pre_rank") <= pool)
    cut = cut.withColumn("score", final)
    return cut.withColumn("rank", F.row_number().over(by.orderBy(F.desc("score"), "hit"))).where(F.col("rank") <= k)

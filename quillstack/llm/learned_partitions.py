"""Approximate nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into parts of equal size with few
edges between them (recursive bisection along a spectral vector, then swaps).
A small network learns two answers for any vector: the part that it belongs to,
and how its neighbours are spread over the parts. Every row is filed under its
most probable part; a query visits its most probable ones, and what lies there
is scored exactly.

The number of parts visited is the least that reaches the wanted recall on
sampled vectors that neither the graph nor the network has seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstack.llm.common import materialize

#: Vectors at most that the index is fitted on; one in HELD of them is kept back to measure recall.
SAMPLE, HELD = 8_192, 10
#: Rows that a part is meant to hold, and parts at most.
PART_ROWS, MOST_PARTS = 1_000, 64
#: Neighbours of a node in the graph; width of the network's hidden layer; rounds over the sample.
DEGREE, HIDDEN, ROUNDS = 16, 128, 25
#: Rows, or queries, in a block. A pair of blocks is scored at once.
BLOCK = 2_048
#: Recall that is asked for on vectors held back, above the 0.9 that is promised on all rows.
RECALL = 0.95


def nearest(rows: np.ndarray, others: np.ndarray, k: int, itself: bool = False) -> np.ndarray:
    """Places in `others` of the k greatest inner products of each row; `itself`: rows are the others, and none is its own neighbour."""
    k = min(k, len(others) - itself)
    out = np.empty((len(rows), max(k, 0)), np.int64)
    for a in range(0, len(rows) if k > 0 else 0, 1024):
        score = rows[a : a + 1024] @ others.T
        if itself:
            score[np.arange(len(score)), a + np.arange(len(score))] = -np.inf
        out[a : a + 1024] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


def bisect(n: int, a: np.ndarray, b: np.ndarray, share: float, rng: np.random.Generator) -> np.ndarray:
    """True for the `share` of n nodes on one side of a cut with few of the edges (a, b), each given in both directions."""
    size = int(round(n * share))
    degree = np.maximum(np.bincount(a, minlength=n), 1).astype(float)
    root = np.sqrt(degree)
    x = rng.standard_normal(n)
    for _ in range(40):  # towards the second eigenvector of the normalised graph
        x -= root * (x @ root) / degree.sum()
        x = 0.5 * x + 0.5 * np.bincount(a, (x / root)[b], n) / root
        x /= max(np.linalg.norm(x), 1e-300)
    side = np.zeros(n, bool)
    side[np.argsort(x / root, kind="stable")[:size]] = True
    for _ in range(12):  # swap the nodes that gain most by it, fewer each time
        across = np.bincount(a, side[a] != side[b], n)
        gain = 2 * across - np.bincount(a, minlength=n)
        left, right = np.flatnonzero(side), np.flatnonzero(~side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right))
        good = np.flatnonzero(gain[left[:m]] + gain[right[:m]] <= 0)
        m = (int(good[0]) if len(good) else m) // 2
        if not m:
            break
        trial = side.copy()
        trial[left[:m]], trial[right[:m]] = False, True
        if np.count_nonzero(trial[a] != trial[b]) >= np.count_nonzero(side[a] != side[b]):
            break
        side = trial
    return side


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """The part of each node of a neighbour graph (row: a node's neighbours); sizes differ by a few nodes."""
    rng = np.random.default_rng(seed)
    n = len(graph)
    a = np.repeat(np.arange(n), graph.shape[1])
    b = graph.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    out = np.zeros(n, np.int64)
    todo = [(np.arange(n), 0, parts)]
    place = np.full(n, -1)
    while todo:
        nodes, first, m = todo.pop()
        out[nodes] = first
        if m < 2 or len(nodes) < 2:
            continue
        place[nodes] = np.arange(len(nodes))
        inside = (place[a] >= 0) & (place[b] >= 0)
        side = bisect(len(nodes), place[a[inside]], place[b[inside]], (m // 2) / m, rng)
        place[nodes] = -1
        todo += [(nodes[side], first, m // 2), (nodes[~side], first + m // 2, m - m // 2)]
    return out


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


@dataclass
class Index:
    """weights: the network's; parts: their number; probes: parts that a query visits; scale: of the vectors."""

    weights: list[np.ndarray]
    parts: int
    probes: int
    scale: float

    def features(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x / self.scale, np.linalg.norm(x / self.scale, axis=1, keepdims=True)], 1)

    def _hidden(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(self.features(x) @ self.weights[0] + self.weights[1], 0)

    def home(self, x: np.ndarray) -> np.ndarray:
        """The part that each vector is filed under."""
        return np.argmax(self._hidden(x) @ self.weights[2] + self.weights[3], 1) if self.parts > 1 else np.zeros(len(x), np.int64)

    def route(self, x: np.ndarray) -> np.ndarray:
        """All parts for each vector, the one where most neighbours are expected first."""
        if self.parts == 1:
            return np.zeros((len(x), 1), np.int64)
        return np.argsort(-(self._hidden(x) @ self.weights[4] + self.weights[5]), axis=1, kind="stable")


def train(index: Index, x: np.ndarray, own: np.ndarray, spread: np.ndarray, seed: int = 7) -> None:
    """Fits the network's two answers, `own` and `spread` (a distribution over parts a row), by Adam."""
    rng = np.random.default_rng(seed)
    f = index.features(x)
    m, d = index.parts, f.shape[1]
    w = [rng.standard_normal((d, HIDDEN)) * np.sqrt(2 / d), np.zeros(HIDDEN), rng.standard_normal((HIDDEN, m)) * np.sqrt(1 / HIDDEN), np.zeros(m), rng.standard_normal((HIDDEN, m)) * np.sqrt(1 / HIDDEN), np.zeros(m)]
    index.weights = w
    one, two = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    step, batch = 0, 256
    for turn in range(ROUNDS):
        rate = 0.003 * (1 - turn / ROUNDS) + 0.0002
        for rows in np.array_split(rng.permutation(len(f)), max(len(f) // batch, 1)):
            step += 1
            h = np.maximum(f[rows] @ w[0] + w[1], 0)
            p, q = softmax(h @ w[2] + w[3]), softmax(h @ w[4] + w[5])
            p[np.arange(len(rows)), own[rows]] -= 1
            q -= spread[rows]
            p, q = p / len(rows), q / len(rows)
            back = (p @ w[2].T + q @ w[4].T) * (h > 0)
            for k, g in enumerate((f[rows].T @ back, back.sum(0), h.T @ p, p.sum(0), h.T @ q, q.sum(0))):
                g = g + 1e-5 * w[k]
                one[k] += 0.1 * (g - one[k])
                two[k] += 0.001 * (g * g - two[k])
                w[k] -= rate * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.999**step)) + 1e-8)


def fit(sample: np.ndarray, rows: int, k: int, recall: float = RECALL) -> Index:
    """An index for `rows` rows from a bounded sample of their vectors (an array of doubles, a row a vector)."""
    scale = float(np.sqrt((sample**2).sum(1).mean())) if len(sample) else 1.0
    parts = int(np.clip(min(rows // PART_ROWS, len(sample) // 64), 1, MOST_PARTS))
    if parts == 1:
        return Index([], 1, 1, scale)
    held, seen = sample[::HELD], np.delete(sample, np.s_[::HELD], 0)
    graph = nearest(seen, seen, DEGREE, itself=True)
    own = balanced_parts(graph, parts)
    spread = np.zeros((len(seen), parts))
    np.add.at(spread, (np.repeat(np.arange(len(seen)), graph.shape[1]), own[graph.ravel()]), 1 / graph.shape[1])
    index = Index([], parts, parts, scale)
    train(index, seen, own, spread)
    home, wanted = index.home(seen), nearest(held, seen, k)
    # at which visit each neighbour is met
    visit = np.argsort(index.route(held), axis=1)[np.arange(len(held))[:, None], home[wanted]]
    reached = np.cumsum(np.bincount(visit.ravel(), minlength=parts)) / visit.size
    index.probes = min(int(np.searchsorted(reached, recall)) + 1, parts)
    return index


def floors(queries: np.ndarray, parts: np.ndarray, sample: np.ndarray, home: np.ndarray, k: int) -> np.ndarray:
    """For each query a score that at least k sampled rows of the parts it visits reach: no worse row is among its k best.

    parts: a row of parts for each query; home: the parts of the sampled rows.
    """
    out = np.full(len(queries), -np.inf)
    for a in range(0, len(queries) if len(sample) >= k else 0, 512):
        visited = np.zeros((len(parts[a : a + 512]), int(home.max()) + 1), bool)
        inside = parts[a : a + 512] <= home.max()
        visited[np.nonzero(inside)[0], parts[a : a + 512][inside]] = True
        score = np.where(visited[:, home], queries[a : a + 512] @ sample.T, -np.inf)
        out[a : a + 512] = -np.partition(-score, k - 1, axis=1)[:, k - 1]
    return out


def best(queries: np.ndarray, floor: np.ndarray, rows: np.ndarray, first: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query (places of rows, scores) of its k best rows that reach its floor, best first, ties by `first`, and of those equal to the last.

    Scores near the k-th are computed again in one order of summation, so that equal vectors score alike in every block.
    """
    k = min(k, len(rows))
    for a in range(0, len(queries), 512):
        part = queries[a : a + 512]
        rough = part @ rows.T
        low = np.maximum(-np.partition(-rough, k - 1, axis=1)[:, k - 1], floor[a : a + 512])
        slack = 1e-12 * (1 + np.maximum(np.abs(rough).max(1), np.abs(np.where(np.isfinite(floor[a : a + 512]), floor[a : a + 512], 0))))
        for q, r, least in zip(part, rough, low - slack, strict=True):
            at = np.flatnonzero(r >= least)
            score = (rows[at] * q).sum(1)
            turn = np.lexsort((first[at], -score))
            yield at[turn], score[turn]


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, filled up with zeros to the width."""
    out = np.zeros((len(column), width))
    for k, v in enumerate(column):
        values = v.values.to_numpy(zero_copy_only=False)
        out[k, : len(values)] = values
    return out


def _filed(index: Index, width: int):
    """Adds the part that each vector is filed under."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = index.home(matrix(batch.column(batch.schema.names.index("v")), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home, pa.int32())], names=[*batch.schema.names, "part"])

    return work


def _routed(index: Index, sample: np.ndarray, width: int, k: int):
    """Adds the parts that each query visits, and a score that k of the rows there reach."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = index.home(sample)
        for batch in batches:
            x = matrix(batch.column(batch.schema.names.index("v")), width)
            parts = index.route(x)[:, : index.probes]
            floor = floors(x, parts, sample, home, k)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts.tolist(), pa.list_(pa.int32())), pa.array(floor, pa.float64())], names=[*batch.schema.names, "parts", "floor"])

    return work


def _scored(width: int, k: int):
    def work(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if rows.num_rows and queries.num_rows:
            ids = rows.column("ids").to_pylist()
            first = np.array([x[0] for x in ids])
            for q, (at, score) in zip(queries.column("query_id").to_pylist(), best(matrix(queries.column("v"), width), queries.column("floor").to_numpy(), matrix(rows.column("v"), width), first, k + 1), strict=True):
                here = sorted((-s, i) for r, s in zip(at.tolist(), score.tolist(), strict=True) for i in ids[r] if i != q)[:k]
                out[0] += [q] * len(here)
                out[1] += [i for _, i in here]
                out[2] += [-s for s, _ in here]
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])

    return work


def taking_part(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v) of rows with an id and a vector that is neither null nor zero nor holds null or non-finite numbers.

    Of a repeated id the least vector counts. Negative zeros become zeros.
    """
    v = F.col("v")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    named = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    return named.where(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))).groupBy("vec_id").agg(F.min(F.transform("v", lambda x: x + 0)).alias("v"))


def search(rows: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", recall: float = RECALL) -> DataFrame:
    """The k rows nearest found, by inner product, of each row for which `queries` (a condition on vec_id) holds, itself left out.

    Returns query_id, rank from 1, vec_id and score, the inner product in double
    precision; ties go to the lesser vec_id. Shorter vectors are filled up with
    zeros. Rows that take no part (see taking_part) neither ask nor are found;
    one row alone, or none, gives no rows. Other columns are left out.

    The index is fitted on a sample of at most SAMPLE vectors, by a hash of the
    vector's least id; all rows are filed. Of equal vectors the k + 1 least ids
    are filed, since no more can be among k. Parts and their queries are scored
    in pairs of blocks of about BLOCK, so a crowded part is many tasks. A query
    carries the score that k + 1 sampled rows of its parts reach, and no worse row leaves a block.
    """
    spark = rows.sparkSession
    clean = materialize(taking_part(rows, key, vector), "vectors")
    turn = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    distinct = clean.withColumn("turn", turn).where(F.col("turn") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    distinct = materialize(distinct, "distinct")
    n, width = distinct.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    sample = distinct.select("v").orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(SAMPLE).toArrow()
    sampled = matrix(sample.column("v"), width)
    index = fit(sampled, n, k, recall)

    kind = distinct.schema["v"].dataType.simpleString()
    filed = materialize(distinct.mapInArrow(_filed(index, width), f"v {kind}, ids array<long>, part int"), "filed")
    asking = clean.where(queries).select("v", F.col("vec_id").alias("query_id"))
    asking = materialize(asking.mapInArrow(_routed(index, sampled, width, k + 1), f"v {kind}, query_id long, parts array<int>, floor double"), "routed")
    # rows and queries of each part, at most MOST_PARTS numbers each, decide on its blocks
    blocks = lambda df: {r.part: -(-r.n // BLOCK) for r in df.groupBy("part").agg(F.count("*").alias("n")).collect()}
    of_rows, of_queries = blocks(filed), blocks(asking.select(F.explode("parts").alias("part")))
    pairs = spark.createDataFrame([(p, of_rows[p], of_queries[p]) for p in sorted(of_rows) if p in of_queries], "part int, of_rows int, of_queries int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = filed.join(F.broadcast(pairs), "part").withColumn("b", F.pmod(F.xxhash64("ids"), F.col("of_rows")).cast("int"))
    x = x.select("part", "b", each("of_queries").alias("q"), "v", "ids")
    y = asking.select("query_id", "v", "floor", F.explode("parts").alias("part")).join(F.broadcast(pairs), "part").withColumn("q", F.pmod(F.xxhash64("query_id"), F.col("of_queries")).cast("int"))
    y = y.select("part", each("of_rows").alias("b"), "q", "v", "query_id", "floor")
    found = x.groupBy("part", "b", "q").cogroup(y.groupBy("part", "b", "q")).applyInArrow(_scored(width, k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

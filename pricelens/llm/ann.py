"""Approximate nearest neighbours by learned partitions.

Fit, on a bounded sample (``FIT_ROWS`` vectors by a hash of the id): the sample's
neighbour graph is cut into parts of nearly equal size, first by medians along main
directions and then by moving vectors to the part most of their neighbours are in,
as far as room allows. A small network with one hidden layer learns which parts hold
a vector's neighbours. The number of parts to visit is the least that finds
``TARGET_RECALL`` of the neighbours of vectors held out from the fit.

Index and search run on all rows: every vector goes to its most probable part, every
query to its several most probable ones, and parts are reranked exactly. A part is
cut into blocks of rows and of queries, so a part that holds a third of all rows is
many groups of bounded size. Parts are visited in waves, each ``WAVE`` times as wide as
the one before: after a wave a query knows its ``k`` best so far, and later groups
return only rows that reach its last score. So what a query receives grows with the
number of waves and not with the number of parts; each wave's best are stored.

Defined cases: vectors that are NULL, zero or hold NULL or non-finite components
take no part, nor do rows without an id or of another dimension than most of the
sample. Rows that share an id count once, with the least vector in array order. Ties
go to the smaller id. Too few candidates: all are returned. Empty tables give empty
results. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.session import stage_table
from pricelens.storage import storage

FIT_ROWS = 8192
NEIGHBOURS = 20
TARGET_RECALL = 0.94
ROWS_PER_PART = 500
MAX_PARTS = 256
HIDDEN = 128
EPOCHS = 40
BLOCK_ROWS = 20_000
BLOCK_QUERIES = 4_000
#: Parts of the first wave, and the factor from wave to wave.
FIRST_WAVE, WAVE = 4, 4


@dataclass
class Router:
    """The fitted network and the number of parts a query visits."""

    layers: list[np.ndarray]
    parts: int
    visits: int
    dimension: int

    def chances(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        out = np.maximum(x @ a + b, 0) @ c + d
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)


def vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Usable vectors as ``id`` and ``v`` (doubles), one per id."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = table.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


# --- fit on the sample -------------------------------------------------------


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k largest inner products of each row with the others, in blocks."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 512):
        scores = x[a : a + 512] @ x.T
        scores[np.arange(len(scores)), np.arange(a, a + len(scores))] = -np.inf
        out[a : a + 512] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.05) -> np.ndarray:
    """Parts of nearly equal size that cut few edges; ``parts`` is a power of two."""
    part = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        halves = []
        for g in groups:
            centred = x[g] - x[g].mean(axis=0) if len(g) else x[g]
            line = np.linalg.svd(centred.T @ centred)[0][:, 0] if len(g) else np.zeros(x.shape[1])
            order = g[np.argsort(centred @ line, kind="stable")]
            halves += [order[: len(g) // 2], order[len(g) // 2 :]]
        groups = halves
    for i, g in enumerate(groups):
        part[g] = i
    room = int(np.ceil(slack * len(x) / parts))
    for _ in range(rounds):
        votes = np.zeros((len(x), parts), np.int32)
        np.add.at(votes, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        gain = votes - votes[np.arange(len(x)), part][:, None]
        size, moved = np.bincount(part, minlength=parts), 0
        for i in np.argsort(-gain.max(axis=1), kind="stable"):
            to = int(gain[i].argmax())
            if gain[i, to] <= 0:
                break
            if size[to] < room:
                size[part[i]] -= 1
                size[to] += 1
                part[i] = to
                moved += 1
        if not moved:
            break
    return part


def train_router(x: np.ndarray, wanted: np.ndarray, seed: int = 0) -> list[np.ndarray]:
    """A one-hidden-layer network from vectors to distributions over parts."""
    rng = np.random.default_rng(seed)
    d, parts = x.shape[1], wanted.shape[1]
    layers = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            rows = order[a : a + 256]
            hidden = np.maximum(x[rows] @ layers[0] + layers[1], 0)
            out = hidden @ layers[2] + layers[3]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            error = (out / out.sum(axis=1, keepdims=True) - wanted[rows]) / len(rows)
            inner = (error @ layers[2].T) * (hidden > 0)
            slopes = [x[rows].T @ inner, inner.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                layers[i] -= 0.003 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return layers


def part_shares(part: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    shares = np.zeros((len(graph), parts))
    np.add.at(shares, (np.repeat(np.arange(len(graph)), graph.shape[1]), part[graph].ravel()), 1 / graph.shape[1])
    return shares


def unit_length(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x**2).sum(axis=1, keepdims=True)), 1e-300)


def fit(rows: DataFrame, n_rows: int, fit_rows: int = FIT_ROWS, k: int = NEIGHBOURS) -> Router:
    """Partition, router and number of visits from at most ``fit_rows`` vectors."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(fit_rows).select("v").toPandas()["v"]
    dimension = int(np.bincount([len(v) for v in sample]).argmax()) if len(sample) else 1
    x = np.array([v for v in sample if len(v) == dimension], np.float64).reshape(-1, dimension)
    parts = 1 << max(1, min(MAX_PARTS, n_rows // ROWS_PER_PART) - 1).bit_length()
    kept = len(x) - len(x) // 8  # the rest tells how many parts to visit
    if kept < 8 * parts:
        zero = [np.zeros((dimension, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)]
        return Router(zero, 1, 1, dimension)
    x = x / np.sqrt((x**2).sum(axis=1).mean())
    graph = neighbour_graph(x[:kept], k)
    part = balanced_parts(x[:kept], graph, parts)
    unit = unit_length(x)  # what the router sees, here and in routed(); the graph stays on inner products
    router = Router(train_router(unit[:kept], part_shares(part, graph, parts)), parts, parts, dimension)
    home = router.chances(unit[:kept]).argmax(axis=1)
    near = np.argpartition(-(x[kept:] @ x[:kept].T), k - 1, axis=1)[:, :k]
    ranks = np.empty((len(near), parts), np.int64)
    np.put_along_axis(ranks, np.argsort(-router.chances(unit[kept:]), axis=1), np.arange(parts)[None, :], axis=1)
    seen = np.take_along_axis(ranks, home[near], axis=1)
    recall = [(seen < m).mean() for m in range(1, parts + 1)]
    router.visits = 1 + int(np.argmax(np.array(recall) >= TARGET_RECALL))
    return router


# --- index and search --------------------------------------------------------


def routed(rows: DataFrame, router: Router, visits: int) -> DataFrame:
    """``id``, ``part``, its place ``nth`` among the visited ones and the vector's bytes, a row per visited part."""

    def route(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            found = [np.array(v, np.float64) for v in batch.column("v").to_pylist()]
            good = np.array([len(v) == router.dimension for v in found], bool)
            x = np.array([v for v in found if len(v) == router.dimension]).reshape(-1, router.dimension)
            best = np.argsort(-router.chances(unit_length(x)), axis=1, kind="stable")[:, :visits]
            data = [v.tobytes() for v in x]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(ids[good], best.shape[1])),
                    pa.array(best.ravel().astype(np.int32)),
                    pa.array(np.tile(np.arange(best.shape[1], dtype=np.int32), len(best))),
                    pa.array([v for v in data for _ in range(best.shape[1])], pa.binary()),
                ],
                ["id", "part", "nth", "v"],
            )

    return rows.mapInArrow(route, "id long, part int, nth int, v binary")


def rerank(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """Exact best ``k`` rows of ``right`` for every query of ``left``, none below the query's ``floor``."""
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
    if not len(left) or not len(right):
        return empty
    q, x = (np.frombuffer(b"".join(t["v"]), np.float64).reshape(len(t), -1) for t in (left, right))
    query, ids = left["id"].to_numpy(), right["id"].to_numpy()
    floor = left["floor"].fillna(-np.inf).to_numpy()
    parts = []
    for a in range(0, len(q), 256):
        scores = q[a : a + 256] @ x.T
        scores[query[a : a + 256, None] == ids[None, :]] = -np.inf
        least = floor[a : a + 256]
        if scores.shape[1] > k:
            least = np.maximum(least, np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k])
        slack = 1e-9 * np.maximum(1, np.abs(np.where(np.isfinite(least), least, 0)))
        i, j = np.nonzero((scores >= (least - slack)[:, None]) & (scores > -np.inf))
        exact = (q[a + i] * x[j]).sum(axis=1)  # the same sum for equal vectors, wherever they stand
        reach = exact >= floor[a + i]
        i, j, exact = i[reach], j[reach], exact[reach]
        order = np.lexsort((ids[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        first = np.searchsorted(i, np.arange(len(scores)))
        keep = np.arange(len(i)) - first[i] < k
        parts.append(pd.DataFrame({"query_id": query[a + i[keep]], "vec_id": ids[j[keep]], "score": exact[keep]}))
    return pd.concat(parts) if parts else empty


def blocks_of(counts: DataFrame, size: int, name: str) -> DataFrame:
    return counts.select(F.col("part").alias(f"_{name}_part"), F.ceil(F.col("n") / size).cast("int").alias(name))


def search(table: DataFrame, is_query, k: int = NEIGHBOURS, id_col: str = "vec_id", vector_col: str = "embedding", router: Router | None = None) -> DataFrame:
    """The ``k`` nearest found for every row that ``is_query`` (a condition on ``id``) selects."""
    with storage(table.sparkSession) as own:
        rows = stage_table(vectors(table, id_col, vector_col), "vectors")
        router = router or fit(rows, rows.count(), k=k)
        index = stage_table(routed(rows, router, 1), "ann_index")
        queries = stage_table(routed(rows.filter(is_query), router, router.visits), "ann_queries")
        # a row per part, MAX_PARTS at most
        row_blocks = F.broadcast(blocks_of(index.groupBy("part").agg(F.count("*").alias("n")), BLOCK_ROWS, "n_rows"))
        found, start, width = None, 0, FIRST_WAVE
        while start < router.visits:
            wave = queries.filter(F.col("nth").between(start, start + width - 1))
            found = stage_table(_visit(wave, index, row_blocks, found, k), "ann_found")
            start, width = start + width, width * WAVE
        return own.result(found, "neighbours")


def _visit(wave: DataFrame, index: DataFrame, row_blocks: DataFrame, found: DataFrame | None, k: int) -> DataFrame:
    """The ``k`` best of ``found`` and of the parts that a wave of queries visits."""
    if found is None:
        wave = wave.withColumn("floor", F.lit(None).cast("double"))
    else:
        last = found.filter(F.col("rank") == k).select(F.col("query_id").alias("_q"), F.col("score").alias("floor"))
        wave = wave.join(last, F.col("id") == F.col("_q"), "left").drop("_q")
    query_blocks = F.broadcast(blocks_of(wave.groupBy("part").agg(F.count("*").alias("n")), BLOCK_QUERIES, "n_queries"))

    def dealt(side: DataFrame, own: str, other: str, *more: str) -> DataFrame:
        """Each row in one block of its side, and with every block of the other."""
        sized = side.join(row_blocks, F.col("part") == F.col("_n_rows_part")).join(query_blocks, F.col("part") == F.col("_n_queries_part"))
        sized = sized.withColumn(f"{own}_block", F.pmod(F.xxhash64("id"), F.col(own)).cast("int"))
        sized = sized.withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return sized.select("part", "n_rows_block", "n_queries_block", "id", "v", *more)

    keys = ["part", "n_rows_block", "n_queries_block"]
    left, right = dealt(wave, "n_queries", "n_rows", "floor"), dealt(index, "n_rows", "n_queries")
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(lambda a, b: rerank(a, b, k), "query_id long, vec_id long, score double")
    every = near if found is None else near.unionByName(found.drop("rank"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(table: DataFrame) -> DataFrame:
    """Neighbours of every vector whose id is divisible by 20."""
    return search(table, F.col("id") % 20 == 0)

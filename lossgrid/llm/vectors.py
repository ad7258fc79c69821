"""Approximate nearest neighbours over robust-pruned directed graphs, one per shard.

Distinct vectors are dealt to shards of about ``SHARD`` by a hash. In each shard a directed graph is built: a greedy beam
search from the middle proposes neighbours for every point, relaxed distance pruning keeps the nearest and drops those that
a kept neighbour is closer to by the factor ``RELAX``, and edges get their reverse, pruned again where a point has too
many. Many points are searched in step, so the work is numpy on whole arrays. A query runs a beam search on every shard;
the nearest of all shards are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lossgrid.llm.common import parallelism, written

SHARD, DEGREE, BEAM, RELAX, STEP = 5000, 24, 48, 1.2, 256
SEARCH_BEAM, QUERIES, SEED = 96, 4096, 3


def _distances(x: np.ndarray, norms: np.ndarray, points: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances of each query (row) to its own points (row of indices)."""
    return norms[points] - 2 * np.einsum("qpd,qd->qp", x[points], queries) + (queries * queries).sum(axis=1)[:, None]


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ``beam`` nearest points met and their squared distances, nearest first; -1 fills up.

    ``graph`` holds the neighbours of each point, -1 fills up. A query ends when its whole beam is expanded.
    """
    n, count = len(queries), len(x)
    norms = (x * x).sum(axis=1)
    near = np.full((n, beam), -1)
    far = np.full((n, beam), np.inf, x.dtype)
    done = np.zeros((n, beam), bool)
    seen = np.zeros((n, count), bool)
    near[:, 0], far[:, 0] = start, _distances(x, norms, np.full((n, 1), start), queries)[:, 0]
    seen[:, start] = True
    active = np.arange(n)
    while len(active):
        open_ = ~done[active] & (near[active] >= 0)
        first = open_.argmax(axis=1)
        alive = open_[np.arange(len(active)), first]
        active, first = active[alive], first[alive]
        if not len(active):
            break
        done[active, first] = True
        points = graph[near[active, first]]
        fresh = (points >= 0) & ~seen[active[:, None], np.maximum(points, 0)]
        distance = np.where(fresh, _distances(x, norms, np.maximum(points, 0), queries[active]), np.inf)
        rows, columns = np.nonzero(fresh)
        seen[active[rows], points[rows, columns]] = True
        all_near = np.concatenate([near[active], np.where(fresh, points, -1)], axis=1)
        all_far = np.concatenate([far[active], distance], axis=1)
        all_done = np.concatenate([done[active], np.zeros(points.shape, bool)], axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        at = np.arange(len(active))[:, None]
        near[active], far[active], done[active] = all_near[at, order], all_far[at, order], all_done[at, order]
    return near, far


def prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours for each point out of its candidates (-1 and the point itself do not count)."""
    p = x[points]
    c = x[np.maximum(candidates, 0)]
    dropped = (candidates < 0) | (candidates == points[:, None])
    ordered = np.sort(candidates, axis=1)
    repeat = np.zeros(candidates.shape, bool)
    order = np.argsort(candidates, axis=1, kind="stable")
    repeat[np.arange(len(points))[:, None], order[:, 1:]] = ordered[:, 1:] == ordered[:, :-1]
    dropped |= repeat
    own = ((c - p[:, None, :]) ** 2).sum(axis=2)
    norms = (c * c).sum(axis=2)
    between = norms[:, :, None] + norms[:, None, :] - 2 * np.matmul(c, c.transpose(0, 2, 1))
    kept = np.full((len(points), degree), -1)
    at = np.arange(len(points))
    for k in range(degree):
        value = np.where(dropped, np.inf, own)
        best = value.argmin(axis=1)
        good = np.isfinite(value[at, best])
        if not good.any():
            break
        kept[good, k] = candidates[at, best][good]
        dropped |= good[:, None] & (relax * relax * between[at, best] <= own)
        dropped[at, best] = True
    return kept


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relax: float = RELAX) -> tuple[np.ndarray, int]:
    """(neighbours of each point, start point) for distinct vectors."""
    n = len(x)
    rng = np.random.default_rng(SEED)
    start = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    if n <= degree + 1:
        full = np.tile(np.arange(n), (n, 1))
        return np.where(full == np.arange(n)[:, None], -1, full), start
    graph = np.full((n, degree), -1)
    some = min(8, degree)
    graph[:, :some] = rng.integers(0, n, (n, some))
    for turn in (1.0, relax):
        order = rng.permutation(n)
        for low in range(0, n, STEP):
            points = order[low : low + STEP]
            met, _ = beam_search(x, graph, start, x[points], beam)
            graph[points] = prune(x, points, np.concatenate([met, graph[points]], axis=1), degree, turn)
            targets = graph[points].ravel()
            sources = np.repeat(points, degree)[targets >= 0]
            targets = targets[targets >= 0]
            by = np.argsort(targets, kind="stable")
            unique, first, counts = np.unique(targets[by], return_index=True, return_counts=True)
            extra = np.full((len(unique), int(counts.max())), -1)
            extra[np.repeat(np.arange(len(unique)), counts), np.arange(len(by)) - np.repeat(first, counts)] = sources[by]
            for part in range(0, len(unique), STEP):
                rows = unique[part : part + STEP]
                both = np.concatenate([graph[rows], extra[part : part + STEP]], axis=1)
                both = both[:, (both >= 0).any(axis=0)]
                graph[rows] = prune(x, rows, both, degree, turn)
    return graph, start


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of rows that take part: no null id, vector or component, all finite, not all zero."""
    chosen = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").alias("vector")).where("vec_id is not null and vector is not null")
    good = "forall(vector, v -> v is not null and not isnan(v) and abs(v) < double('infinity')) and exists(vector, v -> v <> 0)"
    return chosen.where(good).distinct()


INDEX = "shard int, dims int, place int, start int, ids array<bigint>, vector array<double>, neighbours array<int>"


def index(vectors: DataFrame, k: int, shard: int = SHARD) -> DataFrame:
    """One row per distinct vector: its shard, the ``k + 1`` smallest ids that have it, and its neighbours in the graph.

    Equal vectors are one point, however many ids have them.
    """
    least = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    points = written(vectors.withColumn("n", least).where(F.col("n") <= k + 1).groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    shards = points.groupBy(F.size("vector").alias("dims")).agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    dealt = points.withColumn("dims", F.size("vector")).join(shards, "dims").select(
        "dims", "ids", F.col("vector").cast("array<double>").alias("vector"), F.expr("int(pmod(xxhash64(vector), shards))").alias("shard"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ids", key=lambda s: s.map(lambda v: v[0])).reset_index(drop=True)
        x = np.stack(rows["vector"].to_list())
        # one scale for the shard, so that products of very large components stay finite
        graph, start = build((x / max(np.abs(x).max(), 1e-300)).astype(np.float32))
        return rows.assign(place=np.arange(len(rows)), start=start, neighbours=[g[g >= 0].tolist() for g in graph])[[f.split()[0] for f in INDEX.split(", ")]]

    return _spread(dealt, "dims", "shard").groupBy("dims", "shard").applyInPandas(run, INDEX)


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Dealt by the keys over a stated number of partitions, which stays: groups are few bytes but much work."""
    return df.repartition(max(parallelism(df.sparkSession), df.sparkSession.sparkContext.defaultParallelism), *keys)


FOUND = "query_id bigint, vec_id bigint, score double"


def search(indexed: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest vectors found for each query (query_id, vector) but its own id.

    Queries go to the shards of their number of dimensions in blocks, so a task holds one shard and one block.
    """
    shards = indexed.select("dims", "shard").distinct()
    number = written(queries.withColumn("dims", F.size("vector")))
    blocks = number.groupBy("dims").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
    placed = number.join(blocks, "dims").withColumn("block", F.expr("int(pmod(xxhash64(query_id), blocks))"))
    asked = placed.join(shards, "dims").select(F.col("dims").alias("_dims"), F.col("shard").alias("_shard"), F.col("block").alias("_block"), "query_id", F.col("vector").cast("array<double>").alias("vector"))
    held = indexed.join(blocks, "dims").withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))

    def run(points: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(wanted):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        points = points.sort_values("place")
        x, q = np.stack(points["vector"].to_list()), np.stack(wanted["vector"].to_list())
        graph = np.full((len(points), DEGREE), -1)
        for i, near in enumerate(points["neighbours"]):
            graph[i, : len(near)] = near
        scale = max(np.abs(x).max(), 1e-300)
        ids, out = points["ids"].to_list(), []
        for low in range(0, len(q), STEP):
            part = q[low : low + STEP]
            met, _ = beam_search((x / scale).astype(np.float32), graph, int(points["start"].iloc[0]), (part / scale).astype(np.float32), beam)
            for query, vector, near in zip(wanted["query_id"].to_numpy()[low:], part, met):
                near = near[near >= 0]
                exact = np.sqrt(((x[near] - vector) ** 2).sum(axis=1))
                found = sorted((d, i) for d, p in zip(exact.tolist(), near) for i in ids[p] if i != query)[:k]
                out += [(query, i, d) for d, i in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    held, asked = _spread(held, "dims", "shard", "block"), _spread(asked, "_dims", "_shard", "_block")
    found = held.groupBy("dims", "shard", "block").cogroup(asked.groupBy("_dims", "_shard", "_block")).applyInPandas(run, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """Null ids and vectors that do not take part are left out; equal rows count once; a query's own id is no candidate."""
    good = written(usable(vectors))
    queries = good.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    return search(written(index(good, k)), queries, k)

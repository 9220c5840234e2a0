"""Approximate nearest neighbours over robust-pruned directed graphs, one per shard.

Distinct vectors are dealt to shards of about ``SHARD_ROWS`` by a hash.  In a shard, vectors are
inserted in batches: a greedy search from the centre proposes neighbours, relaxed distance
pruning keeps the diverse ones (a candidate goes if a kept one is ``ALPHA`` times nearer to it
than the new point is), and kept edges get a way back.  The stored graphs are searched by blocks
of queries: beam search in every shard, exact distances in double precision, best of all shards.

Equal vectors are one graph node with their ``k + 1`` least identifiers, which is all that a
query can need, so a vector that a third of all rows hold costs one node.

Vectors that are null or zero, or hold null or non-finite components, take no part; vectors of
different lengths never meet.  Equal rows count once; of several vectors under one query
identifier the least (as an array) asks.  Ties go to the smaller identifier.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.stage import staged

SHARD_ROWS = 4096
DEGREE = 24
BUILD_BEAM = 48
SEARCH_BEAM = 64
ALPHA = 1.2
QUERY_BLOCK = 512
_BATCH = 256
_GRAPH = pa.schema([("dim", pa.int32()), ("shard", pa.int64()), ("members", pa.list_(pa.list_(pa.int64()))), ("vectors", pa.binary()), ("edges", pa.binary()), ("start", pa.int32())])
_GRAPH_DDL = "dim int, shard long, members array<array<long>>, vectors binary, edges binary, start int"


def beam_search(x: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int):
    """Nearest found nodes (queries x beam, -1 pads) and squared distances, nearest first; and all
    nodes whose edges were followed, in the order of the walk."""
    n_q = len(queries)
    nodes = np.full((n_q, beam), -1, np.int64)
    dist = np.full((n_q, beam), np.inf, np.float32)
    done = np.zeros((n_q, beam), bool)
    nodes[:, 0] = start
    dist[:, 0] = ((queries - x[start]) ** 2).sum(axis=1)
    seen = np.zeros((n_q, len(x)), bool)
    seen[:, start] = True
    walked = []
    rows = np.arange(n_q)
    while True:
        open_dist = np.where(done | (nodes < 0), np.inf, dist)
        pick = open_dist.argmin(axis=1)
        live = np.flatnonzero(np.isfinite(open_dist[rows, pick]))
        if not len(live):
            return nodes, dist, walked
        at = nodes[live, pick[live]]
        done[live, pick[live]] = True
        step = np.full(n_q, -1, np.int64)
        step[live] = at
        walked.append(step)
        near = edges[at]
        fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
        seen[live[:, None], np.maximum(near, 0)] |= near >= 0
        gap = x[np.maximum(near, 0)] - queries[live][:, None, :]
        d = np.where(fresh, np.einsum("ijk,ijk->ij", gap, gap), np.inf).astype(np.float32)
        every_d = np.concatenate((dist[live], d), axis=1)
        order = np.argsort(every_d, axis=1, kind="stable")[:, :beam]
        dist[live] = np.take_along_axis(every_d, order, 1)
        nodes[live] = np.where(np.isfinite(dist[live]), np.take_along_axis(np.concatenate((nodes[live], near), axis=1), order, 1), -1)
        done[live] = np.take_along_axis(np.concatenate((done[live], np.zeros_like(fresh)), axis=1), order, 1)


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Diverse out-neighbours of each point from its candidates (-1 pads)."""
    # a candidate twice, or the point itself, is none
    candidates = np.sort(candidates, axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    candidates[candidates == points[:, None]] = -1
    there = candidates >= 0
    vectors = x[np.maximum(candidates, 0)]
    gap = vectors - x[points][:, None, :]
    to_point = np.where(there, np.einsum("ijk,ijk->ij", gap, gap), np.inf)
    out = np.full((len(points), degree), -1, np.int64)
    rows = np.arange(len(points))
    for r in range(degree):
        best = to_point.argmin(axis=1)
        ok = np.isfinite(to_point[rows, best])
        if not ok.any():
            break
        out[ok, r] = candidates[rows, best][ok]
        gap = vectors - vectors[rows, best][:, None, :]
        between = np.einsum("ijk,ijk->ij", gap, gap)
        to_point[(alpha * alpha * between <= to_point) & ok[:, None]] = np.inf
        to_point[rows, best] = np.inf
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """Edges (n x degree, -1 pads) and the start node."""
    n = len(x)
    start = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    rng = np.random.default_rng(n)
    edges = np.full((n, degree), -1, np.int64)
    if n == 1:
        return edges, start
    edges[:, : min(degree, n - 1)] = (np.arange(n)[:, None] + 1 + np.argsort(rng.random((n, max(n - 1, 1))), axis=1)[:, : min(degree, n - 1)]) % n if n <= degree + 1 else rng.integers(0, n, (n, degree))
    edges[edges == np.arange(n)[:, None]] = -1
    for relax in (1.0, alpha):
        order = rng.permutation(n)
        for at in range(0, n, _BATCH):
            points = order[at : at + _BATCH]
            nodes, _, walked = beam_search(x, edges, start, x[points], beam)
            proposed = np.concatenate((nodes, np.stack(walked, axis=1), edges[points]), axis=1)
            edges[points] = robust_prune(x, points, proposed, degree, relax)
            _ways_back(x, edges, points, degree, relax)
    return edges, start


def _ways_back(x, edges, points, degree, relax):
    """Add point -> neighbour edges the other way round; full lists are pruned again."""
    source = np.repeat(points, degree)
    target = edges[points].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    first = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1]))) if len(target) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(target)))
    if not len(first):
        return
    added = np.full((len(first), int(count.max())), -1, np.int64)
    added[np.repeat(np.arange(len(first)), count), np.arange(len(target)) - np.repeat(first, count)] = source
    for a in range(0, len(first), _BATCH):
        own = target[first[a : a + _BATCH]]
        every = np.concatenate((edges[own], added[a : a + _BATCH]), axis=1)
        held = np.sort(every, axis=1)
        distinct = (held >= 0) & np.concatenate((np.ones((len(own), 1), bool), held[:, 1:] != held[:, :-1]), axis=1)
        fits = distinct.sum(axis=1) <= degree
        if fits.any():
            kept = np.where(distinct, held, -1)[fits]
            edges[own[fits]] = -np.sort(-kept, axis=1)[:, :degree]
        if (~fits).any():
            edges[own[~fits]] = robust_prune(x, own[~fits], every[~fits], degree, relax)


# ---------------------------------------------------------------------------------- Spark


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part, once each."""
    v = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return v.filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(F.exists("embedding", bad), F.lit(True))
        & F.exists("embedding", lambda x: x != 0)
    ).dropDuplicates(["vec_id", "embedding"])


def _built(table):
    x = np.array(table["embedding"].combine_chunks().flatten().to_numpy(), np.float64).reshape(table.num_rows, -1)
    order = np.lexsort(x.T[::-1])
    x = x[order]
    edges, start = build(x.astype(np.float32))
    members = table["ids"].combine_chunks().take(pa.array(order))
    return pa.table(
        [
            table["dim"].slice(0, 1), table["shard"].slice(0, 1), pa.array([members.to_pylist()], _GRAPH.field("members").type),
            pa.array([x.tobytes()], pa.binary()), pa.array([edges.astype(np.int32).tobytes()], pa.binary()), pa.array([start], pa.int32()),
        ],
        schema=_GRAPH,
    )


def index(embeddings: DataFrame, k: int) -> DataFrame:
    """One graph per shard over the distinct vectors."""
    v = usable(embeddings)
    nth = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    nodes = v.withColumn("nth", nth).filter(F.col("nth") <= k + 1).groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = staged(nodes)
    shards = max(1, math.ceil(nodes.count() / SHARD_ROWS))
    dealt = nodes.select(
        F.size("embedding").alias("dim"), F.pmod(F.xxhash64("embedding"), F.lit(shards)).alias("shard"), "embedding", "ids"
    )
    return staged(dealt.groupBy("dim", "shard").applyInArrow(_built, _GRAPH_DDL))


def _search(k: int, beam: int):
    def run(batches):
        for batch in batches:
            out = [[], [], []]
            for row in batch.to_pylist():
                x = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
                edges = np.frombuffer(row["edges"], np.int32).reshape(len(x), -1).astype(np.int64)
                q = np.frombuffer(row["query_vectors"], np.float64).reshape(-1, row["dim"])
                ids = np.frombuffer(row["query_ids"], np.int64)
                found, _, _ = beam_search(x.astype(np.float32), edges, row["start"], q.astype(np.float32), beam)
                exact = np.sqrt(((x[np.maximum(found, 0)] - q[:, None, :]) ** 2).sum(axis=2))
                exact[found < 0] = np.inf
                for i, query in enumerate(ids.tolist()):
                    order = np.argsort(exact[i], kind="stable")
                    near = [
                        (exact[i, j], v) for j in order[: 2 * k].tolist() if found[i, j] >= 0
                        for v in row["members"][found[i, j]] if v != query
                    ]
                    for d, v in sorted(near)[:k]:
                        for column, value in zip(out, (query, v, float(d))):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"]
            )

    return run


def _query_block(table):
    table = table.sort_by("vec_id")
    x = np.array(table["embedding"].combine_chunks().flatten().to_numpy(), np.float64)
    return pa.table(
        [
            table["dim"].slice(0, 1), table["block"].slice(0, 1), pa.array([table["vec_id"].to_numpy().astype(np.int64).tobytes()], pa.binary()),
            pa.array([x.tobytes()], pa.binary()),
        ],
        names=["dim", "block", "query_ids", "query_vectors"],
    )


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = 10, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found, without itself.

    ``queries`` has vec_id and embedding; it is a stated set that meets every shard, in blocks.
    """
    graphs = index(embeddings, k)
    asking = usable(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asking = staged(asking.withColumn("dim", F.size("embedding")))
    blocks = max(1, math.ceil(asking.count() / QUERY_BLOCK))
    asked = asking.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).groupBy("dim", "block").applyInArrow(
        _query_block, "dim int, block long, query_ids binary, query_vectors binary"
    )
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    met = graphs.select("*", every_block).repartition("shard", "block").join(asked, ["dim", "block"])
    found = met.mapInArrow(_search(k, beam), "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

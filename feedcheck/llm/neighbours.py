"""Approximate nearest neighbours by a robust-pruned directed graph in each shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedcheck.llm.common import record_batches
from feedcheck.session import materialise

#: Rows of a shard; edges of a node; width of the beam; how much nearer a kept neighbour must
#: be for a candidate to be dropped; nodes that search at once; queries of a block.
SHARD_ROWS, DEGREE, BEAM, ALPHA, LOCKSTEP, QUERY_ROWS = 4096, 24, 40, 1.2, 256, 512


def _distances(points: np.ndarray, norms: np.ndarray, picked: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances of each query (row) to its picked points, up to the query's own norm."""
    return norms[picked] - 2 * np.einsum("bkd,bd->bk", points[picked], queries, optimize=True)


def beam_search(points: np.ndarray, norms: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, width: int) -> np.ndarray:
    """Greedy search for all queries in step: ids of the ``width`` nearest seen (-1 where fewer).
    ``graph`` holds -1 for no edge."""
    n, b = len(points), len(queries)
    rows = np.arange(b)
    ids = np.full((b, width), -1)
    dist = np.full((b, width), np.inf, np.float32)
    done = np.zeros((b, width), bool)
    seen = np.zeros((b, n + 1), bool)
    ids[:, 0], seen[:, entry], seen[:, n] = entry, True, True
    dist[:, 0] = _distances(points, norms, np.full((b, 1), entry), queries)[:, 0]
    while True:
        waiting = np.where(done | (ids < 0), np.inf, dist)
        nearest = waiting.argmin(axis=1)
        live = rows[np.isfinite(waiting[rows, nearest])]
        if not len(live):
            return ids
        now = ids[live, nearest[live]]
        done[live, nearest[live]] = True
        near = graph[now]
        fresh = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        d = np.where(fresh, _distances(points, norms, near, queries[live]), np.inf)
        all_ids = np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1)
        all_dist = np.concatenate([dist[live], d], axis=1)
        all_done = np.concatenate([done[live], np.zeros_like(fresh)], axis=1)
        best = np.argsort(all_dist, axis=1, kind="stable")[:, :width]
        ids[live] = np.take_along_axis(all_ids, best, 1)
        dist[live] = np.take_along_axis(all_dist, best, 1)
        done[live] = np.take_along_axis(all_done, best, 1)


def prune(points: np.ndarray, node: int, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Keep the nearest candidate, drop those that are nearer to it (by the factor alpha) than to
    the node, and go on until ``degree`` are kept."""
    candidates = np.unique(candidates[(candidates >= 0) & (candidates != node)])
    vectors = points[candidates] - points[node]
    own = np.einsum("kd,kd->k", vectors, vectors)
    order = np.argsort(own, kind="stable")
    vectors, own = vectors[order], own[order]
    between = own[:, None] + own - 2 * (vectors @ vectors.T)
    nearer = alpha**2 * between <= own
    alive = np.ones(len(order), bool)
    kept: list[int] = []
    while len(kept) < degree:
        i = int(alive.argmax()) if len(alive) else 0
        if not len(alive) or not alive[i]:
            break
        kept.append(i)
        alive &= ~nearer[i]
        alive[i] = False
    return candidates[order[kept]]


def build_graph(points: np.ndarray, degree: int = DEGREE, width: int = BEAM, alpha: float = ALPHA, seed: int = 3) -> tuple[np.ndarray, int]:
    """Edges (-1 where none) and the entry node. A node may gain half as many edges again before
    they are pruned to ``degree``. Starts from random edges; each node
    searches for itself, keeps a pruned choice of the nearest nodes that it met, and becomes their neighbour in
    turn; a first round uses a factor of 1, a second one ``alpha``."""
    n = len(points)
    rng = np.random.default_rng(seed)
    graph = np.full((n, degree + degree // 2), -1)
    if n > 1:
        few = min(degree // 2, n - 1)
        graph[:, :few] = (np.arange(n)[:, None] + rng.integers(1, n, (n, few))) % n
    norms = (points**2).sum(axis=1)
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    for factor in (1.0, alpha):
        order = rng.permutation(n)
        for i in range(0, n, LOCKSTEP):
            group = order[i : i + LOCKSTEP]
            ids = beam_search(points, norms, graph, entry, points[group], width)
            gained: dict[int, list[int]] = {}
            for node, found in zip(group.tolist(), ids):
                kept = prune(points, node, np.concatenate([found, graph[node]]), degree, factor)
                graph[node] = -1
                graph[node, : len(kept)] = kept
                for other in kept.tolist():
                    gained.setdefault(other, []).append(node)
            for other, new in gained.items():
                held = graph[other][graph[other] >= 0]
                edges = np.unique(np.concatenate([held, new]))
                if len(edges) > graph.shape[1]:
                    edges = prune(points, other, edges, degree, factor)
                graph[other] = -1
                graph[other, : len(edges)] = edges
    return graph, entry


def search(points: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, width: int) -> np.ndarray:
    norms = (points**2).sum(axis=1)
    return np.concatenate([beam_search(points, norms, graph, entry, queries[i : i + LOCKSTEP], width) for i in range(0, len(queries), LOCKSTEP)])


_SHARD = pa.schema([("shard", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("owner", pa.binary()), ("points", pa.binary()), ("graph", pa.binary()), ("entry", pa.int32())])
_SHARD_DDL = "shard long, dim int, n int, ids binary, owner binary, points binary, graph binary, entry int"
_HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array of double) of rows with an id and a vector that is finite and not zero; a
    row that is there several times counts once."""
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.filter(finite & F.exists("embedding", lambda v: v != 0)).distinct()


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: vectors and graph, written to the shared folder. Rows are dealt by a hash to
    shards of about ``shard_rows``, each of vectors of one length; equal vectors are one node."""
    rows = materialise(usable(vectors).withColumn("dim", F.size("embedding")), "vectors")
    sizes = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards"))
    dealt = rows.join(sizes, "dim").withColumn("shard", F.xxhash64("dim", F.pmod(F.xxhash64("vec_id"), F.col("shards"))))

    def build(pdf):
        import pandas as pd

        pdf = pdf.sort_values("vec_id")
        original = np.array(pdf["embedding"].tolist(), np.float64)
        points, owner = np.unique(original, axis=0, return_inverse=True)
        graph, entry = build_graph(points.astype(np.float32))
        return pd.DataFrame([(pdf["shard"].iloc[0], original.shape[1], len(points), pdf["vec_id"].to_numpy("<i8").tobytes(), owner.reshape(-1).astype("<i4").tobytes(), points.tobytes(), graph.astype("<i4").tobytes(), entry)], columns=_SHARD.names)

    return materialise(dealt.groupBy("shard").applyInPandas(build, _SHARD_DDL), "graph")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, width: int = 2 * BEAM) -> DataFrame:
    """The ``k`` rows of ``vectors`` (``vec_id``, ``embedding``) nearest to each of ``queries``, itself excluded:
    query_id, rank (from 1), vec_id, score (Euclidean distance in double precision on the
    original vectors); nearest first, ties to the smaller id.

    Every row is in the graph of one shard. Queries go to each shard in blocks, and a shard's
    ``k`` best of each query are merged. Vectors that are null, zero, or hold null or
    non-finite components take no part on either side; a query meets only vectors of its own
    length. Equal vectors are one node whose ids are all considered. A query without other
    vectors has no rows; with fewer than ``k`` it has all. Other columns are ignored.
    """
    index = build_index(vectors)
    asked = usable(queries).withColumnRenamed("vec_id", "query_id").withColumn("dim", F.size("embedding"))
    counted = materialise(asked, "queries")
    blocks = counted.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).alias("blocks"))
    blocked = counted.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")))
    blocked = blocked.groupBy("dim", "block").agg(F.collect_list(F.struct("query_id", "embedding")).alias("asked"))
    blocked = materialise(blocked, "blocks")
    # Which block meets which shard, then the queries, then the graph, so that tasks are dealt by shard.
    pairs = index.select("dim", "shard").join(blocked.select("dim", "block"), "dim")
    meet = pairs.join(blocked, ["dim", "block"]).join(index.drop("dim"), "shard").select("dim", "n", "ids", "owner", "points", "graph", "entry", "asked")

    def found(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}
                ids = np.frombuffer(r["ids"], "<i8")
                owner = np.frombuffer(r["owner"], "<i4")
                points = np.frombuffer(r["points"]).reshape(r["n"], r["dim"])
                graph = np.frombuffer(r["graph"], "<i4").reshape(r["n"], -1).astype(np.int64)
                by_node = np.argsort(owner, kind="stable")
                begin = np.searchsorted(owner[by_node], np.arange(r["n"] + 1))
                asks = np.array([a["embedding"] for a in r["asked"]])
                nodes = search(points.astype(np.float32), graph, r["entry"], asks.astype(np.float32), max(width, 2 * k))
                for a, q, near in zip(r["asked"], asks, nodes):
                    near = near[near >= 0]
                    score = np.sqrt(((points[near] - q) ** 2).sum(axis=1))
                    best = []
                    for j in np.argsort(score, kind="stable"):
                        if len(best) > k and score[j] > best[-1][0]:
                            break
                        # The ids of a node ascend, so its first k + 1 suffice (the query may be one).
                        best += [(score[j], int(x)) for x in ids[by_node[begin[near[j]] : begin[near[j] + 1]]][: k + 1] if x != a["query_id"]]
                    for s, x in sorted(best)[:k]:
                        yield a["query_id"], x, float(s)

    hits = meet.mapInArrow(lambda b: record_batches(found(b), _HITS), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

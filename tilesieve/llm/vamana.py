"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Equal vectors are one node.  Nodes are dealt to shards by hash, and each shard becomes a graph:
nodes come in batches, a greedy beam search from the node nearest the mean proposes neighbours,
and pruning keeps those that no kept one is nearer to by the factor ``ALPHA``, so that edges stay
diverse; edges back are added and pruned likewise.  Queries go to every shard in blocks and walk
its graph with a beam; what they find is measured exactly, in double precision, and merged.

The measure is the inner product.  Graphs are built in the space with one coordinate more,
sqrt(max |x|^2 - |x|^2), where the largest inner product is the smallest distance.

Vectors that are null, empty, zero or hold a null or non-finite component take no part, neither as
query nor as candidate.  Vectors of different length never meet.  Ties in score go to the smaller
id; a row that repeats an id counts once per different vector.  Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written

# Nodes per shard; edges per node; beams of building and searching; relaxation of the pruning.
SHARD, DEGREE, BEAM, SEARCH, ALPHA = 8_192, 32, 64, 128, 1.2
# Queries that a task walks a graph with in one block, and of these at a time; nodes entered at a time.
BLOCK, AT_ONCE, ENTER = 16_384, 512, 512
# Nodes that a step of the beam search opens per query.
OPEN = 4


def _distances(x: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its own list of nodes."""
    diff = x[ids] - q[:, None, :]
    return np.einsum("qcd,qcd->qc", diff, diff)


def beam_search(x: np.ndarray, edges: np.ndarray, start: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes met on the way, nearest first, with squared distances; -1 and inf where fewer."""
    n, row = len(q), np.arange(len(q))[:, None]
    ids = np.full((n, beam), -1)
    dist = np.full((n, beam), np.inf, np.float32)
    opened = np.ones((n, beam), bool)
    seen = np.zeros((n, len(x)), bool)
    stamp = np.zeros((n, len(x)), np.int16)
    ids[:, 0], opened[:, 0], seen[:, start] = start, False, True
    dist[:, 0] = _distances(x, q, ids[:, :1])[:, 0]
    while True:
        # The nearest nodes not yet opened come first; rows without any are done.
        order = np.argsort(np.where(opened, np.inf, dist), axis=1)[:, :OPEN]
        todo = ~opened[row, order]
        if not todo.any():
            return ids, dist
        opened[row, order] = True
        near = np.where(todo[:, :, None], edges[ids[row, order]], -1).reshape(n, -1)
        known = near < 0
        near[known] = 0
        # Of a node that is listed twice only the last place counts.
        place = np.broadcast_to(np.arange(near.shape[1], dtype=np.int16), near.shape)
        np.put_along_axis(stamp, np.where(known, start, near), place, axis=1)
        fresh = ~known & ~seen[row, near] & (stamp[row, near] == place)
        rows, cols = np.nonzero(fresh)
        seen[rows, near[rows, cols]] = True
        d = np.full(near.shape, np.inf, np.float32)
        diff = x[near[rows, cols]] - q[rows]
        d[rows, cols] = np.einsum("ij,ij->i", diff, diff)
        ids, dist = np.hstack([ids, np.where(fresh, near, -1)]), np.hstack([dist, d])
        opened = np.hstack([opened, ~fresh])
        best = np.argpartition(dist, beam - 1, axis=1)[:, :beam]
        best = best[row, np.argsort(dist[row, best], axis=1, kind="stable")]
        ids, dist, opened = ids[row, best], dist[row, best], opened[row, best]


def robust_prune(x: np.ndarray, nodes: np.ndarray, ids: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` diverse neighbours of each node out of its candidates (-1: none)."""
    valid = (ids >= 0) & (ids != nodes[:, None])
    ids = np.where(valid, ids, 0)
    own = np.where(valid, _distances(x, x[nodes], ids), np.inf)
    row = np.arange(len(nodes))
    vectors = x[ids]
    kept = np.full((len(nodes), degree), -1)
    for k in range(degree):
        best = own.argmin(axis=1)
        there = np.isfinite(own[row, best])
        if not there.any():
            break
        kept[there, k] = ids[row, best][there]
        diff = vectors - vectors[row, best][:, None, :]
        between = np.einsum("qcd,qcd->qc", diff, diff)
        own = np.where((alpha * alpha * between <= own) | ~there[:, None], np.inf, own)
        own[row, best] = np.inf
    return kept


def _entered(x: np.ndarray, edges: np.ndarray, degree: np.ndarray, nodes: np.ndarray, ids: np.ndarray, alpha: float) -> None:
    """Give nodes their edges and the neighbours edges back."""
    width = edges.shape[1]
    edges[nodes] = robust_prune(x, nodes, ids, width, alpha)
    degree[nodes] = (edges[nodes] >= 0).sum(axis=1)
    source, place = np.nonzero(edges[nodes] >= 0)
    target, source = edges[nodes][source, place], nodes[source]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    unique, first, count = np.unique(target, return_index=True, return_counts=True)
    for lo in range(0, len(unique), ENTER):
        t, f, c = unique[lo : lo + ENTER], first[lo : lo + ENTER], count[lo : lo + ENTER]
        more = int(c.max())
        wide = np.full((len(t), width + more), -1)
        wide[:, :width] = edges[t]
        at = np.arange(more)
        back = at[None, :] < c[:, None]
        wide[:, width:][back] = source[np.minimum(f[:, None] + at, len(source) - 1)[back]]
        # A back edge that is there already is left out.
        again = (wide[:, width:, None] == wide[:, None, :width]).any(axis=2)
        wide[:, width:][again] = -1
        number = (wide >= 0).sum(axis=1)
        full = number > width
        if full.any():
            edges[t[full]] = robust_prune(x, t[full], wide[full], width, alpha)
        if (~full).any():
            packed = np.take_along_axis(wide[~full], np.argsort(wide[~full] < 0, axis=1, kind="stable"), axis=1)
            edges[t[~full]] = packed[:, :width]


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """(edges, start): a row of neighbours (-1: none) per vector, and where searches start."""
    n = len(x)
    start = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    edges, count = np.full((n, degree), -1), np.zeros(n, int)
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    head = order[: min(n, ENTER // 2)]
    # The first nodes are each other's candidates.
    _entered(x, edges, count, head, np.tile(head, (len(head), 1)), alpha)
    at = len(head)
    while at < n:
        nodes = order[at : at + min(at, ENTER)]
        ids, _ = beam_search(x, edges, start, x[nodes], beam)
        _entered(x, edges, count, nodes, ids, alpha)
        at += len(nodes)
    return edges, start


def augmented(v: np.ndarray) -> np.ndarray:
    """The vectors with the coordinate that turns inner products into distances."""
    square = np.einsum("ij,ij->i", v, v)
    return np.hstack([v, np.sqrt(np.maximum(square.max() - square, 0))[:, None]]).astype(np.float32)


def usable(vec: Column) -> Column:
    """False for vectors that take no part."""
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) > 0) & good & F.exists(vec, lambda x: x != 0), F.lit(False))


def _arrow(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]


def _matrix(column, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(-1, dims)


def index(points: DataFrame, k: int, shard: int = SHARD, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(dims, shards, shard, node, start, v, ids, edges): every usable row, written.

    ``ids`` are the k + 1 smallest of the rows that have the vector: no list of k nearest needs more.
    """
    rows = points.filter(usable(F.col(vec)) & F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("id"), F.transform(vec, lambda x: x.cast("double") + F.lit(0.0)).alias("v")).distinct()
    # Ranks are cut in the tasks first, so a vector that very many rows have stays small.
    first = rows.withColumn("_r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("_r") <= k + 1)
    nodes = written(first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("dims", F.size("v")), "nodes")
    sizes = nodes.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"))
    # One row per vector length.
    dealt = nodes.join(F.broadcast(sizes), "dims").withColumn("shard", F.pmod(F.xxhash64("v"), F.col("shards")).cast("int"))
    id_type = points.schema[id_col].dataType.simpleString()

    def graph(group: pa.Table) -> pa.Table:
        dims = group["dims"][0].as_py()
        group = group.take(np.lexsort(_matrix(group["v"], dims).T))  # one order, whatever the tasks' was
        edges, start = build(augmented(_matrix(group["v"], dims)), degree, beam, alpha)
        n = len(edges)
        return pa.table(
            {
                "dims": group["dims"],
                "shards": group["shards"],
                "shard": group["shard"],
                "node": pa.array(np.arange(n, dtype=np.int32)),
                "start": pa.array(np.full(n, start, np.int32)),
                "v": group["v"],
                "ids": group["ids"],
                "edges": pa.array(list(edges.astype(np.int32)), pa.list_(pa.int32())),
            }
        )

    schema = f"dims int, shards int, shard int, node int, start int, v array<double>, ids array<{id_type}>, edges array<int>"
    columns = ["dims", "shards", "shard", "v", "ids"]
    return written(dealt.select(*columns).groupBy("dims", "shard").applyInArrow(graph, schema), "graph")


def search(graph: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH, block: int = BLOCK, id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each usable query's k nearest rows other than its own."""
    id_type = queries.schema[id_col].dataType.simpleString()
    asked = queries.filter(usable(F.col(vec)) & F.col(id_col).isNotNull())
    asked = asked.select(F.col(id_col).alias("query_id"), F.transform(vec, lambda x: x.cast("double") + F.lit(0.0)).alias("q")).distinct()
    asked = written(asked.withColumn("dims", F.size("q")), "queries")
    counts = asked.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    shards = graph.select("dims", "shards").distinct()
    both = F.broadcast(counts.join(shards, "dims"))  # one row per vector length
    # Every block of queries visits every shard: queries are repeated per shard, shards per block.
    sent = asked.join(both, "dims").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int"))
    sent = sent.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select("dims", "shard", "block", "query_id", "q")
    kept = graph.join(both.drop("shards"), "dims").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    kept = kept.select("dims", "shard", "block", "node", "start", "v", "ids", "edges")
    found_type = pa.schema([("query_id", _arrow(id_type)), ("score", pa.float64()), ("ids", pa.list_(_arrow(id_type)))])

    def walk(nodes: pa.Table, asked: pa.Table) -> pa.Table:
        if not nodes.num_rows or not asked.num_rows:
            return found_type.empty_table()
        dims = nodes["dims"][0].as_py()
        nodes = nodes.sort_by("node")
        v, q = _matrix(nodes["v"], dims), _matrix(asked["q"], dims)
        x, edges = augmented(v), np.array(nodes["edges"].to_pylist())
        width = min(max(beam, k + 1), len(v))
        queries = np.hstack([q, np.zeros((len(q), 1))]).astype(np.float32)
        ids = np.concatenate(
            [beam_search(x, edges, nodes["start"][0].as_py(), queries[a : a + AT_ONCE], width)[0] for a in range(0, len(q), AT_ONCE)]
        )
        score = np.where(ids >= 0, _products(q, v, ids), -np.inf)
        best = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
        row, _ = np.nonzero(np.take_along_axis(ids, best, axis=1) >= 0)
        node = np.take_along_axis(ids, best, axis=1)
        there = node >= 0
        return pa.Table.from_arrays(
            [
                asked["query_id"].combine_chunks().take(pa.array(row)),
                pa.array(np.take_along_axis(score, best, axis=1)[there]),
                nodes["ids"].combine_chunks().take(pa.array(node[there])),
            ],
            schema=found_type,
        )

    keys = ("dims", "shard", "block")
    found = kept.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(walk, f"query_id {id_type}, score double, ids array<{id_type}>")
    each = found.select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    # An id with several vectors counts with its best.
    each = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _products(q: np.ndarray, v: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Inner products of each query with its own list of nodes, some queries at a time."""
    step = max(1, (1 << 22) // (ids.shape[1] * q.shape[1]))
    return np.concatenate([np.einsum("qd,qcd->qc", q[a : a + step], v[ids[a : a + step]]) for a in range(0, len(q), step)])


def nearest(points: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec: str = "embedding", **how) -> DataFrame:
    """Index all points and search it with the queries, which are rows of the same kind."""
    return search(index(points, k, id_col=id_col, vec=vec, **how), queries, k, id_col=id_col, vec=vec)

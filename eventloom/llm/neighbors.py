"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Distinct vectors are dealt to shards of about ``shard_rows`` by their hash, so the shards are even and
each holds a fair draw of the whole table. A shard's graph is one row of the index: its vectors and, per
level, a flat array of neighbours (``degree`` places a node, -1 where empty). Nodes stand in order
of falling level, so that level ``l`` is a prefix and a node has one number at all levels.

Vectors enter in that order, in growing batches: each looks up its candidates in the graph
made so far and among its batch, keeps those that are nearer to it than to a neighbour already kept,
and its neighbours link back, thinned by the same rule. All searches of a batch walk in
lockstep as matrices. Queries go to every shard; a shard's best are measured on the original vectors
in double precision and merged by distance and id.

Equal vectors are one node with their smallest ids, so a vector that fills a third of the table costs
one node and keeps the graph connected.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventloom.llm.common import stored
from eventloom.session import checkpoint_root

SHARD_ROWS = 8192
DEGREE = 16  # links of a node on upper levels; twice as many on the lowest
BUILD_WIDTH = 48  # candidates looked at for a new node
SEARCH_WIDTH = 64  # candidates looked at for a query
QUERY_BLOCK = 4096  # queries that the driver sends to the shards at once
AT_ONCE = 4  # nodes expanded per query and step
LOCKSTEP = 1 << 24  # queries walked together times nodes of the graph

INDEX = (
    "dim int, shard int, vectors binary, scale double, first_ids array<array<long>>, level_nodes array<int>, "
    "level_degrees array<int>, neighbours binary"
)


@dataclass
class Graph:
    """``links[l]`` are the flat neighbour arrays of level l: nodes x degree, -1 where empty.

    Walks choose their way in single precision, on vectors divided by ``scale``.
    """

    vectors: np.ndarray
    scale: float
    links: list[np.ndarray]


def _single(vectors: np.ndarray, scale: float) -> np.ndarray:
    return np.clip(vectors / scale, -1e15, 1e15).astype(np.float32)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, as double-precision sums of squared differences."""
    gap = a - b
    with np.errstate(over="ignore", invalid="ignore"):
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b (last two axes), for choosing only."""
    left, right = (a * a).sum(-1), (b * b).sum(-1)
    return np.maximum(left[..., :, None] + right[..., None, :] - 2 * (a @ np.swapaxes(b, -1, -2)), 0.0)


def walk(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest nodes that a best-first walk meets, nearest first: ids (-1: none) and
    squared distances, for all queries in lockstep. ``entry`` has one row of start nodes a query."""
    q, nodes = len(queries), len(links)
    ids = np.full((q, width), -1, dtype=np.int32)
    near = np.full((q, width), np.inf, dtype=np.float32)
    open_ = np.zeros((q, width), dtype=bool)
    seen = np.full((q, nodes), -1, dtype=np.int16)
    active = np.arange(q)
    fresh = entry
    while len(active):
        # Nodes not met before; the first of equal ones in a row stays.
        row, slot = np.nonzero(fresh >= 0)
        node = fresh[row, slot]
        new = seen[active[row], node] < 0
        row, slot, node = row[new], slot[new], node[new]
        seen[active[row], node] = slot
        own = seen[active[row], node] == slot
        row, slot, node = row[own], slot[own], node[own]
        gap = vectors[node] - queries[active[row]]
        found = np.full(fresh.shape, np.inf, dtype=np.float32)
        found[row, slot] = np.einsum("ij,ij->i", gap, gap)
        all_near = np.concatenate([near[active], found], axis=1)
        all_ids = np.concatenate([ids[active], np.where(np.isinf(found), -1, fresh)], axis=1)
        all_open = np.concatenate([open_[active], ~np.isinf(found)], axis=1)
        best = np.argsort(all_near, axis=1, kind="stable")[:, :width]
        near[active] = np.take_along_axis(all_near, best, 1)
        ids[active] = np.take_along_axis(all_ids, best, 1)
        still = np.take_along_axis(all_open, best, 1)
        turn = still & (np.cumsum(still, axis=1) <= AT_ONCE)
        open_[active] = still & ~turn
        going = turn.any(axis=1)
        active, turn = active[going], turn[going]
        if not len(active):
            break
        place = np.argsort(~turn, axis=1, kind="stable")[:, :AT_ONCE]
        chosen = np.take_along_axis(ids[active], place, 1)
        chosen[~np.take_along_axis(turn, place, 1)] = -1
        fresh = links[chosen].reshape(len(active), -1)
        fresh[np.repeat(chosen < 0, links.shape[1], axis=1)] = -1
    return ids, near


def select(vectors: np.ndarray, base: np.ndarray, candidates: np.ndarray, degree: int) -> np.ndarray:
    """For every row at most ``degree`` of the candidates (-1: none): from the nearest on, those
    nearer to the row's vector than to any candidate kept before."""
    rows, wide = candidates.shape
    points = vectors[np.maximum(candidates, 0)]
    gap = points - base[:, None, :]
    own = np.einsum("ijk,ijk->ij", gap, gap)
    own[candidates < 0] = np.inf
    order = np.argsort(own, axis=1, kind="stable")
    between = _squared(points, points)
    kept = np.zeros((rows, wide), dtype=bool)
    count = np.zeros(rows, dtype=int)
    every = np.arange(rows)
    for nth in range(wide):
        c = order[:, nth]
        blocked = (kept & (between[every, c] <= own[every, c][:, None])).any(axis=1)
        fits = (candidates[every, c] >= 0) & ~blocked & (count < degree)
        kept[every, c] = fits
        count += fits
    # Places left over go to the nearest of the others.
    rank = np.lexsort((own, np.where(candidates < 0, 2, ~kept)), axis=1)[:, :degree]
    out = np.take_along_axis(candidates, rank, 1)
    if out.shape[1] < degree:
        out = np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)
    return out


def _distinct(candidates: np.ndarray) -> np.ndarray:
    """Rows with every later repeat of a node replaced by -1."""
    order = np.argsort(candidates, axis=1, kind="stable")
    held = np.take_along_axis(candidates, order, 1)
    again = np.zeros_like(held, dtype=bool)
    again[:, 1:] = held[:, 1:] == held[:, :-1]
    out = candidates.copy()
    np.put_along_axis(out, order, np.where(again, -1, held), 1)
    return out


def _link_back(vectors: np.ndarray, links: np.ndarray, sources: np.ndarray) -> None:
    """Every neighbour of the new nodes gets the new node as a candidate of its own."""
    degree = links.shape[1]
    row, slot = np.nonzero(links[sources] >= 0)
    target, source = links[sources][row, slot], sources[row]
    gap = vectors[target] - vectors[source]
    order = np.lexsort((source, np.einsum("ij,ij->i", gap, gap), target))
    target, source = target[order], source[order]
    nth = np.arange(len(target)) - np.searchsorted(target, target)
    near = nth < degree  # a target considers its nearest new nodes
    target, source, nth = target[near], source[near], nth[near]
    touched, at = np.unique(target, return_inverse=True)
    for a in range(0, len(touched), 512):
        part = touched[a: a + 512]
        inside = (at >= a) & (at < a + 512)
        offered = np.full((len(part), degree), -1, dtype=np.int32)
        offered[at[inside] - a, nth[inside]] = source[inside]
        offered = offered[:, : int(nth[inside].max(initial=0)) + 1]
        links[part] = select(vectors, vectors[part], _distinct(np.concatenate([links[part], offered], axis=1)), degree)


def _levels(n: int, degree: int) -> list[int]:
    """Number of nodes of each level: each upper level has a ``degree``-th of the one below."""
    counts = [n]
    while counts[-1] > degree:
        counts.append(counts[-1] // degree)
    return counts


def build_graph(vectors: np.ndarray, degree: int = DEGREE, width: int = BUILD_WIDTH) -> Graph:
    """The graph over the rows, which must be distinct and in no particular order."""
    originals, scale = vectors, float(np.abs(vectors).max(initial=0.0)) or 1.0
    vectors = _single(originals, scale)
    counts = _levels(len(vectors), degree)
    links = [np.full((n, degree * (2 if level == 0 else 1)), -1, dtype=np.int32) for level, n in enumerate(counts)]
    for level in range(len(counts) - 1, -1, -1):
        done = 0
        while done < counts[level]:
            size = min(counts[level] - done, max(64, done // 4), max(64, LOCKSTEP // max(done, 1)), 1024)
            new = np.arange(done, done + size)
            fresh = vectors[new]
            # Among the batch itself, those before and after a node alike.
            mates = _squared(fresh, fresh)
            np.fill_diagonal(mates, np.inf)
            few = min(degree, size - 1)
            with_mates = new[np.argpartition(mates, few - 1, axis=1)[:, :few]] if few > 0 else np.full((size, 0), -1)
            candidates = with_mates.astype(np.int32)
            if done:
                start = _descend(vectors, links, counts, fresh, level)
                met, _ = walk(vectors, links[level][:done], fresh, np.where(start < done, start, -1), width)
                candidates = np.concatenate([met, candidates], axis=1)
            if candidates.shape[1]:
                links[level][new] = select(vectors, fresh, candidates, links[level].shape[1])
                _link_back(vectors, links[level], new)
            done += size
    return Graph(originals, scale, links)


def _descend(vectors: np.ndarray, links: list[np.ndarray], counts: list[int], queries: np.ndarray, level: int) -> np.ndarray:
    """Start nodes at a level: the nearest met on the levels above it, and node 0."""
    entry = np.zeros((len(queries), 1), dtype=np.int32)
    for above in range(len(counts) - 1, level, -1):
        entry, _ = walk(vectors, links[above], queries, entry, 4)
    return np.concatenate([entry, np.zeros((len(queries), 1), dtype=np.int32)], axis=1) if entry.shape[1] > 1 else entry


def search_graph(graph: Graph, queries: np.ndarray, width: int = SEARCH_WIDTH) -> np.ndarray:
    """Nodes met, nearest first, -1 where fewer; queries are walked in bounded groups."""
    counts = [len(level) for level in graph.links]
    group = max(1, LOCKSTEP // len(graph.vectors))
    vectors = _single(graph.vectors, graph.scale)
    out = np.full((len(queries), width), -1, dtype=np.int32)
    for a in range(0, len(queries), group):
        part = _single(queries[a: a + group], graph.scale)
        entry = _descend(vectors, graph.links, counts, part, 0)
        out[a: a + group], _ = walk(vectors, graph.links[0], part, entry, width)
    return out


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, vector``: rows with an id whose vector is of finite components, not all of them zero."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda c: c != 0.0))


def build_index(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", keep: int = 11,
                shard_rows: int = SHARD_ROWS, degree: int = DEGREE, width: int = BUILD_WIDTH) -> DataFrame:
    """One row per dimension and shard (see ``INDEX``), written to the shared folder.

    Every usable vector is indexed (see ``top_k``). ``keep`` ids, the smallest, are kept of equal vectors.
    """
    nth = F.row_number().over(W.partitionBy("vector").orderBy("id"))
    ids = _usable(rows, key, vector).distinct().withColumn("nth", nth).where(F.col("nth") <= keep)
    nodes = stored(ids.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("dim", F.size("vector")), "vectors")
    # One row per dimension that occurs.
    sizes = nodes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).cast("long").alias("shards"))
    # Shards are few bytes and much work: without a number of partitions Spark would put many into one task.
    tasks = 2 * (sizes.agg(F.coalesce(F.sum("shards"), F.lit(1))).first()[0])
    dealt = nodes.join(sizes, "dim").withColumn("hash", F.xxhash64("vector"))
    dealt = dealt.withColumn("shard", F.pmod("hash", "shards").cast("int")).drop("shards")
    dealt = dealt.repartitionByRange(tasks, "dim", "shard")

    def index(part: pd.DataFrame) -> pd.DataFrame:
        # The hash deals the levels, in the same way in every run.
        part = part.sort_values("hash", kind="stable")
        vectors = np.array(part["vector"].tolist(), dtype=np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            graph = build_graph(vectors, degree, width)
        return pd.DataFrame({
            "dim": [int(part["dim"].iloc[0])], "shard": [int(part["shard"].iloc[0])], "vectors": [vectors.tobytes()],
            "scale": [graph.scale],
            "first_ids": [[list(map(int, x)) for x in part["ids"]]], "level_nodes": [[len(x) for x in graph.links]],
            "level_degrees": [[x.shape[1] for x in graph.links]],
            "neighbours": [b"".join(x.tobytes() for x in graph.links)],
        })

    return stored(dealt.groupBy("dim", "shard").applyInPandas(index, INDEX), "graphs")


def read_graph(row: dict) -> Graph:
    vectors = np.frombuffer(row["vectors"], dtype=np.float64).reshape(-1, row["dim"])
    flat, links, at = np.frombuffer(row["neighbours"], dtype=np.int32), [], 0
    for nodes, degree in zip(row["level_nodes"], row["level_degrees"]):
        links.append(flat[at: at + nodes * degree].reshape(nodes, degree))
        at += nodes * degree
    return Graph(vectors, row["scale"], links)


def _search_shards(index: DataFrame, ids: np.ndarray, vectors: list[np.ndarray], k: int, width: int) -> DataFrame:
    """The ``k`` best candidates of every shard for each of a block of queries."""
    by_dim = {d: np.flatnonzero([len(v) == d for v in vectors]) for d in {len(v) for v in vectors}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                which = by_dim.get(row["dim"])
                if which is None:
                    continue
                graph, first_ids = read_graph(row), row["first_ids"]
                asked = np.stack([vectors[i] for i in which])
                with np.errstate(over="ignore", invalid="ignore"):
                    met = search_graph(graph, asked, width)
                    q, slot = np.nonzero(met >= 0)
                    node = met[q, slot]
                    score = distances(graph.vectors[node], asked[q])
                held = np.array([len(x) for x in first_ids])[node]
                flat = np.concatenate([first_ids[n] for n in node]) if len(node) else np.zeros(0, np.int64)
                q, score = np.repeat(q, held), np.repeat(score, held)
                other = flat != ids[which][q]
                q, score, flat = q[other], score[other], flat[other]
                order = np.lexsort((flat, score, q))
                q, score, flat = q[order], score[order], flat[order]
                # An id that stands twice counts with its nearer vector; a few more than k make up for it.
                best = np.arange(len(q)) - np.searchsorted(q, q) < 2 * k
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[which][q[best]]), pa.array(flat[best], pa.int64()), pa.array(score[best])],
                    ["query_id", "vec_id", "score"],
                )

    return index.mapInArrow(run, "query_id long, vec_id long, score double")


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding",
          index: DataFrame | None = None, width: int = SEARCH_WIDTH) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for every query.

    Rows and queries without id or vector, with a null or non-finite component or with zeros only take
    no part. A query is not its own neighbour: rows of its id are left out. Equal distances go to
    the smaller id. Rows of one id and vector count once; of an id with several vectors the nearest
    counts, and a query id with several vectors is answered for the nearest of them. Vectors of another
    dimension than the query's are no candidates. Other columns are not looked at. Candidates are
    approximate, distances are not. ``index`` is one of ``build_index`` over the same rows.
    """
    spark = rows.sparkSession
    index = build_index(rows, key, vector, k + 1) if index is None else index
    wanted = _usable(queries, key, vector).distinct()
    wanted = stored(wanted.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(_query_blocks(wanted)))), "graph-queries", ("block",))
    path = f"{checkpoint_root(spark)}/llm/neighbours-{uuid.uuid4().hex}"
    schema = "query_id long, vec_id long, score double"
    spark.createDataFrame([], schema).write.parquet(path)
    for (block,) in wanted.select("block").distinct().toLocalIterator():
        asked = wanted.where(F.col("block") == block).select("id", "vector").toPandas()  # some QUERY_BLOCK rows
        vectors = [np.array(v, dtype=np.float64) for v in asked["vector"]]
        found = _search_shards(index, asked["id"].to_numpy(np.int64), vectors, k, width)
        found.write.mode("append").parquet(path)
    nearest = spark.read.schema(schema).parquet(path).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return nearest.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _query_blocks(queries: DataFrame) -> int:
    return max(1, math.ceil(queries.count() / QUERY_BLOCK))

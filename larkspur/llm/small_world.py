"""Approximate nearest neighbours with one navigable small-world graph per shard.

Distinct vectors are dealt to shards of about ``shard_rows`` by a hash; copies
of one vector share a node that carries its smallest ``k + 1`` ids, more than
any answer can show.  A task builds the layered graph of a shard (insertion
with a beam of ``ef_build``, diverse neighbour selection) and stores it as flat
arrays: per layer the member nodes and a fixed-width neighbour table.  Queries
are packed into one row per block of about ``block`` and travel so to every
shard; a task holds one graph and one block, and there are as many tasks as
pairs of them.  The shards' answers are merged and ranked by exact distances of
the original vectors.

Defined cases: rows with a null id, a null vector, a null, NaN or infinite
component or only zeros, and vectors of another length than the most frequent
one, take no part; repeated rows count once; an id with several vectors answers
with its nearest; fewer candidates than ``k`` give fewer rows; ties go to the
smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from larkspur.llm.common import staged, usable_vector


_MOST_TASKS = 100_000


@dataclass
class Graph:
    """Flat form: vectors, and per layer (bottom first) its nodes, each node's place in the layer, and a -1 padded neighbour table."""

    vectors: np.ndarray
    nodes: list[np.ndarray]
    places: list[np.ndarray]
    neighbours: list[np.ndarray]
    entry: int

    def pack(self) -> bytes:
        head = np.array([*self.vectors.shape, len(self.nodes), self.entry], "<i8")
        parts = [head, self.vectors.astype("<f8")]
        for nodes, table in zip(self.nodes, self.neighbours):
            parts += [np.array(table.shape, "<i8"), nodes.astype("<i4"), table.astype("<i4")]
        return b"".join(p.tobytes() for p in parts)

    @classmethod
    def unpack(cls, blob: bytes) -> Graph:
        at = 0

        def read(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, dtype, n, at)
            at += out.nbytes
            return out

        n, d, layers, entry = read("<i8", 4).tolist()
        vectors = read("<f8", n * d).reshape(n, d)
        nodes, places, tables = [], [], []
        for _ in range(layers):
            rows, width = read("<i8", 2).tolist()
            nodes.append(read("<i4", rows))
            tables.append(read("<i4", rows * width).reshape(rows, width))
            places.append(np.full(n, -1, "i4"))
            places[-1][nodes[-1]] = np.arange(rows)
        return cls(vectors, nodes, places, tables, entry)


def _beam(vectors: np.ndarray, norms: np.ndarray, links, query: np.ndarray, starts: list[int], ef: int) -> list[tuple[float, int]]:
    """The ``ef`` nearest nodes a best-first walk finds, nearest first; ``links(node)`` gives neighbours."""
    doubled, own = 2 * query, float(query @ query)

    def far(nodes: np.ndarray | list[int]) -> list[float]:
        return (norms[nodes] - vectors[nodes] @ doubled + own).tolist()

    seen = set(starts)
    found = [(-d, n) for d, n in zip(far(starts), starts)]
    heapq.heapify(found)
    front = [(-d, n) for d, n in found]
    heapq.heapify(front)
    while front:
        d, node = heapq.heappop(front)
        if len(found) >= ef and d > -found[0][0]:
            break
        fresh = [x for x in links(node) if x >= 0 and x not in seen]
        if not fresh:
            continue
        seen.update(fresh)
        for d, x in zip(far(fresh), fresh):
            if len(found) < ef:
                heapq.heappush(found, (-d, x))
                heapq.heappush(front, (d, x))
            elif d < -found[0][0]:
                heapq.heapreplace(found, (-d, x))
                heapq.heappush(front, (d, x))
    return sorted((-d, n) for d, n in found)


def _diverse(vectors: np.ndarray, found: list[tuple[float, int]], m: int) -> list[int]:
    """Up to ``m`` of the nearest: first those nearer to the base than to any chosen one, then the nearest others."""
    if len(found) <= m:
        return [n for _, n in found]
    nodes = np.array([n for _, n in found])
    points = vectors[nodes]
    squares = (points * points).sum(1)
    between = squares[:, None] + squares[None, :] - 2 * points @ points.T
    closest = np.full(len(nodes), np.inf)
    chosen, rest = [], []
    for i, (d, _) in enumerate(found):
        if len(chosen) == m:
            break
        if d <= closest[i]:
            chosen.append(i)
            np.minimum(closest, between[i], out=closest)
        else:
            rest.append(i)
    chosen += rest[: m - len(chosen)]
    return nodes[chosen].tolist()


def build_graph(vectors: np.ndarray, m: int = 16, ef_build: int = 80, seed: int = 0) -> Graph:
    """Insert the vectors one by one.  A list of neighbours may grow to twice its size before it is cut back."""
    n = len(vectors)
    norms = (vectors * vectors).sum(1)
    levels = np.floor(-np.log(np.maximum(np.random.default_rng(seed).random(n), 1e-12)) / math.log(m)).astype(int)
    lists: list[dict[int, list[int]]] = [{} for _ in range(int(levels.max(initial=0)) + 1)]
    entry, top = 0, -1
    for node in range(n):
        level = int(levels[node])
        starts = [entry]
        for layer in range(top, level, -1):
            starts = [_beam(vectors, norms, lists[layer].__getitem__, vectors[node], starts, 1)[0][1]]
        for layer in range(min(top, level), -1, -1):
            room = 2 * m if layer == 0 else m
            found = _beam(vectors, norms, lists[layer].__getitem__, vectors[node], starts, ef_build)
            lists[layer][node] = chosen = _diverse(vectors, found, m)
            for other in chosen:
                near = lists[layer][other]
                near.append(node)
                if len(near) > 2 * room:
                    d = ((vectors[near] - vectors[other]) ** 2).sum(1)
                    lists[layer][other] = _diverse(vectors, sorted(zip(d.tolist(), near)), room)
            starts = [x for _, x in found]
        for layer in range(max(top + 1, 0), level + 1):
            lists[layer][node] = []
        if level > top:
            entry, top = node, level
    nodes, places, tables = [], [], []
    for layer in lists[: top + 1]:
        members = np.array(sorted(layer), "i4")
        table = np.full((len(members), max([1, *map(len, layer.values())])), -1, "i4")
        for row, member in enumerate(members.tolist()):
            table[row, : len(layer[member])] = layer[member]
        place = np.full(n, -1, "i4")
        place[members] = np.arange(len(members))
        nodes, places, tables = [*nodes, members], [*places, place], [*tables, table]
    return Graph(vectors, nodes, places, tables, entry)


def search_graph(graph: Graph, query: np.ndarray, k: int, ef: int, norms: np.ndarray) -> list[int]:
    """The ``k`` nearest nodes that the walk from the top layer finds."""
    starts = [graph.entry]
    for layer in range(len(graph.nodes) - 1, -1, -1):
        links = lambda x, t=graph.neighbours[layer], p=graph.places[layer]: t[p[x]].tolist()
        found = _beam(graph.vectors, norms, links, query, starts, ef if layer == 0 else 1)
        starts = [found[0][1]]
    return [x for _, x in found[:k]]


def usable_rows(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``(id, v)`` of the rows that take part: ids given, vectors usable and of the most frequent length, equal rows once."""
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & usable_vector("v")).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("v") == (length["d"] if length else 0)).dropDuplicates(["id", "v"])


def nearest(
    df: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding",
    shard_rows: int = 5_000, m: int = 16, ef_build: int = 80, ef: int = 96, block: int = 4_096,
) -> DataFrame:
    """For every row where ``is_query`` (an expression on ``id``): the ``k`` nearest other rows as ``query_id, rank, vec_id, score``."""
    rows = usable_rows(df, id_column, vector_column)
    first = Window.partitionBy("v").orderBy("id")  # cut before the shuffle, so copies of one vector do not gather
    few = rows.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1)
    nodes = staged(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    n = nodes.count()
    shards = max(1, math.ceil(n / shard_rows))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("first", kind="stable")
        graph = build_graph(np.stack(group["v"].to_numpy()), m, ef_build)
        ids = [np.asarray(x, "<i8") for x in group["ids"]]
        ends = np.cumsum([len(x) for x in ids]).astype("<i8")
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "graph": [graph.pack()], "ids": [np.concatenate(ids).tobytes()], "ends": [ends.tobytes()]})

    dealt = nodes.withColumns({"first": F.col("ids")[0], "shard": F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int")})
    # dealt by number, so that small partitions are not put together into few long tasks
    graphs = staged(dealt.repartition(min(shards, _MOST_TASKS), "shard").groupBy("shard").applyInPandas(build, "shard int, graph binary, ids binary, ends binary"), "graphs")

    queries = rows.filter(is_query)
    blocks = max(1, math.ceil(queries.count() / block))

    def bundle(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        return pd.DataFrame({"block": [group["block"].iloc[0]], "asked": [group["id"].to_numpy("<i8").tobytes()], "points": [np.stack(group["v"].to_numpy()).astype("<f8").tobytes()]})

    bundles = queries.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")).groupBy("block").applyInPandas(bundle, "block long, asked binary, points binary")
    sent = staged(bundles, "bundles").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    copies = graphs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def search(asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(asked) and len(stored):
            wanted = np.frombuffer(asked["asked"].iloc[0], "<i8")
            points = np.frombuffer(asked["points"].iloc[0], "<f8").reshape(len(wanted), -1)
            graph = Graph.unpack(stored["graph"].iloc[0])
            norms = (graph.vectors * graph.vectors).sum(1)
            ids, ends = (np.frombuffer(stored[c].iloc[0], "<i8") for c in ("ids", "ends"))
            for query, point in zip(wanted.tolist(), points):
                for node in search_graph(graph, point, k + 1, ef, norms):
                    score = float(np.sqrt(((graph.vectors[node] - point) ** 2).sum()))
                    out += [(query, x, score) for x in ids[ends[node - 1] if node else 0 : ends[node]].tolist()]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    key, tasks = ["shard", "block"], min(shards * blocks, _MOST_TASKS)
    found = sent.repartition(tasks, *key).groupBy(*key).cogroup(copies.repartition(tasks, *key).groupBy(*key)).applyInPandas(search, "query_id long, vec_id long, score double")
    found = found.filter("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

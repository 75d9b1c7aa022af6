"""Approximate nearest neighbours with HNSW graphs (operator 7).

Equal vectors are one node that keeps its k + 1 smallest ids, so a vector
with a third of all rows is one node too. Nodes are dealt by hash into
shards of about ``rows_per_shard`` (a search costs nearly the same in a
large graph as in a small one, so shards are as large as a task can build);
every shard builds a hierarchical
navigable small-world graph, kept as a table of flat neighbour arrays.
Distinct query vectors visit every shard, in blocks of so many that a shard
is sent about once; the shards' results are merged per query by exact
distance and id. An index keeps k, and a search for more raises.

Distances are Euclidean, in double precision, on the original vectors.
Vectors that are null, zero, or hold null or non-finite components take no
part, neither as queries nor as candidates. Vectors of different length
never meet. Rows with equal id and vector count once; a query meets no row
of its own id. With fewer than k candidates all are returned. Empty table:
no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, read_table, splitmix

K = 10
M = 12                    # neighbours per node above the ground level; twice that on it
EF_BUILD = 80
EF_SEARCH = 256
ROWS_PER_SHARD = 1 << 14
QUERIES_PER_BLOCK = 1 << 16
FEW = 10_000


class Graph:
    """One shard's graph. ``links[l]`` is an (n, width) array of neighbour
    numbers of level l, -1 where there is none."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, links: list[np.ndarray], entry: int):
        self.x, self.levels, self.links, self.entry = vectors, levels, links, entry
        self.sq = np.einsum("ij,ij->i", vectors, vectors)
        self.seen = np.zeros(len(vectors), np.int64)
        self.stamp = 0

    def _near(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return self.sq[nodes] - 2.0 * (self.x[nodes] @ q)

    def search_level(self, q: np.ndarray, start: list[tuple[float, int]], ef: int, level: int) -> list[tuple[float, int]]:
        """The ``ef`` nearest nodes met, as (distance, node), ascending."""
        links, seen = self.links[level], self.seen
        self.stamp += 1
        seen[[n for _, n in start]] = self.stamp
        todo = list(start)
        heapq.heapify(todo)
        best = [(-d, n) for d, n in start]
        heapq.heapify(best)
        while len(best) > ef:
            heapq.heappop(best)
        while todo:
            d, node = heapq.heappop(todo)
            if len(best) >= ef and d > -best[0][0]:
                break
            near = links[node]
            near = near[near >= 0]
            near = near[seen[near] != self.stamp]
            if not len(near):
                continue
            seen[near] = self.stamp
            dist = self._near(q, near)
            if len(best) >= ef:
                closer = dist < -best[0][0]
                near, dist = near[closer], dist[closer]
            for d, n in zip(dist.tolist(), near.tolist()):
                if len(best) < ef:
                    heapq.heappush(best, (-d, n))
                elif d < -best[0][0]:
                    heapq.heapreplace(best, (-d, n))
                else:
                    continue
                heapq.heappush(todo, (d, n))
        return sorted((-d, n) for d, n in best)

    def descend(self, q: np.ndarray, to: int) -> list[tuple[float, int]]:
        """Nearest node found on the levels above ``to``."""
        at = [(float(self._near(q, np.array([self.entry]))[0]), self.entry)]
        for level in range(int(self.levels[self.entry]), to, -1):
            at = self.search_level(q, at, 1, level)
        return at

    def search(self, q: np.ndarray, ef: int) -> np.ndarray:
        found = self.search_level(q, self.descend(q, 0), ef, 0)
        return np.array([n for _, n in found], np.int64)

    def _choose(self, near: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours in different directions: a node is taken if it is
        nearer to the new one than to all taken so far; then the nearest rest."""
        nodes = np.array([n for _, n in near])
        x = self.x[nodes]
        between = self.sq[nodes][:, None] + self.sq[nodes][None, :] - 2.0 * (x @ x.T)
        own = np.array([d for d, _ in near])
        limit, taken = np.full(len(nodes), np.inf), []
        for i in range(len(nodes)):
            if own[i] < limit[i]:
                taken.append(i)
                if len(taken) == most:
                    break
                np.minimum(limit, between[i], out=limit)
        if len(taken) < most:
            chosen = set(taken)
            taken += [i for i in range(len(nodes)) if i not in chosen][: most - len(taken)]
        return nodes[taken].tolist()

    def _link(self, a: int, b: int, level: int) -> None:
        row = self.links[level][a]
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = b
            return
        near = np.append(row, b)
        dist = self._near(self.x[a], near) + self.sq[a]
        by = np.argsort(dist, kind="stable")
        row[:] = self._choose([(float(dist[i]), int(near[i])) for i in by], len(row))

    def insert(self, node: int, ef: int) -> None:
        q, top = self.x[node], int(self.levels[node])
        highest = int(self.levels[self.entry])
        at = self.descend(q, top)
        for level in range(min(top, highest), -1, -1):
            near = self.search_level(q, at, ef, level)
            # distances are without the query's own square: add it for the choice
            whole = [(d + float(self.sq[node]), n) for d, n in near]
            width = self.links[level].shape[1]
            chosen = self._choose(whole, M)
            self.links[level][node][: min(len(chosen), width)] = chosen[:width]
            for other in chosen:
                self._link(other, node, level)
            at = near
        if top > highest:
            self.entry = node


def build(vectors: np.ndarray, keys: np.ndarray, ef: int = EF_BUILD) -> Graph:
    """Insert all vectors; levels are drawn from the hash of ``keys``."""
    u = (splitmix(keys.astype(np.int64).view(np.uint64)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    levels = np.minimum((-np.log(np.maximum(u, 1e-18)) / np.log(M)).astype(np.int64), 12)
    links = [np.full((len(vectors), 2 * M if lv == 0 else M), -1, np.int32) for lv in range(int(levels.max()) + 1)]
    graph = Graph(vectors, levels, links, 0)
    for node in range(1, len(vectors)):
        graph.insert(node, ef)
    return graph


INDEX = ("dim int, shard int, k int, n int, entry int, levels binary, vectors binary, ids binary, id_ends binary, link_levels int, links binary")


def _flat(g: Graph) -> bytes:
    """Neighbour arrays of all levels, one after another; above the ground
    only of the nodes that reach the level."""
    return b"".join([g.links[0].tobytes(), *(g.links[lv][g.levels >= lv].tobytes() for lv in range(1, len(g.links)))])


def _index_shard(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    pdf = pdf.sort_values("node", kind="stable")
    vectors = np.array([np.asarray(v, np.float64) for v in pdf["embedding"]])
    g = build(vectors, pdf["node"].to_numpy())
    ids = [np.asarray(i, np.int64) for i in pdf["ids"]]
    return pd.DataFrame([{
        "dim": int(pdf["dim"].iloc[0]), "shard": int(pdf["shard"].iloc[0]), "k": k, "n": len(vectors), "entry": g.entry,
        "levels": g.levels.astype("<i1").tobytes(), "vectors": vectors.tobytes(), "ids": np.concatenate(ids).tobytes(),
        "id_ends": np.cumsum([len(i) for i in ids]).astype("<i8").tobytes(), "link_levels": len(g.links), "links": _flat(g)}])


def load_graph(row) -> Graph:
    n, dim = int(row["n"]), int(row["dim"])
    levels = np.frombuffer(row["levels"], "<i1").astype(np.int64)
    flat, at, links = np.frombuffer(row["links"], np.int32), 0, []
    for lv in range(int(row["link_levels"])):
        width, nodes = (2 * M, np.arange(n)) if lv == 0 else (M, np.flatnonzero(levels >= lv))
        full = np.full((n, width), -1, np.int32)
        full[nodes] = flat[at: at + len(nodes) * width].reshape(-1, width)
        at += len(nodes) * width
        links.append(full)
    return Graph(np.frombuffer(row["vectors"], np.float64).reshape(n, dim), levels, links, int(row["entry"]))


RESULT = "query long, vec_id long, score double"


def _searcher(k: int, ef: int):
    def run(queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        out = {"query": [], "vec_id": [], "score": []}
        for _, row in index.iterrows():
            if row["k"] < k:
                raise ValueError(f"the index keeps equal vectors for {row['k']} neighbours, not {k}")
            g = load_graph(row)
            ids, ends = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["id_ends"], "<i8")
            for query, v in zip(queries["query"], queries["embedding"]):
                q = np.asarray(v, np.float64)
                nodes = g.search(q, max(ef, k + 1))
                dist = np.sqrt(((g.x[nodes] - q) ** 2).sum(axis=1))
                # a node more than asked for, as the query's own id may be among them
                keep = np.argsort(dist, kind="stable")
                last = dist[keep[min(k, len(keep) - 1)]]
                for i in keep[dist[keep] <= last].tolist():
                    own = ids[(ends[nodes[i] - 1] if nodes[i] else 0): ends[nodes[i]]].tolist()
                    out["query"] += [query] * len(own)
                    out["vec_id"] += own
                    out["score"] += [float(dist[i])] * len(own)
        return pd.DataFrame(out).astype({"query": "int64", "vec_id": "int64", "score": "float64"})
    return run


def valid_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding, dim) of the vectors that take part."""
    e = F.col("embedding")
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), e)
            .where(F.col("vec_id").isNotNull() & e.isNotNull() & ~F.coalesce(F.exists(e, bad), F.lit(True)) & F.exists(e, lambda x: x != 0))
            .withColumn("dim", F.size(e)))


def build_index(vectors: DataFrame, scratch: Scratch, k: int = K, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """Index table (``INDEX``) of :func:`valid_vectors` rows."""
    nth = F.dense_rank().over(Window.partitionBy("embedding").orderBy("vec_id"))
    nodes = scratch.save(vectors.withColumn("nth", nth).where(F.col("nth") <= k + 1)
                         .groupBy("embedding", "dim").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
                         .withColumn("node", F.get("ids", F.lit(0))), "nodes")
    shards = nodes.groupBy(F.col("dim").alias("_dim")).agg(F.ceil(F.count(F.lit(1)) / rows_per_shard).alias("shards"))
    shards = F.broadcast(shards) if shards.limit(FEW + 1).count() <= FEW else shards
    dealt = nodes.join(shards, F.col("dim") == F.col("_dim")).withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))
    return scratch.save(dealt.select("dim", "shard", "node", "embedding", "ids").groupBy("dim", "shard").applyInPandas(lambda pdf: _index_shard(pdf, k), INDEX), "index")


def nearest(queries: DataFrame, index: DataFrame, scratch: Scratch, k: int = K, ef: int = EF_SEARCH,
            queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of :func:`valid_vectors` queries."""
    distinct = scratch.save(queries.groupBy("embedding", "dim").agg(F.min("vec_id").alias("query")), "queries")
    blocks = max(1, -(-distinct.count() // queries_per_block))
    visits = (distinct.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
              .join(index.select(F.col("dim").alias("_dim"), F.col("shard").alias("_shard")), F.col("dim") == F.col("_dim"))
              .select("dim", F.col("_shard").alias("shard"), "block", "query", "embedding"))
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = scratch.save(visits.groupBy("dim", "shard", "block").cogroup(copies.groupBy("dim", "shard", "block"))
                         .applyInPandas(lambda q, i: _searcher(k, ef)(q, i), RESULT), "found")
    best = Window.partitionBy("query").orderBy("score", "vec_id")
    found = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).drop("nth")
    asked = (queries.select("vec_id", "embedding", "dim").distinct().withColumnRenamed("vec_id", "query_id")
             .join(distinct.select(F.col("embedding").alias("_e"), "query"), F.col("embedding") == F.col("_e")).select("query_id", "query"))
    own = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (asked.join(found, "query").where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op7_hnsw_search(spark, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "hnsw")
    vectors = valid_vectors(read_table(spark, sf_dir, "embeddings"))
    index = build_index(vectors, scratch)
    return nearest(vectors.where("vec_id % 100 = 0"), index, scratch)

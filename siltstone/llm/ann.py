"""Nearest neighbours by navigable small-world graphs, one per shard (operator 1).

Equal vectors are one node with the ids of their first copies. Nodes are dealt to shards
by a hash; each shard's task builds its graph by itself: layers of flat neighbour arrays,
filled node by node with a beam search and thinned to diverse neighbours. The graphs are
a table. Queries come in blocks; every block is sent to every shard, where one task holds
the shard's graph and lets a lane of blocks pass by. The shards' answers are merged.
Distances are Euclidean, in double precision, on the original vectors. A graph holds its
vectors divided by a power of two, so that squares neither vanish nor overflow.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import scratch_path

#: Distinct vectors in a shard, about.
SHARD = 4096
#: Queries in a block, about.
QUERY_BLOCK = 256
#: Blocks that pass by one copy of a graph.
LANE = 64
NEIGHBOURS = 12
BUILD_BEAM = 64
SEARCH_BEAM = 96


class Graph:
    """Layers of a small-world graph over the rows of ``vectors``.

    ``near[l]`` has the neighbours on layer ``l``, ``-1`` where there are fewer; a node's
    row on layer ``l`` is ``row[l][node]``. Distances are squared inside.
    """

    def __init__(self, vectors: np.ndarray, neighbours: int = NEIGHBOURS, seed: int = 1):
        self._hold(vectors)
        self.most = neighbours
        n = len(vectors)
        draw = np.random.default_rng(seed).random(n)
        self.level = np.floor(-np.log(1 - draw) / np.log(neighbours)).astype(np.int8)
        top = int(self.level.max()) if n else 0
        self.width = [2 * neighbours] + [neighbours] * top
        self.near = [np.full((n, w), -1, np.int32) for w in self.width]
        self.held = [np.zeros(n, np.int32) for _ in self.width]
        self.entry, self.entry_level = -1, -1

    def _hold(self, vectors: np.ndarray) -> None:
        self.exponent = int(np.frexp(np.abs(vectors).max(initial=0.0))[1])
        self.vectors = np.ldexp(np.ascontiguousarray(vectors, np.float64), -self.exponent)

    def build(self, beam: int = BUILD_BEAM) -> Graph:
        for node in range(len(self.vectors)):
            self._insert(node, beam)
        return self

    def _apart(self, q: np.ndarray, nodes) -> np.ndarray:
        d = self.vectors[nodes] - q
        return np.einsum("ij,ij->i", d, d)

    def _closest(self, q: np.ndarray, start: int, above: int, level: int) -> int:
        """Greedy walk down from layer ``above`` to just above ``level``."""
        best, apart = start, float(self._apart(q, [start])[0])
        for layer in range(above, level, -1):
            moved = True
            while moved:
                nodes = self.near[layer][best, : self.held[layer][best]]
                moved = False
                if len(nodes):
                    d = self._apart(q, nodes)
                    i = int(d.argmin())
                    if d[i] < apart:
                        best, apart, moved = int(nodes[i]), float(d[i]), True
        return best

    def _beam(self, q: np.ndarray, start: list[int], beam: int, layer: int) -> list[tuple[float, int]]:
        """The nearest nodes found from ``start``, nearest first."""
        seen = np.zeros(len(self.vectors), bool)
        seen[start] = True
        open_heap = list(zip(self._apart(q, start).tolist(), start))
        heapq.heapify(open_heap)
        kept = [(-d, i) for d, i in open_heap]
        heapq.heapify(kept)
        near, held = self.near[layer], self.held[layer]
        while open_heap:
            apart, node = heapq.heappop(open_heap)
            if len(kept) >= beam and apart > -kept[0][0]:
                break
            nodes = near[node, : held[node]]
            nodes = nodes[~seen[nodes]]
            if not len(nodes):
                continue
            seen[nodes] = True
            d = self._apart(q, nodes)
            if len(kept) >= beam:
                better = d < -kept[0][0]
                d, nodes = d[better], nodes[better]
            for x, i in zip(d.tolist(), nodes.tolist()):
                if len(kept) < beam:
                    heapq.heappush(kept, (-x, i))
                elif x < -kept[0][0]:
                    heapq.heapreplace(kept, (-x, i))
                else:
                    continue
                heapq.heappush(open_heap, (x, i))
        return sorted((-d, i) for d, i in kept)

    def _diverse(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours nearer to the node than to each other; the rest fills up."""
        if len(found) <= most:
            return [i for _, i in found]
        nodes = [i for _, i in found]
        v = self.vectors[nodes]
        square = np.einsum("ij,ij->i", v, v)
        between = square[:, None] + square[None] - 2 * (v @ v.T)
        least = np.full(len(nodes), np.inf, np.float32)
        chosen, passed = [], []
        for at, (apart, node) in enumerate(found):
            if least[at] > apart:
                chosen.append(node)
                if len(chosen) == most:
                    return chosen
                np.minimum(least, between[at], out=least)
            else:
                passed.append(node)
        return chosen + passed[: most - len(chosen)]

    def _insert(self, node: int, beam: int) -> None:
        level = int(self.level[node])
        q = self.vectors[node]
        if self.entry < 0:
            self.entry, self.entry_level = node, level
            return
        start = [self._closest(q, self.entry, self.entry_level, level)]
        for layer in range(min(level, self.entry_level), -1, -1):
            found = self._beam(q, start, beam, layer)
            chosen = self._diverse(found, self.most)
            self.near[layer][node, : len(chosen)] = chosen
            self.held[layer][node] = len(chosen)
            for other in chosen:
                self._link(layer, other, node)
            start = [i for _, i in found]
        if level > self.entry_level:
            self.entry, self.entry_level = node, level

    def _link(self, layer: int, node: int, other: int) -> None:
        held, most = self.held[layer][node], self.width[layer]
        if held < most:
            self.near[layer][node, held] = other
            self.held[layer][node] = held + 1
            return
        nodes = np.append(self.near[layer][node], other)
        d = self._apart(self.vectors[node], nodes)
        order = np.argsort(d, kind="stable")
        chosen = self._diverse(list(zip(d[order].tolist(), nodes[order].tolist())), most)
        self.near[layer][node, : len(chosen)] = chosen

    def search(self, q: np.ndarray, beam: int = SEARCH_BEAM) -> np.ndarray:
        """Nodes found near ``q``, nearest first."""
        if self.entry < 0:
            return np.empty(0, np.int64)
        with np.errstate(over="ignore"):  # a query far beyond all of the shard's numbers
            q = np.ldexp(np.asarray(q, np.float64), -self.exponent)
            start = self._closest(q, self.entry, self.entry_level, 0)
            return np.array([i for _, i in self._beam(q, [start], beam, 0)], np.int64)

    def packed(self) -> dict[str, bytes]:
        """The graph as flat arrays."""
        return {
            "near": b"".join(n.tobytes() for n in self.near),
            "held": b"".join(h.tobytes() for h in self.held),
            "shape": np.array([len(self.vectors), self.most, len(self.near), self.entry, self.entry_level]).tobytes(),
        }

    @classmethod
    def unpacked(cls, vectors: np.ndarray, near: bytes, held: bytes, shape: bytes) -> Graph:
        n, most, layers, entry, entry_level = np.frombuffer(shape, np.int64).tolist()
        graph = cls.__new__(cls)
        graph._hold(vectors)
        graph.most = most
        graph.width = [2 * most] + [most] * (layers - 1)
        ends = np.cumsum([0] + [n * w for w in graph.width])
        flat = np.frombuffer(near, np.int32)
        graph.near = [flat[a:b].reshape(n, -1) for a, b in zip(ends, ends[1:])]
        graph.held = list(np.frombuffer(held, np.int32).reshape(layers, n))
        graph.entry, graph.entry_level = entry, entry_level
        return graph


_INDEX = "dim int, shard int, n int, ids binary, copies binary, vectors binary, near binary, held binary, shape binary"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v``: vectors that are not null, empty or zero, of finite numbers only."""
    v = F.col(vector_col).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    fine = F.forall("v", finite) & F.exists("v", lambda x: x != 0)
    ids = F.col(id_col).cast("bigint").alias("vec_id")
    return vectors.select(ids, v.alias("v")).filter(F.col("vec_id").isNotNull() & (F.size("v") > 0) & fine)


def distinct_vectors(rows: DataFrame, copies: int) -> DataFrame:
    """``v, ids``: each different vector with its ``copies`` least ids, ascending.

    No more copies of a vector can be among that many nearest, as ties go to the least id.
    """
    # 0.0 and -0.0 are one number
    v = F.transform("v", lambda x: x + F.lit(0.0))
    keyed = rows.select("vec_id", v.alias("v")).withColumn("key", F.xxhash64("v"))
    order = Window.partitionBy("key", "v").orderBy("vec_id")
    least = keyed.distinct().withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= copies)
    return least.groupBy("key", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).drop("key")


def _build(group: pd.DataFrame) -> pd.DataFrame:
    ids = np.concatenate([np.asarray(i, np.int64) for i in group["ids"]])
    copies = np.array([len(i) for i in group["ids"]], np.int32)
    vectors = np.stack(group["v"].to_numpy())
    order = np.argsort([i[0] for i in group["ids"]], kind="stable")  # the same graph in every attempt
    begin = np.cumsum(copies) - copies
    ids = np.concatenate([ids[begin[i] : begin[i] + copies[i]] for i in order])
    vectors, copies = vectors[order], copies[order]
    graph = Graph(vectors).build()
    row = {
        "dim": group["dim"].iloc[0],
        "shard": group["shard"].iloc[0],
        "n": len(vectors),
        "ids": ids.tobytes(),
        "copies": copies.tobytes(),
        "vectors": vectors.astype(np.float64).tobytes(),
        **graph.packed(),
    }
    return pd.DataFrame([row])


def build_index(vectors: DataFrame, path: str, k: int, id_col: str, vector_col: str, shard: int = SHARD) -> DataFrame:
    """Write the table of shard graphs over every usable vector; vectors of each length apart."""
    spark = vectors.sparkSession
    nodes = distinct_vectors(usable(vectors, id_col, vector_col), k + 1)
    nodes = nodes.withColumn("dim", F.size("v"))
    nodes.write.parquet(f"{path}/nodes")
    nodes = spark.read.parquet(f"{path}/nodes")
    shards = nodes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"))
    dealt = nodes.join(shards, "dim").withColumn(
        "shard", F.pmod(F.xxhash64("v", F.lit(5)), F.col("shards")).cast("int")
    )
    tasks = shards.agg(F.sum("shards")).first()[0] or 1
    # a partition per shard and more, so that few shards meet in one task
    spread = dealt.repartition(4 * int(tasks), "dim", "shard")
    spread.groupBy("dim", "shard").applyInPandas(_build, _INDEX).write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def _answers(k: int, beam: int):
    """Answers of each graph to the query blocks that follow it in the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = ()
        for batch in batches:
            for i in range(len(batch)):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["block"] < 0:
                    vectors = np.frombuffer(row["vectors"]).reshape(row["n"], row["dim"])
                    graph = Graph.unpacked(vectors, row["near"], row["held"], row["shape"])
                    copies = np.frombuffer(row["copies"], np.int32)
                    begin = np.cumsum(copies) - copies
                    held = (graph, vectors, np.frombuffer(row["ids"], np.int64), begin, copies)
                    continue
                out: list[tuple[int, int, float]] = []
                for query in row["queries"]:
                    out += _one(*held, query, k, beam)
                columns = zip(*out) if out else ((), (), ())
                kinds = (pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], ["query_id", "vec_id", "score"]
                )

    return run


def _distances(vectors: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances; dividing by a power of two changes no digit, but saves the squares."""
    apart = vectors - q
    exponent = np.frexp(np.abs(apart).max(axis=1, initial=0.0))[1]
    apart = np.ldexp(apart, -exponent[:, None])
    return np.ldexp(np.sqrt((apart**2).sum(axis=1)), exponent)


def _one(graph, vectors, ids, begin, copies, query, k: int, beam: int) -> list[tuple[int, int, float]]:
    q = np.array(query["v"])
    found = graph.search(q, max(beam, k + 1))
    rows = [
        (float(s), int(i))
        for s, node in zip(_distances(vectors[found], q), found)
        for i in ids[begin[node] : begin[node] + copies[node]]
        if i != query["vec_id"]
    ]
    return [(query["vec_id"], i, s) for s, i in heapq.nsmallest(k, rows)]


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    beam: int = SEARCH_BEAM,
    shard: int = SHARD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest of ``vectors`` found for each of ``queries``, but for its own id.

    Returns ``query_id, rank, vec_id, score``; ranks go by distance, ties by the smaller id.
    Vectors that are null, empty, zero or hold a null or non-finite number take no part on
    either side, nor do null ids; vectors of different lengths are not compared. Repeated
    rows count once; of a query id with several vectors the least one asks. Every vector is
    indexed; the search is approximate.
    """
    spark = vectors.sparkSession
    path = scratch_path(spark, "ann")
    index = build_index(vectors, path, k, id_col, vector_col, shard)
    asked = usable(queries, id_col, vector_col).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked.withColumn("dim", F.size("v")).write.parquet(f"{path}/queries")
    asked = spark.read.parquet(f"{path}/queries")
    blocks = asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("blocks"))
    shards = index.groupBy("dim").agg((F.max("shard") + 1).alias("shards"))
    # the query set against all shards: a shard's graph, and after it the blocks of the lane
    sizes = blocks.join(shards, "dim").withColumn("lanes", F.ceil(F.col("blocks") / LANE).cast("int"))
    every = lambda end: F.explode(F.sequence(F.lit(0), F.col(end) - 1))
    graphs = index.join(sizes.select("dim", "lanes"), "dim")
    graphs = graphs.select(*index.columns, every("lanes").alias("lane")).withColumn("block", F.lit(-1).cast("bigint"))
    placed = asked.join(sizes, "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    packed = placed.groupBy("dim", "shards", "lanes", "block").agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
    sent = packed.select(
        "dim", every("shards").alias("shard"), F.pmod("block", "lanes").cast("int").alias("lane"), "block", "queries"
    )
    tasks = sizes.agg(F.sum(F.col("shards") * F.col("lanes"))).first()[0] or 1
    met = graphs.unionByName(sent, allowMissingColumns=True)
    met = met.repartition(2 * int(tasks), "dim", "shard", "lane").sortWithinPartitions("dim", "shard", "lane", "block")
    names = ["dim", "block", "n", "ids", "copies", "vectors", "near", "held", "shape", "queries"]
    answers = met.select(*names).mapInArrow(_answers(k, beam), "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

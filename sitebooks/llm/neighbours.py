"""Approximate nearest neighbours: a navigable small-world graph per shard."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a shard; links per node (twice as many on the ground level); width of the search while building and asking.
SHARD, LINKS, BUILD, SEARCH = 8192, 16, 100, 200


class Graph:
    """A hierarchical navigable small-world graph of unit vectors in flat neighbour arrays.

    ``near[level]`` has a row of neighbour numbers per node, filled with -1.
    Levels are drawn from a fixed seed, so a rebuilt shard is the same graph.
    """

    def __init__(self, vectors: np.ndarray, links: int = LINKS, build: int = BUILD, seed: int = 1):
        norms = np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)
        self.x = (vectors / norms).astype(np.float32)
        n = len(vectors)
        draw = np.random.default_rng(seed).random(n)
        self.level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(links)).astype(int), 8)
        self.width = [2 * links, *[links] * 8]
        self.near = [np.full((n, w), -1, np.int32) for w in self.width[: int(self.level.max(initial=0)) + 1]]
        self.size = [np.zeros(n, np.int32) for _ in self.near]
        self.seen, self.turn = np.zeros(n, np.int32), 0
        self.entry = -1
        for i in range(n):
            self._insert(i, build)

    def _search(self, q: np.ndarray, entries: list[tuple[float, int]], width: int, level: int) -> list[tuple[float, int]]:
        """The best ``width`` found on a level from the entries, as (similarity, node), unordered."""
        self.turn += 1
        seen, turn, near, size, x = self.seen, self.turn, self.near[level], self.size[level], self.x
        best = list(entries)
        heapq.heapify(best)
        todo = [(-s, i) for s, i in entries]
        heapq.heapify(todo)
        seen[[i for _, i in entries]] = turn
        push, swap, pop = heapq.heappush, heapq.heappushpop, heapq.heappop
        while todo:
            s, c = pop(todo)
            if len(best) >= width and -s < best[0][0]:
                break
            nodes = near[c, : size[c]]
            nodes = nodes[seen[nodes] != turn]
            if not len(nodes):
                continue
            seen[nodes] = turn
            sims = x[nodes] @ q
            if len(best) >= width:
                some = sims > best[0][0]
                nodes, sims = nodes[some], sims[some]
            for sim, node in zip(sims.tolist(), nodes.tolist()):
                if len(best) < width:
                    push(best, (sim, node))
                    push(todo, (-sim, node))
                elif sim > best[0][0]:
                    swap(best, (sim, node))
                    push(todo, (-sim, node))
        return best

    def _choose(self, nodes: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Neighbours in different directions: one nearer to a chosen one than to the node waits."""
        order = np.argsort(-sims, kind="stable")
        nodes, sims = nodes[order], sims[order]
        if len(nodes) <= most // 2:
            return nodes
        among = self.x[nodes] @ self.x[nodes].T
        shadow = np.full(len(nodes), -2.0, np.float32)
        taken, waiting = [], []
        for i, s in enumerate(sims.tolist()):
            if shadow[i] < s:
                taken.append(i)
                if len(taken) == most:
                    break
                np.maximum(shadow, among[i], out=shadow)
            else:
                waiting.append(i)
        return nodes[np.array((taken + waiting)[:most])]

    def _insert(self, i: int, build: int) -> None:
        if self.entry < 0:
            self.entry = i
            return
        q, top = self.x[i], int(self.level[self.entry])
        best = [(float(self.x[self.entry] @ q), self.entry)]
        for level in range(top, -1, -1):
            if level > self.level[i]:
                best = [max(self._search(q, best, 1, level))]
                continue
            best = self._search(q, best, build, level)
            sims, nodes = np.array([b[0] for b in best], np.float32), np.array([b[1] for b in best])
            near, size, width = self.near[level], self.size[level], self.width[level]
            chosen = self._choose(nodes, sims, width // 2 if level == 0 else width)
            near[i, : len(chosen)], size[i] = chosen, len(chosen)
            for c in chosen.tolist():
                k = int(size[c])
                if k < width:
                    near[c, k], size[c] = i, k + 1
                else:
                    others = np.append(near[c], np.int32(i))
                    kept = self._choose(others, self.x[others] @ self.x[c], width)
                    near[c, : len(kept)], size[c] = kept, len(kept)
        if self.level[i] > top:
            self.entry = i

    def find(self, vector: np.ndarray, width: int) -> list[int]:
        """Nodes near a vector, nearest first."""
        q = (vector / np.linalg.norm(vector.astype(np.float64))).astype(np.float32)
        best = [(float(self.x[self.entry] @ q), self.entry)]
        for level in range(int(self.level[self.entry]), 0, -1):
            best = [max(self._search(q, best, 1, level))]
        found = self._search(q, best, width, 0)
        return [i for _, i in sorted(found, reverse=True)]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of one vector with rows of others, in double precision."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return (b @ a) / (np.sqrt((b * b).sum(1)) * np.sqrt((a * a).sum()))


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id`` and ``v`` (floats) of the rows that can be compared: an id, finite components, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col(vec_id).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).select(
        F.col(vec_id).cast("long").alias("id"), v.cast("array<double>").alias("v")
    )


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard: int = SHARD,
    links: int = LINKS,
    build: int = BUILD,
    search: int = SEARCH,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each query row, its own row left out.

    Equal vectors are one entry with their smallest k + 1 ids, which is all a
    result can name, so a vector of very many rows is neither a hot key nor a
    knot in a graph.  Entries are dealt by a hash to shards of about ``shard``;
    each shard's graph is built in one task from a fixed seed and the queries,
    read as a stream, are searched in it.  Scores are cosines of the original
    vectors in double precision; the shards' answers are merged by score, ties
    to the smaller id.  Only vectors of one length are compared.

    Rows with a null id or with a null, zero, empty, or not finite vector take
    no part; a repeated id is asked and named once, with its best score; a query
    leaves out all rows of its id; fewer candidates give fewer rows; other columns are ignored.
    """
    rows = usable(vectors, vec_id, vector)
    order = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    entries = few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    total = rows.count()
    shards = max(1, -(-total // shard))
    place = F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int")
    asked = usable(queries, vec_id, vector).distinct().select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.array("id").alias("ids"), "v", F.lit(1).alias("ask")
    )
    both = entries.select(place.alias("shard"), "ids", "v", F.lit(0).alias("ask")).union(asked)
    both = both.withColumn("dim", F.size("v"))

    def run(batches):
        at, graph, owned, held_v, held_ids = None, None, None, [], []

        def answer(ids, vecs):
            out = ([], [], [])
            for own, v in zip(ids, vecs):
                found = np.array(graph.find(v, search))
                scores = cosine(v, owned[0][found])
                best = sorted(
                    (-s, i) for s, f in zip(scores.tolist(), found.tolist()) for i in owned[1][f] if i != own[0]
                )[:k]
                for s, i in best:
                    out[0].append(own[0])
                    out[1].append(i)
                    out[2].append(-s)
            return pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                names=["query_id", "vec_id", "score"],
            )

        for batch in batches:
            shard_of, ids, vecs, ask, dim = (c for c in batch.columns)
            keys = list(zip(shard_of.to_pylist(), dim.to_pylist()))
            asks, ids = ask.to_pylist(), ids.to_pylist()
            flat, edge = vecs.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(dim.to_numpy())]
            pending = ([], [])
            for j, key in enumerate(keys):
                v = flat[edge[j] : edge[j + 1]]
                if key != at:
                    if pending[0]:
                        yield answer(*pending)
                        pending = ([], [])
                    at, graph, owned, held_v, held_ids = key, None, None, [], []
                if not asks[j]:
                    held_v.append(v.copy())
                    held_ids.append(ids[j])
                    continue
                if owned is None and held_v:
                    owned = (np.stack(held_v), held_ids)
                    graph = Graph(owned[0], links, build)
                if owned is not None:
                    pending[0].append(ids[j])
                    pending[1].append(v)
            if pending[0]:
                yield answer(*pending)

    dealt = both.repartition(4 * shards, "shard", "dim").sortWithinPartitions("shard", "dim", "ask")
    found = dealt.select("shard", "ids", "v", "ask", "dim").mapInArrow(run, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    merged = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(merged)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Exact top-k inner-product search: branch and bound on one ball tree per shard.

Candidates are dealt into shards of at most about ``shard_rows``, queries into blocks of ``block_queries``; a cell is
one shard with one block, so a task holds a bounded number of rows of both. Within a cell a query visits the nodes of
the shard's ball tree in the order of their upper bound ``q . center + |q| radius`` and stops at the first bound below
the current kth score. All blocks search a pilot shard first; its kth score is a lower bound of the final one and is
shared with the searches of all other shards. Nothing is approximate: a shard's answers are merged by (score, id).

Defined results: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows without
an id; vectors are compared to those of the same length only; rows that share the query's id are its own; repeated
candidate rows each count; repeated query rows count once; ties go to the smaller id; an empty table gives an empty
result; extra columns are ignored. Scores are 64-bit integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagwise.session import materialize
from tagwise.sources.tables import table

K = 5
SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
LEAF = 64


class BallTree:
    """Nodes in arrays: center, radius, children; leaves hold positions of the rows."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.centers: list[np.ndarray] = []
        self.radii: list[float] = []
        self.children: list[tuple[int, int] | None] = []
        self.leaves: list[np.ndarray | None] = []
        todo = [(np.arange(len(rows)), -1, 0)]
        while todo:
            idx, parent, side = todo.pop()
            node = len(self.radii)
            if parent >= 0:
                pair = list(self.children[parent] or (-1, -1))
                pair[side] = node
                self.children[parent] = (pair[0], pair[1])
            x = rows[idx]
            center = x.mean(axis=0)
            far = ((x - center) ** 2).sum(axis=1)
            self.centers.append(center)
            self.radii.append(float(np.sqrt(far.max())))
            self.children.append(None)
            self.leaves.append(idx)
            if len(idx) > LEAF and far.max() > 0:
                a = x[int(far.argmax())]
                b = x[int(((x - a) ** 2).sum(axis=1).argmax())]
                order = np.argsort(x @ (b - a), kind="stable")
                half = len(idx) // 2
                self.leaves[node] = None
                todo += [(idx[order[:half]], node, 0), (idx[order[half:]], node, 1)]
        self.center = np.array(self.centers)
        self.radius = np.array(self.radii)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        ub = queries @ self.center.T + np.sqrt((queries**2).sum(axis=1))[:, None] * self.radius[None, :]
        return ub + 1e-9 * np.abs(ub) + 1.0  # never below the exact bound: scores are integers

    def search(self, q: np.ndarray, bound: np.ndarray, score, ids: np.ndarray, own: int, k: int, floor: float) -> list[tuple[int, int]]:
        """The k best (score, id) of this tree for ``q``; rows that cannot reach ``floor`` may be left out."""
        best: list[tuple[int, int]] = []  # heap of (score, -id): the worst on top
        heap = [(-bound[0], 0)]
        while heap:
            ub, node = heapq.heappop(heap)
            if -ub < floor:
                break
            if self.leaves[node] is None:
                for child in self.children[node] or ():
                    if bound[child] >= floor:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            idx = self.leaves[node]
            s = score(idx, q)
            for i in np.flatnonzero(s >= floor).tolist():
                item = (int(s[i]), -int(ids[idx[i]]))
                if -item[1] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                floor = max(floor, best[0][0])
        return [(s, -i) for s, i in best]


def _scores(rows: np.ndarray, top: int):
    """Exact integer inner products: by doubles while all sums stay below 2^53, else by 64-bit integers."""
    if top * top * max(1, rows.shape[1]) < 1 << 53:
        dense = rows.astype(np.float64)
        return lambda idx, q: dense[idx] @ q
    return lambda idx, q: rows[idx] @ q.astype(np.int64)


def _answer(data: list[tuple[int, np.ndarray]], queries: list[tuple[int, np.ndarray, float]], k: int) -> Iterator[tuple[int, bytes, int, int]]:
    by_length: dict[int, list[tuple[int, np.ndarray]]] = {}
    for item in data:
        by_length.setdefault(len(item[1]), []).append(item)
    for d, own in by_length.items():
        asked = [q for q in queries if len(q[1]) == d]
        if not asked:
            continue
        ids, rows = np.array([i for i, _ in own], np.int64), np.stack([v for _, v in own])
        qs = np.stack([v for _, v, _ in asked])
        top = max(int(np.abs(rows).max()), int(np.abs(qs).max()))
        tree, score = BallTree(rows.astype(np.float64)), _scores(rows, top)
        exact = qs.astype(np.float64) if top * top * d < 1 << 53 else qs
        for at in range(0, len(asked), 256):
            bounds = tree.bounds(qs[at : at + 256].astype(np.float64))
            for j, (query, v, floor) in enumerate(asked[at : at + 256]):
                for s, i in tree.search(exact[at + j], bounds[j], score, ids, query, k, floor):
                    yield query, v.tobytes(), i, s


FOUND = "query_id long, q binary, vec_id long, score long"


def _search_cells(cells: DataFrame, k: int) -> DataFrame:
    """Cells of rows ``(cell, role, vec_id, v, floor)``; role 0: candidate, 1: query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, data, queries = None, [], []

        def out() -> pa.RecordBatch:
            found = list(_answer(data, queries, k)) if data and queries else []
            cols = list(zip(*found, strict=True)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["query_id", "q", "vec_id", "score"])

        for b in batches:
            for c, role, i, v, floor in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if c != cell:
                    if cell is not None:
                        yield out()
                    cell, data, queries = c, [], []
                v = np.frombuffer(v, np.int64)
                data.append((i, v)) if role == 0 else queries.append((i, v, -np.inf if floor is None else floor))
        if cell is not None:
            yield out()

    return cells.repartition("cell").sortWithinPartitions("cell", "role").mapInArrow(run, FOUND)


def valid(v: Column) -> Column:
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(ok, F.lit(False))


def quantise(rows: DataFrame, scale: int = 256) -> DataFrame:
    """``(vec_id, embedding)`` -> ``(vec_id, v binary)`` of 64-bit integers floor(scale * x); invalid rows go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(1)
            flat, ends = np.floor(scale * v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64), v.value_lengths().to_numpy()
            raw, at, out = flat.tobytes(), 0, []
            for n in ends.tolist():
                out.append(raw[8 * at : 8 * (at + n)])
                at += n
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["vec_id", "v"])

    good = rows.where(F.col("vec_id").isNotNull() & valid(F.col("embedding")))
    return good.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, "vec_id long, v binary")


def top_k(rows: DataFrame, queries: Column, k: int = K, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``(vec_id, embedding)`` -> ``(query_id, rank, vec_id, score)`` for the rows that satisfy ``queries``."""
    data = materialize(quantise(rows))
    n = data.count()
    asked = data.where(queries).dropDuplicates(["vec_id", "v"])
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-asked.count() // block_queries))
    data = data.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)))
    each_block, no_floor = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")), F.lit(None).cast("double")
    cell = lambda shard, block: (shard * blocks + block).alias("cell")

    def candidates(part: DataFrame) -> DataFrame:
        return part.withColumn("block", F.explode(each_block)).select(
            cell(F.col("shard"), F.col("block")), F.lit(0).alias("role"), "vec_id", "v", no_floor.alias("floor")
        )

    pilot = candidates(data.where("shard = 0")).union(
        asked.select(cell(F.lit(0), F.col("block")), F.lit(1).alias("role"), "vec_id", "v", no_floor.alias("floor"))
    )
    first = materialize(_search_cells(pilot, k))
    if shards > 1:
        kth = first.groupBy("query_id", "q").agg(F.min("score").cast("double").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
        known = asked.join(kth, (asked["vec_id"] == kth["query_id"]) & (asked["v"] == kth["q"]), "left")
        others = F.sequence(F.lit(1).cast("long"), F.lit(shards - 1).cast("long"))
        rest = candidates(data.where("shard > 0")).union(
            known.withColumn("shard", F.explode(others)).select(cell(F.col("shard"), F.col("block")), F.lit(1).alias("role"), "vec_id", "v", "floor")
        )
        first = first.union(_search_cells(rest, k))
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), F.col("vec_id"))
    return first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)

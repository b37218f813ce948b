"""SimHash near-duplicates: fingerprints of word shingles, linked through BK-trees of fingerprint shards.

1. ``fingerprints``: one 64-bit SimHash per text (Arrow batches, whole texts).
2. Equal fingerprints are merged first, so a group of copies of any size is one node.
3. ``shard_links``: fingerprints are sharded by their bits so that a shard holds about ``TREE_ROWS`` of them. 64 bits are
   cut into ``distance + g`` blocks; two fingerprints that differ in at most ``distance`` bits agree on at least g whole
   blocks, so they meet in the shard of those g blocks' leading bits. g is 1 and grows to 2 when single blocks have too
   few bits for the table. Every shard has a BK-tree (children keyed by the integer Hamming distance to the parent,
   children of up to ``LEAF`` fingerprints kept as a bucket of that one distance), searched by the shard's
   fingerprints along the edges within the radius only. A shard of more than ``shard_rows`` is cut into several
   trees, and each is sent to the fingerprints of the shard's other parts (nothing is broadcast to all: shard trees
   have a bounded size, the number of shards grows with the data).
4. Links of a shard are thinned to a spanning forest (they only serve reachability), then ``connected_components``.

Defined results: null and empty texts have no words and fingerprint zero, which links like any other; texts with
fewer words than a shingle use their whole word sequence; equal rows share a component; rows without an id take part
and get the smallest non-null id of their component (null if there is none); an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwise.llm.components import connected_components
from tagwise.session import materialize
from tagwise.sources.tables import table

SHINGLE = 4
DISTANCE = 4
SEED = 42
LEAF = 32  # largest child of a BK-tree node that stays a bucket: all at one distance from the parent, compared directly
TREE_ROWS = 16_384  # fingerprints of one shard, aimed at by the number of key bits
SHARD_ROWS = 2 * TREE_ROWS  # a shard beyond that is cut into several trees
BLOCK = 2_048  # queries that walk a tree at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text; bytes.lower and bytes.split treat just A-Z and just ASCII white space, as asked for."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), grams), dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carried: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, text, carried)`` -> ``(doc_id, fp long, carried)``; fp holds the 64 bits as a signed long, the
    ``carried`` columns are longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in b.column(1).to_pylist()), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", *carried])

    schema = ", ".join(["doc_id long, fp long", *(f"{c} long" for c in carried)])
    return docs.select(F.col("doc_id").cast("long"), "text", *carried).mapInArrow(run, schema)


def shard_keys(distance: int, rows: int, tree_rows: int = TREE_ROWS) -> list[list[tuple[int, int]]]:
    """Bits of each shard key as (shift, width) parts, for ``rows`` fingerprints; one key without bits: a single shard."""
    bits = ceil(log2(rows / tree_rows)) if rows > tree_rows else 0
    if not bits:
        return [[]]
    for agree in (1, 2):
        n = distance + agree
        if bits <= agree * (64 // n) or agree == 2:
            break
    cuts = [64 * i // n for i in range(n + 1)]
    widths = [min(64 // n, (bits + i) // agree) for i in range(agree)]
    return [[(cuts[i], w) for i, w in zip(which, widths, strict=True)] for which in combinations(range(n), agree)]


def _shards(fps: DataFrame, plan: list[list[tuple[int, int]]]) -> DataFrame:
    """``(shard, fp)``: each fingerprint once per key; shard = (key number, the key's bits)."""
    keys = []
    for i, parts in enumerate(plan):
        bits = F.lit(i).cast("long")
        for shift, width in parts:
            bits = F.shiftleft(bits, width).bitwiseOR(F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)))
        keys.append(bits)
    return fps.select(F.explode(F.array(*keys)).alias("shard"), "fp")


class BKTree:
    """BK-tree over distinct fingerprints. A node has a pivot and children keyed by their Hamming distance to it; a child
    of up to LEAF fingerprints is a bucket of that distance. ``followed`` and ``skipped`` count (query, edge) pairs."""

    def __init__(self, fps: np.ndarray, idx: np.ndarray | None = None):
        self.fps, self.idx = fps, np.arange(len(fps)) if idx is None else idx
        self.pivot, rest = int(self.idx[0]), self.idx[1:]
        d = np.bitwise_count(fps[rest] ^ fps[self.pivot])
        order = np.argsort(d, kind="stable")
        keys, at = np.unique(d[order], return_index=True)
        parts = np.split(rest[order], at[1:]) if len(keys) else []
        self.children = {int(k): BKTree(fps, part) if len(part) > LEAF else part for k, part in zip(keys, parts, strict=True)}
        self.followed = self.skipped = 0

    def search(self, queries: np.ndarray, q: np.ndarray, radius: int, hit, alike) -> None:
        """``hit(a, b)`` gets arrays of query and tree positions within ``radius``. ``alike(q, idx)`` returns the
        queries that can still learn something below this node (others already share its component)."""
        q = alike(q, self.idx)
        if not len(q):
            return
        d = np.bitwise_count(queries[q] ^ self.fps[self.pivot]).astype(np.int64)
        near = q[d <= radius]
        hit(near, np.full(len(near), self.pivot))
        for k, child in self.children.items():
            down = q[np.abs(d - k) <= radius]
            self.followed += len(down)
            self.skipped += len(q) - len(down)
            if isinstance(child, BKTree):
                child.search(queries, down, radius, hit, alike)
            elif len(down):
                a, b = np.nonzero(np.bitwise_count(queries[down][:, None] ^ self.fps[child][None, :]) <= radius)
                hit(down[a], child[b])

    def edges(self) -> tuple[int, int]:
        """(query, edge) pairs followed and skipped in the whole tree."""
        below = [c.edges() for c in self.children.values() if isinstance(c, BKTree)]
        return self.followed + sum(f for f, _ in below), self.skipped + sum(s for _, s in below)


class _Forest:
    """Union-find over one shard's positions; keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.parent, self.links = np.arange(n), []

    def root(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = int(p[x])
        return x

    def roots(self, x: np.ndarray) -> np.ndarray:
        x = self.parent[x]
        while not np.array_equal(up := self.parent[x], x):
            x = up
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        ra, rb = self.roots(a), self.roots(b)
        new = np.flatnonzero(ra != rb)
        if not len(new):
            return
        ends = np.stack([np.minimum(ra[new], rb[new]), np.maximum(ra[new], rb[new])])
        _, first = np.unique(ends, axis=1, return_index=True)  # one link for each pair of trees
        for i in new[first].tolist():
            rx, ry = self.root(int(ra[i])), self.root(int(rb[i]))
            if rx != ry:
                self.parent[max(rx, ry)] = min(rx, ry)
                self.links.append((int(a[i]), int(b[i])))

    def flat(self) -> np.ndarray:
        while not np.array_equal(up := self.parent[self.parent], self.parent):
            self.parent = up
        return self.parent


def shard_forest(fps: np.ndarray, radius: int, other: np.ndarray | None = None, tree: BKTree | None = None) -> list[tuple[int, int]]:
    """Spanning links (pairs of fingerprints) among ``fps``, or between ``fps`` (the tree) and ``other`` (queries)."""
    tree, n = tree or BKTree(fps), len(fps)
    queries = fps if other is None else other
    every = fps if other is None else np.concatenate([fps, other])
    off = 0 if other is None else n
    forest = _Forest(len(every))
    i, block = 0, 64  # blocks of queries grow: the first ones join dense groups, whose subtrees later ones skip
    while i < len(queries):
        flat = forest.flat().copy()

        def alike(q: np.ndarray, idx: np.ndarray, flat: np.ndarray = flat) -> np.ndarray:
            own = flat[idx]
            return q[flat[q + off] != own[0]] if (own == own[0]).all() else q

        tree.search(queries, np.arange(i, min(i + block, len(queries))), radius, lambda a, b: forest.join(a + off, b), alike)
        i, block = i + block, min(2 * block, BLOCK)
    return [(int(every[x]), int(every[y])) for x, y in forest.links]


def _sorted_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Groups of whole key runs from batches sorted by the first ``keys`` columns: (columns, run starts)."""
    held: list[np.ndarray] | None = None

    def starts(cols: list[np.ndarray]) -> np.ndarray:
        new = np.ones(len(cols[0]), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:keys]])
        return np.flatnonzero(new)

    for b in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
        if not len(cols[0]):
            continue
        s = starts(cols)
        last = s[-1]
        if last:
            yield [c[:last] for c in cols], s[:-1]
        held = [c[last:] for c in cols]
    if held is not None and len(held[0]):
        yield held, starts(held)


def _edge_batch(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a = np.concatenate([p[0] for p in pairs] or [np.zeros(0, np.uint64)]).astype(np.uint64).view(np.int64)
    b = np.concatenate([p[1] for p in pairs] or [np.zeros(0, np.uint64)]).astype(np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def shard_links(fps: DataFrame, distance: int = DISTANCE, shard_rows: int = SHARD_ROWS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``(fp)`` that suffice for reachability."""
    n = fps.count()
    plan = shard_keys(distance, n, tree_rows)
    shards = _shards(fps, plan)
    count = len(plan) * 2 ** sum(w for _, w in plan[0])  # tasks: at most one for a shard, at least some for each core
    tasks = min(count, max(4 * fps.sparkSession.sparkContext.defaultParallelism, n * len(plan) // (4 * TREE_ROWS)))
    # the number of trees of each shard: 1 but for the hot ones
    trees = shards.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).alias("trees")).where("trees > 1")
    hot = shards.join(trees, "shard").withColumn("tree", F.pmod(F.xxhash64("fp"), F.col("trees")))
    cold = shards.join(trees, "shard", "left_anti")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, fp), start in _sorted_runs(batches, 1):
            u, out = fp.view(np.uint64), []
            for s, e in zip(start.tolist(), np.append(start[1:], len(u)).tolist(), strict=True):
                if e - s > 1:
                    links = shard_forest(u[s:e], distance)
                    out.append((np.array([x for x, _ in links], np.uint64), np.array([y for _, y in links], np.uint64)))
            yield _edge_batch(out)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, part, fp), start in _sorted_runs(batches, 2):
            u, out = fp.view(np.uint64), []
            for s, e in zip(start.tolist(), np.append(start[1:], len(u)).tolist(), strict=True):
                own = part[s:e] == 0
                if own.all() or not own.any():
                    continue
                links = shard_forest(u[s:e][own], distance, u[s:e][~own])
                out.append((np.array([x for x, _ in links], np.uint64), np.array([y for _, y in links], np.uint64)))
            yield _edge_batch(out)

    near = cold.repartition(tasks, "shard").sortWithinPartitions("shard").mapInArrow(within, "a long, b long")
    # a hot shard: each part has a tree, searched by itself and by every later part in pieces of at most a tree's size
    own = hot.select("shard", "tree", "fp")
    inside = (
        own.select(F.xxhash64("shard", "tree").alias("shard"), "fp").repartition("shard").sortWithinPartitions("shard").mapInArrow(within, "a long, b long")
    )
    meet = hot.where("tree < trees - 1").select(
        "shard", F.explode(F.sequence(F.col("tree") + 1, F.col("trees") - 1)).alias("by"), F.col("tree").alias("of"), F.lit(0).alias("part"), "fp"
    )
    ask = hot.where("tree > 0").select(
        "shard", F.col("tree").alias("by"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("tree") - 1)).alias("of"), F.lit(1).alias("part"), "fp"
    )
    cells = meet.union(ask).select(F.xxhash64("shard", "of", "by").alias("cell"), "shard", "part", "fp")
    across = cells.repartition("cell").sortWithinPartitions("cell", "shard", "part").mapInArrow(between, "a long, b long")
    return near.union(inside).union(across).distinct()


def _components(distinct: DataFrame, distance: int) -> DataFrame:
    """``(fp, least)`` of distinct fingerprints -> ``(fp, least, component)``; component = smallest fingerprint."""
    distinct = materialize(distinct)
    comps = connected_components(shard_links(distinct.select("fp"), distance))
    named = distinct.join(comps, distinct["fp"] == comps["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    return materialize(named)


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, fp, component_id)``: one row per input row."""
    prints = materialize(fingerprints(docs, shingle))
    named = _components(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), distance)
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    label = named.join(smallest, "component").select("fp", "component_id")
    return prints.join(label, "fp", "left").select("doc_id", "fp", "component_id")


def simhash_kept(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``(doc_id, text, row_key long)`` -> ``(row_key)``: one row of each component, the one with the smallest
    (doc_id with nulls last, hash of the text, row_key)."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), "row_key")
    prints = materialize(fingerprints(rows, shingle, ("text_hash", "row_key")))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "row_key")
    named = _components(prints.groupBy("fp").agg(F.min(order).alias("least")), distance)
    return named.groupBy("component").agg(F.min("least").alias("least")).select("least.row_key")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

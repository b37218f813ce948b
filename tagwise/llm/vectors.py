"""Embedding near-dedup by PCA-ordered tiled comparison.

Equal vectors are merged first (a class has one representative and a size). Representatives are scaled to unit length
and turned into the principal axes of all of them, so that leading dimensions carry most of every product. They are
sorted by the first axis into tiles of about ``tile_rows``; two unit vectors with cosine c are at most sqrt(2 - 2c)
apart, so tiles whose ranges on the first axis are further apart are never compared. A cell compares two tiles in
blocks: products over the leading dimensions are accumulated first, the rest is bounded by the product of both suffix
norms, and a pair is given up as soon as it cannot reach the threshold. Survivors are decided by the cosine of the
original vectors in double precision.

A cell returns each representative's number of linked vectors and a spanning forest of the links, never the pairs, so
dense groups cost no output. Links are counted with the sizes of the classes.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors
of different length do not link; equal vectors link; equal rows are separate vectors; rows without an id count as
linked vectors, get the smallest non-null id of their component, and are never kept; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwise.llm.balltree import valid
from tagwise.llm.components import connected_components
from tagwise.session import materialize
from tagwise.sources.tables import table

THRESHOLD = 0.95
TILE_ROWS = 4096
BLOCK = 1024
STEP = 16  # dimensions accumulated between two looks at the bound


def unit(v: np.ndarray) -> np.ndarray:
    """Rows at unit length; scaled by the largest component first, so that no square overflows."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _matrix(column: Any, width: int) -> np.ndarray:
    """Binary column of doubles as a matrix; shorter vectors are padded with zeros."""
    out = np.zeros((len(column), width))
    for i, raw in enumerate(column.to_pylist()):
        out[i, : len(raw) // 8] = np.frombuffer(raw, np.float64)
    return out


def principal_axes(classes: DataFrame, width: int) -> np.ndarray:
    """Eigenvectors of the second moments of the unit vectors, largest first. Sums are added up by Spark."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in batches:
            u = unit(_matrix(b.column(0), width))
            total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], names=["i", "x"])

    sums = classes.select("v").mapInArrow(moments, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    total = np.zeros(width * width)
    for r in sums:
        total[r["i"]] = r["x"]
    values, axes = np.linalg.eigh(total.reshape(width, width))
    return np.ascontiguousarray(axes[:, np.argsort(-values)])


class _Tile:
    def __init__(self, cid: np.ndarray, size: np.ndarray, v: list[bytes], axes: np.ndarray):
        self.cid, self.size = cid, size
        self.dims = np.array([len(x) // 8 for x in v])
        self.v = np.zeros((len(v), axes.shape[0]))
        for i, x in enumerate(v):
            self.v[i, : self.dims[i]] = np.frombuffer(x, np.float64)
        turned = unit(self.v) @ axes
        tail = np.cumsum((turned**2)[:, ::-1], axis=1)[:, ::-1]
        self.turned = turned.astype(np.float32)
        self.suffix = np.sqrt(np.concatenate([tail, np.zeros((len(v), 1))], axis=1)).astype(np.float32)
        self.links = np.zeros(len(v), np.int64)


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def block_pairs(x: _Tile, y: _Tile, rows: slice, cols: slice, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs (positions in x, in y) of one block, in portions."""
    width, slack = x.turned.shape[1], 1e-5
    step = min(STEP, width)
    dot = x.turned[rows, :step] @ y.turned[cols, :step].T
    i, j = np.nonzero(dot + x.suffix[rows, step][:, None] * y.suffix[cols, step][None, :] >= threshold - slack)
    i, j, part = i + rows.start, j + cols.start, dot[i, j]
    for at in range(0, len(i), 1 << 16):
        a, b, s = i[at : at + (1 << 16)], j[at : at + (1 << 16)], part[at : at + (1 << 16)]
        done = step
        while done < width and len(a):
            stop = min(done + STEP, width)
            s = s + np.einsum("ij,ij->i", x.turned[a, done:stop], y.turned[b, done:stop])
            done = stop
            alive = s + x.suffix[a, done] * y.suffix[b, done] >= threshold - slack
            a, b, s = a[alive], b[alive], s[alive]
        if len(a):
            alive = (_cosine(x.v[a], y.v[b]) >= threshold) & (x.dims[a] == y.dims[b])
            yield a[alive], b[alive]


def compare(x: _Tile, y: _Tile | None, threshold: float, block: int = BLOCK) -> list[tuple[int, int]]:
    """Count links of both tiles (of one tile with itself if ``y`` is None) and return a spanning forest of them."""
    same, y = y is None, x if y is None else y
    n, off = len(x.cid), 0 if same else len(x.cid)
    parent = np.arange(n if same else n + len(y.cid))
    forest: list[tuple[int, int]] = []

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = int(parent[k])
        return k

    for r in range(0, n, block):
        for c in range(r if same else 0, len(y.cid), block):
            for a, b in block_pairs(x, y, slice(r, min(r + block, n)), slice(c, min(c + block, len(y.cid))), threshold):
                if same:
                    a, b = a[a < b], b[a < b]
                x.links += np.bincount(a, y.size[b], len(x.links)).astype(np.int64)
                y.links += np.bincount(b, x.size[a], len(y.links)).astype(np.int64)
                while not np.array_equal(up := parent[parent], parent):
                    parent = up
                new = parent[a] != parent[b + off]
                for p, q in zip(a[new].tolist(), b[new].tolist(), strict=True):
                    rp, rq = root(p), root(q + off)
                    if rp != rq:
                        parent[max(rp, rq)] = min(rp, rq)
                        forest.append((int(x.cid[p]), int(y.cid[q])))
    return forest


def _tiles(classes: DataFrame, axes: np.ndarray, tile_rows: int, threshold: float) -> DataFrame:
    """``(cid, size, v, tile, first, last)``: each representative's tile and the tiles it must be compared to."""
    width = len(axes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u = unit(_matrix(b.column(2), width)) @ axes[:, 0]
            # the tiny shift by id tells vectors apart that agree on the first axis, so that no tile is too large
            u = u + 1e-9 * ((b.column(0).to_numpy() * 2654435761 % 1000003) / 1000003)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(u)], names=["cid", "size", "v", "at"])

    placed = materialize(classes.select("cid", "size", "v").mapInArrow(place, "cid long, size long, v binary, at double"))
    tiles = max(1, math.ceil(placed.count() / tile_rows))
    # one number per tile reaches the driver
    cuts = placed.approxQuantile("at", [i / tiles for i in range(1, tiles)], 0.1 / tiles) if tiles > 1 else []
    low, high, reach = np.array([-2.0, *cuts]), np.array([*cuts, 2.0]), math.sqrt(2 - 2 * threshold) + 1e-6
    first = np.searchsorted(high, low - reach, "left").tolist()
    last = (np.searchsorted(low, high + reach, "right") - 1).tolist()
    edges = np.array(cuts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = np.searchsorted(edges, b.column(3).to_numpy(), "right")
            near = [pa.array([x[i] for i in t.tolist()], pa.int32()) for x in (first, last)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(t.astype(np.int32)), *near], names=["cid", "size", "v", "tile", "first", "last"])

    return placed.mapInArrow(deal, "cid long, size long, v binary, tile int, first int, last int")


CELL_OUT = "cid long, links long, other long"


def link_classes(classes: DataFrame, width: int, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(cid, size, v)`` -> ``(cid, links, other)``: link counts (other null) and forest links (links null)."""
    axes = principal_axes(classes, width)
    tiles = _tiles(classes, axes, tile_rows, threshold)
    pair = F.explode(F.sequence("first", "last")).alias("with")
    cells = tiles.select("cid", "size", "v", "tile", pair).select(
        F.concat_ws(":", F.least("tile", "with"), F.greatest("tile", "with")).alias("cell"), "tile", "cid", "size", "v"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, {}

        def out() -> pa.RecordBatch:
            tiles = [_Tile(np.array([r[0] for r in t]), np.array([r[1] for r in t]), [r[2] for r in t], axes) for t in held.values()]
            low, high = cell.split(":")
            forest = compare(tiles[0], None if low == high else tiles[1], threshold) if low == high or len(tiles) == 2 else []
            cid = np.concatenate([t.cid[t.links > 0] for t in tiles])
            links = np.concatenate([t.links[t.links > 0] for t in tiles])
            a, b = ([p[k] for p in forest] for k in (0, 1))
            return pa.RecordBatch.from_arrays(
                [pa.array([*cid.tolist(), *a], pa.int64()), pa.array([*links.tolist(), *[None] * len(a)], pa.int64()), pa.array([*[None] * len(cid), *b], pa.int64())],
                names=["cid", "links", "other"],
            )

        for b in batches:
            for c, tile, cid, size, v in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if c != cell:
                    if cell is not None:
                        yield out()
                    cell, held = c, {}
                held.setdefault(tile, []).append((cid, size, v))
        if cell is not None:
            yield out()

    return cells.repartition("cell").sortWithinPartitions("cell", "tile").mapInArrow(run, CELL_OUT)


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(vec_id, embedding)`` -> ``(vec_id, n_links, component_id, kept)``: one row per input row."""
    rows = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("e"))
    ok = valid(F.col("e")) & F.exists("e", lambda x: x != 0)
    good = rows.where(ok)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(0)
            raw, at, out = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).tobytes(), 0, []
            for n in v.value_lengths().to_pylist():
                out.append(raw[8 * at : 8 * (at + n)])
                at += n
            yield pa.RecordBatch.from_arrays([v, pa.array(out, pa.binary()), *b.columns[1:]], names=["e", "v", "size", "least"])

    grouped = good.groupBy("e").agg(F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("least"))
    classes = materialize(grouped.mapInArrow(packed, "e array<double>, v binary, size long, least long").withColumn("cid", F.monotonically_increasing_id()))
    width = classes.agg(F.max(F.octet_length("v"))).first()[0]
    single = rows.where(~F.coalesce(ok, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept")
    )
    if width is None:
        return single
    found = materialize(link_classes(classes.select("cid", "size", "v"), width // 8, threshold, tile_rows))
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comps = connected_components(found.where("other IS NOT NULL"), "cid", "other").select(F.col("node").alias("cid"), "component")
    named = classes.select("e", "cid", "size", "least").join(counts, "cid", "left").join(comps, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    named = materialize(named)
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    label = named.join(smallest, "component").select("e", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id")
    linked = good.join(label, "e").select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
    return linked.union(single)


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))

"""Truncated SVD by a randomised range finder (T18), uncentred.

Rows are packed once into blocks of sparse rows. A pass multiplies every block by a (features x width) basis, Y = X·V, and
returns two sums over all blocks: the triangular factor of Y, by a tree of small QR steps over stacked factors, and XᵀY.
With them Q = Y·T is orthonormal without being formed, XᵀQ = (XᵀY)·T is the next basis, and its singular values are those
of X in the range found so far: one Spark job per power iteration. Iterations end when the wanted values stop changing.

The driver holds and sends features x width doubles (the vocabulary is capped, width = components + oversampling), which is
checked against the broadcast limit; nothing with a row per document leaves the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.operators.trainer import pack_rows
from tagwise.plans.broadcast import BROADCAST_BYTES

BLOCK_ROWS = 512
RANK_TOL = 1e-10  # directions below this share of the largest are no part of the range


class SparseBlock:
    """Rows as (row position, feature, value) runs, with the order of entries by feature for products with Xᵀ."""

    def __init__(self, rows: list):
        self.ids = [r["row_id"] for r in rows]
        size = np.array([len(r["idx"]) for r in rows], dtype=np.int64)
        self.idx = np.concatenate([np.asarray(r["idx"], dtype=np.int64) for r in rows])
        self.val = np.concatenate([np.asarray(r["val"], dtype=float) for r in rows])
        self.row = np.repeat(np.arange(len(rows)), size)
        self.full, self.starts = np.flatnonzero(size), (np.cumsum(size) - size)[size > 0]
        self.order = np.argsort(self.idx, kind="stable")
        self.features, self.runs = np.unique(self.idx[self.order], return_index=True)

    def times(self, v: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.ids), v.shape[1]))
        if len(self.idx):
            out[self.full] = np.add.reduceat(self.val[:, None] * v[self.idx], self.starts)
        return out

    def back(self, y: np.ndarray, out: np.ndarray) -> None:
        if len(self.idx):
            o = self.order
            out[self.features] += np.add.reduceat(self.val[o, None] * y[self.row[o]], self.runs)


def _blocks(rows: Iterator) -> Iterator[SparseBlock]:
    own: list = []
    for r in rows:
        own.append(r)
        if len(own) == BLOCK_ROWS:
            yield SparseBlock(own)
            own = []
    if own:
        yield SparseBlock(own)


@dataclass
class Svd:
    """``us``: (row_id, component, value) of U·S for every row; ``s``: singular values; ``v``: features x components;
    ``off``: largest entry of |UᵀU − 1|; ``passes`` over the rows."""

    us: DataFrame
    s: np.ndarray
    v: np.ndarray
    off: float
    passes: int


def _triangle(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.vstack([a, b]), mode="r")


def _pass(rdd, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(triangular factor of X·basis, Xᵀ·X·basis)."""
    if rdd.getNumPartitions() == 0:
        return np.zeros((0, basis.shape[1])), np.zeros_like(basis)
    sent = rdd.context.broadcast(basis)  # size checked by the caller

    def part(blocks: Iterator[SparseBlock]):
        v = sent.value
        tri, back = np.zeros((0, v.shape[1])), np.zeros_like(v)
        for b in blocks:
            y = b.times(v)
            tri = _triangle(tri, y)
            b.back(y, back)
        yield tri, back

    out = rdd.mapPartitions(part).treeReduce(lambda a, b: (_triangle(a[0], b[0]), a[1] + b[1]))
    sent.unpersist()
    return out


def randomized_svd(x: DataFrame, rows: DataFrame, n_features: int, k: int = 10, oversample: int = 20, tol: float = 1e-7, max_passes: int = 60, seed: int = 42) -> Svd:
    """Largest ``k`` singular values and vectors of ``x`` (row_id, feat_idx, value) over ``rows``, fewer if the rank is smaller.

    Signs are fixed: the largest entry of each right vector is positive. Rows without features have zeros; an empty table
    gives no values. ``tol``: largest relative change of a wanted value between two passes.
    """
    spark = x.sparkSession
    width = min(k + oversample, n_features)
    if 8 * n_features * width > BROADCAST_BYTES:
        raise ValueError(f"{n_features} features x {width} columns are over the limit of {BROADCAST_BYTES} bytes")
    packed = pack_rows(x, spark.createDataFrame([], "row_id long, label_idx int"), rows).select("row_id", "idx", "val")
    kept = packed.rdd.mapPartitions(_blocks).persist(StorageLevel.MEMORY_AND_DISK)
    basis = np.random.default_rng(seed).standard_normal((n_features, width))
    s = np.zeros(0)
    for passes in range(1, max_passes + 1):
        tri, back = _pass(kept, basis)
        _, scale, right = np.linalg.svd(tri, full_matrices=False)
        held = scale > RANK_TOL * scale.max(initial=0.0)
        if not held.any():
            kept.unpersist()
            return Svd(spark.createDataFrame([], "row_id long, component int, value double"), np.zeros(0), np.zeros((n_features, 0)), 0.0, passes)
        onto = right[held].T / scale[held]  # Q = Y·onto is orthonormal
        v, now, _ = np.linalg.svd(back @ onto, full_matrices=False)  # XᵀQ
        done = len(s) == len(now[:k]) and np.all(np.abs(now[:k] - s) <= tol * now[:k])
        s, basis = now[:k], v
        if done:
            break
    v = v[:, : len(s)] * np.sign(v[np.abs(v[:, : len(s)]).argmax(axis=0), np.arange(len(s))])
    last, _ = _pass(kept, v)  # U·S = X·v: its triangular factor gives UᵀU
    us_gram = (last / s).T @ (last / s)
    sent = spark.sparkContext.broadcast(v)

    def project(b: SparseBlock):
        return [(i, c, value) for i, y in zip(b.ids, b.times(sent.value).tolist(), strict=True) for c, value in enumerate(y)]

    # not persisted: the blocks of a row are packed again where they were lost or released
    us = spark.createDataFrame(packed.rdd.mapPartitions(_blocks).flatMap(project), "row_id long, component int, value double")
    kept.unpersist()
    return Svd(us, s, v, float(np.abs(us_gram - np.eye(len(s))).max()), passes + 1)

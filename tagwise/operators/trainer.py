"""One-vs-rest linear trainers for all labels at once (L3 squared-hinge SVM, L4 options, L17 ridge).

Per label l, with y in {-1, +1}, balanced weights c (A20) and the bias as an extra feature:
  svm   (squared hinge, L2): ½‖[w;b]‖² + C Σ_i c_il · max(0, 1 − y_il (w·x_i + b))²
  ridge (squared loss):      α‖w‖² + Σ_i c_il · (y_il − w·x_i − b)²      (bias not penalised)
Both are strictly convex, so any converged solver gives the same coefficients.

Distribution: the training rows are packed once into per-row sparse arrays and kept. L2 penalties are solved by
``stacked`` (shifted conjugate gradients, Newton), whose passes serve all labels of a group at once. The L1 penalty
takes proximal steps: every iteration broadcasts the coefficient matrix (labels × features, bounded by the
selection k), each partition returns loss and gradient for all labels, and ``treeReduce`` sums them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.operators import stacked
from tagwise.operators.dual import fit_hinge
from tagwise.operators.linear import LinearModel
from tagwise.operators.select import TrainingStats
from tagwise.session import materialize

BLOCK_ROWS = 4096


def pack_rows(x: DataFrame, y: DataFrame, rows: DataFrame) -> DataFrame:
    """(row_id, idx, val, lab): one row per training row, features and labels as arrays.
    A row's arrays are bounded by its distinct selected features (≤ k) and labels (≤ L)."""
    feats = x.groupBy("row_id").agg(
        F.array_sort(F.collect_list(F.struct("feat_idx", "value"))).alias("fv")
    )
    labs = y.groupBy("row_id").agg(F.collect_list("label_idx").alias("lab"))
    packed = rows.select("row_id").join(feats, "row_id", "left").join(labs, "row_id", "left")
    return packed.select(
        "row_id",
        F.coalesce(F.transform("fv", lambda s: s["feat_idx"]), F.array().cast("array<int>")).alias("idx"),
        F.coalesce(F.transform("fv", lambda s: s["value"]), F.array().cast("array<double>")).alias("val"),
        F.coalesce("lab", F.array().cast("array<int>")).alias("lab"),
    )


def _blocks(it, n_labels):
    """Yield CSR blocks (indptr, indices, data, Y±1) of at most BLOCK_ROWS rows."""
    buf = []
    for r in it:
        buf.append(r)
        if len(buf) >= BLOCK_ROWS:
            yield _to_block(buf, n_labels)
            buf = []
    if buf:
        yield _to_block(buf, n_labels)


def _to_block(rows, n_labels):
    lens = np.fromiter((len(r["idx"]) for r in rows), dtype=np.int64, count=len(rows))
    indptr = np.concatenate([[0], np.cumsum(lens)])
    indices = np.fromiter((i for r in rows for i in r["idx"]), dtype=np.int64, count=int(indptr[-1]))
    data = np.fromiter((v for r in rows for v in r["val"]), dtype=np.float64, count=int(indptr[-1]))
    Y = -np.ones((len(rows), n_labels))
    for k, r in enumerate(rows):
        if r["lab"]:
            Y[k, list(r["lab"])] = 1.0
    return indptr, indices, data, Y


def _scores(indptr, indices, data, W, b):
    """S = X·Wᵀ + b for a CSR block (rows without features get b only)."""
    n = len(indptr) - 1
    S = np.tile(b, (n, 1))
    if len(indices):
        contrib = W[:, indices] * data  # L × nnz
        row_of = np.repeat(np.arange(n), np.diff(indptr))
        for l in range(W.shape[0]):
            S[:, l] += np.bincount(row_of, weights=contrib[l], minlength=n)
    return S


def _grad_block(block, W, b, cw, kind, F_):
    indptr, indices, data, Y = block
    n, L = Y.shape
    S = _scores(indptr, indices, data, W, b)
    weight = np.where(Y > 0, cw[:, 1], cw[:, 0])  # n × L
    if kind == "svm":
        m = np.maximum(0.0, 1.0 - Y * S)
        loss = float(np.sum(weight * m * m))
        R = -2.0 * weight * Y * m  # d loss / d score
    else:
        e = S - Y
        loss = float(np.sum(weight * e * e))
        R = 2.0 * weight * e
    G = np.zeros((L, F_))
    if len(indices):
        row_of = np.repeat(np.arange(n), np.diff(indptr))
        for l in range(L):
            G[l] = np.bincount(indices, weights=data * R[row_of, l], minlength=F_)
    return loss, G, R.sum(axis=0)


class _Oracle:
    """Distributed loss/gradient (one Spark job per evaluation) over CSR blocks that are built once and kept."""

    def __init__(self, packed: DataFrame, stats: TrainingStats, cw: np.ndarray, kind: str):
        n_labels = stats.n_labels
        self.rdd = packed.rdd.mapPartitions(lambda rows: _blocks(rows, n_labels)).persist(StorageLevel.MEMORY_AND_DISK)
        self.sc = packed.sparkSession.sparkContext
        self.L, self.F = stats.n_labels, stats.n_features
        self.cw, self.kind = cw, kind

    def __call__(self, W, b):
        bw = self.sc.broadcast((W, b))
        L, F_, cw, kind = self.L, self.F, self.cw, self.kind

        def part(it):
            Wb, bb = bw.value
            loss, G, gb = 0.0, np.zeros((L, F_)), np.zeros(L)
            for blk in it:
                lo, g, g_b = _grad_block(blk, Wb, bb, cw, kind, F_)
                loss += lo
                G += g
                gb += g_b
            yield loss, G, gb

        out = self.rdd.mapPartitions(part).treeReduce(lambda a, c: (a[0] + c[0], a[1] + c[1], a[2] + c[2]))
        bw.unpersist()
        return out


def fista_l1(smooth, x0, n_w, max_iter=300, tol=1e-6):
    """L4: proximal gradient (FISTA with backtracking) for  ‖w‖₁ + smooth(θ);  θ = [w; b], the bias
    (last ``len(x0) - n_w`` entries) is not penalised. ``smooth`` returns (value, gradient)."""

    def prox(v, t):
        out = v.copy()
        out[:n_w] = np.sign(v[:n_w]) * np.maximum(np.abs(v[:n_w]) - t, 0.0)
        return out

    x = x0.copy()
    yk, tk, step = x.copy(), 1.0, 1.0
    f_y, g_y = smooth(yk)
    history = []
    for _ in range(max_iter):
        while True:
            xn = prox(yk - step * g_y, step)
            f_n, g_n = smooth(xn)
            d = xn - yk
            if f_n <= f_y + float(g_y @ d) + float(d @ d) / (2 * step) + 1e-12:
                break
            step *= 0.5
            if step < 1e-12:
                break
        history.append(f_n + float(np.sum(np.abs(xn[:n_w]))))
        if np.max(np.abs(xn - x)) <= tol * max(1.0, float(np.max(np.abs(x)))):
            x = xn
            break
        t_next = (1 + np.sqrt(1 + 4 * tk * tk)) / 2
        yk = xn + ((tk - 1) / t_next) * (xn - x)
        x, tk = xn, t_next
        f_y, g_y = smooth(yk)
    f_x, g_x = smooth(x)
    return x, history, g_x


def class_weights(y: DataFrame, n_rows: int, n_labels: int) -> np.ndarray:
    """A20 balanced weights per label: [w_neg, w_pos] = n / (2·n_neg), n / (2·n_pos)."""
    pos = {r["label_idx"]: r["n"] for r in y.groupBy("label_idx").agg(F.count(F.lit(1)).alias("n")).collect()}  # L rows
    cw = np.ones((n_labels, 2))
    for l in range(n_labels):
        p = pos.get(l, 0)
        q = n_rows - p
        cw[l, 1] = n_rows / (2.0 * p) if p else 0.0
        cw[l, 0] = n_rows / (2.0 * q) if q else 0.0
    return cw


def _fit_l2(packed: DataFrame, cw: np.ndarray, kind: str, param: float, n_features: int, max_iter: int, tol: float):
    """(W, b, objective per step, gradient as [W; b]) of one parameter, by groups of labels over the same kept rows."""
    L = len(cw)
    passes = stacked.Passes(packed.withColumn("g", F.lit(0)), n_features, L)
    W, b, G, hists = np.zeros((L, n_features)), np.zeros(L), np.zeros((L, n_features + 1)), []
    step = stacked.group_size(n_features, 1, 1, kind)
    for first in range(0, L, step):
        own = np.arange(first, min(L, first + step))
        cols = stacked.Columns(own, np.full(len(own), -1), cw[own, 0], cw[own, 1])
        got = stacked.solve(passes, kind, cols, np.array([param]), tol, max_iter)
        W[own], b[own], G[own] = got.w[0, :-1].T, got.w[0, -1], got.gradient.T
        hists.append(got.history)
    passes.close()
    longest = max(map(len, hists), default=0)
    hist = [sum(h[min(i, len(h) - 1)] for h in hists) for i in range(longest)]
    return W, b, hist, np.concatenate([G[:, :-1].ravel(), G[:, -1]])


def fit_linear(
    x: DataFrame,
    y: DataFrame,
    stats: TrainingStats,
    kind: str = "svm",
    C: float = 0.1,
    alpha: float = 1.0,
    max_iter: int = 200,
    tol: float = 1e-4,
    rows: DataFrame | None = None,
    balanced: bool = True,
    return_history: bool = False,
    penalty: str = "l2",
    dual: bool | None = None,
    loss: str = "squared_hinge",
):
    """Fit all labels jointly (block-separable objective) and return a coefficient-table model.
    Labels that are constant in the training rows get w = 0 and a constant score (0 or 1).

    L4: ``loss='hinge'`` (svm with l2 only) minimises ½‖w‖² + C·Σ c·max(0, 1 − y·s) by dual coordinate ascent to the
    relative duality gap ``tol``; ``penalty='l1'`` (svm only) minimises ‖w‖₁ + C·Σ c·loss with proximal gradient steps over the
    same distributed gradient; ``dual`` only selects a solver in the reference and is accepted and ignored."""
    if kind not in ("svm", "ridge"):
        raise ValueError(f"unknown trainer {kind!r}")
    if penalty not in ("l2", "l1") or (penalty == "l1" and kind != "svm"):
        raise ValueError(f"unsupported penalty {penalty!r} for {kind!r}")
    if loss not in ("squared_hinge", "hinge") or (loss == "hinge" and (kind != "svm" or penalty != "l2")):
        raise ValueError(f"unsupported loss {loss!r} for {kind!r} with penalty {penalty!r}")
    spark = x.sparkSession
    rows = rows if rows is not None else y.select("row_id").union(x.select("row_id")).distinct()
    packed = pack_rows(x, y, rows)
    n, L, F_ = stats.n_rows, stats.n_labels, stats.n_features
    cw = class_weights(y, n, L) if balanced else np.ones((L, 2))
    if penalty == "l1":
        oracle = _Oracle(packed, stats, cw, kind)

        def smooth(t):
            W_ = t[: L * F_].reshape(L, F_)
            b_ = t[L * F_ :]
            loss, G, gb = oracle(W_, b_)
            return C * loss, np.concatenate([(C * G).ravel(), C * gb])

        theta, hist, g = fista_l1(smooth, np.zeros(L * F_ + L), L * F_, max_iter, tol)
        W, b = theta[: L * F_].reshape(L, F_), theta[L * F_ :].copy()
        oracle.rdd.unpersist()
    elif loss == "hinge":
        got = fit_hinge(packed, cw, C, F_, max_iter, tol)
        W, b, hist, g = got.w[:-1].T.copy(), got.w[-1].copy(), got.gaps, got.objective
    else:
        W, b, hist, g = _fit_l2(packed, cw, kind, C if kind == "svm" else alpha, F_, max_iter, tol)
    const = {l: (1.0 if cw[l, 0] == 0 else 0.0) for l in range(L) if cw[l, 0] == 0 or cw[l, 1] == 0}
    for l, v in const.items():
        W[l] = 0.0
        b[l] = v
    at_label, at_feat = np.nonzero(W)  # ≤ L·k entries, bounded by the selection size
    coef = spark.createDataFrame(
        pa.table({"feat_idx": at_feat.astype(np.int32), "label_idx": at_label.astype(np.int32), "w": W[at_label, at_feat]}), "feat_idx int, label_idx int, w double"
    )
    intercept = spark.createDataFrame(pa.table({"label_idx": np.arange(L, dtype=np.int32), "b": b}), "label_idx int, b double")
    model = LinearModel(
        materialize(coef), materialize(intercept), F_, L, kind,
        {"C": C, "alpha": alpha, "penalty": penalty, "loss": loss, "iterations": len(hist) - 1},
    )
    if return_history:
        return model, hist, g
    return model

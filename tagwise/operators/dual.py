"""Hinge-loss SVM for all labels at once, ended by the duality gap (L4).

Per label: min ½‖w‖² + C Σ c_i max(0, 1 − y_i w·x_i), the bias a constant feature that is penalised like the others. Every
row has a dual variable per label, 0 <= a_i <= C c_i. The corner of the loss is rounded over a width h: a loss m = 1 − y_i w·x_i
above 0 counts m² / 2h up to h and m − h/2 beyond, which is the loss with the duals C c_i min(1, m / h). Newton steps with
conjugate gradients lower that objective in ``stacked``'s passes; a pass at w also gives the duals that belong to it, and with
them the duality gap of the hinge loss itself: ½‖gradient‖² and what the rows on the rounded corner add. Where the latter is
the larger part, h is halved. Neither steps nor rounds depend on how the rows are dealt over partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.operators.stacked import STEPS, Block, Columns, Passes, _newton_direction, group_size

WIDTH = 1.0  # of the rounded corner at the start


@dataclass
class HingeFit:
    w: np.ndarray  # (features + 1, labels), the bias last
    gaps: list[float]  # largest relative duality gap of a label, per round
    objective: np.ndarray  # per label


def _sums(b: Block, out: list, c: Columns, w: np.ndarray, h: np.ndarray) -> None:
    """Loss, sum of duals, and the features times the duals (all without C)."""
    y, weight = b.targets(c)
    m = 1.0 - y * b.scores(w)
    duals = weight * np.clip(m / h, 0.0, 1.0)
    out[0] += np.sum(weight * np.maximum(0.0, m), axis=0)
    out[1] += np.sum(duals, axis=0)
    b.back(duals * y, out[2])


def _rounded_curve(b: Block, out: list, c: Columns, w: np.ndarray, d: np.ndarray, h: np.ndarray) -> None:
    """Rounded losses without a step and at all step lengths."""
    y, weight = b.targets(c)
    both = b.scores(np.hstack([w, d]))
    for j, t in enumerate([0.0, *STEPS]):
        m = 1.0 - y * (both[:, : len(c)] + t * both[:, len(c) :])
        a = np.clip(m / h, 0.0, 1.0)
        out[0][j] += np.sum(weight * a * (m - 0.5 * h * a), axis=0)


def _corner_normal(b: Block, out: list, c: Columns, w: np.ndarray, v: np.ndarray, h: np.ndarray) -> None:
    y, weight = b.targets(c)
    both = b.scores(np.hstack([w, v]))
    m = 1.0 - y * both[:, : len(c)]
    b.back(weight / h * ((m > 0.0) & (m < h)) * both[:, len(c) :], out[0])


def _fit_group(passes: Passes, c: Columns, cost: float, max_rounds: int, tol: float) -> HingeFit:
    k, size = len(c), passes.size
    costs, h, w = np.full(k, float(cost)), np.full(k, WIDTH), np.zeros((size, k))
    objective, dual, g, corner = np.zeros(k), np.zeros(k), np.zeros((size, k)), np.zeros(k)

    def look(at: np.ndarray) -> None:
        """The state of the columns ``at`` at their w and h; duals of zero have the dual objective 0."""
        loss, duals, back = passes.run(_sums, [(len(at),), (len(at),), (size, len(at))], c.take(at), w[:, at], h[at])
        square = lambda a: 0.5 * np.einsum("fk,fk->k", a, a)
        objective[at] = square(w[:, at]) + cost * loss
        here = cost * duals - square(cost * back)
        dual[at] = np.maximum(dual[at], here)
        g[:, at] = w[:, at] - cost * back
        corner[at] = objective[at] - here - square(g[:, at])

    look(np.arange(k))
    gap = lambda: (objective - dual) / np.maximum(objective, 1e-12)
    gaps = [float(np.max(gap(), initial=0.0))]
    for _ in range(max_rounds):
        at = np.flatnonzero(gap() > tol)
        if not len(at):
            break
        own, wa, ga, ha = c.take(at), w[:, at], g[:, at], h[at]
        d = _newton_direction(passes, own, costs[at], wa, ga, _corner_normal, ha)
        curve = passes.run(_rounded_curve, [(len(STEPS) + 1, len(at))], own, wa, d, ha)[0]
        t = STEPS[:, None]
        slope, ww, wd, dd = (np.einsum("fk,fk->k", i, j) for i, j in ((ga, d), (wa, wa), (wa, d), (d, d)))
        values = 0.5 * (ww + 2 * t * wd + t * t * dd) + cost * curve[1:]
        good = values <= 0.5 * ww + cost * curve[0] + 1e-4 * t * slope
        moved = good.any(axis=0) & (slope < 0)
        w[:, at] = wa + np.where(moved, STEPS[np.argmin(np.where(good, values, np.inf), axis=0)], 0.0) * d
        look(at)
        narrower = at[(gap()[at] > tol) & (~moved | (corner[at] >= 0.5 * np.einsum("fk,fk->k", g[:, at], g[:, at])))]
        if len(narrower):
            h[narrower] *= 0.5
            look(narrower)
        gaps.append(float(np.max(gap())))
    return HingeFit(w, gaps, objective)


def fit_hinge(packed: DataFrame, cw: np.ndarray, cost: float, n_features: int, max_rounds: int = 200, tol: float = 1e-3) -> HingeFit:
    """``packed``: (idx, val, lab) per row; ``cw``: (labels, 2) weights of negative and positive rows."""
    n_labels = len(cw)
    passes = Passes(packed.withColumn("g", F.lit(0)), n_features, n_labels)
    w, objective, rounds = np.zeros((n_features + 1, n_labels)), np.zeros(n_labels), []
    step = group_size(n_features, 1, 1, "svm")
    for first in range(0, n_labels, step):
        own = np.arange(first, min(n_labels, first + step))
        got = _fit_group(passes, Columns(own, np.full(len(own), -1), cw[own, 0], cw[own, 1]), cost, max_rounds, tol)
        w[:, own], objective[own] = got.w, got.objective
        rounds.append(got.gaps)
    passes.close()
    gaps = [max(r[min(i, len(r) - 1)] for r in rounds) for i in range(max(map(len, rounds), default=0))]
    return HingeFit(w, gaps, objective)

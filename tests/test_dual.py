"""Hinge loss by distributed dual coordinate ascent against coordinate ascent on one dense matrix."""

import numpy as np
import pytest

from tagwise.operators import dual
from tagwise.operators.select import TrainingStats
from tagwise.operators.trainer import class_weights, fit_linear, pack_rows
from tests.test_trainer import balanced, coef_matrix, make_problem

C = 0.5


def primal(A, y, weight, w):
    return 0.5 * w @ w + C * np.sum(weight * np.maximum(0.0, 1.0 - y * (A @ w)))


def dense(A, y, weight):
    a, w = np.zeros(len(y)), np.zeros(A.shape[1])
    for _ in range(3000):
        for i in range(len(y)):
            new = np.clip(a[i] + (1.0 - y[i] * (A[i] @ w)) / (A[i] @ A[i]), 0.0, C * weight[i])
            w += (new - a[i]) * y[i] * A[i]
            a[i] = new
    assert primal(A, y, weight, w) - (a.sum() - 0.5 * w @ w) < 1e-8
    return w


def problem(spark, parts):
    X, Y, x, y, rows = make_problem(spark, n=80, f=6, L=3, seed=13)
    packed = pack_rows(x, y, rows).repartition(parts, "row_id")
    return np.hstack([X, np.ones((len(X), 1))]), np.where(Y == 1, 1.0, -1.0), balanced(Y), packed, class_weights(y, len(X), 3), (x, y, rows)


@pytest.mark.parametrize("parts", [1, 3])
def test_equals_a_dense_solution(spark, parts):
    A, y, weight, packed, cw, _ = problem(spark, parts)
    got = dual.fit_hinge(packed, cw, C, A.shape[1] - 1, max_rounds=400, tol=1e-3)
    assert got.gaps[-1] <= 1e-3 and got.gaps[0] > 0.5
    for label in range(3):
        best = primal(A, y[:, label], weight[:, label], dense(A, y[:, label], weight[:, label]))
        value = primal(A, y[:, label], weight[:, label], got.w[:, label])
        assert got.objective[label] == pytest.approx(value)
        assert best - 1e-9 <= value <= best * (1 + 1e-3) + 1e-9  # the gap bounds the distance


def test_fit_linear_takes_the_loss(spark):
    A, y, weight, _, _, (x, lab, rows) = problem(spark, 2)
    stats = TrainingStats(len(A), 3, A.shape[1] - 1)
    model, gaps, _ = fit_linear(x, lab, stats, C=C, rows=rows, loss="hinge", tol=1e-3, max_iter=300, return_history=True)
    W = coef_matrix(model, 3, A.shape[1] - 1)
    assert gaps[-1] <= 1e-3 and model.params["loss"] == "hinge"
    for label in range(3):
        want = primal(A, y[:, label], weight[:, label], dense(A, y[:, label], weight[:, label]))
        assert primal(A, y[:, label], weight[:, label], W[label]) <= want * (1 + 2e-3)
    for bad in ({"kind": "ridge"}, {"penalty": "l1"}, {"loss": "log"}):
        with pytest.raises(ValueError):
            fit_linear(x, lab, stats, rows=rows, **({"loss": "hinge"} | bad))


def test_rounds_do_not_grow_with_the_partitions(spark):
    rounds = []
    for parts in (1, 12):
        A, y, weight, packed, cw, _ = problem(spark, parts)
        got = dual.fit_hinge(packed, cw, C, A.shape[1] - 1, max_rounds=30, tol=1e-2)
        assert got.gaps[-1] <= 1e-2
        rounds.append(len(got.gaps))
    assert abs(rounds[0] - rounds[1]) <= 1

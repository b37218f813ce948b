"""Property tests for the distributed linear trainers against a dense numpy solve."""

import numpy as np
import pytest

from tagwise.operators.select import TrainingStats
from tagwise.operators.trainer import fit_linear


def make_problem(spark, n=60, f=8, L=3, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.random((n, f)) * (rng.random((n, f)) < 0.5)
    X[0] = 0.0  # a row without features still contributes through the bias
    Wt = rng.normal(size=(L, f))
    S = X @ Wt.T + rng.normal(scale=0.3, size=(n, L))
    Y = (S > np.median(S, axis=0)).astype(int)  # every label has both classes
    x = spark.createDataFrame(
        [(i, j, float(X[i, j])) for i in range(n) for j in range(f) if X[i, j] != 0], "row_id long, feat_idx int, value double"
    )
    y = spark.createDataFrame([(i, l) for i in range(n) for l in range(L) if Y[i, l]], "row_id long, label_idx int")
    rows = spark.createDataFrame([(i,) for i in range(n)], "row_id long")
    return X, Y, x, y, rows


def balanced(Y):
    n = Y.shape[0]
    pos = Y.sum(axis=0)
    return np.where(Y == 1, n / (2.0 * pos), n / (2.0 * (n - pos)))


def dense_svm(X, Y, C):
    n, f = X.shape
    Xa = np.hstack([X, np.ones((n, 1))])
    out = []
    cw = balanced(Y)
    for l in range(Y.shape[1]):
        y = np.where(Y[:, l] == 1, 1.0, -1.0)
        w = np.zeros(f + 1)
        for _ in range(100):
            m = 1 - y * (Xa @ w)
            act = m > 0
            g = w - 2 * C * Xa.T @ (cw[:, l] * y * np.maximum(m, 0))
            H = np.eye(f + 1) + 2 * C * (Xa[act].T * cw[act, l]) @ Xa[act]
            w = w - np.linalg.solve(H, g)
        out.append(w)
    return np.array(out)


def dense_ridge(X, Y, alpha):
    n, f = X.shape
    Xa = np.hstack([X, np.ones((n, 1))])
    P = np.eye(f + 1) * alpha
    P[f, f] = 0.0
    cw = balanced(Y)
    out = []
    for l in range(Y.shape[1]):
        y = np.where(Y[:, l] == 1, 1.0, -1.0)
        Wd = cw[:, l]
        out.append(np.linalg.solve((Xa.T * Wd) @ Xa + P, (Xa.T * Wd) @ y))
    return np.array(out)


def coef_matrix(model, L, f):
    W = np.zeros((L, f + 1))
    for r in model.coef.collect():
        W[r["label_idx"], r["feat_idx"]] = r["w"]
    for r in model.intercept.collect():
        W[r["label_idx"], f] = r["b"]
    return W


@pytest.mark.parametrize("kind", ["svm", "ridge"])
def test_matches_dense_solution(spark, kind):
    X, Y, x, y, rows = make_problem(spark)
    n, f = X.shape
    L = Y.shape[1]
    model, hist, g = fit_linear(
        x, y, TrainingStats(n, L, f), kind=kind, C=0.5, alpha=1.0, rows=rows, tol=1e-8, max_iter=500, return_history=True
    )
    ref = dense_svm(X, Y, 0.5) if kind == "svm" else dense_ridge(X, Y, 1.0)
    got = coef_matrix(model, L, f)
    assert np.allclose(got, ref, atol=1e-4), np.max(np.abs(got - ref))
    assert all(b <= a + 1e-9 for a, b in zip(hist, hist[1:]))  # objective non-increasing
    assert np.max(np.abs(g)) < 1e-4


def test_label_and_row_permutation_invariance(spark):
    X, Y, x, y, rows = make_problem(spark, seed=3)
    n, f = X.shape
    m1 = fit_linear(x, y, TrainingStats(n, 3, f), kind="ridge", rows=rows, tol=1e-7, max_iter=300)
    perm = {0: 2, 1: 0, 2: 1}
    from pyspark.sql import functions as F

    yp = y.withColumn("label_idx", F.create_map(*[F.lit(v) for kv in perm.items() for v in kv])[F.col("label_idx")])
    m2 = fit_linear(x.repartition(3), yp, TrainingStats(n, 3, f), kind="ridge", rows=rows, tol=1e-7, max_iter=300)
    W1, W2 = coef_matrix(m1, 3, f), coef_matrix(m2, 3, f)
    for a, b in perm.items():
        assert np.allclose(W1[a], W2[b], atol=1e-5)


def test_constant_label_gets_constant_score(spark):
    X, Y, x, y, rows = make_problem(spark, seed=5)
    n, f = X.shape
    from pyspark.sql import functions as F

    y_all = y.filter(F.col("label_idx") != 2).unionByName(rows.select("row_id", F.lit(2).alias("label_idx")))
    m = fit_linear(x, y_all, TrainingStats(n, 3, f), kind="svm", rows=rows, max_iter=50)
    W = coef_matrix(m, 3, f)
    assert np.all(W[2, :f] == 0) and W[2, f] == 1.0


def test_l1_penalty_kkt(spark):
    """‖w‖₁ + C·loss: at the optimum |∂loss_j| = 1 where w_j ≠ 0 and ≤ 1 where w_j = 0 (bias: gradient 0)."""
    X, Y, x, y, rows = make_problem(spark, n=50, f=6, L=2, seed=7)
    n, f = X.shape
    model, hist, g = fit_linear(
        x, y, TrainingStats(n, 2, f), kind="svm", C=0.5, rows=rows, penalty="l1", tol=1e-9, max_iter=400, return_history=True
    )
    W = coef_matrix(model, 2, f)
    gw = g[: 2 * f].reshape(2, f)
    nz = W[:, :f] != 0
    assert np.allclose(np.abs(gw[nz]), 1.0, atol=1e-3)
    assert np.all(np.abs(gw[~nz]) <= 1.0 + 1e-3)
    assert np.allclose(g[2 * f :], 0.0, atol=1e-3)
    assert nz.sum() < W[:, :f].size  # the L1 penalty zeroes some weights
    with pytest.raises(ValueError):
        fit_linear(x, y, TrainingStats(n, 2, f), kind="ridge", rows=rows, penalty="l1")

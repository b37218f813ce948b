"""Randomised SVD: equal to numpy's, orthogonal, small ranks and empty tables."""

import numpy as np
import pytest

from tagwise.operators import rsvd as R
from tests.test_reduce import small


def dense(us, n, k):
    out = np.zeros((n, k))
    for r in us.collect():
        out[r["row_id"], r["component"]] = r["value"]
    return out


def test_equals_numpy_with_less_width_than_rank(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_ROWS", 7)
    X, x, rows = small(spark, n=90, f=40, seed=2)
    got = R.randomized_svd(x, rows, 40, k=4, oversample=4)
    u, s, vt = np.linalg.svd(X, full_matrices=False)
    assert np.allclose(got.s, s[:4], rtol=1e-6) and got.off < 1e-6
    assert 3 < got.passes < 60
    us = dense(got.us, 90, 4)
    assert np.allclose(us, X @ got.v, atol=1e-9) and np.allclose(np.linalg.norm(us, axis=0), s[:4], rtol=1e-6)
    assert np.allclose(np.abs(np.sum(got.v * vt[:4].T, axis=0)), 1, atol=1e-4)
    assert (got.v[np.abs(got.v).argmax(axis=0), np.arange(4)] > 0).all()


def test_rank_below_the_components(spark):
    x = spark.createDataFrame([(0, 0, 3.0), (2, 0, 4.0), (3, 2, 2.0)], "row_id long, feat_idx int, value double")
    rows = spark.createDataFrame([(i,) for i in range(5)], "row_id long")
    got = R.randomized_svd(x, rows, 4, k=3)
    assert np.allclose(got.s, [5.0, 2.0])
    assert np.allclose(dense(got.us, 5, 2), [[3, 0], [0, 0], [4, 0], [0, 2], [0, 0]])


def test_empty_table_and_size(spark):
    x = spark.createDataFrame([], "row_id long, feat_idx int, value double")
    got = R.randomized_svd(x, spark.createDataFrame([], "row_id long"), 4, k=2)
    assert got.us.count() == 0 and len(got.s) == 0
    with pytest.raises(ValueError, match="over the limit"):
        R.randomized_svd(x, x.select("row_id"), 10**8, k=2)

"""Thresholds, top-k and request validation (reference edge cases, values ported)."""

import math

import pytest
from pyspark.sql import functions as F

from tagwise.operators import clean as CL
from tagwise.operators import decide as D


def long_proba(spark, rows):
    data = [(i, j, float(p)) for i, row in enumerate(rows) for j, p in enumerate(row)]
    return spark.createDataFrame(data, "row_id long, label_idx int, proba double")


def names(spark, n):
    return spark.createDataFrame([(j, f"L{j}") for j in range(n)], "label_idx int, label string")


@pytest.mark.parametrize(
    "t, expected",
    [(0.0, [[1, 1, 1], [1, 1, 1]]), (1.0, [[0, 0, 0], [0, 0, 0]]), (0.5, [[0, 1, 0], [1, 0, 1]])],
)
def test_threshold_edges(spark, t, expected):
    p = long_proba(spark, [[0.2, 0.6, 0.4], [0.7, 0.3, 0.5]])
    out = D.apply_label_thresholds(p, names(spark, 3), D.ThresholdPolicy(t), 3)
    got = [[0] * 3 for _ in range(2)]
    for r in out.collect():
        got[r["row_id"]][r["label_idx"]] = r["pred"]
    assert got == expected


def test_top_k_after_threshold(spark):
    scores = [1.4, 1.0, -0.4, -0.8, -1.2]
    p = long_proba(spark, [[1 / (1 + math.exp(-s)) for s in scores]])
    decided = D.apply_label_thresholds(p, names(spark, 5), D.ThresholdPolicy(0.5), 5)
    chosen = D.top_k(decided, 3)
    assert sorted(r["label_idx"] for r in chosen.collect()) == [0, 1]
    assert sorted(r["label_idx"] for r in D.top_k(decided, 1).collect()) == [0]


def test_per_label_thresholds_fall_back_to_global(spark):
    p = long_proba(spark, [[0.45, 0.45]])
    pol = D.resolve_thresholds({"L0": 0.4}, spark=spark)
    out = {r["label_idx"]: (r["threshold"], r["pred"]) for r in D.apply_label_thresholds(p, names(spark, 2), pol, 2).collect()}
    assert out == {0: (0.4, 1), 1: (0.55, 0)}


def test_threshold_policy_rules():
    assert D.resolve_thresholds(0.3).global_threshold == 0.3
    assert D.resolve_thresholds({"a": 0.1}, use_global=True).global_threshold == 0.55  # dict + force-global -> default
    assert D.resolve_thresholds(None).global_threshold == 0.55


@pytest.mark.parametrize("threshold, top_k", [(1.5, 3), (-0.1, 3), (0.5, 25), (0.5, 0)])
def test_request_params_rejected(threshold, top_k):
    with pytest.raises(ValueError):
        CL.check_request_params(threshold, top_k)


def test_request_rows(spark):
    df = spark.createDataFrame([(0, ""), (1, "ok"), (2, "x" * 10001), (3, None)], "row_id long, description string")
    got = {r["row_id"]: r["reason"] for r in CL.validate_requests(df).collect()}
    assert got == {0: "too_short", 1: None, 2: "too_long", 3: "too_short"}

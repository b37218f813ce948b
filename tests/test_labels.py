"""Label parsing and encoding: expectations ported from the reference's tests (values, not code)."""

import pytest
from pyspark.sql import functions as F

from tagwise.operators import labels as LB


def parse(spark, genres):
    df = spark.createDataFrame([(i, g) for i, g in enumerate(genres)], "row_id long, genre string")
    return [r["labels"] for r in LB.parse_label_column(df).orderBy("row_id").collect()]


@pytest.mark.parametrize(
    "genre, expected",
    [
        ("Action, Adventure", ["Action", "Adventure"]),
        ("", []),
        (None, []),
        ("Zebra, Action, Drama", ["Action", "Drama", "Zebra"]),
        (" Action , Adventure ", ["Action", "Adventure"]),
    ],
)
def test_parse_cases(spark, genre, expected):
    assert parse(spark, [genre]) == [expected]


def test_parse_duplicates(spark):
    assert len(parse(spark, ["Action, Action, Adventure"])[0]) == 2


def test_parse_all_null_and_empty_frame(spark):
    assert parse(spark, [None, None, None]) == [[], [], []]
    empty = spark.createDataFrame([], "row_id long, genre string")
    assert LB.parse_label_column(empty).count() == 0


def test_rare_rule_is_strict_and_denominator_counts_unlabelled_rows(spark):
    # 20 rows: 'a' on 1 row (5 %) is kept, 'b' never below; 19 rows unlabelled still count
    rows = [(0, "a, b")] + [(i, "b" if i < 10 else None) for i in range(1, 20)]
    df = LB.parse_label_column(spark.createDataFrame(rows, "row_id long, genre string"))
    freq = {r["label"]: r["pct"] for r in LB.label_frequency(df).collect()}
    assert freq["a"] == pytest.approx(5.0)
    idx = LB.fit_labels(df, 5.0)
    assert [r["label"] for r in idx.table.orderBy("label_idx").collect()] == ["a", "b"]
    idx6 = LB.fit_labels(df, 5.0001)
    assert [r["label"] for r in idx6.table.collect()] == ["b"]


def test_multi_hot_and_decode_roundtrip(spark):
    df = LB.parse_label_column(spark.createDataFrame([(0, "x, y"), (1, "y"), (2, None)], "row_id long, genre string"))
    idx = LB.fit_labels(df, 0.0)
    y = LB.multi_hot(df, idx)
    assert sorted((r["row_id"], r["label_idx"]) for r in y.collect()) == [(0, 0), (0, 1), (1, 1)]
    dec = LB.decode_labels(df.select("row_id"), y, idx)
    got = {r["row_id"]: r["labels"] for r in dec.collect()}
    assert got == {0: ["x", "y"], 1: ["y"], 2: []}
    kept = LB.restrict_labels(df, idx)
    assert sorted(r["row_id"] for r in kept.collect()) == [0, 1]

"""Sources and sinks: CSV contract, skip-if-exists writer, state and threshold round trips, ledger."""

import os

import pytest
from pyspark.sql import functions as F

from tagwise.sources import io as IO


def test_csv_roundtrip_keeps_quotes_newlines_and_na_tokens(spark, scratch):
    rows = [(0, "A, b", 'say "hi"\nnext line', " x , y "), (1, "NA", None, ""), (2, "t", "  padded  ", "null")]
    df = spark.createDataFrame(rows, "row_id long, movie_name string, description string, genre string")
    path = os.path.join(scratch, "m.csv")
    IO.write_csv(df, path)
    back = {r["row_id"]: r for r in IO.read_csv(spark, path).collect()}
    assert back[0]["description"] == 'say "hi"\nnext line' and back[0]["genre"] == " x , y "
    assert back[1]["movie_name"] is None and back[1]["genre"] is None and back[1]["description"] is None
    assert back[2]["description"] == "  padded  " and back[2]["genre"] is None


def test_missing_csv_raises(spark, scratch):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        IO.read_csv(spark, os.path.join(scratch, "nope.csv")).collect()


def test_skip_if_exists(spark, scratch):
    path = os.path.join(scratch, "t")
    assert IO.write_table(spark.range(3), path) is True
    assert IO.write_table(spark.range(5), path) is False
    assert IO.read_table(spark, path).count() == 3
    assert IO.write_table(spark.range(5), path, force=True) is True
    assert IO.read_table(spark, path).count() == 5


def test_an_output_without_commit_marker_is_written_again(spark, scratch):
    path = os.path.join(scratch, "dead")
    os.makedirs(os.path.join(path, "_temporary", "0"))  # what a job leaves that died before its commit
    assert IO.write_table(spark.range(4), path) is True
    assert IO.read_table(spark, path).count() == 4
    assert IO.write_table(spark.range(9), path) is False


def test_state_roundtrip_and_errors(spark, scratch):
    path = os.path.join(scratch, "state")
    IO.save_state({"coef": spark.createDataFrame([(0, 1, 0.5)], "feat_idx int, label_idx int, w double")}, {"alpha": 1.0}, path)
    tables, params = IO.load_state(spark, path, ["coef"])
    assert params == {"alpha": 1.0} and tables["coef"].first()["w"] == 0.5
    with pytest.raises(ValueError):
        IO.load_state(spark, "  ", ["coef"])
    with pytest.raises(FileNotFoundError):
        IO.load_state(spark, os.path.join(scratch, "missing"), ["coef"])


def test_thresholds_absent_means_global(spark, scratch):
    assert IO.load_thresholds(spark, os.path.join(scratch, "none")) is None
    t = spark.createDataFrame([("a", 0.4, 0.7), ("b", 0.6, 0.5)], "label string, threshold double, score double")
    IO.save_thresholds(t, os.path.join(scratch, "thr"))
    assert sorted(r["label"] for r in IO.load_thresholds(spark, os.path.join(scratch, "thr")).collect()) == ["a", "b"]


def test_fingerprint_is_order_free(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    b = spark.createDataFrame([(2, "y"), (1, "x")], "k long, v string").repartition(2)
    assert IO.table_fingerprint(a).first() == IO.table_fingerprint(b).first()


def test_ledger_latest_and_search(spark, scratch):
    led = IO.Ledger(spark, os.path.join(scratch, "ledger"))
    r1, r2 = led.new_run(), led.new_run()
    led.log(r1, "model", {"path": "/m1"})
    led.log(r2, "model", {"path": "/m2"})
    led.log(r2, "metric", {"f1": 0.5}, prefix="test_")
    assert led.latest("model", "path").first()["text"] == "/m2"
    assert led.table().filter(F.col("key") == "test_f1").count() == 1
    runs = spark.createDataFrame([(i, float(i % 7), "F") for i in range(300)], "run_id long, metric double, tag string")
    top = IO.search_runs(runs, "tag = 'F'", ["metric DESC", "run_id ASC"])
    assert top.count() == 100 and top.first()["metric"] == 6.0


def test_metrics_append_and_parameters(spark, scratch):
    m = spark.createDataFrame([("r1", "train", "f1", 0.5)], "run_id string, split string, metric string, value double")
    IO.save_metrics(m, os.path.join(scratch, "metrics"))
    IO.save_metrics(m.withColumn("split", F.lit("test")), os.path.join(scratch, "metrics"))
    assert spark.read.parquet(os.path.join(scratch, "metrics")).count() == 2
    IO.save_parameters(spark, {"C": 0.1, "loss": "squared_hinge"}, os.path.join(scratch, "params"))
    import json

    assert json.loads(spark.read.text(os.path.join(scratch, "params")).first()[0]) == {"C": 0.1, "loss": "squared_hinge"}


def test_compare_pipelines_smoke(spark):
    from tagwise.operators.text import VectorizerParams
    from tagwise.plans import jobs as J
    from tagwise.plans import pipeline as P
    from tests.conftest import SF_SMALL

    train, _ = P.split(P.corpus(spark, SF_SMALL))
    cands = {
        "base": P.PipelineParams(vectorizer=VectorizerParams(max_features=2000, ngram_range=(1, 1)), k_features=500),
        "bigrams": P.PipelineParams(vectorizer=VectorizerParams(max_features=2000, ngram_range=(1, 2)), k_features=500),
    }
    out = {r["candidate"]: r for r in J.compare_pipelines(train, cands, "base").collect()}
    assert set(out) == {"base", "bigrams"} and out["base"]["improvement"] == 0.0
    assert sorted(r["rank"] for r in out.values()) == [1, 2]

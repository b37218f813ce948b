"""Fitted state: large-side joins, held-out evaluation, save/load, unseen features in cross-validation."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwise.operators import cv, labels, text
from tagwise.operators.linear import LinearModel, decision_scores
from tagwise.operators.select import TrainingStats
from tagwise.plans import broadcast, jobs
from tagwise.plans import pipeline as P
from tests.conftest import SF_SMALL

SMALL_PARAMS = P.PipelineParams(
    vectorizer=text.VectorizerParams(max_features=400, ngram_range=(1, 2), min_df=2, use_idf=False, norm=None, stop_words=None), k_features=150, alpha=0.5
)


@pytest.fixture(scope="module")
def fitted(spark):
    train, test = P.split(P.corpus(spark, SF_SMALL), SMALL_PARAMS)
    return P.fit_pipeline(train, SMALL_PARAMS)[0], test


def rows_of(df, digits=9):
    return sorted(tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_large_side_joins_give_the_same_rows(spark, fitted, monkeypatch):
    model, test = fitted
    docs = test.select("row_id", "description")
    want = rows_of(P.score(model, docs))
    monkeypatch.setattr(broadcast, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows_of(P.score(model, docs)) == want and len(want) > 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_records_cut_the_texts_below_the_joins(spark, fitted):
    model, test = fitted
    plan = P.predict_records(model, test.select("row_id", "description"))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first_join = next(i for i, line in enumerate(plan) if "Join " in line)
    cut = [i for i, line in enumerate(plan) if "substring(" in line]
    assert cut and min(cut) > first_join


def test_the_fit_tokenises_the_rows_once(spark, monkeypatch):
    train, _ = P.split(P.corpus(spark, SF_SMALL), SMALL_PARAMS)
    _, rows, _ = P.fit_label_stage(train, SMALL_PARAMS)
    calls, real = [], text.doc_words
    monkeypatch.setattr(text, "doc_words", lambda *a: calls.append(1) or real(*a))
    tfidf, x = P.fit_text_stage(rows, SMALL_PARAMS)
    assert calls == [1]
    assert rows_of(x) == rows_of(text.transform_tfidf(rows, tfidf))


def test_numbering_of_large_tables(spark, monkeypatch):
    from tagwise.operators import indexing

    df = spark.createDataFrame([(f"t{i * 7919 % 5000:05d}",) for i in range(5000)], "term string")
    want = rows_of(indexing.dense_index(df, "term", "i", 5000).select("term", "i"))
    monkeypatch.setattr(indexing, "WINDOW_LIMIT", 0)
    assert rows_of(indexing.dense_index(df, "term", "i", 5000).select("term", "i")) == want


def test_saved_pipeline_predicts_as_before(spark, fitted, scratch):
    model, test = fitted
    path = os.path.join(scratch, "model")
    jobs.save_pipeline(model, path)
    back = jobs.load_pipeline(spark, path)
    assert back.params == model.params and back.features.tfidf.params == model.features.tfidf.params
    docs = test.select("row_id", "description")
    assert rows_of(P.score(back, docs)) == rows_of(P.score(model, docs))


def test_evaluation_leaves_rows_without_known_labels_out(spark, fitted):
    model, test = fitted
    one = jobs.evaluate(model, test).first()
    known = labels.restrict_labels(test, model.features.labels)
    noise = test.limit(5).withColumn("row_id", F.col("row_id") + 1_000_000).withColumn("labels", F.array().cast("array<string>"))
    assert jobs.evaluate(model, test.unionByName(noise)).first() == one == jobs.evaluate(model, known).first()


def test_feature_of_one_fold_only_keeps_its_coefficient():
    """Hand-computed: feature 1 occurs in fold 0 only, so for held-out fold 0 both of its sums are zero."""
    total = np.array([[1.0, 2.0], [3.0, 0.0]])
    own = np.array([[[1.0], [2.0]], [[1.0], [0.0]]])
    w = cv._coefficients(total, own, [0.5])
    n1, n0 = 1.0, 2.0  # label and other sums of feature 0 in fold 1, the training part of held-out fold 0
    assert w[1, 0, 0, 0] == pytest.approx(math.log(0.5 / (n1 + 1)) - math.log(0.5 / (n0 + 1)))
    assert w[0, 0, 0, 0] == pytest.approx(math.log(1.5 / (n1 + 1)) - math.log(2.5 / (n0 + 1)))


def test_label_groups_do_not_change_the_curve(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = spark.createDataFrame([(i, int(f), float(rng.random())) for i in range(40) for f in rng.choice(12, 4, replace=False)], "row_id long, feat_idx int, value double")
    y = spark.createDataFrame([(i, int(l)) for i in range(40) for l in rng.choice(3, 1 + i % 2, replace=False)], "row_id long, label_idx int")
    rows, stats = spark.range(40).withColumnRenamed("id", "row_id"), TrainingStats(40, 3, 12)
    want = rows_of(cv.nb_cv_scores(x, y, rows, stats, [0.1, 1.0]))
    monkeypatch.setattr(cv, "MODEL_BYTES", 1)
    assert rows_of(cv.nb_cv_scores(x, y, rows, stats, [0.1, 1.0])) == want and len(want) == 20


def test_features_from_a_fitted_state(spark, fitted):
    model, test = fitted
    prep = P.prepare_features(test, SMALL_PARAMS, state=model.features)
    kept = labels.restrict_labels(test, model.features.labels)
    assert rows_of(prep.x) == rows_of(P.transform(model.features, kept)) and prep.state is model.features


def test_processed_split_names_what_is_missing(spark):
    df = spark.createDataFrame([(1, 0.5, 1)], "row_id long, tfidf_0 double, Action int")
    assert P.split_processed(df) == (["tfidf_0"], ["Action"])
    with pytest.raises(ValueError, match="No feature columns.*Action"):
        P.split_processed(df.drop("tfidf_0"))
    with pytest.raises(ValueError, match="No label columns"):
        P.split_processed(df.drop("Action"))


def test_processed_table_and_back(spark, scratch):
    train, _ = P.split(P.corpus(spark, SF_SMALL), SMALL_PARAMS)
    prep = P.prepare_features(train, SMALL_PARAMS)
    # a row without any feature keeps its labels, and a label of a row can be missing
    lone = prep.rows.select("row_id").orderBy("row_id").first()["row_id"]
    prep.x, prep.y = prep.x.where(F.col("row_id") != lone), prep.y.where(~((F.col("row_id") == lone) & (F.col("label_idx") == 0)))
    path = os.path.join(scratch, "wide")
    P.processed_table(prep).write.parquet(path)
    wide = spark.read.parquet(path)
    names = [r["label"] for r in prep.state.labels.table.orderBy("label_idx").collect()]
    assert wide.columns == ["row_id", *[f"tfidf_{i}" for i in range(prep.stats.n_features)], *names]
    x, lists = P.restore_processed(wide)
    assert rows_of(x) == rows_of(prep.x) and lists.count() == prep.rows.count()
    y = {}
    for r in prep.y.collect():
        y.setdefault(r["row_id"], []).append(r["label_idx"])
    assert {r["row_id"]: r["labels"] for r in lists.collect()} == {r["row_id"]: [names[i] for i in sorted(y.get(r["row_id"], []))] for r in prep.rows.collect()}


def test_processed_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, 0.5, 0.0, 1, 0, 1), (2, 0.0, 0.0, 0, 0, 0)], ["id", "tfidf_a.b", "tfidf_`c", "Sci-Fi & Co.", "x y", "q`t"])
    x, lists = P.restore_processed(df, key="id")
    assert rows_of(x) == [(1, 0, 0.5)] and rows_of(lists.selectExpr("row_id", "array_join(labels, '|') AS l")) == [(1, "Sci-Fi & Co.|q`t"), (2, "")]


def test_state_of_the_whole_corpus_is_not_evaluated(spark, scratch):
    corpus = P.corpus(spark, SF_SMALL)
    prep = P.prepare_corpus(corpus, SMALL_PARAMS)
    assert prep.state.leaky and prep.rows.count() > P.prepare_features(P.split(corpus)[0], SMALL_PARAMS).rows.count()
    model = P.fit_model(prep, SMALL_PARAMS)
    with pytest.raises(ValueError, match="leaky"):
        jobs.evaluate(model, P.split(corpus)[1])
    # the mark stays with the saved state, so the evaluation job refuses it as well
    jobs.save_pipeline(model, os.path.join(scratch, "leaky"))
    assert jobs.load_pipeline(spark, os.path.join(scratch, "leaky")).features.leaky
    with pytest.raises(ValueError, match="leaky"):
        jobs.eval_job(spark, SF_SMALL, os.path.join(scratch, "leaky"), os.path.join(scratch, "runs"))


def test_train_and_eval_jobs(spark, scratch):
    """The ledger names the model, the metrics are those of the loaded model on the held-out rows."""
    folder, ledger = os.path.join(scratch, "model"), os.path.join(scratch, "runs")
    params = P.PipelineParams(vectorizer=SMALL_PARAMS.vectorizer, k_features=150, model="ridge")
    trained = {r["metric"]: r["value"] for r in jobs.train_job(spark, SF_SMALL, folder, ledger, params).collect()}
    tested = {r["metric"]: r["value"] for r in jobs.eval_job(spark, SF_SMALL, None, ledger, threshold=0.5).collect()}
    assert set(trained) == set(tested) == set(jobs.METRIC_NAMES)
    loaded = jobs.load_pipeline(spark, folder)
    corpus = P.corpus(spark, SF_SMALL)
    want = jobs.evaluate(loaded, P.split(corpus)[0]).first()
    assert all(trained[m] == pytest.approx(want[m]) for m in jobs.METRIC_NAMES)
    from tagwise.operators import decide

    want = jobs.evaluate(loaded, P.split(corpus)[1], decide.resolve_thresholds(0.5, variant="evaluate")).first()
    assert all(tested[m] == pytest.approx(want[m]) for m in jobs.METRIC_NAMES) and trained["f1"] > tested["f1"]


def test_records_and_request_bounds(spark, fitted):
    model, _ = fitted
    req = spark.createDataFrame([(1, "x" * 150), (2, "short")], "row_id long, description string")
    got = {r.row_id: r for r in P.predict_records(model, req, threshold=0.0, k=2).collect()}
    assert got[1].description == "x" * 100 + "..." and len(got[1].genres) == 2 and got[1].validation.is_optimal
    conf = [c.confidence for c in got[1].genres_with_confidence]
    assert conf == sorted(conf, reverse=True) and {c.genre for c in got[1].genres_with_confidence} == set(got[1].genres)
    assert not got[2].validation.is_optimal and "too short (5 chars)" in got[2].validation.recommendation
    for bad in ({"threshold": 1.5}, {"threshold": -0.1}, {"k": 0}, {"k": 25}):
        with pytest.raises(ValueError):
            P.predict_records(model, req, **bad)


def test_scores_without_intercept_rows(spark):
    coef = spark.createDataFrame([(0, 0, 2.0)], "feat_idx int, label_idx int, w double")
    b = spark.createDataFrame([(0, -1.0), (1, 0.5)], "label_idx int, b double")
    x = spark.createDataFrame([(7, 0, 3.0)], "row_id long, feat_idx int, value double")
    rows = spark.createDataFrame([(7,), (8,)], "row_id long")
    assert rows_of(decision_scores(x, rows, LinearModel(coef, b, 1, 2))) == [(7, 0, 5.0), (7, 1, 0.5), (8, 0, -1.0), (8, 1, 0.5)]


def test_exact_median(spark):
    from tagwise.operators.metrics import exact_median

    rng = np.random.default_rng(3)
    for values in ([0.5], [0.1, 0.9], [0.2] * 7 + [0.8] * 7, rng.random(501).tolist(), rng.random(500).round(3).tolist(), [0.0, 1.0, 1.0], (rng.random(300) * 1e-6).tolist()):
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        assert exact_median(df, "x") == pytest.approx(float(np.median(values)), abs=1e-15)
    assert exact_median(spark.createDataFrame([], "x double"), "x") is None


def test_fingerprint_tells_apart(spark):
    from tagwise.sources.io import table_fingerprint

    fp = lambda rows: tuple(table_fingerprint(spark.createDataFrame(rows, "a string, b string")).first())
    assert fp([("a|b", "c")]) != fp([("a", "b|c")])
    assert fp([("1", "x"), ("1", "x"), ("2", "y")]) != fp([("3", "z"), ("3", "z"), ("2", "y")])
    assert fp([(None, "c")]) != fp([("\\N", "c")]) and fp([(None, "")]) != fp([("", None)])


def test_file_hash_reads_in_blocks(spark, scratch):
    import hashlib

    from tagwise.sources.io import file_fingerprint

    data = os.urandom(3_000_000)
    os.makedirs(f"{scratch}/d/e")
    for name in ("a.bin", "e/b.bin"):
        with open(f"{scratch}/d/{name}", "wb") as f:
            f.write(data + name.encode())
    got = {r.path.rsplit("/", 1)[1]: r for r in file_fingerprint(spark, f"{scratch}/d").collect()}
    assert got["a.bin"].sha256 == hashlib.sha256(data + b"a.bin").hexdigest() and got["b.bin"].n_bytes == 3_000_007


def test_nmf_of_unseen_rows_lowers_the_error(spark):
    from tagwise.operators import reduce as RD

    rng = np.random.default_rng(5)
    H = rng.random((2, 6))
    W = rng.random((8, 2))
    X = W @ H
    x = spark.createDataFrame([(i, f, float(X[i, f])) for i in range(8) for f in range(6)], "row_id long, feat_idx int, value double")
    rows = spark.range(9).withColumnRenamed("id", "row_id")
    got = {r.row_id: np.array(r.w) for r in RD.nmf_transform(x, rows, H, max_iter=2000).collect()}
    assert max(np.abs(got[i] @ H - X[i]).max() for i in range(8)) < 1e-2 and np.abs(got[8]).max() < 1e-6


def test_no_shuffle_carries_the_wide_rows(spark):
    train, _ = P.split(P.corpus(spark, SF_SMALL), SMALL_PARAMS)
    prep = P.prepare_features(train, SMALL_PARAMS)
    # of a pair or a row that comes twice the first value counts, and the row stays twice
    prep.x, prep.rows = prep.x.unionByName(prep.x), prep.rows.unionByName(prep.rows)
    wide = P.processed_table(prep)
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "pivotfirst" not in plan.lower() and plan.strip().startswith("MapInArrow")
    assert wide.count() == prep.rows.count()
    assert rows_of(P.restore_processed(wide.distinct())[0]) == rows_of(prep.x.distinct())

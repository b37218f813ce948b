"""Pipeline comparison: shared stages run once, ranks and held-out metrics equal the separate steps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwise.operators import cv, text
from tagwise.plans import compare
from tagwise.plans import pipeline as P
from tests.conftest import SF_SMALL

VEC = text.VectorizerParams(max_features=300, ngram_range=(1, 1), min_df=2, stop_words=None)
CANDIDATES = [
    compare.Candidate("base", VEC, k=80),
    compare.Candidate("mi", VEC, score_fn="mutual_info", k=80),
    compare.Candidate("all", VEC, score_fn=None),
    compare.Candidate("nmf", VEC, components=6, iterations=8, score_fn=None),
    compare.Candidate("nmf_chi2", VEC, components=6, iterations=8, k=4),
]


@pytest.fixture(scope="module")
def compared(spark):
    calls = []
    counted = lambda name, fn: lambda *a, **b: calls.append(name) or fn(*a, **b)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(compare, "fit_tfidf", counted("tfidf", compare.fit_tfidf))
        m.setattr(compare.RD, "nmf", counted("nmf", compare.RD.nmf))
        m.setattr(compare, "feature_label_grid", counted("grid", compare.feature_label_grid))
        train, test = P.split(P.corpus(spark, SF_SMALL))
        out, stages = compare.pipeline_comparison(train, test, CANDIDATES, "base", k=3)
        rows = {r["candidate"]: r for r in out.collect()}
    return rows, stages, calls, train, test


def test_common_stages_run_once(compared):
    _, stages, calls, _, _ = compared
    assert sorted(calls) == ["grid", "grid", "nmf", "tfidf"]
    assert len(stages.held) == 7  # tf-idf, its grid and two selections; the reduction, its grid and one selection


def test_ranks_and_sizes(compared):
    rows, _, _, _, _ = compared
    assert set(rows) == {c.name for c in CANDIDATES}
    order = sorted(rows.values(), key=lambda r: (-round(r["val_mean"], 12), r["candidate"]))
    assert [r["rank"] for r in order] == [1, 2, 3, 4, 5]
    assert rows["base"]["improvement"] == 0.0 and all(r["improvement"] == r["val_mean"] - rows["base"]["val_mean"] for r in rows.values())
    assert [rows[c]["n_features"] for c in ("base", "mi", "all", "nmf", "nmf_chi2")] == [80, 80, 300, 6, 4]
    assert all(r["fit_seconds"] > 0 and r["transform_seconds"] > 0 for r in rows.values())
    # a chain that goes on from another one costs at least as much
    assert rows["nmf"]["fit_seconds"] > rows["all"]["fit_seconds"] and rows["nmf_chi2"]["fit_seconds"] > rows["nmf"]["fit_seconds"]


def test_scores_equal_the_separate_steps(compared):
    rows, _, _, train, _ = compared
    prep = P.prepare_features(train, P.PipelineParams(vectorizer=VEC, k_features=80))
    f1 = cv.nb_cv_scores(prep.x, prep.y, prep.rows.select("row_id"), prep.stats, [1.0], 3)
    got = {r["split"]: r["m"] for r in f1.groupBy("split").agg(F.avg("f1").alias("m")).collect()}
    assert rows["base"]["val_mean"] == pytest.approx(got["validation"]) and rows["base"]["train_mean"] == pytest.approx(got["train"])


def test_held_out_metrics_of_the_best_only(compared):
    rows, stages, _, train, test = compared
    best = next(r for r in rows.values() if r["rank"] == 1)
    assert all((r["test_f1"] is None) == (r["rank"] != 1) for r in rows.values())
    # the same numbers from dense arrays: naive Bayes in closed form on the features that the comparison kept
    f, _, _ = stages.features(next(c for c in CANDIDATES if c.name == best["candidate"]))

    def dense(x, rows):
        ids = {r["row_id"]: i for i, r in enumerate(rows.select("row_id").collect())}
        out = np.zeros((len(ids), f.n_features))
        for r in x.collect():
            out[ids[r["row_id"]], r["feat_idx"]] = r["value"]
        return ids, out

    index = {r["label"]: r["label_idx"] for r in stages.labels.table.collect()}

    def truth(ids, rows):
        out = np.zeros((len(ids), stages.labels.n_labels), int)
        for r in rows.collect():
            out[ids[r["row_id"]], [index[v] for v in set(r["labels"]) if v in index]] = 1
        return out

    a, x = dense(f.train, stages.train)
    b, z = dense(f.test, stages.test)
    y, t = truth(a, stages.train), truth(b, stages.test)
    theta = lambda m: np.log((m.T @ x + 1.0) / ((m.T @ x).sum(axis=1, keepdims=True) + f.n_features))
    hit = (z @ (theta(y) - theta(1 - y)).T > 0).astype(int)
    tp, fp, fn = (hit & t).sum(), (hit & (1 - t)).sum(), ((1 - hit) & t).sum()
    assert best["test_precision"] == pytest.approx(tp / (tp + fp)) and best["test_recall"] == pytest.approx(tp / (tp + fn))
    assert best["test_f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn)) and best["test_jaccard"] == pytest.approx(tp / (tp + fp + fn))
    assert best["test_hamming_loss"] == pytest.approx((hit != t).mean())
    ids = {r["row_id"] for r in stages.test.collect()}
    assert not ids & {r["row_id"] for r in train.select("row_id").collect()} and ids <= {r["row_id"] for r in test.select("row_id").collect()}


def test_components_too_large_to_broadcast_give_the_same_features(spark, monkeypatch):
    train, test = P.split(P.corpus(spark, SF_SMALL))
    c = compare.Candidate("nmf", VEC, components=4, iterations=3, score_fn=None)
    stages = compare.Stages(train, test, 5.0)
    whole = stages.features(c)[0]
    stages.held = {k: v for k, v in stages.held.items() if k[0] == "tfidf"}
    monkeypatch.setattr(compare, "BROADCAST_BYTES", 0)
    cut = stages.features(c)[0]
    for a, b in ((whole.train, cut.train), (whole.test, cut.test)):
        left, right = ({(r["row_id"], r["feat_idx"]): r["value"] for r in d.collect()} for d in (a, b))
        assert left.keys() == right.keys() and all(right[k] == pytest.approx(v, rel=1e-6) for k, v in left.items())


def test_every_registered_selection_leaves_features_out():
    from tagwise.plans.queries import COMPARED

    chains = [compare.Candidate(name, **stages) for name, stages in COMPARED.items()]
    assert [c.name for c in chains] == ["chi2", "mutual_info", "nmf", "nmf_chi2", "nmf_mutual_info"]
    for c in chains:
        assert c.components in (None, 2000) and c.iterations == 50
        assert c.score_fn is None or c.k < (c.components or c.vectorizer.max_features)

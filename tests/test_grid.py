"""Preprocessor grid: every configuration equals the pipeline fitted for it alone."""

import pytest

from tagwise.operators import metrics as M
from tagwise.operators.labels import multi_hot, restrict_labels
from tagwise.operators.linear import baseline_predictions, decision_scores
from tagwise.operators.text import VectorizerParams
from tagwise.plans import grid as G
from tagwise.plans import pipeline as P
from tests.conftest import SF_SMALL

CONFIGS = [G.Config(400, 2, 0.7, 2, 80), G.Config(400, 2, 0.7, 2, 150), G.Config(150, 1, 0.3, 4, 80), G.Config(250, 2, 0.3, 2, 300)]


@pytest.fixture(scope="module")
def split(spark):
    return P.split(P.corpus(spark, SF_SMALL))


def test_equal_to_single_pipelines(spark, split):
    train, test = split
    out, seconds = G.preprocessor_grid(train, test, CONFIGS)
    got = {(r["max_features"], r["k_features"]): r for r in out.collect()}
    assert len(got) == 4 and seconds["fit_seconds"] > 0 and seconds["score_seconds"] > 0
    for c in CONFIGS:
        vec = VectorizerParams(max_features=c.max_features, ngram_range=(1, c.ngram_max), max_df=c.max_df, min_df=c.min_df)
        fitted, prep = P.fit_pipeline(train, P.PipelineParams(vectorizer=vec, k_features=c.k_features))
        labels = fitted.features.labels
        rows = restrict_labels(test, labels).select("row_id", "description", "labels")
        scored = decision_scores(P.transform(fitted.features, rows), rows.select("row_id"), fitted.model)
        pred = baseline_predictions(scored).where("pred = 1").select("row_id", "label_idx")
        n = rows.count()
        want = M.micro_metrics(M.label_counts(multi_hot(rows, labels), pred, labels.table, n), n, labels.n_labels).first()
        r = got[c.max_features, c.k_features]
        assert r["n_features"] == prep.stats.n_features and r["n_terms"] == fitted.features.tfidf.n_features
        assert r["n_samples_train"] == prep.stats.n_rows and r["n_samples_test"] == n
        for m in ("f1", "precision", "recall", "hamming_loss", "jaccard"):
            assert r[m] == pytest.approx(want[m], abs=1e-9), (c, m)


def test_the_reference_grid_has_32_configurations():
    assert len(G.reference_grid()) == 32 and len({c.vectorizer for c in G.reference_grid()}) == 16


def test_counts_no_terms_of_all_rows_and_keeps_no_columns_per_vectorizer(spark, split, monkeypatch):
    from tagwise.operators import text as TX

    kept = []
    monkeypatch.setattr(TX, "term_counts", lambda *a: 1 / 0)
    real = G.materialize
    monkeypatch.setattr(G, "materialize", lambda df: kept.append(df.columns) or real(df))
    out, _ = G.preprocessor_grid(*split, CONFIGS)
    assert out.count() == 4
    assert not any("row_id" in c and "feat_idx" in c for c in kept)


def test_impossible_bounds_and_too_many_vectorizers(split):
    train, test = split
    with pytest.raises(ValueError, match="max_df corresponds"):
        G.preprocessor_grid(train, test, [G.Config(10, 1, 1.0, 10**6, 5)])
    with pytest.raises(ValueError, match="vectorizers"):
        G.preprocessor_grid(train, test, [G.Config(i, 1, 0.7, 2, 5) for i in range(1, 64)])

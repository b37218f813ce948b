"""TF-IDF against a hand computation, selection ties and L2 idempotence."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagwise.operators import select as SE
from tagwise.operators import text as TX

DOCS = ["the red fox jumps", "red fox red fox", "a blue fox", "blue sky and blue sea", ""]


def docs_df(spark):
    return spark.createDataFrame(list(enumerate(DOCS)), "row_id long, description string")


def test_tfidf_matches_hand_computation(spark):
    p = TX.VectorizerParams(max_features=None, ngram_range=(1, 2), min_df=1, max_df=1.0)
    st = TX.fit_tfidf(docs_df(spark), p)
    vocab = {r["term"]: (r["feat_idx"], r["idf"]) for r in st.vocab.collect()}
    stop = set(p.stop_words)
    n = len(DOCS)
    grams = []
    for d in DOCS:
        toks = [t for t in d.lower().split() if len(t) >= 2 and t not in stop]
        grams.append(toks + [" ".join(toks[i : i + 2]) for i in range(len(toks) - 1)])
    dfc = Counter(t for g in grams for t in set(g))
    assert sorted(vocab) == sorted(dfc)
    assert [t for t, _ in sorted(vocab.items(), key=lambda kv: kv[1][0])] == sorted(dfc)  # alphabetical numbering
    x = {(r["row_id"], r["feat_idx"]): r["value"] for r in TX.transform_tfidf(docs_df(spark), st).collect()}
    for i, g in enumerate(grams):
        tf = Counter(g)
        w = {t: (1 + math.log(c)) * (math.log((1 + n) / (1 + dfc[t])) + 1) for t, c in tf.items()}
        norm = math.sqrt(sum(v * v for v in w.values())) or 1.0
        for t, v in w.items():
            assert x[(i, vocab[t][0])] == pytest.approx(v / norm)
    assert not any(k[0] == 4 for k in x)  # the empty text has no features


def test_l2_normalize_is_idempotent(spark):
    st = TX.fit_tfidf(docs_df(spark), TX.VectorizerParams(max_features=None, min_df=1, max_df=1.0))
    x = TX.transform_tfidf(docs_df(spark), st)
    again = TX.l2_normalize(x)
    a = {(r["row_id"], r["feat_idx"]): r["value"] for r in x.collect()}
    b = {(r["row_id"], r["feat_idx"]): r["value"] for r in again.collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_max_features_tie_break_and_df_bounds(spark):
    p = TX.VectorizerParams(max_features=2, ngram_range=(1, 1), min_df=1, max_df=1.0)
    st = TX.fit_tfidf(docs_df(spark), p)
    # counts: fox 4, red 3, blue 3 -> fox plus the alphabetically first of the tied ones
    assert sorted(r["term"] for r in st.vocab.collect()) == ["blue", "fox"]
    with pytest.raises(ValueError):
        TX.df_bounds(TX.VectorizerParams(min_df=3, max_df=2), 10)


def test_select_k_best_keeps_higher_index_on_ties(spark):
    scores = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 1.0), (3, 0.5)], "feat_idx int, score double")
    sel = SE.select_k_best(scores, 2)
    assert sorted((r["feat_idx"], r["sel_idx"]) for r in sel.table.collect()) == [(1, 0), (2, 1)]
    assert SE.select_k_best(scores, 10).k == 4


def test_unknown_vectorizer_key():
    with pytest.raises(ValueError):
        TX.VectorizerParams.from_dict({"max_feature": 10})


def test_char_grams_are_code_points(spark):
    """Characters beyond the BMP are one character each, alone, repeated, and beside spaces."""
    from tagwise.operators.text import char_grams

    texts = ["a\U0001F600b\U00010348", "\U0001F600 \U0001F600", "\U0001F600", "", None, "x  \U0001D504y"]
    got = {}
    for r in char_grams(spark.createDataFrame(list(enumerate(texts)), "row_id long, description string"), 3).collect():
        got.setdefault(r.row_id, []).append(r.term)
    flat = ["" if t is None else t.lower().replace("  ", " ") for t in texts]
    assert got == {i: [t[j : j + 3] for j in range(len(t) - 2)] for i, t in enumerate(flat) if len(t) >= 3}

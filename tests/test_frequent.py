"""Capped vocabularies are counted without holding every n-gram, and hold the same terms and counts."""

import random

import pytest
from pyspark.sql import functions as F

from tagwise.operators import frequent
from tagwise.operators import text as TX


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(words[min(int(rng.expovariate(0.03)), 299)] for _ in range(rng.randint(0, 60)))) for i in range(200)]
    rows += [(7, rows[7][1]), (8, "w1 w2 XX w3"), (9, None), (None, "w1 w2 w3"), (None, "w3 w1 w2")]  # keys may repeat or be null
    return spark.createDataFrame(rows, "row_id long, description string").repartition(3)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("cap", "ngrams", "low", "high"), [(40, (1, 3), 3, 0.5), (700, (1, 3), 2, 0.7), (60, (1, 2), 1, 1.0), (100_000, (1, 3), 3, 0.7)])
def test_capped_vocabulary_equals_the_full_count(spark, docs, cap, ngrams, low, high):
    p = TX.VectorizerParams(max_features=cap, ngram_range=ngrams, min_df=low, max_df=high)
    n = docs.count()
    every = TX.prune_terms(TX.doc_freq(TX.term_counts(docs, p)), p, n)
    found = TX.pruned_terms(docs, p, n)
    key = ["term", "df", "ttf"]
    assert rows_of(TX.cap_terms(found, cap).select(key)) == rows_of(TX.cap_terms(every, cap).select(key))
    if cap < 100:
        assert found.count() < every.count() / 2  # the n-grams that cannot reach the cap are not summed
    state = TX.fit_tfidf(docs, p)
    counted = TX.known_terms(docs, state).select("row_id", "feat_idx", "tf")
    want = TX.term_counts(docs, p).join(F.broadcast(state.vocab), "term").select("row_id", "feat_idx", "tf")
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert order(counted) == order(want)


def test_too_many_words_are_counted_the_plain_way(spark, docs, monkeypatch):
    monkeypatch.setattr(frequent, "MAX_WORDS", 5)
    p = TX.VectorizerParams(max_features=40, min_df=2)
    state = TX.fit_tfidf(docs, p)
    assert TX.known_terms(docs, state) is None
    monkeypatch.undo()
    assert rows_of(state.vocab) == rows_of(TX.fit_tfidf(docs, p).vocab)
    round_ = lambda x: x.select("row_id", "feat_idx", F.round("value", 9)).where("row_id is not null")
    assert TX.known_terms(docs, state) is not None and len(rows_of(round_(TX.transform_tfidf(docs, state)))) > 0

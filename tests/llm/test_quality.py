import zlib

import numpy as np

from tagwise.llm import quality
from tagwise.sources.tables import table
from tests.llm import helpers as H

LABELS = "doc_id long, quality int, toxic int, text string, n_chars string"


def test_sum_of_squares_identity_equals_all_pairs():
    rng = np.random.default_rng(1)
    m = quality.FactorisationMachine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    rows = [(rng.choice(50, n, replace=False).astype(np.int32), rng.normal(size=n)) for n in (1, 7, 20)]
    got = m.raw(*quality._ragged(rows))
    for (ids, x), g in zip(rows, got, strict=True):
        pairs = sum(m.v[ids[i]] @ m.v[ids[j]] * x[i] * x[j] for i in range(len(ids)) for j in range(i))
        assert abs(m.bias + m.w[ids] @ x + pairs - g) < 1e-9


def test_interactions_are_learned():
    """A label that depends on a pair of words only cannot be told by single words."""
    rng = np.random.default_rng(2)
    rows, y = [], []
    for _ in range(1500):
        a, b = rng.integers(0, 2, 2)
        rows.append((np.array([a, 2 + b], np.int32), np.ones(2)))
        y.append(float(a == b))
    m = quality.fit_machine(rows, np.array(y), epochs=30)
    assert ((m.score(*quality._ragged(rows)) >= 0.5) == np.array(y)).mean() > 0.95


def brute_held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_edge_cases(spark, scratch):
    docs = H.doc_rows()
    labels = [(i, i % 2, 0, "c", "c") for i in range(0, 60)] + [(61, None, 0, "", ""), (62, 7, 0, "", ""), (None, 1, 0, "", "")]
    folder = H.sf_dir(spark, scratch, documents=(docs, H.DOC_SCHEMA), labels=(labels, LABELS))
    got = quality.op1_quality_classifier(spark, folder).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d[0]) for d in docs)
    for r in got:
        assert r.held_out == brute_held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_id[3]) == 1


def test_without_labels_every_score_is_even(spark, scratch):
    folder = H.sf_dir(spark, scratch, documents=(H.doc_rows()[:5], H.DOC_SCHEMA), labels=([], LABELS))
    assert {r.score for r in quality.op1_quality_classifier(spark, folder).collect()} == {0.5}


def test_empty_table(spark, scratch):
    folder = H.sf_dir(spark, scratch, documents=([], H.DOC_SCHEMA), labels=([(1, 1, 0, "", "")], LABELS))
    assert quality.op1_quality_classifier(spark, folder).collect() == []


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    got = [r for r in quality.op1_quality_classifier(spark, folder).collect() if r.held_out and r.doc_id in truth]
    right = [r.predicted == truth[r.doc_id] for r in got]
    junk = [r.predicted == 0 for r in got if truth[r.doc_id] == 0]
    clean = [r.predicted == 1 for r in got if truth[r.doc_id] == 1]
    assert len(got) > 300 and np.mean(right) > 0.97 and np.mean(junk) > 0.95 and np.mean(clean) > 0.97


def test_labels_lang_source_and_ids_do_not_enter(spark):
    ids, x = quality.features("The same text.", 14)
    again, y = quality.features("The same text.", 14)
    assert (ids == again).all() and (x == y).all() and len(ids) == 3 + len(quality.STATISTICS)

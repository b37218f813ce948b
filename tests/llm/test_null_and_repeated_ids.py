import hashlib
import random

import corpus_pipeline
from tagwise.llm import suffix
from tagwise.sources.tables import table
from tests.llm import helpers as H
from tests.llm.test_suffix import brute


def rows():
    rng = random.Random(5)
    a, b, c, d, e = (H.words(rng, 120) for _ in range(5))
    found = [(1, a), (None, a), (2, b), (2, c), (None, d), (None, d), (3, e), (3, e), (None, None), (4, "")]
    return [(i, t, "en", None, None if t is None else len(t), "extra", "extra") for i, t in found], (a, b, c, d, e)


def test_one_row_of_each_group_stays(spark, scratch):
    data, (a, b, c, d, e) = rows()
    docs = table(spark, H.sf_dir(spark, scratch, documents=(data, H.DOC_SCHEMA)), "documents")
    kept = corpus_pipeline.near_dedup_stage(spark, docs, scratch)
    want = sorted([(1, a), (2, b), (2, c), (None, d), (3, e), (4, "")], key=str)
    assert kept.columns == docs.columns and sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == want
    # no copy is left that would take the whole text with it
    cut = corpus_pipeline.substring_stage(spark, kept, scratch)
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=str) == want


def test_different_texts_under_one_id_lose_their_own_bytes(spark, scratch):
    data, (a, b, c, _, _) = rows()
    data += [(7, "x" + a[:300] + b, None, None, None, None, None), (7, c[:250], None, None, None, None, None), (7, None, None, None, None, None, None)]
    folder = H.sf_dir(spark, scratch, documents=(data, H.DOC_SCHEMA))
    want = sorted((str(r[0]), n, g, s, hashlib.sha256(k).hexdigest()) for r, (n, g, s, k) in zip(data, brute([r[1] for r in data], 200), strict=True))
    got = suffix.op8_suffix_array_dedup(spark, folder).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want

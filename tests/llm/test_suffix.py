import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tagwise.llm import suffix
from tagwise.sources.tables import table
from tests.llm import helpers as H


def brute(texts, window):
    raw = [(t or "").encode() for t in texts]
    n = Counter(r[i : i + window] for r in raw for i in range(len(r) - window + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - window + 1):
            if n[r[i : i + window]] > 1:
                gone[i : i + window] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(r) else 0
        kept = bytes(b for b, g in zip(r, gone, strict=False) if not g)
        out.append((len(r), int(gone.sum()), spans, kept))
    return out


def check(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "text").collect()
    want = sorted((str(r.doc_id), n, g, s, hashlib.sha256(k).hexdigest()) for r, (n, g, s, k) in zip(rows, brute([r.text for r in rows], 200), strict=True))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.op8_suffix_array_dedup(spark, folder).collect())
    assert got == want
    return sum(w[2] for w in want)


def test_edge_cases_match_brute_force(spark, scratch):
    assert check(spark, H.sf_dir(spark, scratch, documents=(H.doc_rows(), H.DOC_SCHEMA)))


def test_documents_match_brute_force(spark):
    assert check(spark, "/root/testdata/sf0.001")


def test_empty_table(spark, scratch):
    assert suffix.op8_suffix_array_dedup(spark, H.sf_dir(spark, scratch, documents=([], H.DOC_SCHEMA))).collect() == []


def test_small_windows_with_many_partial_overlaps(spark):
    """Passages shared in parts, inside and across texts, periodic texts, and one shared by many."""
    rng = random.Random(6)
    pieces = ["".join(rng.choice("abcd") for _ in range(rng.randint(5, 60))) for _ in range(12)]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 6))) for _ in range(150)] + ["ab" * 40, "z" * 90, None, "", "é" * 33]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, sum(s.end - s.begin for s in r.removed), len(r.removed), bytes(r.kept)) for r in suffix.remove_repeats(df, 20, 8).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 20)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=400), st.integers(2, 6))
def test_runs_cover_each_window_once_and_equal_windows_agree(data, q):
    window = 12
    first, n, bucket, kind = suffix.runs(np.frombuffer(data, np.uint8), window, q)
    starts = [int(i) for f, k in zip(first, n, strict=True) for i in range(f, f + k)]
    assert starts == list(range(max(0, len(data) - window + 1)))
    of = {}
    for f, k, b in zip(first.tolist(), n.tolist(), bucket.tolist(), strict=True):
        for i in range(f, f + k):
            assert of.setdefault(data[i : i + window], b) == b


def test_columns_stay_and_cut_characters_go(spark):
    text = "é" * 150
    df = spark.createDataFrame([(1, text, "a", 150, "x"), (2, "b" + text + "c", "a", 7, "y"), (3, None, None, None, "z")], "doc_id long, text string, key string, n_chars long, whole string")
    got = {r.doc_id: r for r in suffix.drop_repeats(df).collect()}
    assert list(got[1].asDict()) == df.columns
    assert got[1].text == "" and got[1].n_chars == 0 and got[2].text == "bc" and got[2].n_chars == 2 and got[3].text is None and got[2]["whole"] == "y"

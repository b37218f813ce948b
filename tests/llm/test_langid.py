import zlib
from collections import Counter

import numpy as np

from tagwise.llm import langid
from tagwise.sources.tables import table
from tests.llm import helpers as H


def grams(text):
    out, word = Counter(), ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            p = f"_{word}_"
            out.update(word)
            out.update(p[i : i + 2] for i in range(len(p) - 1))
            out.update(p[i : i + 3] for i in range(len(p) - 2))
            word = ""
    return out


def top(counts):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:300]]


def brute(rows):
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 4 == 2
    learned = {}
    for i, t, lang in rows:
        if lang is not None and t is not None and not held(i):
            learned.setdefault(lang, Counter()).update(grams(t))
    profiles = {lang: {g: r for r, g in enumerate(top(c))} for lang, c in learned.items() if c}
    out = []
    for i, t, _ in rows:
        mine = top(grams(t))
        if not mine or not profiles:
            out.append((str(i), held(i), "und", 0.0))
            continue
        d = {lang: sum(abs(r - p[g]) if g in p else 300 for r, g in enumerate(mine)) for lang, p in profiles.items()}
        best = min(sorted(d), key=d.get)
        out.append((str(i), held(i), best, 1 - d[best] / (300 * len(mine))))
    return sorted(out)


def check(spark, folder):
    rows = [(r.doc_id, r.text, r.lang) for r in table(spark, folder, "documents").collect()]
    got = sorted((str(r.doc_id), r.held_out, r.lang_pred, r.score) for r in langid.op9_language_id(spark, folder).collect())
    want = brute(rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])


def test_edge_cases_match_brute_force(spark, scratch):
    rows = H.doc_rows() + [(500, "İI ΑΣ _a_b_ 1a2b 中文 x́", None, None, None, None, None), (501, "123 ... 4", "en", None, None, None, None)]
    check(spark, H.sf_dir(spark, scratch, documents=(rows, H.DOC_SCHEMA)))


def test_documents_match_brute_force(spark):
    check(spark, "/root/testdata/sf0.001")


def test_empty_table_and_no_language(spark, scratch):
    assert langid.op9_language_id(spark, H.sf_dir(spark, scratch, documents=([], H.DOC_SCHEMA))).collect() == []
    folder = H.sf_dir(spark, scratch, documents=([(1, "some text", None, None, None, None, None)], H.DOC_SCHEMA))
    assert [(r.lang_pred, r.score) for r in langid.op9_language_id(spark, folder).collect()] == [("und", 0.0)]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in table(spark, folder, "documents").select("doc_id", "lang").collect()}
    got = [r for r in langid.op9_language_id(spark, folder).collect() if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got]) > 0.97

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tagwise.llm import lexical
from tagwise.sources.tables import table
from tests.llm import helpers as H

ITEMS = "item_id long, text string, extra string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    own = [(d[0], Counter(split(d[1]))) for d in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n_docs, n_terms = len(own), sum(n for _, _, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in {(i[0], i[1]) for i in items}:
        found = []
        for doc, c, n in own:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(split(text)) if c[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank + 1, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(map(str, out))


def data():
    rng = random.Random(8)
    docs = H.doc_rows(seed=8, n=120)
    docs += [(500 + i, "the of common words " + H.words(rng, 5), None, None, None, None, None) for i in range(200)]
    docs += [(900, "İ ﬁ É é DON'T straße_x 12ab", None, None, None, None, None), (901, "\x00\x7f--", None, None, None, None, None)]
    items = [(i, docs[i][1][:200], "x") for i in range(0, 40, 3)] + [(100, "the THE of", "x"), (101, "É é ﬁ straße 12AB don", "x"), (102, "", "x"), (103, None, "x")]
    items += [(None, "common words", "x"), (7, "the one", "x"), (7, "on in", "x"), (0, docs[0][1][:200], "y"), (104, "nowhereatall", "x"), (105, H.words(rng, 3000), "x")]
    return docs, items


@pytest.mark.parametrize("short, postings, block", [(0, 1 << 20, 1 << 20), (5, 300, 1 << 20), (10**9, 500, 600), (lexical.SHORT, lexical.SHARD_POSTINGS, lexical.QUERY_BYTES)])
def test_equals_brute_force(spark, scratch, short, postings, block):
    docs, items = data()
    folder = H.sf_dir(spark, scratch, documents=(docs, H.DOC_SCHEMA), benchmark=(items, ITEMS))
    got = lexical.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), short=short, shard_postings=postings, block_bytes=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(docs, items)


def test_query_and_empty_tables(spark, scratch):
    docs, items = data()
    full = H.sf_dir(spark, scratch + "/a", documents=(docs, H.DOC_SCHEMA), benchmark=(items, ITEMS))
    assert sorted(str(tuple(r)) for r in lexical.op12_ranked_lexical_search(spark, full).collect()) == brute(docs, items)
    blank = [(1, None, None, None, None, None, None), (2, "--", None, None, None, None, None)]
    for name, d, q in (("b", [], items), ("c", docs[:5], []), ("d", blank, items)):
        folder = H.sf_dir(spark, f"{scratch}/{name}", documents=(d, H.DOC_SCHEMA), benchmark=(q, ITEMS))
        assert lexical.op12_ranked_lexical_search(spark, folder).collect() == []


def lists_of(rng, n_docs, sizes, top):
    out = []
    for size in sizes:
        d = np.sort(np.array(rng.sample(range(n_docs), size), np.int64))
        out.append((d, np.array([rng.randint(1, max(1, top // max(1, size // 50))) for _ in range(size)], np.int64)))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_search_of_lists_equals_a_full_sum(seed):
    rng = random.Random(seed)
    n_docs = rng.choice([3, 100, 20_000])
    lists = lists_of(rng, n_docs, [rng.randint(0, n_docs) for _ in range(rng.randint(0, 6))], rng.choice([3, 1000]))
    total = np.zeros(n_docs, np.int64)
    for d, s in lists:
        total[d] += s
    want = sorted(((-int(t), i) for i, t in enumerate(total) if t > 0))[:10]
    docs, scores = lexical.search(lists, n_docs, 10, 0)
    assert [(-int(s), int(d)) for d, s in zip(docs, scores, strict=True)] == want
    floor = -want[-1][0] if len(want) == 10 else 0
    docs, scores = lexical.search(lists, n_docs, 10, floor)
    assert [(-int(s), int(d)) for d, s in zip(docs, scores, strict=True)] == want


def test_long_lists_are_skipped():
    """With accumulators of rare terms as one iterator and their kth sum as floor, few postings of long lists are read."""
    rng = random.Random(1)
    n_docs = 50_000
    long = [(np.arange(n_docs), np.full(n_docs, 5, np.int64)), (np.arange(0, n_docs, 2), np.full(n_docs // 2, 7, np.int64))]
    rare = np.sort(np.array(rng.sample(range(n_docs), 40), np.int64))
    acc = (rare, np.array([100 + rng.randint(0, 900) for _ in rare], np.int64))
    seen = []
    lexical.search([acc, *long], n_docs, 10, int(np.sort(acc[1])[-10]), seen)
    assert seen[0] <= 40 * 3 < sum(len(d) for d, _ in long) / 100

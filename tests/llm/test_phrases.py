import random
from hashlib import sha256

import numpy as np
import pytest

from tagwise.llm import phrases
from tagwise.sources.tables import table
from tests.llm import helpers as H

M = (1 << 64) - 1
A, B, C = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9


def mix(x):
    x = (x ^ x >> 32) * A & M
    x = (x ^ x >> 29) * B & M
    return x ^ x >> 32


def toss(stretch):
    """Labels of one stretch without equal neighbours: four rounds of coin tossing."""
    for _ in range(4):
        out = [stretch[0] & 1]
        for a, b in zip(stretch, stretch[1:], strict=False):
            k = 0
            while a >> k & 1 == b >> k & 1:
                k += 1
            out.append(2 * k + (b >> k & 1))
        stretch = out
    assert max(stretch) < 6 and all(a != b for a, b in zip(stretch, stretch[1:], strict=False))
    return stretch


def plain_parse(x):
    """One level, symbol by symbol: the phrases' names."""
    pieces, i = [], 0  # runs and stretches in turn
    while i < len(x):
        j = i + 1
        if j < len(x) and x[j] == x[i]:
            while j < len(x) and x[j] == x[i]:
                j += 1
            pieces.append((True, x[i:j]))
        else:
            while j < len(x) and not (x[j] == x[j - 1] or (j + 1 < len(x) and x[j + 1] == x[j])):
                j += 1
            pieces.append((False, x[i:j]))
        i = j
    out = []
    for run, own in pieces:
        if run:
            out.append((mix(own[0]) * B + len(own) * C) & M)
            continue
        label = toss(own)
        cuts = [0] + [j for j in range(2, len(own) - 1) if label[j] > label[j - 1] and label[j] > label[j + 1]] + [len(own)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            out.append(sum(mix(v) * pow(A, k + 1, 1 << 64) for k, v in enumerate(own[a:b])) & M)
    return [mix(v ^ C) for v in out]


def plain_names(text, level=0):
    if not text:
        return {mix(C)}
    x, found = [ord(c) for c in text], set()
    while True:
        if level >= phrases.FROM_LEVEL:
            found |= set(x)
        if len(x) == 1:
            found |= {x[0]} if level else {mix((x[0] + A) & M)}
            return {mix(v) for v in found}
        x, level = plain_parse(x), level + 1


def plain_sketch(text):
    return [v >> 32 for v in sorted(plain_names(text))[: phrases.SKETCH]]


def plain_likeness(a, b):
    least = sorted(set(a) | set(b))[: phrases.SKETCH]
    both = len(set(least) & set(a) & set(b))
    return 2 * both / (len(least) + both)


def show(sketch):
    return "".join(f"{v:08x}" for v in sketch)


def texts():
    rng = random.Random(4)
    out = [r[1] or "" for r in H.doc_rows(seed=4, n=40)]
    out += ["", "a", "ab", "aa", "aaa", "aab", "baa", "abab" * 50, "𝒳é" * 7, "aabbaabb" * 9, "x" * 5000, "xy" * 2000 + "z" * 70 + "xy" * 10]
    return out + ["".join(rng.choice("ab") for _ in range(rng.randint(1, 400))) for _ in range(80)]


def test_parsing_in_batches_equals_a_plain_version():
    own = texts()
    for text, got in zip(own, phrases.sketches(own), strict=True):
        assert got.tolist() == plain_sketch(text)
    assert [s.tolist() for s in phrases.sketches(own[::-1])] == [s.tolist() for s in phrases.sketches(own)[::-1]]
    assert phrases.sketches([]) == []


def test_equal_substrings_share_their_interior():
    rng = random.Random(9)
    passage = H.words(rng, 700)[:3000]
    inside = set(phrases.names([passage])[1].tolist())
    for k in range(12):
        around = H.words(rng, 60)[:k] + passage + H.words(rng, 60)
        other = set(phrases.names([around])[1].tolist())
        assert len(inside & other) >= 0.9 * len(inside)
    # these texts have 15 syllables, so short phrases meet by chance; longer ones do not
    long, other = (set(phrases.names([t], 3)[1].tolist()) for t in (passage, H.words(rng, 700)))
    assert len(long & other) <= 0.02 * len(long)


def brute(rows):
    hashed = {t: h for t, h in rows["hash"]}
    order = sorted(rows["docs"], key=lambda r: (r[0] is None, -(r[0] or 0), hashed[r[1]]))
    out = []
    for i, r in enumerate(order):
        a, b = r[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(a) // 2
        c = a[: len(a) - half] + b[:half]
        own, cut = plain_sketch(a), plain_sketch(c)
        out.append((r[0], len(a), sha256(c.encode()).hexdigest(), show(own), show(cut), plain_likeness(own, cut), plain_likeness(own, plain_sketch(b))))
    return sorted(map(str, out))


@pytest.mark.parametrize("chars", [phrases.BATCH_CHARS, 300])
def test_query_equals_brute_force(spark, scratch, chars, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(phrases, "BATCH_CHARS", chars)
    rows = [r for r in H.doc_rows(seed=6, n=30) if len(r[1] or "") < 8000]
    rows += [(1000 + i, t, None, None, None, None, None) for i, t in enumerate(texts()[-40:])] + [(1000, "tie", None, None, None, None, None)]
    folder = H.sf_dir(spark, scratch, documents=(rows, H.DOC_SCHEMA))
    docs = table(spark, folder, "documents")
    hashed = [tuple(r) for r in docs.select("text", F.xxhash64("text")).distinct().collect()]
    got = phrases.op13_document_fingerprints(spark, folder)
    assert got.columns == [c.split()[0] for c in phrases.RESULT.split(", ")]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute({"docs": [r[:2] for r in rows], "hash": hashed})


def test_few_documents(spark, scratch):
    for n in (0, 1, 2):
        rows = [(i, f"text {i} " * 9, "en", None, None, None, None) for i in range(n)]
        got = phrases.op13_document_fingerprints(spark, H.sf_dir(spark, f"{scratch}/{n}", documents=(rows, H.DOC_SCHEMA))).collect()
        assert sorted(r.doc_id for r in got) == list(range(n))
        if n == 1:  # its own next document: the last half becomes a second first half
            assert got[0].near_next == 1.0 and got[0].edited_sha256 == sha256((rows[0][1][:32] + rows[0][1][:31]).encode()).hexdigest()


def test_likeness_tells_edits_from_other_texts():
    rng = random.Random(2)
    own = [H.words(rng, rng.randint(150, 900)) for _ in range(60)]
    cut = [phrases.edited(a, b) for a, b in zip(own, own[1:] + own[:1], strict=True)]
    a, b = phrases.sketches(own), phrases.sketches(cut)
    near = [phrases.likeness(x, y) for x, y in zip(a, b, strict=True)]
    far = [phrases.likeness(x, y) for x, y in zip(a, a[1:] + a[:1], strict=True)]
    assert min(near) > max(far) and 0.4 <= np.mean(near) <= 0.6 and np.mean(far) < 0.1

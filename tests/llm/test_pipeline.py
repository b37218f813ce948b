import random
import re

import corpus_pipeline
from tagwise.llm import ledger, packing, quality
from tagwise.sources.tables import table
from tests.llm import helpers as H
from tests.llm.test_ledger import BASE
from tests.llm.test_simhash import brute_fp
from tests.llm.test_suffix import brute as brute_repeats

LABELS = "doc_id long, quality int, toxic int"


def fixture(spark, scratch):
    """Clean and junk texts that a classifier can tell apart, copies, near copies, shared passages and secrets."""
    rng = random.Random(11)
    rows, labels = [], []
    passage = H.words(rng, 70)
    for i in range(240):
        text = ". ".join(H.words(rng, rng.randint(5, 12)).capitalize() for _ in range(rng.randint(3, 9))) + "."
        if i % 4 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif i % 10 == 1:
            text += " " + passage
        elif i % 10 == 3:
            text += " password = hunter2hunter"
        rows.append((i, text, "en", "hot", len(text), "extra", "extra"))
        labels.append((i, int(i % 4 != 0), 0))
    clean = [r for r in rows if r[0] % 4 and r[0] % 10 not in (1, 3)]
    rows += [(1000 + k, r[1], "en", "hot", r[4], "extra", "extra") for k, r in enumerate(clean[:6])]
    rows += [(None, clean[8][1], None, None, None, None, None), (2000, None, None, None, None, None, None), (2001, "", None, None, 0, None, None), rows[5]]
    return H.sf_dir(spark, scratch, documents=(rows, H.DOC_SCHEMA), labels=(labels, LABELS))


def by_row(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_stages_match_brute_force(spark, scratch):
    folder = fixture(spark, scratch)
    docs = table(spark, folder, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    assert names == ["quality_classifier", "simhash_near_dedup", "suffix_array_dedup", "secret_scans", "best_fit_packing"]

    machine = quality.fit(docs, table(spark, folder, "labels"))
    score = lambda r: float(machine.score(*quality._ragged([quality.features(r.text, r.n_chars)]))[0])
    one = stages[names[0]](spark, docs, folder)
    assert one.columns == docs.columns and by_row(one) == sorted(str(tuple(r)) for r in docs.collect() if score(r) >= 0.5)
    kept = {r.doc_id for r in one.collect()}
    assert sum(i in kept for i in range(240) if i % 4) >= 175 and sum(i in kept for i in range(0, 240, 4)) <= 5

    rows = one.collect()
    root = H.brute_components([brute_fp(r.text) for r in rows], lambda a, b: (a ^ b).bit_count() <= 4)
    # the least row of each component by id (rows without one last); rows of one component that share all of that are copies
    least = {}
    for r, c in sorted(zip(rows, root, strict=True), key=lambda x: (x[0].doc_id is None, x[0].doc_id or 0, str(x[0]))):
        least.setdefault(c, r)
    two = stages[names[1]](spark, one, folder)
    assert two.columns == docs.columns
    assert by_row(two) == sorted(str(tuple(r)) for r in least.values())
    assert sum(r.doc_id is None for r in rows) > sum(r.doc_id is None for r in least.values())

    rows = two.collect()
    three = stages[names[2]](spark, two, folder)
    assert three.columns == docs.columns
    cut = [(r.doc_id, None if r.text is None else k.decode("utf-8", "ignore")) for r, (_, _, _, k) in zip(rows, brute_repeats([r.text for r in rows], 200), strict=True)]
    assert sorted(map(str, cut)) == sorted(str((r.doc_id, r.text)) for r in three.collect())
    assert sum(len(t or "") for _, t in cut) < sum(len(r.text or "") for r in rows) - 1000
    assert all(r.n_chars in (len(r.text or ""), None) for r in three.collect())

    four = stages[names[3]](spark, three, folder)
    assert four.columns == docs.columns and four.count() == three.count()
    before = {r.doc_id: r.text for r in three.collect() if r.doc_id is not None}
    for r in four.collect():
        if r.doc_id is not None:
            masked = before[r.doc_id]
            for _, p, ok in BASE:
                masked = masked and re.sub(p, lambda m, ok=ok: "[SECRET]" if ok(m) else m[0], masked)
            assert r.text == masked
    assert any("[SECRET]" in (r.text or "") for r in four.collect())
    assert all(not r.spans for r in ledger.scan_versions(four.select(four["doc_id"].alias("key"), "text"), f"{scratch}/again").collect())

    five = stages[names[4]](spark, four, folder).collect()
    assert {str(r.doc_id) for r in five} == {str(r.doc_id) for r in four.collect()}
    fill = {}
    for r in five:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= packing.CAPACITY and len(fill) <= -(-sum(fill.values()) // packing.CAPACITY) + 1


def test_run_applies_the_stages(spark, scratch):
    folder = fixture(spark, scratch)
    got = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns) and got.count() > 100


def test_empty_documents(spark, scratch):
    folder = H.sf_dir(spark, scratch, documents=([], H.DOC_SCHEMA), labels=([], LABELS))
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_columns_of_documents_may_bear_any_name(spark, scratch):
    names = "row row_key key several _blob _spans blob spans cut fp shard tree component least".split()
    rows = [(i, H.words(random.Random(i), 60) + " password = hunter2hunter", "en", "hot", 1, *[f"{c}{i}" for c in names]) for i in range(6)]
    rows.append((6, rows[0][1], None, None, None, *[None] * len(names)))
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in names)
    folder = H.sf_dir(spark, scratch, documents=(rows, schema), labels=([(0, 1, 0)], LABELS))
    docs = table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == schema.replace(" long", "").replace(" string", "").split(", ")
        got = {r.doc_id: r for r in docs.collect()}
        assert sorted(got) == ([0, 1, 2, 3, 4, 5, 6] if name == "quality_classifier" else [0, 1, 2, 3, 4, 5])
        assert all(got[i][c] == f"{c}{i}" for i in range(6) for c in names)
    assert all("hunter2" not in r.text for r in got.values())
    assert {r.doc_id for r in corpus_pipeline.packing_stage(spark, docs, folder).collect()} == set(range(6))

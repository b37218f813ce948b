import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagwise.llm import packing
from tagwise.llm.bpe import public_path
from tagwise.sources.tables import table
from tests.llm import helpers as H


def check(spark, folder):
    tok = Tokenizer.from_file(public_path(packing.VOCABULARY))
    got = packing.op2_best_fit_packing(spark, folder).collect()
    want = []
    for r in table(spark, folder, "documents").collect():
        ids = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for i, n in enumerate(packing.cut_lengths(len(ids), 2048)):
            want.append((str(r.doc_id), i, at, n, zlib.crc32(ids[at : at + n].tobytes())))
            at += n
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r["offset"], r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 2048
    return len(bins), -(-sum(w[3] for w in want) // 2048)


def test_edge_cases_are_complete_gapless_and_near_the_bound(spark, scratch):
    rows = H.doc_rows() + [(900 + i, t, None, None, None, None, None) for i, t in enumerate(["  a  b\n\n\nc \n d", "\ta\t b", "a  b", "x<|endoftext|> y", "\n"])]
    used, bound = check(spark, H.sf_dir(spark, scratch, documents=(rows, H.DOC_SCHEMA)))
    assert used <= bound + 1


def test_documents(spark):
    used, bound = check(spark, "/root/testdata/sf0.001")
    assert used <= bound + 1


def test_empty_table(spark, scratch):
    assert packing.op2_best_fit_packing(spark, H.sf_dir(spark, scratch, documents=([], H.DOC_SCHEMA))).collect() == []


def test_pools_open_bins_over_blocks(spark):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 2049, 3000).tolist()
    items = spark.createDataFrame(list(enumerate(lengths)), "id long, length long")
    got = packing.pack(items, block_items=1024).collect()
    assert sorted(r.id for r in got) == list(range(3000))
    used, bound = len({r.sequence_id for r in got}), packing.lower_bound(np.array(lengths), 2048)
    assert used <= bound * 1.01 + 2


def test_pieces_that_cannot_share_end(spark):
    items = spark.createDataFrame([(i, 1100) for i in range(700)], "id long, length long")
    assert len({r.sequence_id for r in packing.pack(items, block_items=64).collect()}) == 700


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=120), st.integers(0, 5))
def test_evolution_keeps_valid_partitions_and_never_worsens(lengths, seed):
    a = np.array(lengths, np.int64)
    people, score, bound = packing.evolve(a, [], seed, capacity=100)
    for p in people:
        assert len(p) == len(a) and packing.fills(p, a).max() <= 100 and packing.fills(p, a).min() > 0
    assert bound <= len(packing.fills(people[0], a)) <= len(packing.fills(packing.first_individual(a, 100, None), a))


def test_crossover_injects_whole_bins():
    rng = np.random.default_rng(2)
    a = rng.integers(1, 60, 200)
    x, y = packing.first_individual(a, 100, None), packing.first_individual(a, 100, rng)
    child = packing.crossover(x, y, a, 100, rng)
    groups = lambda p: {frozenset(np.flatnonzero(p == b).tolist()) for b in range(p.max() + 1)}
    assert len(groups(child) & groups(y)) >= len(groups(y)) // 8
    assert packing.fills(child, a).max() <= 100

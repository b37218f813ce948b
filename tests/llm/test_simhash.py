import random
import re

import numpy as np
import xxhash

from tagwise.llm import simhash
from tagwise.sources.tables import table
from tests.llm import helpers as H


def brute_fp(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    grams = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def check(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "text").collect()
    fps = [brute_fp(r.text) for r in rows]
    root = H.brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for r, c in zip(rows, root, strict=True):
        if r.doc_id is not None:
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), f"{f:016x}", str(least.get(c))) for r, f, c in zip(rows, fps, root, strict=True))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.op10_simhash_near_dedup(spark, folder).collect())
    assert got == want


def test_edge_cases_match_brute_force(spark, scratch):
    check(spark, H.sf_dir(spark, scratch, documents=(H.doc_rows(), H.DOC_SCHEMA)))


def test_documents_match_brute_force(spark):
    check(spark, "/root/testdata/sf0.001")


def test_empty_table(spark, scratch):
    assert simhash.op10_simhash_near_dedup(spark, H.sf_dir(spark, scratch, documents=([], H.DOC_SCHEMA))).collect() == []


def clustered(seed, n):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5, 60])):
            out.add(x)
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
    return sorted(out)


def roots(nodes, links):
    at = {x: i for i, x in enumerate(nodes)}
    have = {frozenset((at[a], at[b])) for a, b in links}
    return H.brute_components(range(len(nodes)), lambda i, j: frozenset((i, j)) in have)


def test_tree_links_reach_what_all_pairs_reach(spark):
    fps = clustered(3, 500)
    want = H.brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    links = simhash.shard_forest(np.array(fps, np.uint64), 4)
    assert all((a ^ b).bit_count() <= 4 for a, b in links) and roots(fps, links) == want


def test_shards_lose_no_link_also_when_hot_shards_are_cut(spark):
    fps = clustered(5, 300)
    want = H.brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    # a single shard, keys of one block, keys of two blocks (more bits than one block has), each also with hot shards
    for rows, aim in ((20_000, 16_384), (3, 16_384), (20_000, 40), (3, 40), (20_000, 0.01), (2, 0.01)):
        got = simhash.shard_links(df, shard_rows=rows, tree_rows=aim).collect()
        links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in got]
        assert all((a ^ b).bit_count() <= 4 for a, b in links) and roots(fps, links) == want


def test_keys_meet_within_the_distance_and_grow_with_the_table():
    rng = random.Random(11)
    for rows, parts in ((10, 0), (10**6, 1), (10**9, 2), (10**12, 2)):
        plan = simhash.shard_keys(4, rows)
        assert all(len(p) == parts for p in plan)
        key = lambda x, p: [x >> shift & (1 << width) - 1 for shift, width in p]  # noqa: E731, B023
        for _ in range(2_000):
            x = y = rng.getrandbits(64)
            for b in rng.sample(range(64), 4):
                y ^= 1 << b
            assert any(key(x, p) == key(y, p) for p in plan)
        bits = {sum(w for _, w in p) for p in plan}
        assert len(bits) == 1 and (parts == 0 or rows / 2 ** bits.pop() <= max(simhash.TREE_ROWS, rows / 2**20))


def test_trees_of_the_given_fingerprints_have_children_and_skip_edges(spark):
    """The shards that the operator makes of a given table are trees of several levels, and a search leaves most of
    the (query, edge) pairs of the lower levels out."""
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    fps = np.array([r.fp for r in simhash.fingerprints(docs).select("fp").distinct().collect()], np.int64).view(np.uint64)
    assert simhash.shard_keys(4, len(fps)) == [[]]  # one shard here
    tree = simhash.BKTree(fps)
    inner = [c for c in tree.children.values() if isinstance(c, simhash.BKTree)]
    assert len(inner) >= 10 and any(isinstance(c, simhash.BKTree) for t in inner for c in t.children.values())
    stack = [tree]
    while stack:
        node = stack.pop()
        for k, child in node.children.items():
            idx = child.idx if isinstance(child, simhash.BKTree) else child
            assert (np.bitwise_count(fps[idx] ^ fps[node.pivot]) == k).all() and (isinstance(child, simhash.BKTree) or len(idx) <= simhash.LEAF)
            stack += [child] if isinstance(child, simhash.BKTree) else []
    links = simhash.shard_forest(fps, 4, tree=tree)
    followed, skipped = tree.edges()
    assert 0 < followed < skipped + followed and skipped > 0.2 * (skipped + followed), (followed, skipped)
    near = [np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 4) + i + 1 for i in range(len(fps))]
    linked = {frozenset(p) for p in links}
    boss = {int(x): int(x) for x in fps}

    def root(x):
        while boss[x] != x:
            x = boss[x]
        return x

    for a, b in (tuple(p) for p in linked):
        boss[root(a)] = root(b)
    assert all(root(int(fps[i])) == root(int(fps[j])) for i, js in enumerate(near) for j in js)
    assert all((a ^ b).bit_count() <= 4 for a, b in (tuple(p) for p in linked))

import random
import zlib
from hashlib import sha256

import pytest

from tagwise.llm import merkle
from tagwise.sources.tables import table
from tests.llm import helpers as H


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*map(enc, (r[0], r[3], r[2], r[4], text)))


def grow(nodes):
    """All levels of one tree and, for every leaf, its siblings level by level as (left, right)."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h(*row[i : i + 3]) for i in range(0, len(row), 3)])
    ways = []
    for i in range(len(nodes)):
        way = []
        for row in levels[:-1]:
            at = i // 3 * 3
            way.append(("".join(row[at:i]), "".join(row[i + 1 : at + 3])))
            i //= 3
        ways.append(way)
    return levels[-1][0], ways


def brute(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        own = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append((own, *grow([leaf(r, r[1]) for r in own])))
    root, over = grow([t[1] for t in trees])
    out = []
    for (own, subroot, ways), top in zip(trees, over, strict=True):
        for r, way in zip(own, ways, strict=True):
            hit = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf(r, r[1].replace("\n", "") if hit else r[1])
            for a, b in way + top:
                node = h(a, node, b)
            proof = h(*[x for pair in way + top for x in pair])
            out.append((r[0], leaf(r, r[1]), subroot, root, proof, node, node == root))
    return sorted(map(str, out))


def rows(n):
    rng = random.Random(n)
    found = H.doc_rows(seed=3, n=20)
    for i in range(100, 100 + n):
        text = H.words(rng, rng.randint(1, 8)) + rng.choice(["", "\n", "\n\nend"])
        found.append((i, text, "en", rng.choice(["hot", "hot", "hot", "a", "é", "zz", "", "𝒳", f"s{i % 17}"]), len(text), "clash", "clash"))
    return found + [found[-1]] * 5 + [(2**60 + 1, "x\n", None, "one", 1, None, None), (-3, "\n", None, "hot", 1, None, None)]


@pytest.mark.parametrize("levels", [1, 2, merkle.LEVELS])
def test_equals_brute_force(spark, scratch, levels):
    data = rows(150)
    docs = table(spark, H.sf_dir(spark, scratch, documents=(data, H.DOC_SCHEMA)), "documents")
    got = merkle.manifest(merkle.document_leaves(docs), levels).collect()
    assert sorted(str((None if r[0] is None else int(r[0]), *r[1:])) for r in got) == brute(data)


def test_query_and_its_columns(spark, scratch):
    data = rows(12)
    got = merkle.op11_merkle_manifest(spark, H.sf_dir(spark, scratch, documents=(data, H.DOC_SCHEMA)))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = got.collect()
    assert sorted(str(tuple(r)) for r in found) == brute(data)
    assert {r.verified for r in found} == {True, False} and len({r.root for r in found}) == 1


def test_one_leaf_and_no_leaf(spark, scratch):
    one = [(5, "a\nb", None, None, 3, None, None)]
    got = merkle.op11_merkle_manifest(spark, H.sf_dir(spark, scratch + "/1", documents=(one, H.DOC_SCHEMA)))
    assert [str(tuple(r)) for r in got.collect()] == brute(one)
    none = merkle.op11_merkle_manifest(spark, H.sf_dir(spark, scratch + "/0", documents=([], H.DOC_SCHEMA)))
    assert none.columns == got.columns and none.collect() == []


def test_equal_leaves_of_a_hot_group_are_split(spark, scratch):
    """A document that is repeated over and over is dealt over the range partitions like any other rows."""
    data = [(1, "same", "en", "hot", 4)] * 3000
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    nodes, n_trees, largest = merkle._placed(merkle.document_leaves(docs))
    assert (n_trees, largest) == (1, 3000)
    assert sorted(r.pos for r in nodes.select("pos").collect()) == list(range(3000))

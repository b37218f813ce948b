import math

import numpy as np

from tagwise.llm import balltree
from tagwise.sources.tables import table
from tests.llm import helpers as H

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string"


def brute(rows, every, k=5):
    good = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out, done = [], set()
    for i, q in good:
        if i % every or (i, tuple(q)) in done:
            continue
        done.add((i, tuple(q)))
        scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in good if j != i and len(v) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def check(spark, folder, every=50):
    rows = [(r.vec_id, r.embedding) for r in table(spark, folder, "embeddings").select("vec_id", "embedding").collect()]
    got = sorted(tuple(r) for r in balltree.op5_exact_top_k(spark, folder).select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute(rows, every) and (got or not rows)


def test_edge_cases_match_brute_force(spark, scratch):
    rng = np.random.default_rng(1)
    vs = rng.normal(size=(230, 8)).astype(np.float32).tolist()
    vs += [vs[0]] * 9 + [None, [], [1.0] + [None] * 7, [float("nan")] * 8, [float("-inf")] * 8, vs[1][:4], vs[2][:4], [0.0] * 8, [1e6] * 8]
    rows = [(i, v, 0, "clash", "clash") for i, v in enumerate(vs)] + [(None, vs[0], 0, "", ""), (3, vs[3], 0, "", ""), (50, vs[50], 0, "", ""), (100, None, 0, "", "")]
    check(spark, H.sf_dir(spark, scratch, embeddings=(rows, SCHEMA)))


def test_documents_match_brute_force(spark):
    check(spark, "/root/testdata/sf0.001")


def test_empty_table(spark, scratch):
    assert balltree.op5_exact_top_k(spark, H.sf_dir(spark, scratch, embeddings=([], SCHEMA))).collect() == []


def test_shards_and_blocks_give_the_same_answers(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    rows = list(enumerate(rng.integers(-1, 2, size=(400, 6)).astype(float).tolist()))  # many ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, 7)
    for shard_rows, block in ((1000, 1000), (60, 13)):
        got = balltree.top_k(df, F.col("vec_id") % 7 == 0, shard_rows=shard_rows, block_queries=block).collect()
        assert sorted(tuple(r) for r in got) == want


def test_bound_prunes_leaves():
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(40, 32)) * 400
    rows = np.floor(centers[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 32)) * 20)
    tree, visits = balltree.BallTree(rows), []
    score = lambda idx, q: (visits.append(len(idx)), rows[idx] @ q)[1]
    q = rows[0]
    got = tree.search(q, tree.bounds(q[None])[0], score, np.arange(4000), 0, 5, -np.inf)
    assert sorted(s for s, _ in got) == sorted((rows[1:] @ q).astype(int))[-5:] and sum(visits) < 1000

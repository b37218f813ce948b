import math

import numpy as np

from tagwise.llm import vectors
from tagwise.sources.tables import table
from tests.llm import helpers as H

SCHEMA = "vec_id long, embedding array<float>, label int, size long, component string"


def brute(rows, threshold=0.95):
    ok, vec = [], []
    for _, e in rows:
        good = e is not None and len(e) > 0 and all(x is not None and math.isfinite(x) for x in e) and any(x != 0 for x in e)
        ok.append(good)
        v = np.array(e, np.float64) if good else None
        vec.append(v / np.abs(v).max() if good else None)

    def linked(i, j):
        if not (ok[i] and ok[j]) or len(vec[i]) != len(vec[j]):
            return False
        if (vec[i] == vec[j]).all():
            return True
        return float(vec[i] @ vec[j]) / (np.linalg.norm(vec[i]) * np.linalg.norm(vec[j])) >= threshold

    n = len(rows)
    links = [sum(linked(i, j) for j in range(n) if j != i) for i in range(n)]
    root = H.brute_components(range(n), linked)
    least = {}
    for i, c in enumerate(root):
        if rows[i][0] is not None:
            least[c] = min(least.get(c, rows[i][0]), rows[i][0])
    return sorted((str(rows[i][0]), links[i], str(least.get(root[i])), rows[i][0] is not None and rows[i][0] == least.get(root[i])) for i in range(n))


def check(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in table(spark, folder, "embeddings").select("vec_id", "embedding").collect()]
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in vectors.op3_embedding_near_dedup(spark, folder).collect())
    want = brute(rows)
    assert got == want
    return sum(w[1] for w in want)


def clustered(seed, n, d=16, noise=0.09):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, d))
    return [(centers[i % 12] + rng.normal(size=d) * noise * (1 + i % 3)).astype(np.float32).tolist() for i in range(n)]


def test_edge_cases_match_brute_force(spark, scratch):
    vs = clustered(1, 150)
    vs += [vs[0], vs[0], vs[1], [0.0] * 16, None, [], [1.0] + [None] * 15, [float("nan")] * 16, [float("inf")] * 16, vs[2][:8], vs[2][:8], [1e38] * 16, [3e38] * 16, [1e-38] * 16]
    rows = [(i, v, 0, 5, "clash") for i, v in enumerate(vs)] + [(None, vs[0], 0, 1, "c"), (None, None, 0, 1, "c"), (3, vs[3], 0, 1, "c")]
    assert check(spark, H.sf_dir(spark, scratch, embeddings=(rows, SCHEMA)))


def test_documents_match_brute_force(spark):
    check(spark, "/root/testdata/sf0.001")


def test_empty_table_and_no_valid_vector(spark, scratch):
    assert vectors.op3_embedding_near_dedup(spark, H.sf_dir(spark, scratch, embeddings=([], SCHEMA))).collect() == []
    got = vectors.op3_embedding_near_dedup(spark, H.sf_dir(spark, scratch, embeddings=([(1, None, 0, 1, "x")], SCHEMA))).collect()
    assert [tuple(r) for r in got] == [(1, 0, 1, True)]


def test_many_tiles_lose_no_link(spark):
    rows = list(enumerate(clustered(7, 400, noise=0.12)))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in vectors.near_duplicates(df, tile_rows=40).collect())
    assert got == brute(rows) and sum(g[1] for g in got) > 400


def test_pairs_are_given_up_once_the_bound_falls_below_the_threshold(monkeypatch):
    """Leading dimensions decide most pairs: only few reach the exact check."""
    axes = np.eye(64)
    rng = np.random.default_rng(3)
    scale = 0.5 ** (np.arange(64) / 4)
    raw = [v.tobytes() for v in rng.normal(size=(300, 64)) * scale]
    tile = vectors._Tile(np.arange(300), np.ones(300, np.int64), raw, axes)
    seen, exact = [], vectors._cosine
    monkeypatch.setattr(vectors, "_cosine", lambda a, b: (seen.append(len(a)), exact(a, b))[1])
    vectors.compare(tile, None, 0.95)
    assert 300 <= sum(seen) < 5000

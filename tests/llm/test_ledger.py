import hashlib
import re

from tagwise.llm import ledger
from tagwise.sources.tables import table
from tests.llm import helpers as H

BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def brute(text):
    found = [(m.start(), i, m.end(), k) for i, (k, p, ok) in enumerate(BASE) for m in p.finditer(text or "") if ok(m)]
    spans = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))
    n = {k: sum(x[3] == k for x in found) for k, _, _ in BASE}
    return (n["assign"], n["access"], n["hex"], hashlib.sha256(spans.encode()).hexdigest(), spans)


def check(spark, folder):
    got = sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in ledger.op7_secret_scans(spark, folder).collect())
    want = sorted((str(r.doc_id), *brute(r.text)) for r in table(spark, folder, "documents").collect())
    assert got == want
    return got


def test_matches_brute_force_on_edge_cases(spark, scratch):
    got = check(spark, H.sf_dir(spark, scratch, documents=(H.doc_rows(), H.DOC_SCHEMA)))
    assert sum(x[1] for x in got) >= 4 and sum(x[2] for x in got) >= 2 and sum(x[3] for x in got) >= 2


def test_matches_brute_force_on_documents(spark):
    check(spark, "/root/testdata/sf0.001")


def test_empty_table(spark, scratch):
    assert ledger.op7_secret_scans(spark, H.sf_dir(spark, scratch, documents=([], H.DOC_SCHEMA))).collect() == []


def test_ledger_scans_only_unseen_blobs_and_versions(spark, scratch):
    rows = [("a", H.SECRET), ("b", H.SECRET), ("c", "nothing"), (None, "token=abcdef9"), (None, "token=abcdef9"), ("d", None)]
    first = spark.createDataFrame(rows, "key string, text string")
    path = f"{scratch}/ledger"
    ledger.scan_versions(first, path).collect()
    assert spark.read.parquet(path).count() == 4
    more = first.union(spark.createDataFrame([("e", "nothing"), ("f", "secret=zzzzzz")], "key string, text string"))
    got = ledger.scan_versions(more, path).collect()
    assert len(got) == 8 and all(r.spans is not None for r in got)
    assert spark.read.parquet(path).count() == 5
    only_hex = (ledger.Rule("hex", r"[0-9a-f]{24,}", 24),)
    again = ledger.scan_versions(more, path, only_hex, "hex-1").collect()
    assert spark.read.parquet(path).count() == 10
    assert {s.kind for r in again for s in r.spans} == {"hex"}


def test_redaction_masks_every_span_once(spark):
    df = spark.createDataFrame([("k", H.SECRET), ("n", "clean"), ("z", None)], "key string, text string")
    from pyspark.sql import functions as F

    blobs = df.select("key", F.col("key").alias("blob"), "text")
    out = {r.blob: r.t for r in blobs.join(ledger.scan(blobs.where("text is not null")), "blob", "left").select("blob", ledger.redact(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert out["n"] == "clean" and out["z"] is None
    assert "0123456789abcdef" not in out["k"] and "AKIA" not in out["k"] and out["k"].count("[SECRET]") == 3 and "é𝒳" in out["k"]

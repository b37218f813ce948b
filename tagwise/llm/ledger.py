"""Secret scans with an incremental blob ledger (DataFrame functions only).

Every version of every path is content-addressed (``blob`` = SHA-256 of its text). A ledger table holds one row
per (blob, rules version) that was scanned, with its findings. A run scans only the pairs the ledger has not seen,
appends them, and joins the findings back to every path that holds the blob.

Defined results: a null text counts as empty; an empty text has no findings; equal texts share one blob and one
scan; rows repeat in the result as often as in the input; a null key stays null; an empty table gives an empty
result and an empty ledger entry. Extra columns of the input are ignored. Java regular expressions match the
contract's ASCII classes; lengths and offsets are counted in code points, ``end`` exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwise.session import state_path
from tagwise.sources.tables import table


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches leftmost and non-overlapping; a match whose capture ``group`` (0: all of it) is shorter
    than ``least`` is dropped."""

    kind: str
    pattern: str
    least: int
    group: int = 0


# fixed values: the rules of the contract, in the order in which kinds are listed
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 1),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
RULES_VERSION = "base-1"

SPAN = "struct<kind:string,rank:int,start:int,stop:int>"
LEDGER_SCHEMA = f"blob string, rules string, spans array<{SPAN}>"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule: each piece is the gap before a match plus the match; running lengths give the offsets."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s)\\G(.*?)({rule.pattern})"), F.lit(0))
    gaps = F.regexp_extract_all(text, F.lit(f"(?s)\\G(.*?)({rule.pattern})"), F.lit(1))
    both = F.arrays_zip(pieces.alias("piece"), gaps.alias("gap"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        stop = acc["at"] + F.length(x["piece"])
        begin = acc["at"] + F.length(x["gap"])
        judged = F.regexp_extract(F.substring(x["piece"], F.length(x["gap"]) + 1, F.length(x["piece"])), rule.pattern, rule.group)
        span = F.struct(F.lit(rule.kind).alias("kind"), F.lit(rank).alias("rank"), begin.alias("start"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.when(F.length(judged) >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(both, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(blob, text)`` -> ``(blob, spans)``, spans ordered by start, then by the rules' order."""
    per_rule = [_spans(F.col("text"), r, i) for i, r in enumerate(rules)]
    key = lambda s: F.struct(s["start"], s["rank"], s["stop"], s["kind"])
    merged = F.array_sort(F.transform(F.concat(*per_rule), key))
    spans = F.transform(merged, lambda k: F.struct(k["kind"].alias("kind"), k["rank"].alias("rank"), k["start"].alias("start"), k["stop"].alias("stop")))
    return blobs.select("blob", spans.alias("spans"))


def update_ledger(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, rules_version: str = RULES_VERSION) -> DataFrame:
    """Scan the blobs of ``versions (key, text)`` that ``ledger`` (a Parquet folder) lacks for ``rules_version``,
    append them and return the ledger's rows for that version.

    One representative row per unseen blob is found on narrow columns (hash and key, partial aggregate), and only
    representatives carry their text further. Each run appends its own files, so a run that dies leaves nothing
    half-written (Parquet commit) and a repeated run scans only what is still missing.
    """
    spark = versions.sparkSession
    held = _read_ledger(spark, ledger).where(F.col("rules") == rules_version)
    named = versions.select("key", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("blob", blob_id(F.col("text")))
    # rows without a key cannot be found again by it, so they bring their text along as their own representatives
    reps = named.where("key IS NOT NULL").groupBy("blob").agg(F.min("key").alias("key")).join(held, "blob", "left_anti")
    fresh = named.join(reps.select("key", F.col("blob").alias("_b")), "key").where("blob = _b").select("blob", "text")
    loose = named.where("key IS NULL").select("blob", "text").dropDuplicates(["blob"]).join(held, "blob", "left_anti")
    loose = loose.join(reps.select("blob"), "blob", "left_anti")
    # rows that repeat key and text are scanned once each; their (narrow) findings are one ledger row
    found = scan(fresh.unionByName(loose), rules).dropDuplicates(["blob"]).select("blob", F.lit(rules_version).alias("rules"), "spans")
    found.write.mode("append").parquet(ledger)
    return _read_ledger(spark, ledger).where(F.col("rules") == rules_version)


def _read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; a folder that does not exist yet is an empty ledger."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def scan_versions(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, rules_version: str = RULES_VERSION) -> DataFrame:
    """``(key, text)`` -> ``(key, blob, spans)`` for every row, scanning only what the ledger has not seen."""
    found = update_ledger(versions, ledger, rules, rules_version).select("blob", "spans").dropDuplicates(["blob"])
    return versions.select("key", blob_id(F.col("text")).alias("blob")).join(found, "blob", "left").select("key", "blob", "spans")


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """Replace every character run covered by a span with ``mask`` (overlapping spans are masked once)."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], kept, F.lit(mask))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), out.alias("out"))

    done = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, from a ledger that starts empty for this run."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text")
    found = scan_versions(docs, state_path(spark, "ledger"))
    shown = F.array_join(
        F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("key").alias("doc_id"),
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(shown.cast("binary"), 256).alias("base_sha256"),
        shown.alias("spans"),
        "blob",
    )

"""Training-corpus pipeline over ``documents``.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes
as Parquet in the shared checkpoint folder and rereads as the next stage's docs. All stages but the last return the
columns of ``documents`` (extra columns included). Rows without a doc_id or text are documents like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwise.llm import ledger, packing, quality, simhash, suffix
from tagwise.session import materialize, state_path
from tagwise.sources.tables import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores below 0.5 go. Scored in place, without a shuffle."""
    score = quality.scorer(spark, quality.fit(docs, table(spark, sf_dir, "labels")))
    # the score is a row's own expression: it adds no column that could clash
    return docs.where(score(F.col("text"), F.col("n_chars")) >= 0.5)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id, rows without an id last.

    Rows are told apart by a key of their own, written with them, so rows that repeat an id or have none are
    documents like any other: copies go, and different texts under one id stay.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("row_key"))
    rows = materialize(rows)
    kept = simhash.simhash_kept(rows.select("row.doc_id", "row.text", "row_key"))
    stays = rows.join(kept, "row_key", "left_semi")
    return stays.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of repeated 200-byte strings are removed; a character that is cut in two goes as a whole."""
    return suffix.drop_repeats(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked. Findings are joined back by blob, so every path of a blob is masked.

    A row travels as one struct beside its blob, so no column of the documents can clash with one of the join."""
    versions = docs.select(F.col("doc_id").alias("key"), "text")
    found = ledger.update_ledger(versions, state_path(spark, "ledger")).where(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), ledger.blob_id(docs["text"]).alias("blob"))
    text = F.when(F.col("spans").isNotNull(), ledger.redact(F.col("row.text"), F.col("spans"))).otherwise(F.col("row.text"))
    masked = rows.join(found, "blob", "left").withColumn("text", text)
    n_chars = F.when(F.col("spans").isNull(), F.col("row.n_chars")).otherwise(F.length("text")).cast("long")
    own = {"text": F.col("text"), "n_chars": n_chars}
    return masked.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document that is left, with its sequence and offset."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("suffix_array_dedup", substring_stage),
    ("secret_scans", secrets_stage),
    ("best_fit_packing", packing_stage),
]

# SQL cannot express the fitted classifier, the byte-level tokenizer or the genetic algorithm; tests/llm/test_pipeline.py
# holds the stages against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs

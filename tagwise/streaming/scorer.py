"""Continuous scoring of arriving texts (X1) with invalid requests diverted.

Structured Streaming file source -> ``foreachBatch``. Inside a micro-batch the per-row group-bys and
the top-k window are ordinary batch plans over the batch's rows joined with the (static, broadcast)
fitted state tables. Each batch writes ``<sink>/<table>/batch_id=<id>`` with overwrite, so a replayed
batch after a failure rewrites the same folder (idempotent); progress lives in the checkpoint folder.
Only offsets are state, so no watermark is needed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwise.operators.clean import validate_requests
from tagwise.plans import pipeline as P
from tagwise.sources.io import scratch_dir


def request_stream(spark: SparkSession, source_dir: str, glob: str = "documents.parquet", max_files: int | None = None) -> DataFrame:
    """Documents arriving in ``source_dir`` as scoring requests (row_id, description); a micro-batch takes at most
    ``max_files`` new files (all of them without). ``glob`` names files, or folders of part files as Spark writes them:
    it is part of the path, as a file-name filter would pass over the parts of a folder."""
    source_dir = source_dir.rstrip("/")
    schema = spark.read.parquet(f"{source_dir}/{glob}").schema
    raw = spark.readStream.schema(schema)
    if max_files:
        raw = raw.option("maxFilesPerTrigger", max_files)
    # in braces a plain name is a pattern too: the stream takes a path without one as a folder, never as one file
    return requests_projection(raw.parquet(f"{source_dir}/{{{glob}}}"))


def requests_projection(docs: DataFrame) -> DataFrame:
    """Same projection as the ``requests`` view (every 50th document arrives blank)."""
    return docs.select(
        F.col("doc_id").alias("row_id"),
        F.when(F.col("doc_id") % 50 == 0, F.lit("")).otherwise(F.col("text")).alias("description"),
    )


def flat_records(records: DataFrame) -> DataFrame:
    """Prediction records with the nested parts as text."""
    shown = F.transform("genres_with_confidence", lambda s: F.format_string("%s:%.6f", s["genre"], s["confidence"]))
    return records.select(
        "row_id",
        F.array_join("genres", ",").alias("predicted"),
        F.size("genres").cast("long").alias("n_labels"),
        F.array_join(shown, "|").alias("confidences"),
        "description",
        F.col("validation.length").alias("length"),
        F.col("validation.is_optimal").alias("is_optimal"),
        F.col("validation.recommendation").alias("recommendation"),
    )


def run_scorer(
    spark: SparkSession,
    source_dir: str,
    fitted: P.FittedPipeline,
    sink_dir: str | None = None,
    checkpoint_dir: str | None = None,
    glob: str = "documents.parquet",
    max_files: int | None = None,
    on_predictions: Callable[[int], None] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Process everything available (``availableNow``) and return (predictions, quarantine) tables.

    A run that ends in the middle of a micro-batch leaves that batch's offsets in ``checkpoint_dir``; the next run with
    the same two folders takes the same files for it and overwrites its folder, so every request is there once.
    ``on_predictions`` is called with the batch id once a batch's predictions are written, before its quarantine.
    """
    # without folders of its own the run is a one-off; a restart must pass the same folders to go on where it stopped
    run = uuid.uuid4().hex[:12]
    sink_dir = sink_dir or scratch_dir(spark, f"stream_sink_{run}")
    checkpoint_dir = checkpoint_dir or f"{sink_dir}/_progress"

    def handle(batch: DataFrame, batch_id: int) -> None:
        checked = validate_requests(batch).persist()
        good = checked.filter("valid").select("row_id", "description")
        bad = checked.filter(~F.col("valid")).select("row_id", "reason")
        out = flat_records(P.predict_records(fitted, good))
        out.write.mode("overwrite").parquet(f"{sink_dir}/predictions/batch_id={batch_id}")
        if on_predictions:
            on_predictions(batch_id)
        bad.write.mode("overwrite").parquet(f"{sink_dir}/quarantine/batch_id={batch_id}")
        checked.unpersist()

    q = (
        request_stream(spark, source_dir, glob, max_files)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    preds = spark.read.parquet(f"{sink_dir}/predictions").drop("batch_id")
    quarantine = spark.read.parquet(f"{sink_dir}/quarantine").drop("batch_id")
    return preds, quarantine

"""The streaming scorer gives the same predictions as the batch plan, and diverts invalid rows."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark):
    from tagwise.operators.clean import validate_requests
    from tagwise.plans import pipeline as P
    from tagwise.plans import queries as Q
    from tagwise.sources import tables
    from tagwise.streaming.scorer import run_scorer

    fitted, _, _, _ = Q.fitted_nb(spark, SF_SMALL)
    preds, quarantine = run_scorer(spark, SF_SMALL, fitted)
    req = validate_requests(tables.requests(spark, SF_SMALL))
    batch = P.predict(fitted, req.filter("valid").select("row_id", "description"))
    want = sorted((r["row_id"], ",".join(r["labels"])) for r in batch.collect())
    got = sorted((r["row_id"], r["predicted"]) for r in preds.collect())
    assert got == want
    bad = sorted((r["row_id"], r["reason"]) for r in quarantine.collect())
    assert bad == sorted((r["row_id"], r["reason"]) for r in req.filter(~F.col("valid")).collect())
    assert len(bad) > 0


def test_restart_takes_up_the_unfinished_batch(spark, scratch):
    """Ended inside batch 1 (its predictions are there, its quarantine is not); the next run repeats that batch with the
    same file and takes the rest, so each request is in one of the tables once. A third run finds nothing new."""
    import pytest
    from pyspark.errors import StreamingQueryException

    from tagwise.plans import queries as Q
    from tagwise.sources import tables
    from tagwise.streaming.scorer import run_scorer

    fitted, _, _, _ = Q.fitted_nb(spark, SF_SMALL)
    source, sink = f"{scratch}/in", f"{scratch}/out"
    docs = tables.table(spark, SF_SMALL, "documents")
    docs.repartition(4, "doc_id").write.parquet(source)
    folders = dict(sink_dir=sink, checkpoint_dir=f"{sink}/_progress", glob="*.parquet", max_files=1)
    seen = []

    def stop(batch_id):
        seen.append(batch_id)
        if batch_id == 1:
            raise RuntimeError("ended here")

    with pytest.raises(StreamingQueryException, match="ended here"):
        run_scorer(spark, source, fitted, **folders, on_predictions=stop)
    assert seen == [0, 1]
    half = {r.row_id for r in spark.read.parquet(f"{sink}/predictions/batch_id=1").collect()}
    run_scorer(spark, source, fitted, **folders, on_predictions=seen.append)
    assert seen == [0, 1, 1, 2, 3]
    assert half and half == {r.row_id for r in spark.read.parquet(f"{sink}/predictions/batch_id=1").collect()}
    preds, quarantine = run_scorer(spark, source, fitted, **folders, on_predictions=seen.append)
    assert seen == [0, 1, 1, 2, 3]
    got = sorted(r.row_id for r in preds.select("row_id").union(quarantine.select("row_id")).collect())
    assert got == sorted(r.doc_id for r in docs.collect())


def test_documents_in_a_folder_of_part_files(spark, scratch):
    """A table written by Spark is a folder ``documents.parquet`` with parts of other names: all of them are read."""
    from tagwise.streaming.scorer import request_stream

    rows = spark.createDataFrame([(i, f"text {i}") for i in range(1, 9)], "doc_id long, text string")
    rows.repartition(3).write.parquet(f"{scratch}/documents.parquet")
    rows.write.parquet(f"{scratch}/other.parquet")
    q = request_stream(spark, scratch).writeStream.format("memory").queryName("parts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.row_id for r in spark.table("parts").collect()) == list(range(1, 9))

"""Spark-plan properties and partition invariance."""

import pytest

from tests.conftest import SF_SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def q():
    from tagwise.plans import queries as Q

    return Q


def test_flagship_has_no_cartesian_product_or_python_udf(spark, q):
    df = q.QUERIES["nb_predict"](spark, SF_SMALL)
    text = plan_text(df)
    assert "CartesianProduct" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_scan_prunes_columns(spark, q):
    df = q.QUERIES["label_frequency"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    # the documents scan reads only the columns the movie view needs (n_chars is never read)
    assert "n_chars" not in text


@pytest.mark.parametrize("key", ["label_frequency", "threshold_sweep", "confusion_patterns"])
def test_partition_invariance(spark, q, key):
    out = []
    for parts in ("1", "4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        out.append(sorted(map(tuple, q.QUERIES[key](spark, SF_SMALL).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[0] == out[1] == out[2]


def test_no_filter_repeats_the_tokeniser_below_the_exchange(spark):
    from tagwise.operators import text as TX

    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, ""), (3, None)], "row_id long, description string")
    terms = TX.doc_terms(TX.by_row(docs), TX.VectorizerParams())
    assert "size(" not in plan_text(terms)
    assert {r["row_id"] for r in terms.collect()} == {1}  # rows without terms drop out

"""The classifier as pyspark.ml stages."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tagwise.estimator import MicroF1Evaluator, TextLabelClassifier, TextLabelModel
from tagwise.plans import pipeline as P
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def rows(spark):
    return P.split(P.corpus(spark, SF_SMALL).select("row_id", "description", "labels"))


def listed(df, key="row_id", col="predicted"):
    return sorted((r[key], ",".join(r[col])) for r in df.collect())


def test_saved_pipeline_predicts_the_same(spark, rows, scratch):
    train, test = rows
    model = Pipeline(stages=[TextLabelClassifier(topK=2)]).fit(train)
    want = listed(model.transform(test))
    model.write().save(f"{scratch}/model")
    loaded = PipelineModel.load(f"{scratch}/model")
    stage = loaded.stages[0]
    assert isinstance(stage, TextLabelModel) and stage.uid == model.stages[0].uid and stage.getOrDefault("topK") == 2
    assert listed(loaded.transform(test)) == want
    fitted, _ = P.fit_pipeline(train)
    assert want == listed(P.predict(fitted, test.select("row_id", "description"), k=2), col="labels")
    with pytest.raises(Exception, match="already"):
        model.write().save(f"{scratch}/model")  # an existing model stays unless overwritten
    model.write().overwrite().save(f"{scratch}/model")


def test_columns_of_any_name_pass_through_and_nulls_count_as_empty(spark, rows):
    train, test = rows
    odd = test.select(F.col("row_id").alias("a.b"), F.col("description").alias("my text"), F.lit(1).alias("row"), F.lit(2).alias("row_id"), F.lit(3).alias("description"))
    blank = [(-1, None, 1, 2, 3), (-2, "", 1, 2, 3)]
    odd = odd.union(spark.createDataFrame(blank, "`a.b` long, `my text` string, row int, row_id int, description int"))
    names = dict(idCol="a.b", inputCol="my text")
    model = TextLabelClassifier().fit(train)
    out = model.transform(odd, {model.getParam(k): v for k, v in names.items()})
    assert out.columns == [*odd.columns, "predicted"]
    got = dict(listed(out, "a.b"))
    assert got.pop(-1) == got.pop(-2) and sorted(got.items()) == listed(model.transform(test.drop("labels")))
    with pytest.raises(ValueError, match="exists already"):
        model.transform(test.withColumn("predicted", F.lit(1)))
    assert model.transform(test.limit(0)).collect() == []


def test_cross_validator_picks_the_better_of_a_grid(spark, rows):
    train, test = rows
    est = TextLabelClassifier(maxNgram=1)
    grid = ParamGridBuilder().addGrid(est.numFeatures, [2, 400]).build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=MicroF1Evaluator(), numFolds=2, seed=7)
    best = cv.fit(train)
    assert len(best.avgMetrics) == 2
    assert best.bestModel.fitted.params.k_features == (2, 400)[best.avgMetrics.index(max(best.avgMetrics))]
    assert 0 <= MicroF1Evaluator().evaluate(best.transform(test)) <= 1


def test_micro_f1(spark):
    schema = "labels array<string>, predicted array<string>"
    df = spark.createDataFrame([(["a", "b"], ["a"]), ([], ["c"]), (None, None), (["d", "d"], ["d"])], schema)
    assert MicroF1Evaluator().evaluate(df) == pytest.approx(2 * 2 / (2 * 2 + 1 + 1))
    assert MicroF1Evaluator().evaluate(df.limit(0)) == 0.0

"""The classifier as ``pyspark.ml`` stages (L7, T11, S14): an Estimator, its Model, and a micro-F1 Evaluator.

``TextLabelClassifier`` fits labels, tf-idf, selection and the one-vs-rest model from rows with an id, a text and a label
list; ``TextLabelModel`` adds a label list to any rows. Both work in ``Pipeline``, ``CrossValidator`` and
``TrainValidationSplit``, take part in parameter grids, and are saved and loaded with the pipeline that holds them: the
fitted state goes to ``<path>/state`` as Parquet tables, parameters to Spark's own metadata.

The id column must be unique and not null, since features are long tables keyed by it. Null texts count as empty; null
label lists as empty, and rows without a known label do not train. Columns of any name pass through ``transform``; one
named like the prediction column is an error.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.operators import decide
from tagwise.operators.text import VectorizerParams
from tagwise.plans import jobs
from tagwise.plans import pipeline as P


def _param(name: str, doc: str, convert):
    return Param(Params._dummy(), name, doc, convert)


class _Columns(Params):
    idCol = _param("idCol", "unique row id", TypeConverters.toString)
    inputCol = _param("inputCol", "text", TypeConverters.toString)
    labelsCol = _param("labelsCol", "array of label names (training and evaluation)", TypeConverters.toString)
    predictionCol = _param("predictionCol", "array of predicted label names", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(idCol="row_id", inputCol="description", labelsCol="labels", predictionCol="predicted")

    def _column(self, param: Param) -> F.Column:
        return F.col("`" + self.getOrDefault(param).replace("`", "``") + "`")


class _Decision(_Columns):
    threshold = _param("threshold", "least probability of a predicted label", TypeConverters.toFloat)
    topK = _param("topK", "most labels of a row", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(threshold=decide.DEFAULT_THRESHOLD, topK=decide.DEFAULT_TOP_K)


class TextLabelModel(Model, _Decision, MLWritable, MLReadable):
    def __init__(self, fitted: P.FittedPipeline | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        name = self.getOrDefault(self.predictionCol)
        if name in dataset.columns:
            raise ValueError(f"column {name} exists already")
        docs = dataset.select(self._column(self.idCol).alias("row_id"), F.coalesce(self._column(self.inputCol), F.lit("")).alias("description"))
        policy = decide.ThresholdPolicy(self.getOrDefault(self.threshold))
        found = P.predict(self.fitted, docs, policy, self.getOrDefault(self.topK))
        # the whole row travels as one struct, so its columns can have any names
        rows = dataset.select(self._column(self.idCol).alias("row_id"), F.struct("*").alias("row"))
        kept = [F.col("row").getField(c).alias(c) for c in dataset.columns]
        return rows.join(found.select("row_id", "labels"), "row_id", "left").select(*kept, F.col("labels").alias(name))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, instance: TextLabelModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        jobs.save_pipeline(self.instance.fitted, f"{path}/state")


class _ModelReader(MLReader):
    def load(self, path: str) -> TextLabelModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TextLabelModel(jobs.load_pipeline(self.sparkSession, f"{path}/state"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class TextLabelClassifier(Estimator, _Decision, DefaultParamsReadable, DefaultParamsWritable):
    model = _param("model", "nb, svm or ridge", TypeConverters.toString)
    alpha = _param("alpha", "smoothing of nb, penalty of ridge", TypeConverters.toFloat)
    C = _param("C", "cost of svm", TypeConverters.toFloat)
    scoreFunction = _param("scoreFunction", "feature score: chi2 or mutual_info", TypeConverters.toString)
    numFeatures = _param("numFeatures", "features kept by their scores", TypeConverters.toInt)
    maxFeatures = _param("maxFeatures", "terms of the vocabulary", TypeConverters.toInt)
    maxNgram = _param("maxNgram", "longest word n-gram", TypeConverters.toInt)
    minLabelPct = _param("minLabelPct", "least share of rows of a label, in per cent", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, idCol="row_id", inputCol="description", labelsCol="labels", predictionCol="predicted", threshold=decide.DEFAULT_THRESHOLD,
                 topK=decide.DEFAULT_TOP_K, model="nb", alpha=1.0, C=0.1, scoreFunction="chi2", numFeatures=4500, maxFeatures=10000, maxNgram=3, minLabelPct=5.0):
        super().__init__()
        self._setDefault(model="nb", alpha=1.0, C=0.1, scoreFunction="chi2", numFeatures=4500, maxFeatures=10000, maxNgram=3, minLabelPct=5.0)
        self._set(**self._input_kwargs)

    def params_of_pipeline(self) -> P.PipelineParams:
        get = self.getOrDefault
        return P.PipelineParams(
            vectorizer=VectorizerParams(max_features=get(self.maxFeatures), ngram_range=(1, get(self.maxNgram))),
            k_features=get(self.numFeatures), score_fn=get(self.scoreFunction), min_label_pct=get(self.minLabelPct),
            model=get(self.model), alpha=get(self.alpha), C=get(self.C),
        )

    def _fit(self, dataset: DataFrame) -> TextLabelModel:
        rows = dataset.select(
            self._column(self.idCol).alias("row_id"),
            F.coalesce(self._column(self.inputCol), F.lit("")).alias("description"),
            F.coalesce(self._column(self.labelsCol), F.array().cast("array<string>")).alias("labels"),
        )
        fitted, prep = P.fit_pipeline(rows, self.params_of_pipeline())
        for kept in (prep.x, prep.x_all, prep.y, prep.rows):  # the state is written; a grid fits many models in one session
            kept.unpersist()
        return self._copyValues(TextLabelModel(fitted))


class MicroF1Evaluator(Evaluator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Micro F1 of predicted against true label lists, over the labels that occur in either; 0 where there are none."""

    @keyword_only
    def __init__(self, *, labelsCol="labels", predictionCol="predicted"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        none = F.array().cast("array<string>")
        true, found = (F.array_distinct(F.coalesce(self._column(c), none)) for c in (self.labelsCol, self.predictionCol))
        sums = dataset.agg(F.sum(F.size(F.array_intersect(true, found))).alias("hit"), F.sum(F.size(true) + F.size(found)).alias("all")).first()
        return 2.0 * sums["hit"] / sums["all"] if sums["all"] else 0.0

    def isLargerBetter(self) -> bool:
        return True

"""Linear multi-label models: the coefficient-table model and its decision function.

A model is two small state tables: ``coef (feat_idx, label_idx, w)`` and ``intercept (label_idx, b)``.
The trainers (naive Bayes closed form in ``bayes``, squared-hinge / ridge in ``trainer``) all produce
this shape, so scoring, thresholds and metrics are shared.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.plans.broadcast import join_state

INTERCEPT_FEATURE = -1


@dataclass
class LinearModel:
    coef: DataFrame
    intercept: DataFrame
    n_features: int
    n_labels: int
    kind: str = "linear"
    params: dict = field(default_factory=dict)


def _intercept_rows(rows: DataFrame) -> DataFrame:
    """One constant 'bias feature' per row: every row — including rows without any in-vocabulary
    feature — then meets every label through the bias coefficients, with no rows×labels join."""
    return rows.select("row_id", F.lit(INTERCEPT_FEATURE).alias("feat_idx"), F.lit(1.0).alias("value"))


def decision_scores(x: DataFrame, rows: DataFrame, model: LinearModel) -> DataFrame:
    """score(row, label) = Σ_f x·w + b for every row in ``rows`` and every label.

    The coefficient table (F·L rows, bounded by the vocabulary cap × label count) is broadcast when its
    counted size allows; the products are summed map-side before their one shuffle by (row, label).
    """
    bias = model.intercept.select(F.lit(INTERCEPT_FEATURE).alias("feat_idx"), "label_idx", F.col("b").alias("w"))
    coef = model.coef.select("feat_idx", "label_idx", "w").unionByName(bias)
    n_coef = (model.n_features + 1) * model.n_labels
    feats = x.select("row_id", "feat_idx", "value").unionByName(_intercept_rows(rows))
    return (
        join_state(feats, coef, "feat_idx", n_coef)
        .groupBy("row_id", "label_idx")
        .agg(F.sum(F.col("value") * F.col("w")).alias("score"))
    )


def baseline_predictions(scores: DataFrame) -> DataFrame:
    """The estimator's own predict: score > 0 (= probability > 0.5)."""
    return scores.withColumn("pred", (F.col("score") > 0).cast("int"))

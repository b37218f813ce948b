"""From scores to label decisions: sigmoid, threshold policy, per-label thresholds, top-k, confidence
(L6, L8, L9, W4, W5, J3, J4)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagwise.functions.exprs import sigmoid
from tagwise.plans.broadcast import small

DEFAULT_THRESHOLD = 0.55
DEFAULT_TOP_K = 3


def with_proba(scores: DataFrame) -> DataFrame:
    """proba = 1 / (1 + e^-score)."""
    return scores.withColumn("proba", sigmoid(F.col("score")))


@dataclass
class ThresholdPolicy:
    """Resolved policy (L8): either one global value or a per-label table with a global fallback."""

    global_threshold: float
    per_label: DataFrame | None = None  # (label, threshold)
    n_per_label: int = 0


def resolve_thresholds(
    threshold: float | dict | None = None,
    use_global: bool = False,
    stored: DataFrame | None = None,
    spark=None,
    variant: str = "predict",
) -> ThresholdPolicy:
    """L8 threshold policy, decided on the driver before planning.

    predict/service variant: force-global -> 0.55 when a dict was passed (D9) else the float;
    dict -> per-label; float -> global; stored per-label table -> per-label; else 0.55.
    evaluate variant: a float is used only when forced or when no stored thresholds exist.
    """
    if use_global:
        g = threshold if isinstance(threshold, (int, float)) else DEFAULT_THRESHOLD
        return ThresholdPolicy(float(g))
    if isinstance(threshold, dict):
        tbl = spark.createDataFrame([(k, float(v)) for k, v in threshold.items()], "label string, threshold double")
        return ThresholdPolicy(DEFAULT_THRESHOLD, tbl, len(threshold))
    if variant == "evaluate":
        if stored is not None:
            return ThresholdPolicy(DEFAULT_THRESHOLD, stored, stored.count())
        return ThresholdPolicy(float(threshold) if threshold is not None else DEFAULT_THRESHOLD)
    if threshold is not None:
        return ThresholdPolicy(float(threshold))
    if stored is not None:
        return ThresholdPolicy(DEFAULT_THRESHOLD, stored, stored.count())
    return ThresholdPolicy(DEFAULT_THRESHOLD)


def apply_label_thresholds(proba: DataFrame, names: DataFrame, policy: ThresholdPolicy, n_labels: int) -> DataFrame:
    """Attach each label's threshold (global default for labels without one) and the decision
    ``pred = proba >= threshold`` (inclusive)."""
    g = F.lit(float(policy.global_threshold))
    if policy.per_label is None:
        out = proba.withColumn("threshold", g)
    else:
        t = names.join(small(policy.per_label, policy.n_per_label), "label", "left").select(
            "label_idx", F.coalesce(F.col("threshold"), g).alias("threshold")
        )
        out = proba.join(small(t, n_labels), "label_idx", "left").withColumn(
            "threshold", F.coalesce(F.col("threshold"), g)
        )
    return out.withColumn("pred", (F.col("proba") >= F.col("threshold")).cast("int"))


def top_k(decided: DataFrame, k: int = DEFAULT_TOP_K) -> DataFrame:
    """Among the labels that passed their threshold, keep the k most probable per row
    (threshold first, then top-k). Ties: higher label index first. Partitions are one row's labels."""
    w = Window.partitionBy("row_id").orderBy(F.round("proba", 12).desc(), F.col("label_idx").desc())
    passed = decided.filter(F.col("pred") == 1)
    return passed.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= k).drop("_rk")


def confidence_lists(chosen: DataFrame, names: DataFrame, n_labels: int) -> DataFrame:
    """Per row, labels in label order and ``[(label, confidence)]`` by confidence descending."""
    named = chosen.join(small(names, n_labels), "label_idx", "inner")
    return named.groupBy("row_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("label_idx", "label"))), lambda s: s["label"]).alias("labels"),
        F.transform(
            F.array_sort(F.collect_list(F.struct((-F.col("proba")).alias("neg"), "label_idx", "label", "proba"))),
            lambda s: F.struct(s["label"].alias("genre"), s["proba"].alias("confidence")),
        ).alias("genres_with_confidence"),
    )

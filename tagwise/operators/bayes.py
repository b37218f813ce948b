"""One-vs-rest multinomial naive Bayes in closed form.

Per label l (positive class 1, negative class 0) and feature f:
    theta_c[f] = (N_c[f] + alpha) / (N_c + alpha * F)
The posterior log-odds is linear in x: w[f] = ln theta_1[f] - ln theta_0[f], b = ln prior_1 - ln prior_0
(0 for a uniform prior), so the fitted model is an ordinary coefficient table scored by ``linear``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.operators.linear import LinearModel
from tagwise.operators.select import TrainingStats, feature_label_grid
from tagwise.plans.broadcast import small
from tagwise.session import materialize


def nb_coefficients(grid: DataFrame, stats: TrainingStats, alpha: float) -> tuple[DataFrame, DataFrame]:
    """Coefficient table ``(feat_idx, label_idx, w)`` and intercepts ``(label_idx, b)`` from the contingency grid."""
    a = F.lit(float(alpha))
    nf = F.lit(float(stats.n_features))
    n1 = F.col("obs")
    n0 = F.col("fc") - F.col("obs")
    g = grid.select(
        "feat_idx",
        "label_idx",
        "n_pos",
        n1.alias("n1c"),
        n0.alias("n0c"),
    )
    # class totals per label: a partial aggregate down to one row per label, joined back as a broadcast
    totals = g.groupBy("label_idx").agg(F.sum("n1c").alias("N1"), F.sum("n0c").alias("N0"))
    g = g.join(small(totals, stats.n_labels), "label_idx")
    w = F.log((F.col("n1c") + a) / (F.col("N1") + a * nf)) - F.log((F.col("n0c") + a) / (F.col("N0") + a * nf))
    coef = g.select("feat_idx", "label_idx", w.alias("w"))
    # uniform prior: no intercept, one row per label
    intercept = grid.sparkSession.range(stats.n_labels).select(F.col("id").cast("int").alias("label_idx"), F.lit(0.0).alias("b"))
    return coef, intercept


def fit_nb(x: DataFrame, y: DataFrame, stats: TrainingStats, alpha: float = 1.0, grid: DataFrame | None = None) -> LinearModel:
    """Fit on training rows only; the result is a materialised, size-known coefficient table. ``grid`` is the
    contingency grid of the same features where the selection has already summed it."""
    grid = feature_label_grid(x, y, stats) if grid is None else grid
    coef, intercept = nb_coefficients(grid, stats, alpha)
    return LinearModel(
        coef=materialize(coef),
        intercept=intercept,  # a range with zeros: nothing to keep
        n_features=stats.n_features,
        n_labels=stats.n_labels,
        kind="nb",
        params={"alpha": float(alpha)},
    )

"""Feature scores for multi-label targets and k-best selection.

Score functions are callables ``(X_long, Y_long, stats) -> DataFrame(feat_idx, score)``.
All work happens on the sparse ``(feat_idx, label_idx)`` contingency sums; the only dense piece is the
feature × label grid, whose size is bounded by the vocabulary cap times the label count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.operators.indexing import WINDOW_LIMIT, dense_index
from tagwise.plans.broadcast import join_state, small
from tagwise.session import materialize


@dataclass
class TrainingStats:
    """Scalars of a training set that every score needs."""

    n_rows: int
    n_labels: int
    n_features: int


def label_rows(y: DataFrame) -> DataFrame:
    """Rows per label ``(label_idx, n_pos)``."""
    return y.groupBy("label_idx").agg(F.count(F.lit(1)).alias("n_pos"))


def feature_label_sums(x: DataFrame, y: DataFrame) -> DataFrame:
    """O = Yᵀ·X as sparse ``(feat_idx, label_idx, obs, n11)``: value sum and rows with the feature present."""
    return (
        x.join(y, "row_id", "inner")
        .groupBy("feat_idx", "label_idx")
        .agg(F.sum("value").alias("obs"), F.count(F.lit(1)).alias("n11"))
    )


def feature_totals(x: DataFrame) -> DataFrame:
    """Per feature value sum and presence count ``(feat_idx, fc, n1)``."""
    return x.groupBy("feat_idx").agg(F.sum("value").alias("fc"), F.count(F.lit(1)).alias("n1"))


def feature_label_grid(x: DataFrame, y: DataFrame, stats: TrainingStats) -> DataFrame:
    """Dense (feature × label) grid with the contingency sums; missing pairs are zeros.

    Labels are generated per feature with ``explode(sequence)`` (no join, no cross product);
    the label table joined back is the small per-label count table.
    """
    totals = feature_totals(x)
    grid = totals.select("feat_idx", "fc", "n1", F.explode(F.sequence(F.lit(0), F.lit(stats.n_labels - 1))).alias("label_idx"))
    sums = feature_label_sums(x, y)
    pos = small(label_rows(y), stats.n_labels)
    return (
        grid.join(sums, ["feat_idx", "label_idx"], "left")
        .join(pos, "label_idx", "left")
        .select(
            "feat_idx",
            "label_idx",
            "fc",
            "n1",
            F.coalesce("obs", F.lit(0.0)).alias("obs"),
            F.coalesce("n11", F.lit(0)).alias("n11"),
            F.coalesce("n_pos", F.lit(0)).alias("n_pos"),
        )
    )


def chi2_of_grid(g: DataFrame, stats: TrainingStats) -> DataFrame:
    """chi² = Σ_label (O − E)² / E with E = mean(y_label) · Σ_rows x_feat."""
    e = F.col("n_pos") / F.lit(float(stats.n_rows)) * F.col("fc")
    term = F.try_divide((F.col("obs") - e) * (F.col("obs") - e), e)
    return g.groupBy("feat_idx").agg(F.sum(term).alias("score"))


def _mi_cell(n_ab, n_a, n_b, n):
    """p(a,b)·ln(p(a,b)/(p(a)p(b))) with 0·ln 0 = 0."""
    n_ab = n_ab.cast("double")
    return F.when(
        n_ab > 0, n_ab / F.lit(n) * F.log(n_ab * F.lit(n) / (n_a.cast("double") * n_b.cast("double")))
    ).otherwise(F.lit(0.0))


def chi2_scores(x: DataFrame, y: DataFrame, stats: TrainingStats) -> DataFrame:
    return chi2_of_grid(feature_label_grid(x, y, stats), stats)


def mutual_info_of_grid(g: DataFrame, stats: TrainingStats) -> DataFrame:
    """Mean over labels of MI(feature present?, label) from the 2×2 contingency table."""
    n = float(stats.n_rows)
    n11, n1, npos = F.col("n11"), F.col("n1"), F.col("n_pos")
    n10 = n1 - n11
    n01 = npos - n11
    n00 = F.lit(n) - n1 - npos + n11
    n0 = F.lit(n) - n1
    nneg = F.lit(n) - npos
    mi = _mi_cell(n11, n1, npos, n) + _mi_cell(n10, n1, nneg, n) + _mi_cell(n01, n0, npos, n) + _mi_cell(n00, n0, nneg, n)
    return g.groupBy("feat_idx").agg((F.sum(mi) / F.lit(float(stats.n_labels))).alias("score"))


def mutual_info_scores(x: DataFrame, y: DataFrame, stats: TrainingStats) -> DataFrame:
    return mutual_info_of_grid(feature_label_grid(x, y, stats), stats)


SCORE_FUNCTIONS = {"chi2": chi2_scores, "mutual_info": mutual_info_scores}
GRID_SCORES = {"chi2": chi2_of_grid, "mutual_info": mutual_info_of_grid}


@dataclass
class Selection:
    """Selected features: ``(feat_idx, sel_idx, score)`` with sel_idx 0..k-1 in original order."""

    table: DataFrame
    k: int


def select_k_best(scores: DataFrame, k: int) -> Selection:
    """K best scores (ties: higher feat_idx wins, as a stable ascending arg-sort keeps the last),
    renumbered 0..k-1 by original feature index. Fewer than k features -> all are kept."""
    top = scores.orderBy(F.round("score", 9).desc_nulls_last(), F.col("feat_idx").desc()).limit(k)
    top = materialize(top)
    n = top.count()
    sel = dense_index(top, "feat_idx", "sel_idx", n).select("feat_idx", "sel_idx", "score")
    return Selection(sel if n <= WINDOW_LIMIT else materialize(sel), n)


def apply_selection(x: DataFrame, sel: Selection) -> DataFrame:
    """Keep selected columns, renumbered; no re-normalisation afterwards."""
    m = sel.table.select("feat_idx", "sel_idx")
    return join_state(x, m, "feat_idx", sel.k).select("row_id", F.col("sel_idx").alias("feat_idx"), "value")


def select_grid(grid: DataFrame, sel: Selection) -> DataFrame:
    """Contingency grid of the selected features, renumbered: the sums of a feature do not depend on the selection."""
    m = small(sel.table.select("feat_idx", "sel_idx"), sel.k)
    return grid.join(m, "feat_idx").drop("feat_idx").withColumnRenamed("sel_idx", "feat_idx")

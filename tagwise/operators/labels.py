"""Multi-valued label parsing, rare-label rule, label index and multi-hot encoding
(P9-P11, A1-A3, W9, T20, T21, U1-U4).

Label tables are long: ``(row_id, label)`` / ``(row_id, label_idx)``. The label index is a fitted
state table ``(label_idx, label)`` whose size is checked before it is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.functions.exprs import parse_labels
from tagwise.plans.broadcast import small
from tagwise.operators.indexing import WINDOW_LIMIT, dense_index
from tagwise.session import materialize

DEFAULT_MIN_LABEL_PCT = 5.0


def parse_label_column(df: DataFrame, col: str = "genre") -> DataFrame:
    """``labels`` = sorted distinct non-blank stripped pieces of the comma list."""
    return df.withColumn("labels", parse_labels(F.col(col)))


def exploded(parsed: DataFrame) -> DataFrame:
    """(row_id, label) pairs from the parsed ``labels`` array."""
    return parsed.select("row_id", F.explode("labels").alias("label"))


def label_frequency(parsed: DataFrame) -> DataFrame:
    """A1: count and percentage per label; the denominator is every input row (labelled or not)."""
    n_rows = parsed.select(F.count(F.lit(1)).alias("n_rows"))
    counts = exploded(parsed).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    # n_rows is a one-row aggregate: attach it as a literal scalar instead of a join
    total = n_rows.first()["n_rows"]
    return counts.select("label", "n", (F.col("n") * 100.0 / F.lit(total)).alias("pct"))


def kept_labels(freq: DataFrame, min_pct: float = DEFAULT_MIN_LABEL_PCT) -> DataFrame:
    """A2: a label is removed when its percentage is strictly below ``min_pct``."""
    return freq.filter(F.col("pct") >= F.lit(float(min_pct)))


@dataclass
class LabelIndex:
    """Fitted label vocabulary (M4): ``(label_idx, label)`` in code-point order."""

    table: DataFrame
    n_labels: int

    def names(self) -> DataFrame:
        return self.table


def index_labels(labels: DataFrame) -> LabelIndex:
    """Dense index over the (small) distinct-label table, sorted by label."""
    # The distinct-label table is materialised first so its size is known before any broadcast.
    distinct = materialize(labels.select("label").distinct())
    n = distinct.count()
    # numbering a written table of n rows: re-evaluated per use without touching the data again
    idx = dense_index(distinct, "label", "label_idx", n)
    return LabelIndex(idx if n <= WINDOW_LIMIT else materialize(idx), n)


def fit_labels(parsed: DataFrame, min_pct: float = DEFAULT_MIN_LABEL_PCT) -> LabelIndex:
    """T20 fit: label frequencies -> rare-label rule -> label index."""
    return index_labels(kept_labels(label_frequency(parsed), min_pct))


def restrict_labels(parsed: DataFrame, index: LabelIndex) -> DataFrame:
    """Keep only known labels; rows left without labels are dropped."""
    known = small(index.table.select("label"), index.n_labels)
    pairs = exploded(parsed).join(known, "label", "left_semi")
    lists = pairs.groupBy("row_id").agg(F.array_sort(F.collect_list("label")).alias("labels"))
    return parsed.drop("labels").join(lists, "row_id", "inner")


def multi_hot(parsed: DataFrame, index: LabelIndex) -> DataFrame:
    """T20 transform: sparse multi-hot target ``(row_id, label_idx)``; unknown labels are dropped."""
    return exploded(parsed).join(small(index.table, index.n_labels), "label", "inner").select("row_id", "label_idx")


def decode_labels(rows: DataFrame, pred: DataFrame, index: LabelIndex) -> DataFrame:
    """``(row_id, label_idx)`` -> label lists in label order; rows with no label keep an empty list."""
    named = pred.join(small(index.table, index.n_labels), "label_idx", "inner")
    lists = named.groupBy("row_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("label_idx", "label"))), lambda s: s["label"]).alias("labels")
    )
    return rows.join(lists, "row_id", "left").withColumn(
        "labels", F.coalesce(F.col("labels"), F.array().cast("array<string>"))
    )


def label_stats(parsed: DataFrame, index: LabelIndex) -> DataFrame:
    """A3: rows with missing labels, mean labels per row, rows lost by the rare-label rule."""
    known = small(index.table.select("label"), index.n_labels)
    kept = exploded(parsed).join(known, "label", "left_semi").groupBy("row_id").agg(F.count(F.lit(1)).alias("_n_kept"))
    per_row = parsed.select("row_id", "labels").join(kept, "row_id", "left").select("labels", F.coalesce("_n_kept", F.lit(0)).alias("_n_kept"))
    return per_row.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.size("labels") == 0).alias("n_missing"),
        F.avg(F.size("labels").cast("double")).alias("mean_labels"),
        F.count_if(F.col("_n_kept") == 0).alias("n_lost"),
    )


def missing_labels(index: LabelIndex, parsed: DataFrame) -> DataFrame:
    """U4: vocabulary labels that never occur in the data."""
    present = exploded(parsed).select("label").distinct()
    return index.table.join(present, "label", "left_anti")

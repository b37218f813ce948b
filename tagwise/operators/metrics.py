"""Multi-label evaluation aggregates over sparse truth / prediction tables.

Inputs are long ``(row_id, label_idx)`` tables. True negatives are never materialised: they are
derived from counts (n_rows · n_labels − tp − fp − fn). Every per-label output starts from the label
table so labels that are never true or never predicted still appear.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagwise.functions.exprs import f1_from_counts, safe_div


def pair_flags(truth: DataFrame, pred: DataFrame) -> DataFrame:
    """One row per (row, label) that is true or predicted, with 0/1 flags ``t`` and ``p``.

    A union + partial aggregate instead of a full outer join: no join-side skew, one shuffle."""
    t = truth.select("row_id", "label_idx", F.lit(1).alias("t"), F.lit(0).alias("p"))
    p = pred.select("row_id", "label_idx", F.lit(0).alias("t"), F.lit(1).alias("p"))
    return t.unionByName(p).groupBy("row_id", "label_idx").agg(F.max("t").alias("t"), F.max("p").alias("p"))


def label_counts(truth: DataFrame, pred: DataFrame, label_ids: DataFrame, n_rows: int) -> DataFrame:
    """Per label tp, fp, fn, tn (tn derived)."""
    f = pair_flags(truth, pred)
    c = f.groupBy("label_idx").agg(
        F.sum(F.col("t") * F.col("p")).cast("long").alias("tp"),
        F.sum((1 - F.col("t")) * F.col("p")).cast("long").alias("fp"),
        F.sum(F.col("t") * (1 - F.col("p"))).cast("long").alias("fn"),
    )
    out = label_ids.select("label_idx").join(c, "label_idx", "left")  # AQE broadcasts it from runtime size
    out = out.select(
        "label_idx",
        *[F.coalesce(F.col(k), F.lit(0)).cast("long").alias(k) for k in ("tp", "fp", "fn")],
    )
    return out.withColumn("tn", F.lit(n_rows) - F.col("tp") - F.col("fp") - F.col("fn"))


def micro_metrics(counts: DataFrame, n_rows: int, n_labels: int) -> DataFrame:
    """A5: precision, recall, F1, Jaccard, Hamming loss over all (row, label) cells."""
    s = counts.agg(*[F.sum(k).cast("long").alias(k) for k in ("tp", "fp", "fn")])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return s.select(
        "tp",
        "fp",
        "fn",
        safe_div(tp, tp + fp).alias("precision"),
        safe_div(tp, tp + fn).alias("recall"),
        f1_from_counts(tp, fp, fn).alias("f1"),
        safe_div(tp, tp + fp + fn).alias("jaccard"),
        safe_div(fp + fn, F.lit(n_rows * n_labels)).alias("hamming_loss"),
    )


def per_label_metrics(counts: DataFrame, n_rows: int) -> DataFrame:
    """Per-label precision, recall, F1, Jaccard, support and Hamming (error rate)."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "label_idx",
        "tp",
        "fp",
        "fn",
        (tp + fn).alias("support"),
        safe_div(tp, tp + fp).alias("precision"),
        safe_div(tp, tp + fn).alias("recall"),
        f1_from_counts(tp, fp, fn).alias("f1"),
        safe_div(tp, tp + fp + fn).alias("jaccard"),
        safe_div(fp + fn, F.lit(n_rows)).alias("hamming"),
    )


def macro_metrics(per_label: DataFrame) -> DataFrame:
    """Unweighted mean over all labels."""
    return per_label.agg(
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
        F.avg("jaccard").alias("jaccard"),
        F.count(F.lit(1)).alias("n_labels"),
    )


def true_pred_counts(counts: DataFrame) -> DataFrame:
    """True and predicted count per label."""
    return counts.select("label_idx", (F.col("tp") + F.col("fn")).alias("n_true"), (F.col("tp") + F.col("fp")).alias("n_pred"))


def labels_per_row_hist(rows: DataFrame, truth: DataFrame, pred: DataFrame) -> DataFrame:
    """How many rows have n true / n predicted labels, n = 0..max (rows with none included)."""
    nt = truth.groupBy("row_id").agg(F.count(F.lit(1)).alias("nt"))
    npred = pred.groupBy("row_id").agg(F.count(F.lit(1)).alias("np"))
    per = (
        rows.select("row_id")
        .join(nt, "row_id", "left")
        .join(npred, "row_id", "left")
        .select(F.coalesce("nt", F.lit(0)).alias("nt"), F.coalesce("np", F.lit(0)).alias("np"))
    )
    long = per.select(F.explode(F.array(F.struct(F.col("nt").alias("n"), F.lit(1).alias("is_true")),
                                        F.struct(F.col("np").alias("n"), F.lit(0).alias("is_true")))).alias("e")).select("e.*")
    hist = long.groupBy("n").agg(
        F.sum("is_true").cast("long").alias("n_rows_true"), F.sum(1 - F.col("is_true")).cast("long").alias("n_rows_pred")
    )
    # bins 0..max: fill the empty bins from the (tiny) histogram itself
    mx = hist.agg(F.max("n").alias("mx"))
    bins = mx.select(F.explode(F.sequence(F.lit(0), F.col("mx"))).alias("n"))
    return bins.join(hist, "n", "left").select(
        F.col("n").cast("long").alias("n_labels"),
        F.coalesce("n_rows_true", F.lit(0)).cast("long").alias("n_rows_true"),
        F.coalesce("n_rows_pred", F.lit(0)).cast("long").alias("n_rows_pred"),
    )


def _all_pairs(ids: DataFrame, col: str, a: str, b: str) -> DataFrame:
    """Every pair of ids of a small table, zero cells of a heat map included; the list is a scalar subquery."""
    every = ids.agg(F.collect_set(col)).scalar()
    return ids.select(F.col(col).alias(a), F.explode(every).alias(b))


def cooccurrence(truth: DataFrame, label_ids: DataFrame) -> DataFrame:
    """Rows having both labels i and j (diagonal = rows with label i); zero cells included.

    The self-join pairs labels of one row only; a row carries at most n_labels labels, so the work
    is at most n_rows · n_labels² and no group can grow with the data."""
    a = truth.select("row_id", F.col("label_idx").alias("label_i"))
    b = truth.select("row_id", F.col("label_idx").alias("label_j"))
    c = a.join(b, "row_id").groupBy("label_i", "label_j").agg(F.count(F.lit(1)).alias("n"))
    grid = _all_pairs(label_ids, "label_idx", "label_i", "label_j")
    return grid.join(c, ["label_i", "label_j"], "left").select(
        "label_i", "label_j", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def confusion_patterns(truth: DataFrame, pred: DataFrame, label_ids: DataFrame) -> DataFrame:
    """diagonal = hits of label i; (i, j) = rows where i is true but missed and j is predicted."""
    hits = truth.join(pred, ["row_id", "label_idx"], "inner")
    diag = hits.groupBy(F.col("label_idx").alias("label_i")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "label_j", F.col("label_i")
    )
    missed = truth.join(pred, ["row_id", "label_idx"], "left_anti").select("row_id", F.col("label_idx").alias("label_i"))
    off = (
        missed.join(pred.select("row_id", F.col("label_idx").alias("label_j")), "row_id")
        .filter(F.col("label_i") != F.col("label_j"))
        .groupBy("label_i", "label_j")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    c = diag.select("label_i", "label_j", "n").unionByName(off)
    grid = _all_pairs(label_ids, "label_idx", "label_i", "label_j")
    return grid.join(c, ["label_i", "label_j"], "left").select(
        "label_i", "label_j", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def confusion_matrix(true_cls: DataFrame, pred_cls: DataFrame) -> DataFrame:
    """Single-label confusion counts over the labels seen on either side, zero cells included."""
    j = true_cls.join(pred_cls, "row_id")
    c = j.groupBy("true_idx", "pred_idx").agg(F.count(F.lit(1)).alias("n"))
    seen = true_cls.select(F.col("true_idx").alias("l")).union(pred_cls.select(F.col("pred_idx").alias("l"))).distinct()
    grid = _all_pairs(seen, "l", "true_idx", "pred_idx")
    return grid.join(c, ["true_idx", "pred_idx"], "left").select(
        "true_idx", "pred_idx", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def confidence_hist(proba: DataFrame, bins: int = 50) -> DataFrame:
    """Counts in ``bins`` equal-width bins over [min, max] (last bin closed); one-row min/max."""
    mm = proba.agg(F.min("proba").alias("lo"), F.max("proba").alias("hi")).first()
    lo, hi = float(mm["lo"]), float(mm["hi"])
    width = hi - lo
    if width == 0:
        b = F.lit(0)
    else:
        b = F.least(F.floor((F.col("proba") - F.lit(lo)) / F.lit(width) * F.lit(bins)), F.lit(bins - 1))
    return proba.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width / bins)).alias("bin_start"),
        F.col("n").cast("long").alias("n"),
    )


def confidence_stats(proba: DataFrame) -> DataFrame:
    """Mean and median of all probabilities."""
    return proba.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("proba").alias("mean"),
        F.lit(exact_median(proba, "proba")).alias("median"),
        F.min("proba").alias("min"),
        F.max("proba").alias("max"),
    )


def exact_median(df: DataFrame, col: str, bins: int = 4096) -> float | None:
    """Median of a column of values in [0, 1]: two rounds of counting by equal-width bins (partial aggregates, one
    row per bin), then the exact percentile of the distinct values left in the bin of the middle rank."""
    df, lo, width, rank = df.select(F.col(col).alias("x")).where("x IS NOT NULL"), 0.0, 1.0, None
    for _ in range(2):
        b = F.least(F.floor((F.col("x") - lo) / (width / bins)), F.lit(bins - 1)).cast("int")
        counts = sorted((r["b"], r["n"]) for r in df.groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
        n = sum(c for _, c in counts)
        if not n:
            return None
        rank = (n - 1) / 2 if rank is None else rank
        seen = 0
        for i, c in counts:
            if seen + c > int(rank):
                break
            seen += c
        if seen + c <= int(rank + 0.5):  # the two middle values lie in different bins
            above = min(k for k, _ in counts if k > i)
            mid = df.agg(F.max(F.when(b == i, F.col("x"))), F.min(F.when(b == above, F.col("x")))).first()
            return (mid[0] + mid[1]) / 2
        df, lo, width, rank = df.where(b == i), lo + i * width / bins, width / bins, rank - seen
    per = df.groupBy("x").agg(F.count(F.lit(1)).alias("n")).orderBy("x")
    above = per.withColumn("upto", F.sum("n").over(Window.orderBy("x")))  # distinct values of one bin
    mid = above.where((F.col("upto") > int(rank)) & (F.col("upto") - F.col("n") <= int(rank + 0.5))).agg(F.min("x"), F.max("x")).first()
    return (mid[0] + mid[1]) / 2

"""Row cleaning and request rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwise.functions.exprs import clean_title, strip_ws, truncate_text


def first_per_key(df: DataFrame, key: str, order: str = "row_id") -> DataFrame:
    """Keep the first row (smallest ``order``, which is unique) per raw ``key`` value; null keys are dropped.

    Keys of any length are told by a 256-bit hash. (hash -> min order) is a partial aggregate over two narrow
    columns, so a key that holds a third of all rows is combined map-side; the rows are then kept by a semi-join on
    the unique ``order`` alone, so a hot key spreads over all tasks and the wide columns move at most once, by the
    same column as later joins.
    """
    firsts = df.filter(F.col(key).isNotNull()).groupBy(F.sha2(F.col(key).cast("binary"), 256)).agg(F.min(order).alias(order))
    return df.join(firsts.select(order), order, "left_semi")


def clean_titles(df: DataFrame, col: str = "movie_name", lowercase: bool = False) -> DataFrame:
    """Drop null titles, keep the first row per raw title, then normalise the title.

    De-duplication happens before normalisation (so cleaned titles can collide); ``row_id`` stays the key.
    """
    kept = first_per_key(df, col)
    return kept.withColumn(col, clean_title(F.col(col), lowercase=lowercase))


def fill_text(df: DataFrame, col: str = "description") -> DataFrame:
    """Null description -> ''."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit("")))


def text_null_stats(df: DataFrame, col: str = "description") -> DataFrame:
    """P8 counters: rows, null texts, empty texts after filling."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(col).isNull()).alias("n_null"),
        F.count_if(F.length(F.coalesce(F.col(col), F.lit(""))) == 0).alias("n_empty"),
    )


def score_input(df: DataFrame, text_col: str = "description") -> DataFrame:
    """S4 + P12: pick the caller's text column (error lists the available ones), drop blank texts, strip."""
    if text_col not in df.columns:
        raise ValueError(f"Column '{text_col}' not found. Available columns: {', '.join(df.columns)}")
    t = strip_ws(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return df.select("row_id", t.alias("description")).filter(F.length("description") > 0)


def apply_threshold(proba: Column, threshold: float | Column) -> Column:
    """Inclusive threshold."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (proba >= t).cast("int")


def render_labels(labels: Column) -> Column:
    """P14: ', '-joined labels, 'None' when empty."""
    return F.when(F.size(labels) == 0, F.lit("None")).otherwise(F.array_join(labels, ", "))


def prediction_report(pred: DataFrame) -> DataFrame:
    """Truncated text, joined labels, label count (input: row_id, description, labels array)."""
    return pred.select(
        "row_id",
        truncate_text(F.col("description")).alias("description"),
        render_labels(F.col("labels")).alias("predicted_genres"),
        F.size("labels").cast("long").alias("genre_count"),
    )


# fixed values: request validation bounds (text length 1..10000, threshold in [0,1], top_k 1..20)
MIN_TEXT, MAX_TEXT = 1, 10_000
MIN_TOP_K, MAX_TOP_K = 1, 20


def check_request_params(threshold: float | None = None, top_k: int | None = None) -> None:
    """Scalar request parameters are checked on the driver before any plan is built."""
    if threshold is not None and not (0.0 <= threshold <= 1.0):
        raise ValueError(f"threshold must be in [0, 1], got {threshold}")
    if top_k is not None and not (MIN_TOP_K <= top_k <= MAX_TOP_K):
        raise ValueError(f"top_k must be in [{MIN_TOP_K}, {MAX_TOP_K}], got {top_k}")


def validate_requests(df: DataFrame, text_col: str = "description") -> DataFrame:
    """S6 row rules: every row gets ``valid`` and a ``reason`` (null when valid)."""
    n = F.length(F.coalesce(F.col(text_col), F.lit("")))
    reason = (
        F.when(F.col(text_col).isNull() | (n < MIN_TEXT), F.lit("too_short"))
        .when(n > MAX_TEXT, F.lit("too_long"))
    )
    return df.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def length_stats(df: DataFrame, col: str = "description") -> DataFrame:
    """A4: length stats over non-empty texts; q25/q75 by linear interpolation, truncated int bounds."""
    n = F.length(F.coalesce(F.col(col).cast("string"), F.lit("")))
    q = F.percentile(n, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    s = df.filter(n > 0).agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.min(n).cast("long").alias("min"),
        F.max(n).cast("long").alias("max"),
        F.avg(n).alias("mean"),
        q.alias("_q"),
    )
    return s.select(
        "n_texts",
        "min",
        "max",
        "mean",
        F.col("_q")[1].alias("median"),
        F.col("_q")[0].alias("q25"),
        F.col("_q")[2].alias("q75"),
        F.col("_q")[0].cast("long").alias("optimal_min"),
        F.col("_q")[2].cast("long").alias("optimal_max"),
    )


# fixed values: default recommended bounds and the recommendation texts
DEFAULT_OPTIMAL_MIN, DEFAULT_OPTIMAL_MAX = 100, 500
TOO_SHORT_MSG = (
    "Description is too short ({length} chars). Recommended minimum: {lo} characters. "
    "Shorter descriptions may result in less accurate predictions."
)
TOO_LONG_MSG = (
    "Description is quite long ({length} chars). Recommended maximum: {hi} characters. "
    "Very long descriptions may not improve accuracy."
)


def _msg(template: str, length: Column, lo: Column, hi: Column) -> Column:
    parts = []
    rest = template
    for key, colv in (("{length}", length), ("{lo}", lo), ("{hi}", hi)):
        if key in rest:
            before, rest = rest.split(key, 1)
            parts += [F.lit(before), colv.cast("string")]
    parts.append(F.lit(rest))
    return F.concat(*parts)


def length_bounds(stats: DataFrame) -> tuple[int, int]:
    """Recommended bounds from the one-row stats table (defaults when there are no texts)."""
    row = stats.select("optimal_min", "optimal_max").first()
    if row is None or row["optimal_min"] is None:
        return DEFAULT_OPTIMAL_MIN, DEFAULT_OPTIMAL_MAX
    return int(row["optimal_min"]), int(row["optimal_max"])


def length_validation(df: DataFrame, lo: int, hi: int, col: str = "description") -> DataFrame:
    """Per-text length, in-range flag and recommendation for the given bounds."""
    n = F.length(F.coalesce(F.col(col), F.lit("")))
    lo_c, hi_c = F.lit(lo), F.lit(hi)
    return df.select(
        "row_id",
        n.cast("long").alias("length"),
        ((n >= lo_c) & (n <= hi_c)).alias("is_optimal"),
        F.when(n < lo_c, _msg(TOO_SHORT_MSG, n, lo_c, hi_c))
        .when(n > hi_c, _msg(TOO_LONG_MSG, n, lo_c, hi_c))
        .alias("recommendation"),
        lo_c.cast("long").alias("optimal_min"),
        hi_c.cast("long").alias("optimal_max"),
    )

"""Composite fit / transform / predict.

Each fit barrier (label index -> vocabulary -> selected features -> coefficients) materialises a small,
counted state table; everything between barriers is one lazily built DataFrame plan. ``fit_*`` takes
training rows only; ``transform``/``predict`` take state.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagwise.functions.exprs import is_test, truncate_text
from tagwise.operators import decide
from tagwise.operators.bayes import fit_nb
from tagwise.operators.clean import DEFAULT_OPTIMAL_MAX, DEFAULT_OPTIMAL_MIN, check_request_params, clean_titles, fill_text, length_validation
from tagwise.operators.labels import LabelIndex, decode_labels, fit_labels, multi_hot, parse_label_column, restrict_labels
from tagwise.operators.linear import LinearModel, decision_scores
from tagwise.operators.select import GRID_SCORES, Selection, TrainingStats, apply_selection, feature_label_grid, select_grid, select_k_best
from tagwise.operators.text import TfidfState, VectorizerParams, fit_tfidf, kept_words, transform_tfidf
from tagwise.session import materialize
from tagwise.sources import tables


@dataclass(frozen=True)
class PipelineParams:
    vectorizer: VectorizerParams = field(default_factory=VectorizerParams)
    k_features: int = 4500
    score_fn: str = "chi2"
    min_label_pct: float = 5.0
    test_size: float = 0.2
    seed: int = 42
    model: str = "nb"
    alpha: float = 1.0
    C: float = 0.1
    penalty: str = "l2"
    loss: str = "squared_hinge"
    max_iter: int = 200
    tol: float = 1e-4
    balanced: bool = True


@dataclass
class FeatureState:
    labels: LabelIndex
    tfidf: TfidfState
    selection: Selection
    leaky: bool = False  # fitted on rows that a split holds out: not to be evaluated on any


@dataclass
class FittedPipeline:
    features: FeatureState
    model: LinearModel
    params: PipelineParams


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interim table: cleaned titles, filled texts, parsed labels, portable split flag."""
    c = fill_text(clean_titles(tables.movies(spark, sf_dir)))
    return parse_label_column(c)


def split(df: DataFrame, params: PipelineParams = PipelineParams()) -> tuple[DataFrame, DataFrame]:
    flag = is_test(F.col("row_id"), params.test_size, params.seed)
    return df.filter(~flag), df.filter(flag)


@dataclass
class PreparedTrain:
    state: FeatureState
    x: DataFrame  # selected features, long (row_id, feat_idx, value), persisted
    y: DataFrame  # (row_id, label_idx)
    rows: DataFrame  # (row_id, description, labels)
    stats: TrainingStats
    x_all: DataFrame  # tf-idf before selection
    scores: DataFrame  # feature scores used for selection
    grid: DataFrame | None = None  # contingency sums of the selected features and labels


def fit_label_stage(train_parsed: DataFrame, params: PipelineParams = PipelineParams()):
    """Label index (rare-label rule) and the labelled training rows with their targets."""
    labels = fit_labels(train_parsed, params.min_label_pct)
    rows = restrict_labels(train_parsed, labels).select("row_id", "description", "labels")
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    y = multi_hot(rows, labels).persist(StorageLevel.MEMORY_AND_DISK)
    return labels, rows, y


def fit_text_stage(rows: DataFrame, params: PipelineParams = PipelineParams()):
    """Vocabulary + idf and the training tf-idf."""
    words = kept_words(rows, params.vectorizer)
    tfidf = fit_tfidf(rows, params.vectorizer, words=words)
    x_all = transform_tfidf(rows, tfidf, words=words).persist(StorageLevel.MEMORY_AND_DISK)
    return tfidf, x_all


def fit_selection_stage(x_all: DataFrame, y: DataFrame, stats: TrainingStats, params: PipelineParams = PipelineParams()):
    grid = materialize(feature_label_grid(x_all, y, stats))  # features x labels; summed once for scores and naive Bayes
    scores = GRID_SCORES[params.score_fn](grid, stats)
    sel = select_k_best(scores, params.k_features)
    x = apply_selection(x_all, sel).persist(StorageLevel.MEMORY_AND_DISK)
    return scores, sel, x, select_grid(grid, sel)


def prepare_features(train_parsed: DataFrame, params: PipelineParams = PipelineParams(), state: FeatureState | None = None) -> PreparedTrain:
    """Labels -> rare-label rule -> drop unlabeled rows -> tf-idf -> score -> k best.

    F6: with a pre-fitted ``state`` nothing is fitted; the rows are only restricted and transformed by it."""
    if state is not None:
        rows = restrict_labels(train_parsed, state.labels).select("row_id", "description", "labels")
        x_all = transform_tfidf(rows, state.tfidf)
        stats = TrainingStats(rows.count(), state.labels.n_labels, state.selection.k)
        scores = state.selection.table.select("feat_idx", "score")
        return PreparedTrain(state, apply_selection(x_all, state.selection), multi_hot(rows, state.labels), rows, stats, x_all, scores)
    labels, rows, y = fit_label_stage(train_parsed, params)
    tfidf, x_all = fit_text_stage(rows, params)
    n_rows = tfidf.n_docs
    scores, sel, x, grid = fit_selection_stage(x_all, y, TrainingStats(n_rows, labels.n_labels, tfidf.n_features), params)
    return PreparedTrain(
        FeatureState(labels, tfidf, sel), x, y, rows, TrainingStats(n_rows, labels.n_labels, sel.k), x_all, scores, grid
    )


def prepare_corpus(parsed: DataFrame, params: PipelineParams = PipelineParams()) -> PreparedTrain:
    """Features fitted on the whole corpus. Leaky: rows that are later held out take part in every fit, so results
    on them say nothing about unseen rows; only for descriptive tables. The state carries that mark through save and
    load, and evaluation refuses it."""
    prep = prepare_features(parsed, params)
    prep.state.leaky = True
    return prep


FEATURE_PREFIX = "tfidf_"
# a wide table has a column per selected feature; Spark's pivot stops at this many, and so does the export
MAX_WIDE = 10_000
WIDE_CELLS = 1 << 20  # of a batch of wide rows


def processed_table(prep: PreparedTrain, key: str = "row_id") -> DataFrame:
    """One wide row per training row: ``tfidf_<feature>`` values (0 where absent) and a 0/1 column per label.

    The columns come from the fitted state, not from the rows, so every split has the same schema; a selection beyond
    ``MAX_WIDE`` features stays in its long form. Rows are joined while they are narrow (arrays of what they have) and widened
    last, in a map over batches, so no shuffle or sort carries the zeros.
    """
    n, names = prep.state.selection.k, [r["label"] for r in prep.state.labels.table.orderBy("label_idx").collect()]  # one row per label
    if n > MAX_WIDE:
        raise ValueError(f"{n} features are too many columns for a wide table (at most {MAX_WIDE})")
    clash = [c for c in names if c.startswith(FEATURE_PREFIX) or c == key]
    if clash:
        raise ValueError(f"labels cannot be told from features or the key: {', '.join(clash)}")
    features = prep.x.groupBy("row_id").agg(F.collect_list("feat_idx").alias("idx"), F.collect_list("value").alias("val"))
    labels = prep.y.groupBy("row_id").agg(F.collect_list("label_idx").alias("lab"))
    narrow = prep.rows.select("row_id").join(features, "row_id", "left").join(labels, "row_id", "left")
    columns = [F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c) for c, kind in (("idx", "int"), ("val", "double"), ("lab", "int"))]
    n_labels, per_batch = len(names), max(1, WIDE_CELLS // (n + len(names)))

    def widen(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, len(batch), per_batch):
                part = batch.slice(lo, per_batch)
                values, held = np.zeros((n, len(part))), np.zeros((n_labels, len(part)), np.int32)
                idx, val, lab = (part.column(c) for c in ("idx", "val", "lab"))
                for column, out in ((idx, values), (lab, held)):
                    at, row = column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(part)), np.diff(column.offsets.to_numpy()))
                    if out is held:
                        np.add.at(held, (at, row), 1)
                    else:  # of a pair that comes twice the first one counts
                        values[at[::-1], row[::-1]] = val.flatten().to_numpy(zero_copy_only=False)[::-1]
                yield pa.RecordBatch.from_arrays([part.column("row_id"), *map(pa.array, values), *map(pa.array, held)], names=wide)

    wide = [key, *[f"{FEATURE_PREFIX}{i}" for i in range(n)], *names]
    kind = T.StructType([T.StructField(key, prep.rows.schema["row_id"].dataType), *[T.StructField(c, T.DoubleType(), False) for c in wide[1 : n + 1]], *[T.StructField(c, T.IntegerType(), False) for c in names]])
    return narrow.select("row_id", *columns).mapInArrow(widen, kind)


def split_processed(df: DataFrame, feature_prefix: str = FEATURE_PREFIX, key: str = "row_id") -> tuple[list[str], list[str]]:
    """Feature and label columns of a processed (wide) table; an error names what is missing."""
    features = [c for c in df.columns if c.startswith(feature_prefix)]
    labels = [c for c in df.columns if c not in features and c != key]
    if not features:
        raise ValueError(f"No feature columns (prefix '{feature_prefix}') found. Available columns: {', '.join(df.columns)}")
    if not labels:
        raise ValueError(f"No label columns found. Available columns: {', '.join(df.columns)}")
    return features, labels


def restore_processed(df: DataFrame, feature_prefix: str = FEATURE_PREFIX, key: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """A processed table back as long features ``(row_id, feat_idx, value)`` without zeros, numbered in column order,
    and label lists ``(row_id, labels)`` in column order; narrow maps over the wide rows. Columns are quoted, so labels
    may hold dots or spaces."""
    features, names = split_processed(df, feature_prefix, key)
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    values = F.array(*[quoted(c).cast("double") for c in features])
    long = df.select(quoted(key).alias("row_id"), F.posexplode(values).alias("feat_idx", "value")).where("value <> 0")
    held = F.array(*[F.when(quoted(c).cast("double") == 1, F.lit(c)) for c in names])
    return long, df.select(quoted(key).alias("row_id"), F.array_compact(held).alias("labels"))


def transform(state: FeatureState, docs: DataFrame) -> DataFrame:
    """Selected tf-idf features for any rows (unknown terms dropped, no re-normalisation)."""
    return apply_selection(transform_tfidf(docs, state.tfidf), state.selection)


def fit_pipeline(train_parsed: DataFrame, params: PipelineParams = PipelineParams()) -> tuple[FittedPipeline, PreparedTrain]:
    prep = prepare_features(train_parsed, params)
    return fit_model(prep, params), prep


def fit_model(prep: PreparedTrain, params: PipelineParams = PipelineParams()) -> FittedPipeline:
    """The model of ``params`` on prepared features."""
    if params.model == "nb":
        model = fit_nb(prep.x, prep.y, prep.stats, params.alpha, prep.grid)
    else:
        from tagwise.operators.trainer import fit_linear

        model = fit_linear(
            prep.x, prep.y, prep.stats, kind=params.model, C=params.C, alpha=params.alpha, max_iter=params.max_iter, tol=params.tol,
            rows=prep.rows.select("row_id"), balanced=params.balanced, penalty=params.penalty, loss=params.loss,
        )
    return FittedPipeline(prep.state, model, params)


def score(fitted: FittedPipeline, docs: DataFrame) -> DataFrame:
    """L5 + L6 for every (row, label): (row_id, label_idx, score, proba)."""
    x = transform(fitted.features, docs)
    return decide.with_proba(decision_scores(x, docs.select("row_id"), fitted.model))


def predict(
    fitted: FittedPipeline,
    docs: DataFrame,
    policy: decide.ThresholdPolicy | None = None,
    k: int = decide.DEFAULT_TOP_K,
) -> DataFrame:
    """Texts -> label lists (row_id, labels) in label order; rows without labels keep []."""
    policy = policy or decide.ThresholdPolicy(decide.DEFAULT_THRESHOLD)
    labels = fitted.features.labels
    decided = decide.apply_label_thresholds(score(fitted, docs), labels.table, policy, labels.n_labels)
    chosen = decide.top_k(decided, k)
    return decode_labels(docs.select("row_id"), chosen.select("row_id", "label_idx"), labels)


def predict_records(
    fitted: FittedPipeline,
    requests: DataFrame,
    threshold: float | dict | None = None,
    k: int = decide.DEFAULT_TOP_K,
    bounds: tuple[int, int] = (DEFAULT_OPTIMAL_MIN, DEFAULT_OPTIMAL_MAX),
) -> DataFrame:
    """One nested record per request ``(row_id, description)``: the text cut to 100 characters, labels in label
    order, (label, confidence) by confidence, and the length validation. Used by batch and stream alike."""
    check_request_params(threshold if isinstance(threshold, (int, float)) else None, k)
    labels = fitted.features.labels
    policy = decide.resolve_thresholds(threshold, spark=requests.sparkSession)
    docs = requests.select("row_id", "description")
    decided = decide.apply_label_thresholds(score(fitted, docs), labels.table, policy, labels.n_labels)
    lists = decide.confidence_lists(decide.top_k(decided, k), labels.table, labels.n_labels)
    # what is shown of a text is cut before the joins, which would sort the whole texts
    checked = length_validation(docs, *bounds).select("row_id", F.struct("length", "is_optimal", "recommendation").alias("validation"))
    shown = docs.select("row_id", truncate_text(F.col("description")).alias("description"))
    return (
        shown.join(lists, "row_id", "left")
        .join(checked, "row_id")
        .select(
            "row_id",
            "description",
            F.coalesce("labels", F.array().cast("array<string>")).alias("genres"),
            F.coalesce("genres_with_confidence", F.array().cast("array<struct<genre:string,confidence:double>>")).alias("genres_with_confidence"),
            "validation",
        )
    )

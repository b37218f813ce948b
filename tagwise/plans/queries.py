"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per SURVEY §2 key.

Every query reads the driver tables (through the views in ``sources.tables``) so its work grows with
them. Computed columns carry the same aliases as the DuckDB oracle in ``plans.oracle``; doubles are
rounded to 6 places and lists are rendered as joined strings so value hashes compare cleanly.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwise.functions.exprs import r6
from tagwise.plans import pipeline as P
from tagwise.session import materialize, state_path
from tagwise.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def joined(c) -> F.Column:
    return F.array_join(c, ",")


# ---------------------------------------------------------------- shared fitted pipeline
_FIT_CACHE: dict = {}


def _sid(spark: SparkSession):
    """Session identity for the caches: a stopped session's id() may be reused, its application id not."""
    return (spark.sparkContext.applicationId, id(spark))


def _stage(spark: SparkSession, sf_dir: str, name: str):
    """Fit stages cached per session and input folder, so each key only runs the stages it needs."""
    from pyspark import StorageLevel

    key = (_sid(spark), sf_dir, name)
    if key in _FIT_CACHE:
        return _FIT_CACHE[key]
    if name == "split":
        # the cleaned titles are as long as the texts and no stage of the fit reads them
        corpus = P.corpus(spark, sf_dir).drop("movie_name").persist(StorageLevel.MEMORY_AND_DISK)
        out = P.split(corpus)
    elif name == "labels":
        train, _ = _stage(spark, sf_dir, "split")
        out = P.fit_label_stage(train)
    elif name == "text":
        _, rows, _ = _stage(spark, sf_dir, "labels")
        out = P.fit_text_stage(rows)
    elif name == "select":
        labels, rows, y = _stage(spark, sf_dir, "labels")
        tfidf, x_all = _stage(spark, sf_dir, "text")
        stats = P.TrainingStats(tfidf.n_docs, labels.n_labels, tfidf.n_features)
        out = P.fit_selection_stage(x_all, y, stats)
    elif name == "prep":
        labels, rows, y = _stage(spark, sf_dir, "labels")
        tfidf, x_all = _stage(spark, sf_dir, "text")
        scores, sel, x, grid = _stage(spark, sf_dir, "select")
        out = P.PreparedTrain(
            P.FeatureState(labels, tfidf, sel), x, y, rows, P.TrainingStats(tfidf.n_docs, labels.n_labels, sel.k), x_all, scores, grid
        )
    else:
        raise KeyError(name)
    _FIT_CACHE[key] = out
    return out


def fitted_nb(spark: SparkSession, sf_dir: str):
    """Default pipeline fitted on the training split (cached per session and input folder)."""
    key = (_sid(spark), sf_dir, "nb")
    if key not in _FIT_CACHE:
        from tagwise.operators.bayes import fit_nb

        train, test = _stage(spark, sf_dir, "split")
        prep = _stage(spark, sf_dir, "prep")
        fitted = P.FittedPipeline(prep.state, fit_nb(prep.x, prep.y, prep.stats, 1.0, prep.grid), P.PipelineParams())
        _FIT_CACHE[key] = (fitted, prep, train, test)
    return _FIT_CACHE[key]


# ---------------------------------------------------------------- flagship
@query("nb_predict")
def nb_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the train split, predict the held-out rows (threshold 0.55, top-3)."""
    fitted, _, _, test = fitted_nb(spark, sf_dir)
    pred = P.predict(fitted, test.select("row_id", "description"))
    return pred.select("row_id", joined("labels").alias("predicted"), F.size("labels").cast("long").alias("n_labels"))


# ---------------------------------------------------------------- decision + metric keys on the scores view
from tagwise.operators import decide as D  # noqa: E402
from tagwise.operators import metrics as M  # noqa: E402
from tagwise.operators import tune as TU  # noqa: E402
from tagwise.operators.labels import LabelIndex  # noqa: E402

SCORE_THRESHOLD = 0.55


def _score_env(spark: SparkSession, sf_dir: str):
    """(proba table, truth, rows, label names, N, L) for the fixed-score views."""
    proba = D.with_proba(tables.scores(spark, sf_dir))
    truth = tables.truth(spark, sf_dir)
    rows = tables.score_rows(spark, sf_dir)
    names = tables.label_names(spark)
    n = rows.count()
    return proba, truth, rows, names, n, tables.N_SCORE_LABELS


def _global_pred(proba: DataFrame, t: float = SCORE_THRESHOLD) -> DataFrame:
    return proba.filter(F.col("proba") >= F.lit(t)).select("row_id", "label_idx")


@query("sigmoid_proba")
def q_sigmoid_proba(spark, sf_dir):
    proba = D.with_proba(tables.scores(spark, sf_dir))
    return proba.select("row_id", "label_idx", r6(F.col("score")).alias("score"), r6(F.col("proba")).alias("proba"))


@query("apply_threshold")
def q_apply_threshold(spark, sf_dir):
    from tagwise.operators.clean import apply_threshold

    proba = D.with_proba(tables.scores(spark, sf_dir))
    return proba.select("row_id", "label_idx", apply_threshold(F.col("proba"), SCORE_THRESHOLD).alias("pred"))


def _per_label_decided(spark, sf_dir):
    proba = D.with_proba(tables.scores(spark, sf_dir))
    policy = D.resolve_thresholds(dict(tables.THRESHOLD_FIXTURE), spark=spark)
    return D.apply_label_thresholds(proba, tables.label_names(spark), policy, tables.N_SCORE_LABELS)


@query("apply_label_thresholds")
def q_apply_label_thresholds(spark, sf_dir):
    d = _per_label_decided(spark, sf_dir)
    return d.select("row_id", "label_idx", r6(F.col("threshold")).alias("threshold"), "pred")


def _chosen(spark, sf_dir, k=D.DEFAULT_TOP_K):
    proba = D.with_proba(tables.scores(spark, sf_dir))
    decided = D.apply_label_thresholds(proba, tables.label_names(spark), D.ThresholdPolicy(SCORE_THRESHOLD), tables.N_SCORE_LABELS)
    return D.top_k(decided, k)


@query("top_k_labels")
def q_top_k_labels(spark, sf_dir):
    return _chosen(spark, sf_dir).select("row_id", "label_idx", r6(F.col("proba")).alias("proba"))


def _names_index(spark) -> LabelIndex:
    return LabelIndex(tables.label_names(spark), tables.N_SCORE_LABELS)


@query("decode_labels")
def q_decode_labels(spark, sf_dir):
    from tagwise.operators.labels import decode_labels

    dec = decode_labels(tables.score_rows(spark, sf_dir), _chosen(spark, sf_dir).select("row_id", "label_idx"), _names_index(spark))
    return dec.select("row_id", joined("labels").alias("labels"), F.size("labels").cast("long").alias("n_labels"))


@query("predict_confidence")
def q_predict_confidence(spark, sf_dir):
    rows = tables.score_rows(spark, sf_dir)
    conf = D.confidence_lists(_chosen(spark, sf_dir), tables.label_names(spark), tables.N_SCORE_LABELS)
    out = rows.join(conf, "row_id", "left")
    conf_str = F.array_join(
        F.transform(
            F.coalesce("genres_with_confidence", F.array().cast("array<struct<genre:string,confidence:double>>")),
            lambda s: F.format_string("%s:%.6f", s["genre"], s["confidence"]),
        ),
        "|",
    )
    labels = F.coalesce("labels", F.array().cast("array<string>"))
    from tagwise.operators.clean import render_labels

    return out.select(
        "row_id",
        render_labels(labels).alias("genres"),
        conf_str.alias("confidences"),
        F.size(labels).cast("long").alias("genre_count"),
    )


@query("prediction_stats")
def q_prediction_stats(spark, sf_dir):
    from tagwise.operators.labels import decode_labels

    dec = decode_labels(tables.score_rows(spark, sf_dir), _chosen(spark, sf_dir).select("row_id", "label_idx"), _names_index(spark))
    return dec.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.size("labels")).cast("long").alias("total_labels"),
        r6(F.avg(F.size("labels"))).alias("mean_labels"),
    )


def _counts(spark, sf_dir):
    proba, truth, rows, names, n, L = _score_env(spark, sf_dir)
    return M.label_counts(truth, _global_pred(proba), names, n), n, L


@query("confusion_counts")
def q_confusion_counts(spark, sf_dir):
    c, _, _ = _counts(spark, sf_dir)
    return c


def _r6_all(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float") and f.name not in keep:
            out.append(r6(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


@query("micro_metrics")
def q_micro_metrics(spark, sf_dir):
    c, n, L = _counts(spark, sf_dir)
    return _r6_all(M.micro_metrics(c, n, L))


@query("per_label_metrics")
def q_per_label_metrics(spark, sf_dir):
    c, n, L = _counts(spark, sf_dir)
    return _r6_all(M.per_label_metrics(c, n).drop("hamming"))


@query("macro_metrics")
def q_macro_metrics(spark, sf_dir):
    c, n, L = _counts(spark, sf_dir)
    return _r6_all(M.macro_metrics(M.per_label_metrics(c, n)))


@query("per_label_hamming")
def q_per_label_hamming(spark, sf_dir):
    c, n, L = _counts(spark, sf_dir)
    return _r6_all(M.per_label_metrics(c, n).select("label_idx", "hamming"))


@query("label_true_pred_counts")
def q_label_true_pred_counts(spark, sf_dir):
    c, _, _ = _counts(spark, sf_dir)
    return M.true_pred_counts(c)


@query("labels_per_row_hist")
def q_labels_per_row_hist(spark, sf_dir):
    proba, truth, rows, names, n, L = _score_env(spark, sf_dir)
    return M.labels_per_row_hist(rows, truth, _global_pred(proba))


@query("confidence_hist")
def q_confidence_hist(spark, sf_dir):
    proba = D.with_proba(tables.scores(spark, sf_dir))
    return _r6_all(M.confidence_hist(proba))


@query("confidence_stats")
def q_confidence_stats(spark, sf_dir):
    proba = D.with_proba(tables.scores(spark, sf_dir))
    return _r6_all(M.confidence_stats(proba))


@query("confusion_patterns")
def q_confusion_patterns(spark, sf_dir):
    proba, truth, rows, names, n, L = _score_env(spark, sf_dir)
    return M.confusion_patterns(truth, _global_pred(proba), names)


@query("label_cooccurrence")
def q_label_cooccurrence(spark, sf_dir):
    return M.cooccurrence(tables.truth(spark, sf_dir), tables.label_names(spark))


@query("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(tables.true_class(spark, sf_dir), tables.pred_class(spark, sf_dir))


@query("class_weights")
def q_class_weights(spark, sf_dir):
    proba, truth, rows, names, n, L = _score_env(spark, sf_dir)
    pos = truth.groupBy("label_idx").agg(F.count(F.lit(1)).alias("n_pos"))
    c = names.select("label_idx").join(pos, "label_idx", "left").select(
        "label_idx", F.coalesce("n_pos", F.lit(0)).cast("long").alias("n_pos")
    )
    c = c.withColumn("n_neg", F.lit(n) - F.col("n_pos"))
    return c.select(
        "label_idx",
        "n_pos",
        "n_neg",
        r6(F.try_divide(F.lit(float(n)), 2.0 * F.col("n_pos"))).alias("w_pos"),
        r6(F.try_divide(F.lit(float(n)), 2.0 * F.col("n_neg"))).alias("w_neg"),
    )


def _grid(spark, sf_dir, grid):
    proba, truth, rows, names, n, L = _score_env(spark, sf_dir)
    return TU.grid_counts(TU.with_truth(proba, truth), grid, names), n, L, names


@query("threshold_sensitivity")
def q_threshold_sensitivity(spark, sf_dir):
    g, n, L, _ = _grid(spark, sf_dir, TU.SENSITIVITY_GRID)
    return _r6_all(TU.threshold_sensitivity(g).drop("j"))


@query("threshold_sweep")
def q_threshold_sweep(spark, sf_dir):
    g, n, L, _ = _grid(spark, sf_dir, TU.SWEEP_GRID)
    return _r6_all(TU.threshold_sweep(g, n, L))


def _tuned(spark, sf_dir):
    g, n, L, names = _grid(spark, sf_dir, TU.TUNING_GRID)
    return TU.tune_thresholds(g, "f1").join(names, "label_idx"), n, L, names


@query("tune_thresholds")
def q_tune_thresholds(spark, sf_dir):
    t, *_ = _tuned(spark, sf_dir)
    return _r6_all(t.select("label_idx", "label", "threshold", "score"))


@query("threshold_summary")
def q_threshold_summary(spark, sf_dir):
    t, *_ = _tuned(spark, sf_dir)
    return _r6_all(TU.threshold_summary(t))


@query("threshold_table")
def q_threshold_table(spark, sf_dir):
    from pyspark.sql import Window

    t, *_ = _tuned(spark, sf_dir)
    w = Window.orderBy(F.col("threshold").desc(), F.col("label").asc())  # one row per label
    return _r6_all(t.select("label", "threshold", "score").withColumn("rank", F.row_number().over(w)))


@query("threshold_compare")
def q_threshold_compare(spark, sf_dir):
    t, n, L, names = _tuned(spark, sf_dir)
    proba, truth, rows, names, n, L = _score_env(spark, sf_dir)
    base = M.micro_metrics(M.label_counts(truth, _global_pred(proba), names, n), n, L)
    policy = D.ThresholdPolicy(SCORE_THRESHOLD, t.select("label", "threshold"), L)
    per = D.apply_label_thresholds(proba, names, policy, L).filter(F.col("pred") == 1).select("row_id", "label_idx")
    new = M.micro_metrics(M.label_counts(truth, per, names, n), n, L)
    return _r6_all(TU.compare_metrics(base, new))


@query("best_threshold")
def q_best_threshold(spark, sf_dir):
    g, n, L, _ = _grid(spark, sf_dir, TU.SENSITIVITY_GRID)
    return _r6_all(TU.best_point(TU.threshold_sensitivity(g), "threshold", "f1"))


# ---------------------------------------------------------------- sources, cleaning, labels
from tagwise.functions.exprs import fold_of, is_test, strip_ws, truncate_text  # noqa: E402
from tagwise.operators import clean as CL  # noqa: E402
from tagwise.operators import labels as LB  # noqa: E402
from tagwise.operators import select as SE  # noqa: E402
from tagwise.operators import text as TX  # noqa: E402
from tagwise.sources import io as IO  # noqa: E402


@query("scan_docs")
def q_scan_docs(spark, sf_dir):
    """The movie table written as CSV (quoted, multi-line) and scanned back with the explicit schema."""
    path = state_path(spark, "csv")
    IO.write_csv(tables.movies(spark, sf_dir), path, force=True)
    return IO.read_csv(spark, path)


@query("dedup_titles")
def q_dedup_titles(spark, sf_dir):
    return CL.first_per_key(tables.titles(spark, sf_dir), "movie_name")


@query("clean_titles")
def q_clean_titles(spark, sf_dir):
    return CL.clean_titles(tables.movies(spark, sf_dir)).select("row_id", "movie_name", "genre")


@query("text_nulls")
def q_text_nulls(spark, sf_dir):
    return CL.text_null_stats(CL.clean_titles(tables.movies(spark, sf_dir)))


def _parsed_all(spark, sf_dir):
    return LB.parse_label_column(tables.movies(spark, sf_dir))


@query("parse_labels")
def q_parse_labels(spark, sf_dir):
    p = _parsed_all(spark, sf_dir)
    return p.select("row_id", joined("labels").alias("labels"), F.size("labels").cast("long").alias("n_labels"))


@query("label_frequency")
def q_label_frequency(spark, sf_dir):
    return _r6_all(LB.label_frequency(_parsed_all(spark, sf_dir)))


@query("rare_labels")
def q_rare_labels(spark, sf_dir):
    f = LB.label_frequency(_parsed_all(spark, sf_dir))
    return _r6_all(f.withColumn("kept", F.col("pct") >= F.lit(LB.DEFAULT_MIN_LABEL_PCT)))


def _all_index(spark, sf_dir):
    p = _parsed_all(spark, sf_dir)
    return p, LB.fit_labels(p)


@query("label_index")
def q_label_index(spark, sf_dir):
    _, idx = _all_index(spark, sf_dir)
    return idx.table


@query("restrict_labels")
def q_restrict_labels(spark, sf_dir):
    p, idx = _all_index(spark, sf_dir)
    return LB.restrict_labels(p, idx).select("row_id", joined("labels").alias("labels"))


@query("multi_hot")
def q_multi_hot(spark, sf_dir):
    p, idx = _all_index(spark, sf_dir)
    return LB.multi_hot(p, idx)


@query("label_stats")
def q_label_stats(spark, sf_dir):
    p, idx = _all_index(spark, sf_dir)
    return _r6_all(LB.label_stats(p, idx))


@query("missing_labels")
def q_missing_labels(spark, sf_dir):
    _, test = _stage(spark, sf_dir, "split")
    labels, _, _ = _stage(spark, sf_dir, "labels")
    return LB.missing_labels(labels, test)


def _corpus(spark, sf_dir):
    return P.corpus(spark, sf_dir)


@query("length_stats")
def q_length_stats(spark, sf_dir):
    return _r6_all(CL.length_stats(_corpus(spark, sf_dir)))


@query("length_validation")
def q_length_validation(spark, sf_dir):
    lo, hi = CL.length_bounds(CL.length_stats(_corpus(spark, sf_dir)))
    return CL.length_validation(tables.requests(spark, sf_dir), lo, hi)


@query("validate_requests")
def q_validate_requests(spark, sf_dir):
    return CL.validate_requests(tables.requests(spark, sf_dir)).select("row_id", "valid", "reason")


@query("score_input")
def q_score_input(spark, sf_dir):
    return CL.score_input(tables.requests(spark, sf_dir), "description")


@query("train_test_split")
def q_train_test_split(spark, sf_dir):
    return _corpus(spark, sf_dir).select("row_id", is_test(F.col("row_id")).alias("is_test"))


@query("kfold_assign")
def q_kfold_assign(spark, sf_dir):
    _, rows, _ = _stage(spark, sf_dir, "labels")
    return rows.select("row_id", fold_of(F.col("row_id")).alias("fold"))


def _grams(spark, sf_dir):
    return TX.doc_grams(_corpus(spark, sf_dir), TX.VectorizerParams())


@query("tokenize")
def q_tokenize(spark, sf_dir):
    g = _grams(spark, sf_dir)
    return g.select("row_id", F.size("_raw").cast("long").alias("n_tokens"), F.md5(F.array_join("_raw", " ")).alias("tokens_md5"))


@query("stopwords")
def q_stopwords(spark, sf_dir):
    g = _grams(spark, sf_dir)
    return g.select("row_id", F.size("_toks").cast("long").alias("n_tokens"), F.md5(F.array_join("_toks", " ")).alias("tokens_md5"))


@query("ngrams")
def q_ngrams(spark, sf_dir):
    g = _grams(spark, sf_dir)
    return g.select("row_id", F.size("_grams").cast("long").alias("n_grams"), F.md5(F.array_join("_grams", "|")).alias("grams_md5"))


@query("term_counts")
def q_term_counts(spark, sf_dir):
    _, rows, _ = _stage(spark, sf_dir, "labels")
    return TX.term_counts(rows, TX.VectorizerParams())


@query("vocabulary")
def q_vocabulary(spark, sf_dir):
    _, rows, _ = _stage(spark, sf_dir, "labels")
    p = TX.VectorizerParams()
    return TX.prune_terms(TX.doc_freq(TX.term_counts(rows, p)), p, rows.count())


@query("vocabulary_topn")
def q_vocabulary_topn(spark, sf_dir):
    tfidf, _ = _stage(spark, sf_dir, "text")
    return _r6_all(tfidf.vocab)


@query("tfidf_fit")
def q_tfidf_fit(spark, sf_dir):
    _, x_all = _stage(spark, sf_dir, "text")
    return _r6_all(x_all)


@query("tfidf_transform")
def q_tfidf_transform(spark, sf_dir):
    _, test = _stage(spark, sf_dir, "split")
    tfidf, _ = _stage(spark, sf_dir, "text")
    return _r6_all(TX.transform_tfidf(test, tfidf))


@query("l2_normalize")
def q_l2_normalize(spark, sf_dir):
    _, x_all = _stage(spark, sf_dir, "text")
    return _r6_all(TX.l2_normalize(x_all))


@query("chi2_scores")
def q_chi2_scores(spark, sf_dir):
    labels, rows, y = _stage(spark, sf_dir, "labels")
    tfidf, x_all = _stage(spark, sf_dir, "text")
    return _r6_all(SE.chi2_scores(x_all, y, SE.TrainingStats(tfidf.n_docs, labels.n_labels, tfidf.n_features)))


@query("select_k_best")
def q_select_k_best(spark, sf_dir):
    _, sel, _, _ = _stage(spark, sf_dir, "select")
    return _r6_all(sel.table)


@query("mutual_info_scores")
def q_mutual_info_scores(spark, sf_dir):
    labels, rows, y = _stage(spark, sf_dir, "labels")
    tfidf, x_all = _stage(spark, sf_dir, "text")
    return _r6_all(SE.mutual_info_scores(x_all, y, SE.TrainingStats(tfidf.n_docs, labels.n_labels, tfidf.n_features)))


@query("feature_label_table")
def q_feature_label_table(spark, sf_dir):
    """Features and labels side by side per training row (long features, label list)."""
    _, prep, _, _ = fitted_nb(spark, sf_dir)
    feats = prep.x.groupBy("row_id").agg(F.count(F.lit(1)).alias("n_features"), F.sum("value").alias("value_sum"))
    out = prep.rows.select("row_id", "labels").join(feats, "row_id", "left")
    return _r6_all(
        out.select(
            "row_id",
            F.coalesce("n_features", F.lit(0)).cast("long").alias("n_features"),
            F.coalesce("value_sum", F.lit(0.0)).alias("value_sum"),
            joined("labels").alias("labels"),
        )
    )


@query("prepare_features")
def q_prepare_features(spark, sf_dir):
    _, prep, _, _ = fitted_nb(spark, sf_dir)
    return _r6_all(prep.x)


@query("prepare_corpus")
def q_prepare_corpus(spark, sf_dir):
    """The features of all rows, fitted on all rows."""
    train, test = _stage(spark, sf_dir, "split")
    return _r6_all(P.prepare_corpus(train.unionByName(test)).x)


@query("processed_roundtrip")
def q_processed_roundtrip(spark, sf_dir):
    """The wide processed table is written, read back, and split into long features and label lists."""
    _, prep, _, _ = fitted_nb(spark, sf_dir)
    path = state_path(spark, "processed")
    IO.write_table(P.processed_table(prep), path)
    x, labels = P.restore_processed(IO.read_table(spark, path))
    feats = x.groupBy("row_id").agg(F.count(F.lit(1)).alias("n_features"), F.sum("value").alias("value_sum"), F.sum(F.col("value") * F.col("feat_idx")).alias("place_sum"))
    out = labels.join(feats, "row_id", "left")
    return _r6_all(
        out.select(
            "row_id",
            F.coalesce("n_features", F.lit(0)).cast("long").alias("n_features"),
            F.coalesce("value_sum", F.lit(0.0)).alias("value_sum"),
            F.coalesce("place_sum", F.lit(0.0)).alias("place_sum"),
            joined("labels").alias("labels"),
        )
    )


@query("nb_fit")
def q_nb_fit(spark, sf_dir):
    fitted, _, _, _ = fitted_nb(spark, sf_dir)
    return _r6_all(fitted.model.coef.select("feat_idx", "label_idx", "w"))


def _test_scores(spark, sf_dir):
    fitted, _, _, test = fitted_nb(spark, sf_dir)
    return P.score(fitted, test.select("row_id", "description"))


@query("linear_scores")
def q_linear_scores(spark, sf_dir):
    from tagwise.operators.linear import baseline_predictions

    s = baseline_predictions(_test_scores(spark, sf_dir))
    return s.select("row_id", "label_idx", r6(F.col("score")).alias("score"), "pred")


def _test_predictions(spark, sf_dir):
    fitted, _, _, test = fitted_nb(spark, sf_dir)
    pred = P.predict(fitted, test.select("row_id", "description"))
    return test, pred


@query("prediction_report")
def q_prediction_report(spark, sf_dir):
    test, pred = _test_predictions(spark, sf_dir)
    rep = CL.prediction_report(test.select("row_id", "description").join(pred, "row_id", "left"))
    return rep


@query("prediction_merged")
def q_prediction_merged(spark, sf_dir):
    """The original input columns with predictions, joined on row_id (never by position)."""
    test, pred = _test_predictions(spark, sf_dir)
    names = _corpus(spark, sf_dir).select("row_id", "movie_name")
    merged = test.select("row_id", "genre").join(names, "row_id").join(pred, "row_id", "left")
    return merged.select(
        "row_id", "movie_name", "genre", CL.render_labels(F.col("labels")).alias("predicted_genres"),
        F.size("labels").cast("long").alias("genre_count"),
    )


# ---------------------------------------------------------------- CV tables, ledger, fingerprint
BASELINE_CANDIDATE = "view"


@query("cv_summary")
def q_cv_summary(spark, sf_dir):
    return _r6_all(TU.cv_summary(tables.candidates(spark, sf_dir)))


@query("overfit_bands")
def q_overfit_bands(spark, sf_dir):
    return _r6_all(TU.overfit_bands(TU.cv_summary(tables.candidates(spark, sf_dir))))


@query("pipeline_ranking")
def q_pipeline_ranking(spark, sf_dir):
    return _r6_all(TU.rank_candidates(TU.cv_summary(tables.candidates(spark, sf_dir)), BASELINE_CANDIDATE))


@query("run_search")
def q_run_search(spark, sf_dir):
    """Runs tagged 'F', best metric first (ties by run id), default limit 100."""
    return IO.search_runs(tables.runs(spark, sf_dir), "tag = 'F'", ["metric DESC", "run_id ASC"]).select(
        "run_id", "metric", "tag"
    )


@query("table_fingerprint")
def q_table_fingerprint(spark, sf_dir):
    return IO.table_fingerprint(tables.table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- streaming scorer
_STREAM_CACHE: dict = {}


def _stream(spark, sf_dir):
    from tagwise.streaming.scorer import run_scorer

    key = (_sid(spark), sf_dir)
    if key not in _STREAM_CACHE:
        fitted, _, _, _ = fitted_nb(spark, sf_dir)
        _STREAM_CACHE[key] = run_scorer(spark, sf_dir, fitted)
    return _STREAM_CACHE[key]


@query("stream_predict")
def q_stream_predict(spark, sf_dir):
    return _stream(spark, sf_dir)[0]


@query("predict_text_confidence")
def q_predict_text_confidence(spark, sf_dir):
    """Prediction records with confidences and length validation for all valid requests, as one batch."""
    from tagwise.streaming.scorer import flat_records

    fitted, _, _, _ = fitted_nb(spark, sf_dir)
    good = CL.validate_requests(tables.requests(spark, sf_dir)).filter("valid").select("row_id", "description")
    return flat_records(P.predict_records(fitted, good))


@query("stream_quarantine")
def q_stream_quarantine(spark, sf_dir):
    return _stream(spark, sf_dir)[1]


STREAM_FILES = 4


class _Stopped(Exception):
    """Ends a streaming run in the middle of a micro-batch."""


@query("stream_restart")
def q_stream_restart(spark, sf_dir):
    """Documents in several files, one file a micro-batch. The first run is ended inside its second micro-batch, with
    predictions written and nothing committed; the second goes on from the same progress folder: each request once."""
    from pyspark.errors import StreamingQueryException

    from tagwise.streaming.scorer import run_scorer

    fitted, _, _, _ = fitted_nb(spark, sf_dir)
    source, sink = state_path(spark, "stream_source"), state_path(spark, "stream_sink")
    tables.table(spark, sf_dir, "documents").repartition(STREAM_FILES, "doc_id").write.parquet(source)

    def stop(batch_id: int) -> None:
        if batch_id == 1:
            raise _Stopped

    folders = dict(sink_dir=sink, checkpoint_dir=f"{sink}/_progress", glob="*.parquet", max_files=1)
    try:
        run_scorer(spark, source, fitted, **folders, on_predictions=stop)
    except StreamingQueryException as e:
        if _Stopped.__name__ not in str(e):
            raise
    return run_scorer(spark, source, fitted, **folders)[0]


@query("estimator_predict")
def q_estimator_predict(spark, sf_dir):
    """The classifier as a stage of a ``pyspark.ml`` pipeline, fitted on the training split, saved, loaded, and
    applied to the held-out rows (naive Bayes, threshold 0.55, top-3)."""
    from pyspark.ml import Pipeline, PipelineModel

    from tagwise.estimator import TextLabelClassifier

    train, test = _stage(spark, sf_dir, "split")
    path = state_path(spark, "ml_pipeline")
    Pipeline(stages=[TextLabelClassifier()]).fit(train).write().save(path)
    found = PipelineModel.load(path).transform(test.select("row_id", "description"))
    return found.select("row_id", joined("predicted").alias("predicted"), F.size("predicted").cast("long").alias("n_labels"))


# ---------------------------------------------------------------- linear trainers (rows-only keys)
def _fit_linear(spark, sf_dir, kind):
    from tagwise.operators.trainer import fit_linear

    key = (_sid(spark), sf_dir, kind)
    if key not in _FIT_CACHE:
        fitted, prep, _, test = fitted_nb(spark, sf_dir)
        model = fit_linear(prep.x, prep.y, prep.stats, kind=kind, C=0.1, alpha=1.0, rows=prep.rows.select("row_id"))
        _FIT_CACHE[key] = P.FittedPipeline(fitted.features, model, P.PipelineParams(model=kind)), test
    return _FIT_CACHE[key]


@query("svm_scores")
def q_svm_scores(spark, sf_dir):
    """L3: squared-hinge one-vs-rest SVM (C=0.1, balanced) decision scores for the held-out rows."""
    f, test = _fit_linear(spark, sf_dir, "svm")
    return P.score(f, test.select("row_id", "description")).select("row_id", "label_idx", r6(F.col("score")).alias("score"))


@query("ridge_scores")
def q_ridge_scores(spark, sf_dir):
    """One-vs-rest ridge classifier (alpha=1, balanced) decision scores for the held-out rows."""
    f, test = _fit_linear(spark, sf_dir, "ridge")
    return P.score(f, test.select("row_id", "description")).select("row_id", "label_idx", r6(F.col("score")).alias("score"))


@query("hinge_scores")
def q_hinge_scores(spark, sf_dir):
    """L4: hinge-loss one-vs-rest SVM (C=0.1, balanced) decision scores for the held-out rows."""
    from tagwise.operators.trainer import fit_linear

    fitted, prep, _, test = fitted_nb(spark, sf_dir)
    model = fit_linear(prep.x, prep.y, prep.stats, kind="svm", C=0.1, rows=prep.rows.select("row_id"), loss="hinge", tol=1e-2)
    f = P.FittedPipeline(fitted.features, model, P.PipelineParams(model="svm", loss="hinge"))
    return P.score(f, test.select("row_id", "description")).select("row_id", "label_idx", r6(F.col("score")).alias("score"))


@query("pipeline_predict")
def q_pipeline_predict(spark, sf_dir):
    """The default SVM pipeline end to end on the held-out rows (threshold 0.55, top-3)."""
    f, test = _fit_linear(spark, sf_dir, "svm")
    pred = P.predict(f, test.select("row_id", "description"))
    return pred.select("row_id", joined("labels").alias("predicted"), F.size("labels").cast("long").alias("n_labels"))


# ---------------------------------------------------------------- NB cross-validation grids
def _nb_curve(spark, sf_dir, alphas):
    from tagwise.operators import cv as CV

    key = (_sid(spark), sf_dir, "nb_curve", tuple(alphas))
    if key not in _FIT_CACHE:
        _, prep, _, _ = fitted_nb(spark, sf_dir)
        c = CV.curve(CV.nb_cv_scores(prep.x, prep.y, prep.rows.select("row_id"), prep.stats, alphas))
        _FIT_CACHE[key] = c.persist()
    return _FIT_CACHE[key]


@query("nb_grid_search")
def q_nb_grid_search(spark, sf_dir):
    """5-fold CV micro-F1 for the naive Bayes smoothing grid, ranked by validation mean."""
    from pyspark.sql import Window

    from tagwise.operators.cv import NB_GRID_ALPHAS

    c = _nb_curve(spark, sf_dir, NB_GRID_ALPHAS)
    w = Window.orderBy(F.round("val_mean", 12).desc(), F.col("alpha").asc())  # one row per candidate
    return _r6_all(c.withColumn("rank", F.row_number().over(w)).drop("cand"))


@query("nb_validation_curve")
def q_nb_validation_curve(spark, sf_dir):
    """Train / validation micro-F1 (mean ± population std over 5 folds) along the alpha curve."""
    from tagwise.operators.cv import NB_CURVE_ALPHAS

    return _r6_all(_nb_curve(spark, sf_dir, NB_CURVE_ALPHAS).drop("cand"))


@query("nearest_candidate")
def q_nearest_candidate(spark, sf_dir):
    """The curve point nearest the default alpha (1.0) and its train − validation gap."""
    from tagwise.operators.cv import NB_CURVE_ALPHAS

    c = _nb_curve(spark, sf_dir, NB_CURVE_ALPHAS)
    n = TU.nearest(c.select("alpha", "train_mean", "val_mean"), "alpha", 1.0)
    return _r6_all(n.withColumn("gap", F.col("train_mean") - F.col("val_mean")))


def _linear_curve(spark, sf_dir, kind, params):
    """One row per candidate (train / validation mean and std of the folds' micro F1), kept for the session."""
    from tagwise.operators import cv as CV

    key = (_sid(spark), sf_dir, f"{kind}_curve", tuple(params))
    if key not in _FIT_CACHE:
        _, prep, _, _ = fitted_nb(spark, sf_dir)
        scores = CV.linear_cv_scores(prep.x, prep.y, prep.rows.select("row_id"), prep.stats, kind, params)
        _FIT_CACHE[key] = materialize(CV.curve(scores))
    return _FIT_CACHE[key]


@query("ridge_grid_search")
def q_ridge_grid_search(spark, sf_dir):
    """5-fold CV micro-F1 of the balanced ridge classifier for 20 alphas, ranked by validation mean."""
    from pyspark.sql import Window

    from tagwise.operators.cv import RIDGE_GRID_ALPHAS

    c = _linear_curve(spark, sf_dir, "ridge", RIDGE_GRID_ALPHAS)
    w = Window.orderBy(F.round("val_mean", 12).desc(), F.col("alpha").asc())  # one row per candidate
    return _r6_all(c.withColumn("rank", F.row_number().over(w)).drop("cand"))


@query("svm_validation_curve")
def q_svm_validation_curve(spark, sf_dir):
    """Train / validation micro-F1 of the balanced squared-hinge SVM along 20 costs, the gap, and the best point."""
    from tagwise.operators.cv import SVM_CURVE_COSTS

    c = _linear_curve(spark, sf_dir, "svm", SVM_CURVE_COSTS)
    best = c.orderBy(F.round("val_mean", 12).desc(), F.col("alpha").asc()).limit(1).select(F.col("cand").alias("best"))
    out = c.join(F.broadcast(best), F.col("cand") == F.col("best"), "left")
    return _r6_all(
        out.select(
            F.col("alpha").alias("C"), "train_mean", "train_std", "val_mean", "val_std",
            (F.col("train_mean") - F.col("val_mean")).alias("gap"), F.col("best").isNotNull().alias("is_best"),
        )
    )


# as in the reference
NMF_COMPONENTS, NMF_UPDATES = 2000, 50
# the reference selects 4,500 behind the reductions too, which keeps all 2,000 components; here the selection takes part
# with the share that 4,500 are of the vectorizer's 10,000 terms
COMPARED = {
    "chi2": dict(),
    "mutual_info": dict(score_fn="mutual_info"),
    "nmf": dict(score_fn=None, components=NMF_COMPONENTS, iterations=NMF_UPDATES),
    "nmf_chi2": dict(k=900, components=NMF_COMPONENTS, iterations=NMF_UPDATES),
    "nmf_mutual_info": dict(score_fn="mutual_info", k=900, components=NMF_COMPONENTS, iterations=NMF_UPDATES),
}


@query("pipeline_comparison")
def q_pipeline_comparison(spark, sf_dir):
    """chi2, mutual information, NMF, and NMF with either selection over one vectorizer: 5-fold micro F1, ranks, and
    held-out metrics of the best, refitted. Seconds differ from run to run and stay out of the result."""
    from tagwise.plans.compare import Candidate, pipeline_comparison

    train, test = _stage(spark, sf_dir, "split")
    candidates = [Candidate(name, **stages) for name, stages in COMPARED.items()]
    out, _ = pipeline_comparison(train, test, candidates, "chi2")
    return _r6_all(out.drop("fit_seconds", "transform_seconds"))


@query("vocab_grid")
def q_vocab_grid(spark, sf_dir):
    _, rows, _ = _stage(spark, sf_dir, "labels")
    return TX.vocab_grid(rows, rows.count())


@query("preprocessor_grid")
def q_preprocessor_grid(spark, sf_dir):
    """The 32 configurations fitted on the training split and scored on the held-out rows in shared passes. Seconds
    differ from run to run and stay out of the result."""
    from tagwise.plans.grid import preprocessor_grid

    train, test = _stage(spark, sf_dir, "split")
    return _r6_all(preprocessor_grid(train, test)[0])


# ---------------------------------------------------------------- jobs
def _trained(spark, sf_dir):
    """(model folder, ledger folder, train metrics) of this session's training run; each run has folders of its own."""
    from tagwise.plans import jobs as J

    key = (_sid(spark), sf_dir, "train_job")
    if key not in _FIT_CACHE:
        model_dir, ledger = state_path(spark, "model"), state_path(spark, "runs")
        _FIT_CACHE[key] = model_dir, ledger, J.train_job(spark, sf_dir, model_dir, ledger)
    return _FIT_CACHE[key]


@query("train_job")
def q_train_job(spark, sf_dir):
    """The full training job (SVM pipeline), state saved, ledger appended; returns train metrics."""
    return _trained(spark, sf_dir)[2].select("split", "metric", r6(F.col("value")).alias("value"))


@query("eval_job")
def q_eval_job(spark, sf_dir):
    """Evaluates the model that this session's ledger names (trained first if it was not yet)."""
    from tagwise.plans import jobs as J

    _, ledger, _ = _trained(spark, sf_dir)
    return J.eval_job(spark, sf_dir, None, ledger).select("split", "metric", r6(F.col("value")).alias("value"))


@query("model_card")
def q_model_card(spark, sf_dir):
    from tagwise.plans import jobs as J

    fitted, _, _, test = fitted_nb(spark, sf_dir)
    return _r6_all(J.model_card(fitted, test))


@query("analysis_report")
def q_analysis_report(spark, sf_dir):
    from tagwise.plans import jobs as J

    proba, truth, rows, names, n, L = _score_env(spark, sf_dir)
    out = J.analysis_report(proba, truth, rows, names, n, L, SCORE_THRESHOLD)
    return out.select("aggregate", "k1", "k2", r6(F.col("value")).alias("value"))


# ---------------------------------------------------------------- reductions (rows-only keys)
@query("nmf_topics")
def q_nmf_topics(spark, sf_dir):
    """NMF (2,000 components, 50 multiplicative updates) of the selected training tf-idf, L2 rows."""
    from tagwise.operators import blocks as BL
    from tagwise.operators import reduce as RD

    _, prep, _, _ = fitted_nb(spark, sf_dir)
    found = BL.factorise(prep.x, prep.rows.select("row_id"), prep.stats.n_features, NMF_COMPONENTS, NMF_UPDATES)
    return _r6_all(RD.nmf_features(found.weights()))


@query("svd_features")
def q_svd_features(spark, sf_dir):
    """Uncentred truncated SVD (10 components) of the selected training tf-idf: U·S per row."""
    from tagwise.operators.rsvd import randomized_svd

    _, prep, _, _ = fitted_nb(spark, sf_dir)
    return _r6_all(randomized_svd(prep.x, prep.rows.select("row_id"), prep.stats.n_features, k=10).us)


@query("char_ngrams")
def q_char_ngrams(spark, sf_dir):
    """Word ∪ character-trigram term space (prefixed), each pruned and capped like the word vocabulary."""
    _, rows, _ = _stage(spark, sf_dir, "labels")
    tfidf, _ = _stage(spark, sf_dir, "text")
    n = rows.count()
    return TX.word_char_space(tfidf.vocab.select("term", "df", "ttf"), TX.char_vocabulary(rows, n, 3))

"""End-to-end jobs (L13, L24, L25, L27): each is a short driver script of Spark jobs over state tables.

The driver only sequences fit barriers and writes small tables; rows never pass through it.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwise.operators import decide as D
from tagwise.operators import metrics as M
from tagwise.operators import tune as TU
from tagwise.operators.labels import LabelIndex, multi_hot, restrict_labels
from tagwise.operators.linear import LinearModel
from tagwise.operators.select import Selection
from tagwise.operators.text import TfidfState, VectorizerParams
from tagwise.plans import pipeline as P
from tagwise.session import materialize
from tagwise.sources import io as IO
from tagwise.sources import tables

METRIC_NAMES = ("precision", "recall", "f1", "jaccard", "hamming_loss")


# order of the rows of the report's macro and confidence parts
MACRO_NAMES = ("precision", "recall", "f1")
CONFIDENCE_NAMES = ("mean", "median")


def long_metrics(one_row: DataFrame, split: str, run_id: str) -> DataFrame:
    """One-row metric set -> (run_id, split, metric, value)."""
    arr = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in METRIC_NAMES])
    return one_row.select(F.explode(arr).alias("e")).select(
        F.lit(run_id).alias("run_id"), F.lit(split).alias("split"), "e.metric", "e.value"
    )


def evaluate(fitted: P.FittedPipeline, parsed_rows: DataFrame, policy: D.ThresholdPolicy | None = None) -> DataFrame:
    """Five micro metrics of thresholded, top-k-free predictions against the known labels."""
    if fitted.features.leaky:
        raise ValueError("the features were fitted on the whole corpus (leaky): their metrics say nothing about unseen rows")
    labels = fitted.features.labels
    policy = policy or D.ThresholdPolicy(D.DEFAULT_THRESHOLD)
    parsed_rows = restrict_labels(parsed_rows, labels)  # rows without a known label have no truth to compare with
    docs = parsed_rows.select("row_id", "description")
    decided = D.apply_label_thresholds(P.score(fitted, docs), labels.table, policy, labels.n_labels)
    pred = decided.filter(F.col("pred") == 1).select("row_id", "label_idx")
    truth = multi_hot(parsed_rows, labels)
    n = parsed_rows.count()
    counts = M.label_counts(truth, pred, labels.table, n)
    return M.micro_metrics(counts, n, labels.n_labels)


def save_pipeline(fitted: P.FittedPipeline, path: str) -> None:
    """Every state piece as a Parquet table plus JSON parameters."""
    f = fitted.features
    IO.save_state(
        {
            "labels": f.labels.table,
            "vocab": f.tfidf.vocab,
            "selection": f.selection.table,
            "coef": fitted.model.coef,
            "intercept": fitted.model.intercept,
        },
        {
            "kind": fitted.model.kind,
            "model": fitted.model.params,
            "n_labels": f.labels.n_labels,
            "n_vocab": f.tfidf.n_features,
            "n_docs": f.tfidf.n_docs,
            "k": f.selection.k,
            "vectorizer": asdict(f.tfidf.params),
            "pipeline": asdict(fitted.params),
            "leaky": f.leaky,
        },
        path,
    )


def load_pipeline(spark: SparkSession, path: str) -> P.FittedPipeline:
    t, p = IO.load_state(spark, path, ["labels", "vocab", "selection", "coef", "intercept"])
    vp = VectorizerParams.from_dict(p["vectorizer"])
    params = P.PipelineParams(**{**p["pipeline"], "vectorizer": VectorizerParams.from_dict(p["pipeline"]["vectorizer"])})
    feats = P.FeatureState(
        LabelIndex(t["labels"], p["n_labels"]), TfidfState(t["vocab"], p["n_docs"], p["n_vocab"], vp), Selection(t["selection"], p["k"]),
        p.get("leaky", False),
    )
    model = LinearModel(t["coef"], t["intercept"], p["k"], p["n_labels"], p["kind"], p["model"])
    return P.FittedPipeline(feats, model, params)


def train_job(spark: SparkSession, sf_dir: str, model_dir: str, ledger_path: str, params: P.PipelineParams = P.PipelineParams(model="svm")) -> DataFrame:
    """Fingerprint -> split -> labels -> features -> fit -> train metrics -> save -> ledger."""
    led = IO.Ledger(spark, ledger_path)
    run = led.new_run()
    docs = tables.table(spark, sf_dir, "documents")
    led.log_dataset(run, docs, "training", f"{sf_dir}/documents.parquet", "documents")
    train, _ = P.split(P.corpus(spark, sf_dir), params)
    fitted, prep = P.fit_pipeline(train, params)
    metrics = materialize(evaluate(fitted, prep.rows))  # logged and returned: scored once
    save_pipeline(fitted, model_dir)
    led.log(run, "param", {"model": params.model, "C": params.C, "alpha": params.alpha, "k_features": params.k_features})
    led.log(run, "model", {"path": model_dir})
    out = long_metrics(metrics, "train", run)
    led.log(run, "metric", {r["metric"]: r["value"] for r in out.collect()}, prefix="train_")  # five numbers
    return out


def eval_job(spark: SparkSession, sf_dir: str, model_dir: str | None, ledger_path: str, threshold: float | None = None,
             thresholds_path: str | None = None) -> DataFrame:
    """Resolve the model (explicit, else latest in the ledger), score only the held-out rows,
    apply the threshold policy (evaluate variant), append metrics to the ledger (split = 'test')."""
    led = IO.Ledger(spark, ledger_path)
    if model_dir is None:
        row = led.latest("model", "path").first()
        if row is None or row["text"] is None:
            raise FileNotFoundError("no model in the ledger")
        model_dir = row["text"]
    fitted = load_pipeline(spark, model_dir)
    stored = IO.load_thresholds(spark, thresholds_path) if thresholds_path else None
    policy = D.resolve_thresholds(threshold, stored=stored, variant="evaluate")
    _, test = P.split(P.corpus(spark, sf_dir))
    run = led.new_run()
    led.log_dataset(run, test.select("row_id", "description", "genre"), "evaluation", f"{sf_dir}/documents.parquet", "test")
    out = long_metrics(materialize(evaluate(fitted, test, policy)), "test", run)
    led.log(run, "metric", {r["metric"]: r["value"] for r in out.collect()}, prefix="test_")
    return out


def model_card(fitted: P.FittedPipeline, test_parsed: DataFrame) -> DataFrame:
    """One row — model kind and key parameters, sizes, threshold type and held-out metrics."""
    f = fitted.features
    m = evaluate(fitted, test_parsed)
    return m.select(
        F.lit(fitted.model.kind).alias("model"),
        F.lit(float(fitted.model.params.get("alpha", 0.0))).alias("alpha"),
        F.lit(f.labels.n_labels).cast("long").alias("n_labels"),
        F.lit(f.tfidf.n_features).cast("long").alias("n_vocab"),
        F.lit(f.selection.k).cast("long").alias("n_features"),
        F.lit("global").alias("threshold_type"),
        F.lit(D.DEFAULT_THRESHOLD).alias("threshold"),
        *[F.col(c) for c in METRIC_NAMES],
    )


def analysis_report(proba: DataFrame, truth: DataFrame, rows: DataFrame, names: DataFrame, n_rows: int, n_labels: int,
                    threshold: float = D.DEFAULT_THRESHOLD, out_dir: str | None = None) -> DataFrame:
    """One scoring pass feeds every chart aggregate; the result is the stacked long table
    (aggregate, k1, k2, value) and, when ``out_dir`` is given, one small table per aggregate."""
    proba = materialize(proba)
    pred = proba.filter(F.col("proba") >= F.lit(threshold)).select("row_id", "label_idx")
    counts = materialize(M.label_counts(truth, pred, names, n_rows))
    per = M.per_label_metrics(counts, n_rows)
    sens = TU.threshold_sensitivity(TU.grid_counts(TU.with_truth(proba, truth), TU.SENSITIVITY_GRID, names))
    hist = M.labels_per_row_hist(rows, truth, pred)
    scalar = lambda df, cols: df.select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])).alias("e")
    ).select("e.*")

    def stack(df, name, k1, k2, value):
        return df.select(
            F.lit(name).alias("aggregate"),
            F.col(k1).cast("long").alias("k1"),
            (F.col(k2).cast("long") if k2 else F.lit(None).cast("long")).alias("k2"),
            F.col(value).cast("double").alias("value"),
        )

    parts = {
        "per_label_precision": stack(per, "per_label_precision", "label_idx", None, "precision"),
        "per_label_recall": stack(per, "per_label_recall", "label_idx", None, "recall"),
        "per_label_f1": stack(per, "per_label_f1", "label_idx", None, "f1"),
        "per_label_hamming": stack(per, "per_label_hamming", "label_idx", None, "hamming"),
        "true_count": stack(M.true_pred_counts(counts), "true_count", "label_idx", None, "n_true"),
        "pred_count": stack(M.true_pred_counts(counts), "pred_count", "label_idx", None, "n_pred"),
        "cooccurrence": stack(M.cooccurrence(truth, names), "cooccurrence", "label_i", "label_j", "n"),
        "confusion_patterns": stack(M.confusion_patterns(truth, pred, names), "confusion_patterns", "label_i", "label_j", "n"),
        "rows_by_true_count": stack(hist, "rows_by_true_count", "n_labels", None, "n_rows_true"),
        "rows_by_pred_count": stack(hist, "rows_by_pred_count", "n_labels", None, "n_rows_pred"),
        "confidence_hist": stack(M.confidence_hist(proba), "confidence_hist", "bin", None, "n"),
        "sensitivity_precision": stack(sens, "sensitivity_precision", "j", None, "precision"),
        "sensitivity_recall": stack(sens, "sensitivity_recall", "j", None, "recall"),
        "sensitivity_f1": stack(sens, "sensitivity_f1", "j", None, "f1"),
        "macro": stack(scalar(M.macro_metrics(per), MACRO_NAMES), "macro", "k", None, "v"),
        "confidence": stack(scalar(M.confidence_stats(proba), CONFIDENCE_NAMES), "confidence", "k", None, "v"),
    }
    if out_dir:
        for name, df in parts.items():
            df.write.mode("overwrite").parquet(f"{out_dir}/{name}")
    out = None
    for df in parts.values():
        out = df if out is None else out.unionByName(df)
    return out


def compare_pipelines(train_parsed: DataFrame, candidates: dict[str, P.PipelineParams], baseline: str, k: int = 5,
                      alpha: float = 1.0) -> DataFrame:
    """Fit each candidate feature pipeline on the training rows, score it with k-fold naive Bayes
    micro-F1, record fit seconds, and rank against a named baseline (W8). The loop runs over
    *candidates* on the driver; every candidate is a set of Spark jobs over the whole training rows."""
    import time

    from tagwise.operators import cv as CV

    spark = train_parsed.sparkSession
    parts = []
    for name, params in candidates.items():
        t0 = time.time()
        prep = P.prepare_features(train_parsed, params)
        scores = CV.nb_cv_scores(prep.x, prep.y, prep.rows.select("row_id"), prep.stats, [alpha], k)
        per_fold = scores.groupBy("fold").pivot("split", ["train", "validation"]).agg(F.first("f1"))
        rows = [(name, int(r["fold"]), float(r["train"]), float(r["validation"])) for r in per_fold.collect()]  # k rows
        secs = time.time() - t0
        parts.append(spark.createDataFrame([(*r, secs) for r in rows], "candidate string, fold int, train_score double, val_score double, seconds double"))
    table = parts[0]
    for p_ in parts[1:]:
        table = table.unionByName(p_)
    summary = TU.cv_summary(table).join(table.groupBy("candidate").agg(F.max("seconds").alias("fit_seconds")), "candidate")
    return TU.rank_candidates(summary, baseline).join(summary.select("candidate", "train_mean", "fit_seconds"), "candidate")

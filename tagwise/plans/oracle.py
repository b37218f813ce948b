"""DuckDB oracle SQL per registered query key (same column names as ``plans.queries``)."""

from __future__ import annotations

from tagwise.plans.oracle_ctes import C

ORACLE: dict[str, str] = {}


def oracle(name: str, final_sql: str) -> None:
    ORACLE[name] = C.query(final_sql)


HELD_OUT = "SELECT row_id, array_to_string(labels, ',') AS predicted, CAST(len(labels) AS BIGINT) AS n_labels FROM v_te_pred"
oracle("nb_predict", HELD_OUT)
oracle("estimator_predict", HELD_OUT)

from tagwise.plans.oracle_ctes import N_SCORE_LABELS, dbl, sdiv  # noqa: E402

oracle("sigmoid_proba", "SELECT row_id, label_idx, round(score, 6) AS score, round(proba, 6) AS proba FROM v_proba")
oracle("apply_threshold", "SELECT row_id, label_idx, CAST(proba >= 0.55e0 AS INTEGER) AS pred FROM v_proba")
oracle(
    "apply_label_thresholds",
    """
SELECT p.row_id, p.label_idx, round(coalesce(t.threshold, 0.55e0), 6) AS threshold,
       CAST(p.proba >= coalesce(t.threshold, 0.55e0) AS INTEGER) AS pred
FROM v_proba p JOIN v_label_names n ON n.label_idx = p.label_idx LEFT JOIN v_thresholds t ON t.label = n.label
""",
)
oracle("top_k_labels", "SELECT row_id, label_idx, round(proba, 6) AS proba FROM v_sc_chosen")
oracle(
    "decode_labels",
    "SELECT row_id, array_to_string(labels, ',') AS labels, CAST(len(labels) AS BIGINT) AS n_labels FROM v_sc_decoded",
)
oracle(
    "predict_confidence",
    """
SELECT r.row_id, coalesce(c.genres, 'None') AS genres, coalesce(c.conf, '') AS confidences,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS genre_count
FROM v_score_rows r LEFT JOIN (
  SELECT ch.row_id, array_to_string(list(n.label ORDER BY ch.label_idx), ', ') AS genres,
         array_to_string(list(printf('%s:%.6f', n.label, ch.proba) ORDER BY ch.proba DESC, ch.label_idx ASC), '|') AS conf,
         count(*) AS cnt
  FROM v_sc_chosen ch JOIN v_label_names n ON n.label_idx = ch.label_idx GROUP BY ch.row_id) c ON c.row_id = r.row_id
""",
)
oracle(
    "prediction_stats",
    """
SELECT count(*) AS n_rows, CAST(sum(len(labels)) AS BIGINT) AS total_labels, round(avg(len(labels)), 6) AS mean_labels
FROM v_sc_decoded
""",
)
oracle("confusion_counts", "SELECT label_idx, tp, fp, fn, (SELECT n FROM v_n_rows) - tp - fp - fn AS tn FROM v_counts")
oracle(
    "micro_metrics",
    "SELECT tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, "
    "round(jaccard, 6) AS jaccard, round(hamming_loss, 6) AS hamming_loss FROM v_micro",
)
oracle(
    "per_label_metrics",
    "SELECT label_idx, tp, fp, fn, support, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(f1, 6) AS f1, round(jaccard, 6) AS jaccard FROM v_per_label",
)
oracle(
    "macro_metrics",
    "SELECT round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1, "
    "round(avg(jaccard), 6) AS jaccard, count(*) AS n_labels FROM v_per_label",
)
oracle("per_label_hamming", "SELECT label_idx, round(hamming, 6) AS hamming FROM v_per_label")
oracle("label_true_pred_counts", "SELECT label_idx, tp + fn AS n_true, tp + fp AS n_pred FROM v_counts")
oracle(
    "labels_per_row_hist",
    """
WITH per AS (
  SELECT coalesce(t.nt, 0) AS nt, coalesce(p.np, 0) AS np FROM v_score_rows r
  LEFT JOIN (SELECT row_id, count(*) AS nt FROM v_truth GROUP BY row_id) t ON t.row_id = r.row_id
  LEFT JOIN (SELECT row_id, count(*) AS np FROM v_pred GROUP BY row_id) p ON p.row_id = r.row_id)
SELECT CAST(b.n AS BIGINT) AS n_labels,
  CAST((SELECT count(*) FROM per WHERE nt = b.n) AS BIGINT) AS n_rows_true,
  CAST((SELECT count(*) FROM per WHERE np = b.n) AS BIGINT) AS n_rows_pred
FROM range(0, (SELECT greatest(max(nt), max(np)) FROM per) + 1) AS b(n)
""",
)
oracle(
    "confidence_hist",
    """
WITH mm AS (SELECT min(proba) AS lo, max(proba) AS hi FROM v_proba)
SELECT CAST(b AS INTEGER) AS bin, round(lo + b * ((hi - lo) / 50), 6) AS bin_start, count(*) AS n
FROM (SELECT CASE WHEN hi = lo THEN 0 ELSE least(floor((proba - lo) / (hi - lo) * 50), 49) END AS b, lo, hi FROM v_proba, mm) s
GROUP BY b, lo, hi
""",
)
oracle(
    "confidence_stats",
    "SELECT count(*) AS n, round(avg(proba), 6) AS mean, round(quantile_cont(proba, 0.5), 6) AS median, "
    "round(min(proba), 6) AS min, round(max(proba), 6) AS max FROM v_proba",
)
oracle(
    "confusion_patterns",
    """
WITH hits AS (SELECT t.row_id, t.label_idx FROM v_truth t JOIN v_pred p ON p.row_id = t.row_id AND p.label_idx = t.label_idx),
missed AS (SELECT t.row_id, t.label_idx FROM v_truth t
           WHERE NOT EXISTS (SELECT 1 FROM v_pred p WHERE p.row_id = t.row_id AND p.label_idx = t.label_idx)),
c AS (SELECT label_idx AS label_i, label_idx AS label_j, count(*) AS n FROM hits GROUP BY label_idx
      UNION ALL
      SELECT m.label_idx, p.label_idx, count(*) FROM missed m JOIN v_pred p ON p.row_id = m.row_id AND p.label_idx <> m.label_idx
      GROUP BY m.label_idx, p.label_idx)
SELECT a.label_idx AS label_i, b.label_idx AS label_j, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM v_label_names a CROSS JOIN v_label_names b LEFT JOIN c ON c.label_i = a.label_idx AND c.label_j = b.label_idx
""",
)
oracle(
    "label_cooccurrence",
    """
WITH c AS (SELECT a.label_idx AS label_i, b.label_idx AS label_j, count(*) AS n
           FROM v_truth a JOIN v_truth b ON a.row_id = b.row_id GROUP BY a.label_idx, b.label_idx)
SELECT a.label_idx AS label_i, b.label_idx AS label_j, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM v_label_names a CROSS JOIN v_label_names b LEFT JOIN c ON c.label_i = a.label_idx AND c.label_j = b.label_idx
""",
)
oracle(
    "confusion_matrix",
    """
WITH seen AS (SELECT true_idx AS l FROM v_true_class UNION SELECT pred_idx FROM v_pred_class),
c AS (SELECT t.true_idx, p.pred_idx, count(*) AS n FROM v_true_class t JOIN v_pred_class p ON p.row_id = t.row_id GROUP BY ALL)
SELECT a.l AS true_idx, b.l AS pred_idx, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM seen a CROSS JOIN seen b LEFT JOIN c ON c.true_idx = a.l AND c.pred_idx = b.l
""",
)
oracle(
    "class_weights",
    """
WITH c AS (SELECT n.label_idx, CAST(coalesce(p.n_pos, 0) AS BIGINT) AS n_pos FROM v_label_names n
           LEFT JOIN (SELECT label_idx, count(*) AS n_pos FROM v_truth GROUP BY label_idx) p ON p.label_idx = n.label_idx)
SELECT label_idx, n_pos, (SELECT n FROM v_n_rows) - n_pos AS n_neg,
  round(CASE WHEN n_pos = 0 THEN NULL ELSE (SELECT n FROM v_n_rows) / (2.0::DOUBLE * n_pos) END, 6) AS w_pos,
  round(CASE WHEN (SELECT n FROM v_n_rows) - n_pos = 0 THEN NULL
             ELSE (SELECT n FROM v_n_rows) / (2.0::DOUBLE * ((SELECT n FROM v_n_rows) - n_pos)) END, 6) AS w_neg
FROM c
""",
)
oracle(
    "threshold_sensitivity",
    "SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(f1, 6) AS f1 FROM v_sens",
)
oracle(
    "threshold_sweep",
    f"""
SELECT round(threshold, 6) AS threshold, round({sdiv('tp', 'tp + fp')}, 6) AS precision,
  round({sdiv('tp', 'tp + fn')}, 6) AS recall, round({sdiv('2 * tp', '2 * tp + fp + fn')}, 6) AS f1,
  round({sdiv('fp + fn', f'(SELECT n FROM v_n_rows) * {N_SCORE_LABELS}')}, 6) AS hamming_loss,
  round({sdiv('tp', 'tp + fp + fn')}, 6) AS jaccard,
  round((tp + fp) / CAST((SELECT n FROM v_n_rows) AS DOUBLE), 6) AS avg_predicted,
  round((tp + fn) / CAST((SELECT n FROM v_n_rows) AS DOUBLE), 6) AS avg_true,
  round({sdiv('tp', 'tp + fp')} - {sdiv('tp', 'tp + fn')}, 6) AS precision_recall_gap
FROM (SELECT j, threshold, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn
      FROM v_gw_counts GROUP BY j, threshold) s
""",
)
oracle("tune_thresholds", "SELECT label_idx, label, round(threshold, 6) AS threshold, round(score, 6) AS score FROM v_tuned")
oracle(
    "threshold_summary",
    "SELECT round(avg(threshold), 6) AS mean, round(quantile_cont(threshold, 0.5), 6) AS median, "
    "round(min(threshold), 6) AS min, round(max(threshold), 6) AS max, round(stddev_pop(threshold), 6) AS std, "
    "count(*) AS n_labels FROM v_tuned",
)
oracle(
    "threshold_table",
    "SELECT label, round(threshold, 6) AS threshold, round(score, 6) AS score, "
    "CAST(row_number() OVER (ORDER BY threshold DESC, label ASC) AS INTEGER) AS rank FROM v_tuned",
)
oracle(
    "threshold_compare",
    """
WITH b AS (SELECT unnest(['precision', 'recall', 'f1', 'jaccard', 'hamming_loss']) AS metric,
                  unnest([precision, recall, f1, jaccard, hamming_loss]) AS base FROM v_micro),
n AS (SELECT unnest(['precision', 'recall', 'f1', 'jaccard', 'hamming_loss']) AS metric,
             unnest([precision, recall, f1, jaccard, hamming_loss]) AS new FROM v_pl_micro),
j AS (SELECT b.metric, base, new, new - base AS chg,
             CASE WHEN b.metric = 'hamming_loss' THEN new - base < 0 ELSE new - base > 0 END AS improved
      FROM b JOIN n ON b.metric = n.metric)
SELECT metric, round(base, 6) AS base, round(new, 6) AS new, round(chg, 6) AS abs_change,
       round(CASE WHEN base <> 0 THEN chg / abs(base) * 100.0 END, 6) AS pct_change, improved,
       bool_and(improved) OVER () AS all_improved
FROM j
""",
)
oracle(
    "best_threshold",
    "SELECT round(threshold, 6) AS threshold, round(round(f1, 12), 6) AS f1 FROM v_sens "
    "ORDER BY round(f1, 12) DESC, threshold ASC LIMIT 1",
)

from tagwise.plans.oracle_ctes import STRIP, TOKEN_PATTERN, split_hash_sql, ngram_sql  # noqa: E402
from tagwise.sources.io import NA_TOKENS  # noqa: E402

_NA = "(" + ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS) + ")"


def _na(c: str) -> str:
    return f"CASE WHEN {c} IN {_NA} THEN NULL ELSE {c} END AS {c}"


oracle("scan_docs", f"SELECT row_id, {_na('movie_name')}, {_na('description')}, {_na('genre')} FROM v_movies")
oracle(
    "dedup_titles",
    "SELECT row_id, movie_name FROM (SELECT *, row_number() OVER (PARTITION BY movie_name ORDER BY row_id) AS rn "
    "FROM v_titles WHERE movie_name IS NOT NULL) t WHERE rn = 1",
)
oracle("clean_titles", "SELECT row_id, movie_name, genre FROM v_clean")
oracle(
    "text_nulls",
    "SELECT count(*) AS n_rows, count(*) FILTER (WHERE description IS NULL) AS n_null, "
    "count(*) FILTER (WHERE length(coalesce(description, '')) = 0) AS n_empty FROM v_clean",
)
oracle("parse_labels", "SELECT row_id, array_to_string(labels, ',') AS labels, CAST(len(labels) AS BIGINT) AS n_labels FROM v_parsed_all")
oracle("label_frequency", "SELECT label, n, round(pct, 6) AS pct FROM v_all_freq")
oracle("rare_labels", "SELECT label, n, round(pct, 6) AS pct, pct >= 5.0e0 AS kept FROM v_all_freq")
oracle("label_index", "SELECT label_idx, label FROM v_all_index")
oracle("restrict_labels", "SELECT row_id, array_to_string(labels, ',') AS labels FROM v_all_kept WHERE len(labels) > 0")
oracle(
    "multi_hot",
    "SELECT p.row_id, i.label_idx FROM v_all_pairs p JOIN v_all_index i ON i.label = p.label",
)
oracle(
    "label_stats",
    "SELECT (SELECT count(*) FROM v_parsed_all) AS n_rows, "
    "(SELECT count(*) FROM v_parsed_all WHERE len(labels) = 0) AS n_missing, "
    "(SELECT round(avg(CAST(len(labels) AS DOUBLE)), 6) FROM v_parsed_all) AS mean_labels, "
    "(SELECT count(*) FROM v_all_kept WHERE len(labels) = 0) AS n_lost",
)
oracle(
    "missing_labels",
    "SELECT label_idx, label FROM v_label_index WHERE label NOT IN "
    "(SELECT DISTINCT unnest(labels) FROM v_test_parsed)",
)
oracle(
    "length_stats",
    """
WITH l AS (SELECT length(description) AS n FROM v_corpus WHERE length(description) > 0)
SELECT count(*) AS n_texts, CAST(min(n) AS BIGINT) AS min, CAST(max(n) AS BIGINT) AS max, round(avg(n), 6) AS mean,
  round(quantile_cont(n, 0.5), 6) AS median, round(quantile_cont(n, 0.25), 6) AS q25, round(quantile_cont(n, 0.75), 6) AS q75,
  CAST(trunc(quantile_cont(n, 0.25)) AS BIGINT) AS optimal_min, CAST(trunc(quantile_cont(n, 0.75)) AS BIGINT) AS optimal_max
FROM l
""",
)
oracle(
    "length_validation",
    """
WITH b AS (SELECT CAST(trunc(quantile_cont(length(description), 0.25)) AS BIGINT) AS lo,
                  CAST(trunc(quantile_cont(length(description), 0.75)) AS BIGINT) AS hi
           FROM v_corpus WHERE length(description) > 0),
r AS (SELECT row_id, CAST(length(coalesce(description, '')) AS BIGINT) AS length FROM v_requests)
SELECT row_id, length, length >= lo AND length <= hi AS is_optimal,
  CASE WHEN length < lo THEN 'Description is too short (' || length || ' chars). Recommended minimum: ' || lo
         || ' characters. Shorter descriptions may result in less accurate predictions.'
       WHEN length > hi THEN 'Description is quite long (' || length || ' chars). Recommended maximum: ' || hi
         || ' characters. Very long descriptions may not improve accuracy.' END AS recommendation,
  lo AS optimal_min, hi AS optimal_max
FROM r, b
""",
)
oracle(
    "validate_requests",
    """
SELECT row_id, reason IS NULL AS valid, reason FROM (
  SELECT row_id, CASE WHEN description IS NULL OR length(description) < 1 THEN 'too_short'
                      WHEN length(description) > 10000 THEN 'too_long' END AS reason FROM v_requests) t
""",
)
oracle(
    "score_input",
    f"SELECT row_id, d AS description FROM (SELECT row_id, regexp_replace(coalesce(description, ''), '{STRIP}', '', 'g') AS d "
    "FROM v_requests) t WHERE length(d) > 0",
)
oracle("train_test_split", "SELECT row_id, is_test FROM v_split")
oracle("kfold_assign", f"SELECT row_id, CAST({split_hash_sql('row_id')} % 5 AS INTEGER) AS fold FROM v_train_docs")

_RAW = f"regexp_extract_all(lower(coalesce(description, '')), '{TOKEN_PATTERN}')"
oracle(
    "tokenize",
    f"SELECT row_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM (SELECT row_id, {_RAW} AS t FROM v_corpus) s",
)
from tagwise.plans.oracle_ctes import tokens_sql  # noqa: E402

oracle(
    "stopwords",
    f"SELECT row_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 "
    f"FROM (SELECT row_id, {tokens_sql('description')} AS t FROM v_corpus) s",
)
oracle(
    "ngrams",
    f"SELECT row_id, CAST(len(g) AS BIGINT) AS n_grams, md5(array_to_string(g, '|')) AS grams_md5 FROM ("
    f"SELECT row_id, {ngram_sql('toks', 1, 3)} AS g FROM (SELECT row_id, {tokens_sql('description')} AS toks FROM v_corpus) t) s",
)
oracle("term_counts", "SELECT row_id, term, tf FROM v_tr_tc")
oracle(
    "vocabulary",
    "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ttf FROM v_tr_tc GROUP BY term "
    "HAVING count(*) >= 3 AND count(*) <= 0.7e0 * (SELECT n FROM v_n_train)",
)
oracle("vocabulary_topn", "SELECT term, feat_idx, df, ttf, round(idf, 6) AS idf FROM v_vocab")
oracle("tfidf_fit", "SELECT row_id, feat_idx, round(value, 6) AS value FROM v_tr_x")
oracle("tfidf_transform", "SELECT row_id, feat_idx, round(value, 6) AS value FROM v_te_x0")
oracle(
    "l2_normalize",
    "SELECT row_id, feat_idx, round(coalesce(value / sqrt(sum(value * value) OVER (PARTITION BY row_id)), 0.0), 6) AS value FROM v_tr_x",
)
oracle("chi2_scores", "SELECT feat_idx, round(score, 6) AS score FROM v_chi2")
oracle("select_k_best", "SELECT feat_idx, sel_idx, round(score, 6) AS score FROM v_selected")
oracle("mutual_info_scores", "SELECT feat_idx, round(score, 6) AS score FROM v_mi")
oracle(
    "feature_label_table",
    """
SELECT d.row_id, CAST(coalesce(f.n, 0) AS BIGINT) AS n_features, round(coalesce(f.s, 0.0), 6) AS value_sum,
       array_to_string(l.labels, ',') AS labels
FROM v_train_docs d
JOIN (SELECT y.row_id, list(i.label ORDER BY i.label) AS labels FROM v_tr_y y JOIN v_label_index i ON i.label_idx = y.label_idx
      GROUP BY y.row_id) l ON l.row_id = d.row_id
LEFT JOIN (SELECT row_id, count(*) AS n, sum(value) AS s FROM v_tr_xs GROUP BY row_id) f ON f.row_id = d.row_id
""",
)
oracle("prepare_features", "SELECT row_id, feat_idx, round(value, 6) AS value FROM v_tr_xs")
oracle(
    "processed_roundtrip",
    """
SELECT d.row_id, CAST(coalesce(f.n, 0) AS BIGINT) AS n_features, round(coalesce(f.s, 0.0), 6) AS value_sum,
       round(coalesce(f.p, 0.0), 6) AS place_sum, array_to_string(l.labels, ',') AS labels
FROM v_train_docs d
JOIN (SELECT y.row_id, list(i.label ORDER BY i.label) AS labels FROM v_tr_y y JOIN v_label_index i ON i.label_idx = y.label_idx
      GROUP BY y.row_id) l ON l.row_id = d.row_id
LEFT JOIN (SELECT row_id, count(*) AS n, sum(value) AS s, sum(value * feat_idx) AS p FROM v_tr_xs GROUP BY row_id) f ON f.row_id = d.row_id
""",
)
# the same fit with nothing held out
ORACLE["prepare_corpus"] = ORACLE["prepare_features"].replace("SELECT * FROM v_split WHERE NOT is_test", "SELECT * FROM v_split")
oracle("nb_fit", "SELECT feat_idx, label_idx, round(w, 6) AS w FROM v_nb_coef")
oracle("linear_scores", "SELECT row_id, label_idx, round(score, 6) AS score, CAST(score > 0 AS INTEGER) AS pred FROM v_te_scores")
oracle(
    "prediction_report",
    """
SELECT t.row_id,
  CASE WHEN length(t.description) > 100 THEN substr(t.description, 1, 100) || '...' ELSE t.description END AS description,
  CASE WHEN len(p.labels) = 0 THEN 'None' ELSE array_to_string(p.labels, ', ') END AS predicted_genres,
  CAST(len(p.labels) AS BIGINT) AS genre_count
FROM v_test_parsed t JOIN v_te_pred p ON p.row_id = t.row_id
""",
)
oracle(
    "prediction_merged",
    """
SELECT t.row_id, t.movie_name, t.genre,
  CASE WHEN len(p.labels) = 0 THEN 'None' ELSE array_to_string(p.labels, ', ') END AS predicted_genres,
  CAST(len(p.labels) AS BIGINT) AS genre_count
FROM v_test_parsed t LEFT JOIN v_te_pred p ON p.row_id = t.row_id
""",
)

_CV = """
SELECT candidate, avg(train_score) AS train_mean, stddev_pop(train_score) AS train_std,
       avg(val_score) AS val_mean, stddev_pop(val_score) AS val_std, count(*) AS n_folds
FROM v_candidates GROUP BY candidate
"""
oracle(
    "cv_summary",
    f"SELECT candidate, round(train_mean, 6) AS train_mean, round(train_std, 6) AS train_std, round(val_mean, 6) AS val_mean, "
    f"round(val_std, 6) AS val_std, n_folds FROM ({_CV}) s",
)
oracle(
    "overfit_bands",
    f"SELECT candidate, round(train_mean - val_mean, 6) AS gap, CASE WHEN train_mean - val_mean > 0.05e0 THEN 'warning' "
    f"WHEN train_mean - val_mean > 0.02e0 THEN 'caution' ELSE 'good' END AS band FROM ({_CV}) s",
)
oracle(
    "pipeline_ranking",
    f"""
WITH s AS ({_CV}), b AS (SELECT val_mean AS bm FROM s WHERE candidate = 'view')
SELECT candidate, round(val_mean, 6) AS val_mean, round(val_std, 6) AS val_std,
  CAST(row_number() OVER (ORDER BY round(val_mean, 12) DESC, candidate ASC) AS INTEGER) AS rank,
  round(val_mean - bm, 6) AS improvement,
  round(CASE WHEN bm <> 0 THEN (val_mean - bm) / abs(bm) * 100.0 END, 6) AS improvement_pct
FROM s, b
""",
)
oracle("run_search", "SELECT run_id, metric, tag FROM v_runs WHERE tag = 'F' ORDER BY metric DESC, run_id ASC LIMIT 100")
oracle(
    "table_fingerprint",
    """
SELECT count(*) AS n_rows, bit_xor(h) AS fingerprint, CAST(sum(h) AS VARCHAR) AS hash_sum FROM (
  SELECT ('0x' || substr(md5(concat(coalesce(length(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(length(text) || ':' || text, '-'),
    coalesce(length(lang) || ':' || lang, '-'), coalesce(length(source) || ':' || source, '-'),
    coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-'))), 1, 15))::BIGINT AS h
  FROM documents) t
""",
)

# one record per valid request, batch and stream alike
RECORDS = """
SELECT r.row_id, array_to_string(p.labels, ',') AS predicted, CAST(len(p.labels) AS BIGINT) AS n_labels, coalesce(c.conf, '') AS confidences,
  CASE WHEN length(r.description) > 100 THEN substr(r.description, 1, 100) || '...' ELSE r.description END AS description,
  CAST(length(r.description) AS BIGINT) AS length, length(r.description) BETWEEN 100 AND 500 AS is_optimal,
  CASE WHEN length(r.description) < 100 THEN 'Description is too short (' || length(r.description) || ' chars). Recommended minimum: 100'
         || ' characters. Shorter descriptions may result in less accurate predictions.'
       WHEN length(r.description) > 500 THEN 'Description is quite long (' || length(r.description) || ' chars). Recommended maximum: 500'
         || ' characters. Very long descriptions may not improve accuracy.' END AS recommendation
FROM v_req_valid r JOIN v_rq_pred p ON p.row_id = r.row_id LEFT JOIN (
  SELECT ch.row_id, array_to_string(list(printf('%s:%.6f', li.label, ch.proba) ORDER BY ch.proba DESC, ch.label_idx), '|') AS conf
  FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY round(proba, 12) DESC, label_idx DESC) AS rk
        FROM v_rq_scores WHERE proba >= 0.55e0) ch JOIN v_label_index li ON li.label_idx = ch.label_idx
  WHERE ch.rk <= 3 GROUP BY ch.row_id) c ON c.row_id = r.row_id
"""
oracle("stream_predict", RECORDS)
oracle("stream_restart", RECORDS)
oracle("predict_text_confidence", RECORDS)
oracle("stream_quarantine", "SELECT row_id, reason FROM v_req_checked WHERE reason IS NOT NULL")

_CURVE_COLS = ("round(alpha, 6) AS alpha, round(train_mean, 6) AS train_mean, round(train_std, 6) AS train_std, "
               "round(val_mean, 6) AS val_mean, round(val_std, 6) AS val_std")
oracle(
    "nb_grid_search",
    f"SELECT {_CURVE_COLS}, CAST(row_number() OVER (ORDER BY round(val_mean, 12) DESC, alpha ASC) AS INTEGER) AS rank FROM v_nbg_curve",
)
oracle("nb_validation_curve", f"SELECT {_CURVE_COLS} FROM v_nbc_curve")
oracle(
    "nearest_candidate",
    "SELECT round(alpha, 6) AS alpha, round(train_mean, 6) AS train_mean, round(val_mean, 6) AS val_mean, "
    "round(train_mean - val_mean, 6) AS gap FROM v_nbc_curve ORDER BY abs(alpha - 1.0e0), alpha LIMIT 1",
)

from tagwise.plans.oracle_ctes import ngram_sql as _ng, tokens_sql as _tk  # noqa: E402

_GRID = ", ".join(
    f"({mf}, {ng}, {dbl(mx)}, {mn}, {k})"
    for mf in (15000, 20000) for ng in (2, 3) for mx in (0.6, 0.7) for mn in (2, 3) for k in (5000, 6000)
)
oracle(
    "vocab_grid",
    f"""
WITH terms AS (SELECT row_id, unnest({_ng('toks', 1, 3)}) AS term
               FROM (SELECT row_id, {_tk('description')} AS toks FROM v_train_docs) t),
st AS (SELECT term, count(*) AS df, sum(tf) AS ttf FROM (SELECT row_id, term, count(*) AS tf FROM terms GROUP BY row_id, term) c GROUP BY term),
hist AS (SELECT len(string_split(term, ' ')) AS n, df, ttf, count(*) AS cnt FROM st GROUP BY ALL),
cfg AS (SELECT * FROM (VALUES {_GRID}) AS c(max_features, ngram_max, max_df, min_df, k_features)),
per AS (SELECT c.*, h.ttf, sum(h.cnt) AS cnt FROM hist h, cfg c
        WHERE h.n <= c.ngram_max AND h.df >= c.min_df AND h.df <= c.max_df * (SELECT n FROM v_n_train)
        GROUP BY ALL),
cum AS (SELECT *, sum(cnt) OVER (PARTITION BY max_features, ngram_max, max_df, min_df, k_features ORDER BY ttf DESC) - cnt AS above FROM per)
SELECT max_features, ngram_max, max_df, min_df, k_features, CAST(sum(cnt) AS BIGINT) AS n_candidates,
  CAST(least(sum(cnt), max_features) AS BIGINT) AS n_terms, CAST(least(sum(cnt), max_features, k_features) AS BIGINT) AS n_features,
  CAST(min(CASE WHEN above < max_features THEN ttf END) AS BIGINT) AS cut_ttf
FROM cum GROUP BY max_features, ngram_max, max_df, min_df, k_features
""",
)

_TERMS = "SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest({grams}) AS term FROM (SELECT row_id, {toks} AS toks FROM {docs}) t) u GROUP BY row_id, term"
_TRAIN_TERMS, _TEST_TERMS = (_TERMS.format(grams=_ng("toks", 1, 3), toks=_tk("description"), docs=d) for d in ("v_train_docs", "v_test_docs"))
_NG, _NL = "CAST((SELECT n FROM v_n_train) AS DOUBLE)", "(SELECT count(*) FROM v_label_index)"
oracle(
    "preprocessor_grid",
    f"""
WITH cfg AS (SELECT * FROM (VALUES {_GRID}) AS c(max_features, ngram_max, max_df, min_df, k_features)),
vec AS (SELECT row_number() OVER (ORDER BY max_features, ngram_max, max_df, min_df) AS v, * FROM (SELECT DISTINCT max_features, ngram_max, max_df, min_df FROM cfg) d),
tr AS MATERIALIZED ({_TRAIN_TERMS}),
st AS MATERIALIZED (SELECT term, len(string_split(term, ' ')) AS n, count(*) AS df, sum(tf) AS ttf FROM tr GROUP BY term),
vocab AS MATERIALIZED (SELECT v, term, df, ln((1 + (SELECT n FROM v_n_train)) / (1e0 + df)) + 1e0 AS idf FROM (
    SELECT v.v, v.max_features, s.term, s.df, row_number() OVER (PARTITION BY v.v ORDER BY s.ttf DESC, s.term) AS rn
    FROM st s JOIN vec v ON s.n <= v.ngram_max AND s.df >= v.min_df AND s.df <= v.max_df * (SELECT n FROM v_n_train)) r WHERE rn <= max_features),
raw AS (SELECT v.v, t.row_id, t.term, (1e0 + ln(CAST(t.tf AS DOUBLE))) * v.idf AS w FROM tr t JOIN vocab v ON t.term = v.term),
x AS MATERIALIZED (SELECT v, row_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY v, row_id)) AS x FROM raw),
fc AS (SELECT v, term, sum(x) AS fc FROM x GROUP BY v, term),
ob AS (SELECT x.v, x.term, y.label_idx, sum(x.x) AS obs FROM x JOIN v_tr_y y ON x.row_id = y.row_id GROUP BY x.v, x.term, y.label_idx),
pos AS (SELECT label_idx, count(*) AS n_pos FROM v_tr_y GROUP BY label_idx),
cells AS MATERIALIZED (SELECT f.v, f.term, li.label_idx, f.fc, coalesce(o.obs, 0e0) AS obs, coalesce(p.n_pos, 0) AS n_pos
    FROM fc f CROSS JOIN v_label_index li LEFT JOIN ob o ON o.v = f.v AND o.term = f.term AND o.label_idx = li.label_idx
    LEFT JOIN pos p ON p.label_idx = li.label_idx),
chi AS (SELECT v, term, sum(CASE WHEN e = 0 THEN NULL ELSE (obs - e) * (obs - e) / e END) AS score
    FROM (SELECT v, term, obs, CAST(n_pos AS DOUBLE) / {_NG} * fc AS e FROM cells) c GROUP BY v, term),
ranked AS (SELECT v, term, row_number() OVER (PARTITION BY v ORDER BY round(score, 9) DESC NULLS LAST, term DESC) AS rk FROM chi),
sized AS (SELECT c.*, v.v, (SELECT count(*) FROM vocab w WHERE w.v = v.v) AS n_terms FROM cfg c JOIN vec v USING (max_features, ngram_max, max_df, min_df)),
tot AS (SELECT s.v, s.k_features, g.label_idx, sum(g.obs) AS n1, sum(g.fc - g.obs) AS n0, least(any_value(s.n_terms), s.k_features) AS nf
    FROM sized s JOIN ranked r ON r.v = s.v AND r.rk <= s.k_features JOIN cells g ON g.v = r.v AND g.term = r.term GROUP BY s.v, s.k_features, g.label_idx),
coef AS MATERIALIZED (SELECT t.v, t.k_features, g.term, g.label_idx,
      ln((g.obs + 1e0) / (t.n1 + t.nf)) - ln((g.fc - g.obs + 1e0) / (t.n0 + t.nf)) AS w
    FROM tot t JOIN cells g ON g.v = t.v AND g.label_idx = t.label_idx JOIN ranked r ON r.v = g.v AND r.term = g.term AND r.rk <= t.k_features),
te AS (SELECT v.v, t.row_id, t.term, (1e0 + ln(CAST(t.tf AS DOUBLE))) * v.idf AS w FROM ({_TEST_TERMS}) t JOIN vocab v ON t.term = v.term
    WHERE t.row_id IN (SELECT row_id FROM v_te_truth)),
hits AS (SELECT c.v, c.k_features, te.row_id, c.label_idx FROM te JOIN coef c ON te.v = c.v AND te.term = c.term
    GROUP BY c.v, c.k_features, te.row_id, c.label_idx HAVING sum(te.w * c.w) > 0),
tested AS (SELECT h.v, h.k_features, count(*) AS predicted, count(t.row_id) AS tp FROM hits h LEFT JOIN v_te_truth t ON t.row_id = h.row_id AND t.label_idx = h.label_idx GROUP BY h.v, h.k_features),
n AS (SELECT count(*) AS n_true, count(DISTINCT row_id) AS n_rows FROM v_te_truth),
c AS (SELECT s.*, coalesce(t.tp, 0) AS tp, coalesce(t.predicted, 0) - coalesce(t.tp, 0) AS fp, n.n_true - coalesce(t.tp, 0) AS fn, n.n_rows
    FROM sized s CROSS JOIN n LEFT JOIN tested t ON t.v = s.v AND t.k_features = s.k_features)
SELECT max_features, ngram_max, max_df, min_df, k_features, n_terms, least(n_terms, k_features) AS n_features,
  round({sdiv('2 * tp', '2 * tp + fp + fn')}, 6) AS f1, round({sdiv('tp', 'tp + fp')}, 6) AS "precision", round({sdiv('tp', 'tp + fn')}, 6) AS recall,
  round({sdiv('fp + fn', f'n_rows * {_NL}')}, 6) AS hamming_loss, round({sdiv('tp', 'tp + fp + fn')}, 6) AS jaccard,
  CAST((SELECT n FROM v_n_train) AS BIGINT) AS n_samples_train, n_rows AS n_samples_test
FROM c
""",
)

oracle(
    "model_card",
    """
SELECT 'nb' AS model, 1.0e0 AS alpha, (SELECT count(*) FROM v_label_index) AS n_labels, (SELECT count(*) FROM v_vocab) AS n_vocab,
  (SELECT count(*) FROM v_selected) AS n_features, 'global' AS threshold_type, 0.55e0 AS threshold,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(jaccard, 6) AS jaccard,
  round(hamming_loss, 6) AS hamming_loss
FROM v_te_micro
""",
)
oracle(
    "analysis_report",
    """
WITH hits AS (SELECT t.row_id, t.label_idx FROM v_truth t JOIN v_pred p ON p.row_id = t.row_id AND p.label_idx = t.label_idx),
missed AS (SELECT t.row_id, t.label_idx FROM v_truth t
           WHERE NOT EXISTS (SELECT 1 FROM v_pred p WHERE p.row_id = t.row_id AND p.label_idx = t.label_idx)),
cp AS (SELECT label_idx AS i, label_idx AS j, count(*) AS n FROM hits GROUP BY label_idx
       UNION ALL SELECT m.label_idx, p.label_idx, count(*) FROM missed m JOIN v_pred p ON p.row_id = m.row_id AND p.label_idx <> m.label_idx
       GROUP BY m.label_idx, p.label_idx),
co AS (SELECT a.label_idx AS i, b.label_idx AS j, count(*) AS n FROM v_truth a JOIN v_truth b ON a.row_id = b.row_id GROUP BY ALL),
grid AS (SELECT a.label_idx AS i, b.label_idx AS j FROM v_label_names a CROSS JOIN v_label_names b),
per AS (SELECT coalesce(t.nt, 0) AS nt, coalesce(p.np, 0) AS np FROM v_score_rows r
        LEFT JOIN (SELECT row_id, count(*) AS nt FROM v_truth GROUP BY row_id) t ON t.row_id = r.row_id
        LEFT JOIN (SELECT row_id, count(*) AS np FROM v_pred GROUP BY row_id) p ON p.row_id = r.row_id),
bins AS (SELECT n FROM range(0, (SELECT greatest(max(nt), max(np)) FROM per) + 1) AS b(n)),
mm AS (SELECT min(proba) AS lo, max(proba) AS hi FROM v_proba),
ch AS (SELECT CASE WHEN hi = lo THEN 0 ELSE least(floor((proba - lo) / (hi - lo) * 50), 49) END AS b, count(*) AS n
       FROM v_proba, mm GROUP BY ALL),
u AS (
  SELECT 'per_label_precision' AS aggregate, CAST(label_idx AS BIGINT) AS k1, CAST(NULL AS BIGINT) AS k2, precision AS value FROM v_per_label
  UNION ALL SELECT 'per_label_recall', label_idx, NULL, recall FROM v_per_label
  UNION ALL SELECT 'per_label_f1', label_idx, NULL, f1 FROM v_per_label
  UNION ALL SELECT 'per_label_hamming', label_idx, NULL, hamming FROM v_per_label
  UNION ALL SELECT 'true_count', label_idx, NULL, tp + fn FROM v_counts
  UNION ALL SELECT 'pred_count', label_idx, NULL, tp + fp FROM v_counts
  UNION ALL SELECT 'cooccurrence', g.i, g.j, coalesce(co.n, 0) FROM grid g LEFT JOIN co ON co.i = g.i AND co.j = g.j
  UNION ALL SELECT 'confusion_patterns', g.i, g.j, coalesce(cp.n, 0) FROM grid g LEFT JOIN cp ON cp.i = g.i AND cp.j = g.j
  UNION ALL SELECT 'rows_by_true_count', n, NULL, (SELECT count(*) FROM per WHERE nt = bins.n) FROM bins
  UNION ALL SELECT 'rows_by_pred_count', n, NULL, (SELECT count(*) FROM per WHERE np = bins.n) FROM bins
  UNION ALL SELECT 'confidence_hist', CAST(b AS BIGINT), NULL, n FROM ch
  UNION ALL SELECT 'sensitivity_f1', j, NULL, f1 FROM v_sens
  UNION ALL SELECT 'sensitivity_precision', j, NULL, precision FROM v_sens
  UNION ALL SELECT 'sensitivity_recall', j, NULL, recall FROM v_sens
  UNION ALL SELECT 'macro', 0, NULL, avg(precision) FROM v_per_label
  UNION ALL SELECT 'macro', 1, NULL, avg(recall) FROM v_per_label
  UNION ALL SELECT 'macro', 2, NULL, avg(f1) FROM v_per_label
  UNION ALL SELECT 'confidence', 0, NULL, avg(proba) FROM v_proba
  UNION ALL SELECT 'confidence', 1, NULL, quantile_cont(proba, 0.5) FROM v_proba)
SELECT aggregate, k1, k2, round(CAST(value AS DOUBLE), 6) AS value FROM u
""",
)

from tagwise.operators.text import WS_RUN_PATTERN  # noqa: E402

oracle(
    "char_ngrams",
    f"""
WITH t AS (SELECT row_id, regexp_replace(lower(coalesce(description, '')), '{WS_RUN_PATTERN}', ' ', 'g') AS s FROM v_train_docs),
g AS (SELECT row_id, unnest(CASE WHEN length(s) >= 3 THEN list_transform(range(1, length(s) - 1), lambda i: substr(s, i, 3))
                               ELSE []::VARCHAR[] END) AS term FROM t),
tc AS (SELECT row_id, term, count(*) AS tf FROM g GROUP BY row_id, term),
cv AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ttf FROM tc GROUP BY term
       HAVING count(*) >= 3 AND count(*) <= 0.7e0 * (SELECT n FROM v_n_train)
       ORDER BY ttf DESC, term ASC LIMIT 10000)
SELECT 'w:' || term AS term, df, ttf FROM v_vocab
UNION ALL SELECT 'c:' || term AS term, df, ttf FROM cv
""",
)

"""DuckDB versions of the views and of the fitted-state chain, as named CTEs.

These are the oracle's independent statement of each operator's semantics (same parameters as the
Spark defaults in ``PipelineParams``). Used only by ``oracle_sql()``.
"""

from __future__ import annotations

from tagwise.functions.exprs import STRIP_PATTERN, TOKEN_PATTERN
from tagwise.functions.stopwords import token_stop_words
from tagwise.plans.sqlkit import CteSet, dbl, sql_list
from tagwise.sources.tables import N_SCORE_LABELS, THRESHOLD_FIXTURE

# Defaults mirrored from PipelineParams / VectorizerParams.
MAX_FEATURES = 10000
NGRAM = (1, 3)
MIN_DF = 3
MAX_DF = 0.7
K_FEATURES = 4500
MIN_PCT = 5.0
ALPHA = 1.0
THRESHOLD = 0.55
TOP_K = 3
SPLIT_CUT = 858993459  # int(0.2 * 2**32)

STRIP = STRIP_PATTERN
STOP = sql_list(token_stop_words())


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '{STRIP}', '', 'g')"


def split_hash_sql(x: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5(concat(CAST({x} AS VARCHAR), ':{seed}')), 1, 8))::BIGINT"


def ngram_sql(toks: str, lo: int, hi: int) -> str:
    parts = []
    for n in range(lo, hi + 1):
        if n == 1:
            parts.append(toks)
        else:
            parts.append(
                f"(CASE WHEN len({toks}) >= {n} THEN list_transform(range(1, len({toks}) - {n - 2}), "
                f"lambda i: array_to_string({toks}[i:i + {n - 1}], ' ')) ELSE []::VARCHAR[] END)"
            )
    return " || ".join(parts)


def tokens_sql(text: str) -> str:
    return (
        f"list_filter(regexp_extract_all(lower(coalesce({text}, '')), '{TOKEN_PATTERN}'), "
        f"lambda t: NOT list_contains({STOP}, t))"
    )


C = CteSet()

# ---- views over the driver tables (FIXTURES.md part B)
C.add(
    "v_movies",
    """
select d.doc_id as row_id,
 case when d.doc_id % 83 = 0 then null else d.text end as movie_name,
 case when d.doc_id % 97 = 0 then null else d.text end as description,
 case when d.doc_id % 89 = 0 then null else concat(concat_ws(' ,',
   case when d.lang <> 'en' then d.lang end, d.source,
   case when l.quality = 1 then 'quality' end,
   case when l.toxic = 1 then 'toxic' end, concat(' ', d.source)), ', ') end as genre
from documents d left join labels l on d.doc_id = l.doc_id
""",
)
C.add("v_titles", "SELECT p_partkey AS row_id, p_name AS movie_name FROM part")
C.add(
    "v_scores",
    f"""
SELECT vec_id AS row_id, CAST(i - 1 AS INTEGER) AS label_idx, CAST(embedding[i] AS DOUBLE) * 10 AS score
FROM embeddings, range(1, {N_SCORE_LABELS + 1}) AS r(i)
""",
)
C.add(
    "v_truth",
    """
SELECT DISTINCT row_id, label_idx FROM (
  SELECT vec_id AS row_id, CAST(label AS INTEGER) AS label_idx FROM embeddings
  UNION ALL
  SELECT vec_id AS row_id, CAST((label + vec_id) % 64 AS INTEGER) AS label_idx FROM embeddings)
""",
)
C.add("v_score_rows", "SELECT vec_id AS row_id FROM embeddings")
C.add(
    "v_label_names",
    f"SELECT CAST(i AS INTEGER) AS label_idx, 'L' || CAST(i AS VARCHAR) AS label FROM range(0, {N_SCORE_LABELS}) AS r(i)",
)
C.add(
    "v_thresholds",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{lab}', {dbl(t)})" for lab, t in THRESHOLD_FIXTURE)
    + ") AS t(label, threshold)",
)
C.add("v_proba", "SELECT row_id, label_idx, score, 1.0::DOUBLE / (1.0::DOUBLE + exp(-score)) AS proba FROM v_scores")
C.add("v_true_class", "SELECT vec_id AS row_id, CAST(label AS INTEGER) AS true_idx FROM embeddings")
C.add(
    "v_pred_class",
    """
SELECT vec_id AS row_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS pred_idx
FROM embeddings
""",
)
C.add(
    "v_requests",
    "SELECT doc_id AS row_id, CASE WHEN doc_id % 50 = 0 THEN '' ELSE text END AS description FROM documents",
)
C.add(
    "v_candidates",
    """
SELECT event_type AS candidate, CAST(user_id % 5 AS INTEGER) AS fold,
       avg(value) / 500 AS val_score, max(value) / 1000 AS train_score
FROM events GROUP BY event_type, user_id % 5
""",
)
C.add(
    "v_runs",
    "SELECT o_orderkey AS run_id, o_totalprice AS metric, o_orderstatus AS tag, o_orderdate AS created_at FROM orders",
)

# ---- cleaning, labels, split
C.add(
    "v_clean",
    f"""
SELECT row_id,
  regexp_replace(regexp_replace({strip_sql('movie_name')}, '[ -]+', '_', 'g'), '[^a-z0-9_]', '', 'g') AS movie_name,
  description, genre
FROM (SELECT m.*, row_number() OVER (PARTITION BY movie_name ORDER BY row_id) AS rn
      FROM v_movies m WHERE movie_name IS NOT NULL) t
WHERE rn = 1
""",
)
LABELS_SQL = (
    "list_sort(list_distinct(list_filter(list_transform(string_split(coalesce(genre, ''), ','), "
    f"lambda x: {strip_sql('x')}), lambda x: x <> '')))"
)
C.add("v_parsed_all", f"SELECT row_id, genre, {LABELS_SQL} AS labels FROM v_movies")
C.add(
    "v_corpus",
    f"SELECT row_id, movie_name, coalesce(description, '') AS description, genre, {LABELS_SQL} AS labels FROM v_clean",
)
C.add(
    "v_split",
    f"SELECT *, {split_hash_sql('row_id')} < {SPLIT_CUT} AS is_test FROM v_corpus",
)
C.add("v_train_parsed", "SELECT * FROM v_split WHERE NOT is_test")
C.add("v_test_parsed", "SELECT * FROM v_split WHERE is_test")

# label fit on the training rows
C.add("v_tr_pairs", "SELECT row_id, unnest(labels) AS label FROM v_train_parsed")
C.add(
    "v_tr_freq",
    """
SELECT label, count(*) AS n,
       CAST(count(*) AS DOUBLE) * 100.0::DOUBLE / CAST((SELECT count(*) FROM v_train_parsed) AS DOUBLE) AS pct
FROM v_tr_pairs GROUP BY label
""",
)
C.add(
    "v_label_index",
    f"SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_idx, label FROM v_tr_freq WHERE pct >= {dbl(MIN_PCT)}",
)
C.add("v_tr_y", "SELECT p.row_id, li.label_idx FROM v_tr_pairs p JOIN v_label_index li ON p.label = li.label")
C.add(
    "v_train_docs",
    "SELECT row_id, description FROM v_train_parsed WHERE row_id IN (SELECT row_id FROM v_tr_y)",
)
C.add("v_n_train", "SELECT count(*) AS n FROM v_train_docs")

# vocabulary + idf on training documents
C.add(
    "v_tr_terms",
    f"""
SELECT row_id, unnest({ngram_sql('toks', *NGRAM)}) AS term
FROM (SELECT row_id, {tokens_sql('description')} AS toks FROM v_train_docs) t
""",
)
C.add("v_tr_tc", "SELECT row_id, term, count(*) AS tf FROM v_tr_terms GROUP BY row_id, term")
C.add(
    "v_vocab_kept",
    f"""
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ttf FROM v_tr_tc GROUP BY term
HAVING count(*) >= {MIN_DF} AND count(*) <= {dbl(MAX_DF)} * (SELECT n FROM v_n_train)
ORDER BY ttf DESC, term ASC LIMIT {MAX_FEATURES}
""",
)
C.add(
    "v_vocab",
    """
SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS feat_idx, df, ttf,
       ln((1 + (SELECT n FROM v_n_train)) / (1.0::DOUBLE + df)) + 1.0::DOUBLE AS idf
FROM v_vocab_kept
""",
)


def tfidf_cte(name: str, docs: str) -> None:
    """Long normalised tf-idf rows for the documents of CTE ``docs`` (row_id, description)."""
    C.add(
        f"{name}_terms",
        f"""
SELECT row_id, unnest({ngram_sql('toks', *NGRAM)}) AS term
FROM (SELECT row_id, {tokens_sql('description')} AS toks FROM {docs}) t
""",
    )
    C.add(
        f"{name}_w",
        f"""
SELECT t.row_id, v.feat_idx, (1.0::DOUBLE + ln(count(*))) * v.idf AS w
FROM {name}_terms t JOIN v_vocab v ON t.term = v.term
GROUP BY t.row_id, v.feat_idx, v.idf
""",
    )
    C.add(
        name,
        f"""
SELECT row_id, feat_idx, coalesce(w / sqrt(sum(w * w) OVER (PARTITION BY row_id)), 0.0) AS value FROM {name}_w
""",
    )


tfidf_cte("v_tr_x", "v_train_docs")

# chi2 scores + k best on the training rows
C.add("v_tr_pos", "SELECT label_idx, count(*) AS n_pos FROM v_tr_y GROUP BY label_idx")
C.add("v_n_labels", "SELECT count(*) AS l FROM v_label_index")
C.add(
    "v_tr_obs",
    """
SELECT x.feat_idx, y.label_idx, sum(x.value) AS obs, count(*) AS n11
FROM v_tr_x x JOIN v_tr_y y ON x.row_id = y.row_id GROUP BY x.feat_idx, y.label_idx
""",
)
C.add(
    "v_tr_grid",
    """
SELECT f.feat_idx, li.label_idx, f.fc, f.n1, coalesce(o.obs, 0.0) AS obs, coalesce(o.n11, 0) AS n11,
       coalesce(p.n_pos, 0) AS n_pos
FROM (SELECT feat_idx, sum(value) AS fc, count(*) AS n1 FROM v_tr_x GROUP BY feat_idx) f
CROSS JOIN v_label_index li
LEFT JOIN v_tr_obs o ON o.feat_idx = f.feat_idx AND o.label_idx = li.label_idx
LEFT JOIN v_tr_pos p ON p.label_idx = li.label_idx
""",
)
C.add(
    "v_chi2",
    """
SELECT feat_idx, sum(CASE WHEN e = 0 THEN NULL ELSE (obs - e) * (obs - e) / e END) AS score
FROM (SELECT feat_idx, obs, CAST(n_pos AS DOUBLE) / CAST((SELECT n FROM v_n_train) AS DOUBLE) * fc AS e FROM v_tr_grid) g
GROUP BY feat_idx
""",
)
C.add(
    "v_selected",
    f"""
SELECT feat_idx, CAST(row_number() OVER (ORDER BY feat_idx) - 1 AS INTEGER) AS sel_idx, score
FROM (SELECT * FROM v_chi2 ORDER BY round(score, 9) DESC NULLS LAST, feat_idx DESC LIMIT {K_FEATURES}) t
""",
)
C.add(
    "v_tr_xs",
    "SELECT x.row_id, s.sel_idx AS feat_idx, x.value FROM v_tr_x x JOIN v_selected s ON x.feat_idx = s.feat_idx",
)

# naive Bayes (uniform prior) coefficients on the selected features
C.add(
    "v_nb_grid",
    """
SELECT f.feat_idx, li.label_idx, f.fc, coalesce(o.obs, 0.0) AS n1c, f.fc - coalesce(o.obs, 0.0) AS n0c
FROM (SELECT feat_idx, sum(value) AS fc FROM v_tr_xs GROUP BY feat_idx) f
CROSS JOIN v_label_index li
LEFT JOIN (SELECT x.feat_idx, y.label_idx, sum(x.value) AS obs FROM v_tr_xs x JOIN v_tr_y y ON x.row_id = y.row_id
           GROUP BY x.feat_idx, y.label_idx) o ON o.feat_idx = f.feat_idx AND o.label_idx = li.label_idx
""",
)
C.add(
    "v_nb_coef",
    f"""
SELECT g.feat_idx, g.label_idx,
  ln((g.n1c + {dbl(ALPHA)}) / (t.N1 + {dbl(ALPHA)} * (SELECT count(*) FROM v_selected)))
  - ln((g.n0c + {dbl(ALPHA)}) / (t.N0 + {dbl(ALPHA)} * (SELECT count(*) FROM v_selected))) AS w
FROM v_nb_grid g JOIN (SELECT label_idx, sum(n1c) AS N1, sum(n0c) AS N0 FROM v_nb_grid GROUP BY label_idx) t
  ON g.label_idx = t.label_idx
""",
)

# test rows: features, scores, decisions
C.add("v_test_docs", "SELECT row_id, description FROM v_test_parsed")
tfidf_cte("v_te_x0", "v_test_docs")
C.add(
    "v_te_x",
    "SELECT x.row_id, s.sel_idx AS feat_idx, x.value FROM v_te_x0 x JOIN v_selected s ON x.feat_idx = s.feat_idx",
)
C.add(
    "v_te_scores",
    """
SELECT r.row_id, li.label_idx, coalesce(s.score, 0.0) AS score,
       1.0::DOUBLE / (1.0::DOUBLE + exp(-coalesce(s.score, 0.0))) AS proba
FROM v_test_docs r CROSS JOIN v_label_index li
LEFT JOIN (SELECT x.row_id, c.label_idx, sum(x.value * c.w) AS score FROM v_te_x x JOIN v_nb_coef c ON x.feat_idx = c.feat_idx
           GROUP BY x.row_id, c.label_idx) s ON s.row_id = r.row_id AND s.label_idx = li.label_idx
""",
)
C.add(
    "v_te_chosen",
    f"""
SELECT row_id, label_idx, proba FROM (
  SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY round(proba, 12) DESC, label_idx DESC) AS rk
  FROM v_te_scores WHERE proba >= {dbl(THRESHOLD)}) t
WHERE rk <= {TOP_K}
""",
)
C.add(
    "v_te_pred",
    """
SELECT r.row_id, coalesce(p.labels, []::VARCHAR[]) AS labels
FROM v_test_docs r LEFT JOIN (
  SELECT c.row_id, list(li.label ORDER BY c.label_idx) AS labels
  FROM v_te_chosen c JOIN v_label_index li ON c.label_idx = li.label_idx GROUP BY c.row_id) p
ON r.row_id = p.row_id
""",
)
C.add("v_te_truth", "SELECT p.row_id, li.label_idx FROM (SELECT row_id, unnest(labels) AS label FROM v_test_parsed) p JOIN v_label_index li ON p.label = li.label")


# ---- helpers for metric SQL
def sdiv(a: str, b: str) -> str:
    """a / b as DOUBLE, 0 when b = 0."""
    return f"(CASE WHEN ({b}) = 0 THEN 0.0::DOUBLE ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


def f1_sql(tp: str, fp: str, fn: str) -> str:
    return sdiv(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}")


def r6(x: str) -> str:
    return f"round({x}, 6)"


SCORE_THRESHOLD = 0.55
SENSITIVITY_GRID = [0.1 + 0.05 * i for i in range(17)]
SWEEP_GRID = [0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


def grid_list(grid) -> str:
    return "[" + ", ".join(dbl(t) for t in grid) + "]"


C.add("v_pred", f"SELECT row_id, label_idx FROM v_proba WHERE proba >= {dbl(SCORE_THRESHOLD)}")
C.add("v_n_rows", "SELECT count(*) AS n FROM v_score_rows")
C.add(
    "v_flags",
    """
SELECT row_id, label_idx, max(t) AS t, max(p) AS p FROM (
  SELECT row_id, label_idx, 1 AS t, 0 AS p FROM v_truth
  UNION ALL SELECT row_id, label_idx, 0 AS t, 1 AS p FROM v_pred) u
GROUP BY row_id, label_idx
""",
)
C.add(
    "v_counts",
    """
SELECT n.label_idx,
  CAST(coalesce(sum(f.t * f.p), 0) AS BIGINT) AS tp,
  CAST(coalesce(sum((1 - f.t) * f.p), 0) AS BIGINT) AS fp,
  CAST(coalesce(sum(f.t * (1 - f.p)), 0) AS BIGINT) AS fn
FROM v_label_names n LEFT JOIN v_flags f ON f.label_idx = n.label_idx
GROUP BY n.label_idx
""",
)
C.add(
    "v_per_label",
    f"""
SELECT label_idx, tp, fp, fn, tp + fn AS support,
  {sdiv('tp', 'tp + fp')} AS precision, {sdiv('tp', 'tp + fn')} AS recall,
  {f1_sql('tp', 'fp', 'fn')} AS f1, {sdiv('tp', 'tp + fp + fn')} AS jaccard,
  {sdiv('fp + fn', '(SELECT n FROM v_n_rows)')} AS hamming
FROM v_counts
""",
)
C.add(
    "v_micro",
    f"""
SELECT tp, fp, fn, {sdiv('tp', 'tp + fp')} AS precision, {sdiv('tp', 'tp + fn')} AS recall,
  {f1_sql('tp', 'fp', 'fn')} AS f1, {sdiv('tp', 'tp + fp + fn')} AS jaccard,
  {sdiv('fp + fn', f'(SELECT n FROM v_n_rows) * {N_SCORE_LABELS}')} AS hamming_loss
FROM (SELECT CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM v_counts) s
""",
)
C.add(
    "v_sc_chosen",
    f"""
SELECT row_id, label_idx, proba FROM (
  SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY round(proba, 12) DESC, label_idx DESC) AS rk
  FROM v_proba WHERE proba >= {dbl(SCORE_THRESHOLD)}) t
WHERE rk <= 3
""",
)
C.add(
    "v_sc_decoded",
    """
SELECT r.row_id, coalesce(d.labels, []::VARCHAR[]) AS labels FROM v_score_rows r LEFT JOIN (
  SELECT c.row_id, list(n.label ORDER BY c.label_idx) AS labels
  FROM v_sc_chosen c JOIN v_label_names n ON n.label_idx = c.label_idx GROUP BY c.row_id) d ON d.row_id = r.row_id
""",
)
C.add(
    "v_lab",
    """
SELECT p.row_id, p.label_idx, p.proba, CASE WHEN t.row_id IS NULL THEN 0 ELSE 1 END AS t
FROM v_proba p LEFT JOIN v_truth t ON t.row_id = p.row_id AND t.label_idx = p.label_idx
""",
)


def grid_ctes(prefix: str, grid) -> None:
    g = grid_list(grid)
    C.add(
        f"{prefix}_b",
        f"""
SELECT label_idx, len(list_filter({g}, lambda x: x <= proba)) AS b, sum(t) AS pos, sum(1 - t) AS neg
FROM v_lab GROUP BY label_idx, len(list_filter({g}, lambda x: x <= proba))
""",
    )
    C.add(
        f"{prefix}_pred",
        f"""
SELECT label_idx, j, sum(pos) AS tp, sum(neg) AS fp FROM (
  SELECT label_idx, pos, neg, unnest(range(0, b)) AS j FROM {prefix}_b) s
GROUP BY label_idx, j
""",
    )
    C.add(
        f"{prefix}_counts",
        f"""
SELECT n.label_idx, g.j, g.threshold,
  CAST(coalesce(p.tp, 0) AS BIGINT) AS tp, CAST(coalesce(p.fp, 0) AS BIGINT) AS fp,
  CAST(coalesce(tt.P, 0) - coalesce(p.tp, 0) AS BIGINT) AS fn, CAST(coalesce(tt.P, 0) AS BIGINT) AS n_pos
FROM v_label_names n
CROSS JOIN (SELECT CAST(i - 1 AS INTEGER) AS j, {g}[i] AS threshold FROM range(1, {len(grid) + 1}) r(i)) g
LEFT JOIN {prefix}_pred p ON p.label_idx = n.label_idx AND p.j = g.j
LEFT JOIN (SELECT label_idx, sum(pos) AS P FROM {prefix}_b GROUP BY label_idx) tt ON tt.label_idx = n.label_idx
""",
    )


grid_ctes("v_gs", SENSITIVITY_GRID)
grid_ctes("v_gw", SWEEP_GRID)
C.add(
    "v_sens",
    f"""
SELECT j, threshold, avg({sdiv('tp', 'tp + fp')}) AS precision, avg({sdiv('tp', 'tp + fn')}) AS recall,
       avg({f1_sql('tp', 'fp', 'fn')}) AS f1
FROM v_gs_counts GROUP BY j, threshold
""",
)
C.add(
    "v_tuned",
    f"""
SELECT t.label_idx, n.label,
  CASE WHEN n_pos > 0 AND score > 0 THEN threshold ELSE 0.5::DOUBLE END AS threshold,
  CASE WHEN n_pos > 0 AND score > 0 THEN score ELSE 0.0::DOUBLE END AS score
FROM (SELECT *, row_number() OVER (PARTITION BY label_idx ORDER BY round(score, 12) DESC, j ASC) AS rk
      FROM (SELECT label_idx, j, threshold, n_pos, {f1_sql('tp', 'fp', 'fn')} AS score FROM v_gs_counts) s) t
JOIN v_label_names n ON n.label_idx = t.label_idx
WHERE rk = 1
""",
)
C.add(
    "v_pl_pred",
    f"""
SELECT p.row_id, p.label_idx FROM v_proba p JOIN v_label_names n ON n.label_idx = p.label_idx
LEFT JOIN v_tuned t ON t.label = n.label
WHERE p.proba >= coalesce(t.threshold, {dbl(SCORE_THRESHOLD)})
""",
)
C.add(
    "v_pl_micro",
    f"""
SELECT {sdiv('tp', 'tp + fp')} AS precision, {sdiv('tp', 'tp + fn')} AS recall,
  {f1_sql('tp', 'fp', 'fn')} AS f1, {sdiv('tp', 'tp + fp + fn')} AS jaccard,
  {sdiv('fp + fn', f'(SELECT n FROM v_n_rows) * {N_SCORE_LABELS}')} AS hamming_loss
FROM (SELECT CAST(sum(t * p) AS BIGINT) AS tp, CAST(sum((1 - t) * p) AS BIGINT) AS fp, CAST(sum(t * (1 - p)) AS BIGINT) AS fn
      FROM (SELECT row_id, label_idx, max(t) AS t, max(p) AS p FROM (
              SELECT row_id, label_idx, 1 AS t, 0 AS p FROM v_truth
              UNION ALL SELECT row_id, label_idx, 0 AS t, 1 AS p FROM v_pl_pred) u GROUP BY row_id, label_idx) f) s
""",
)


# ---- all-movie label keys
C.add("v_all_pairs", "SELECT row_id, unnest(labels) AS label FROM v_parsed_all")
C.add(
    "v_all_freq",
    """
SELECT label, count(*) AS n,
       CAST(count(*) AS DOUBLE) * 100.0::DOUBLE / CAST((SELECT count(*) FROM v_parsed_all) AS DOUBLE) AS pct
FROM v_all_pairs GROUP BY label
""",
)
C.add(
    "v_all_index",
    f"SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_idx, label FROM v_all_freq WHERE pct >= {dbl(MIN_PCT)}",
)
C.add(
    "v_all_kept",
    """
SELECT r.row_id, coalesce(k.labels, []::VARCHAR[]) AS labels FROM v_parsed_all r LEFT JOIN (
  SELECT p.row_id, list(p.label ORDER BY p.label) AS labels FROM v_all_pairs p JOIN v_all_index i ON i.label = p.label
  GROUP BY p.row_id) k ON k.row_id = r.row_id
""",
)

# ---- mutual information (presence buckets) on the training tf-idf
def _mi_cell(nab: str, na: str, nb: str) -> str:
    n = "CAST((SELECT n FROM v_n_train) AS DOUBLE)"
    return (
        f"(CASE WHEN ({nab}) > 0 THEN CAST({nab} AS DOUBLE) / {n} * "
        f"ln(CAST({nab} AS DOUBLE) * {n} / (CAST({na} AS DOUBLE) * CAST({nb} AS DOUBLE))) ELSE 0.0::DOUBLE END)"
    )


_N = "(SELECT n FROM v_n_train)"
C.add(
    "v_mi",
    f"""
SELECT feat_idx, sum(
  {_mi_cell('n11', 'n1', 'n_pos')} + {_mi_cell('n1 - n11', 'n1', f'{_N} - n_pos')}
  + {_mi_cell('n_pos - n11', f'{_N} - n1', 'n_pos')} + {_mi_cell(f'{_N} - n1 - n_pos + n11', f'{_N} - n1', f'{_N} - n_pos')}
) / CAST((SELECT count(*) FROM v_label_index) AS DOUBLE) AS score
FROM v_tr_grid GROUP BY feat_idx
""",
)


# ---- scoring arbitrary request rows with the NB model (streaming keys)
C.add(
    "v_req_checked",
    """
SELECT row_id, description, CASE WHEN description IS NULL OR length(description) < 1 THEN 'too_short'
                                 WHEN length(description) > 10000 THEN 'too_long' END AS reason
FROM v_requests
""",
)
C.add("v_req_valid", "SELECT row_id, description FROM v_req_checked WHERE reason IS NULL")
tfidf_cte("v_rq_x0", "v_req_valid")
C.add(
    "v_rq_x",
    "SELECT x.row_id, s.sel_idx AS feat_idx, x.value FROM v_rq_x0 x JOIN v_selected s ON x.feat_idx = s.feat_idx",
)
C.add(
    "v_rq_scores",
    """
SELECT r.row_id, li.label_idx, 1.0::DOUBLE / (1.0::DOUBLE + exp(-coalesce(s.score, 0.0))) AS proba
FROM v_req_valid r CROSS JOIN v_label_index li
LEFT JOIN (SELECT x.row_id, c.label_idx, sum(x.value * c.w) AS score FROM v_rq_x x JOIN v_nb_coef c ON x.feat_idx = c.feat_idx
           GROUP BY x.row_id, c.label_idx) s ON s.row_id = r.row_id AND s.label_idx = li.label_idx
""",
)
C.add(
    "v_rq_pred",
    f"""
SELECT r.row_id, coalesce(p.labels, []::VARCHAR[]) AS labels FROM v_req_valid r LEFT JOIN (
  SELECT c.row_id, list(li.label ORDER BY c.label_idx) AS labels FROM (
    SELECT row_id, label_idx FROM (
      SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY round(proba, 12) DESC, label_idx DESC) AS rk
      FROM v_rq_scores WHERE proba >= {dbl(THRESHOLD)}) t WHERE rk <= {TOP_K}) c
  JOIN v_label_index li ON li.label_idx = c.label_idx GROUP BY c.row_id) p ON p.row_id = r.row_id
""",
)


# ---- naive Bayes k-fold curves
def nb_cv_ctes(prefix: str, alphas, k: int = 5) -> None:
    al = "[" + ", ".join(dbl(a) for a in alphas) + "]"
    C.add(f"{prefix}_folds", f"SELECT row_id, CAST({split_hash_sql('row_id')} % {k} AS INTEGER) AS g FROM v_train_docs")
    C.add(f"{prefix}_x", f"SELECT x.row_id, x.feat_idx, x.value, f.g FROM v_tr_xs x JOIN {prefix}_folds f ON f.row_id = x.row_id")
    C.add(f"{prefix}_hs", f"SELECT CAST(h AS INTEGER) AS h FROM range(0, {k}) r(h)")
    C.add(
        f"{prefix}_obs",
        f"""
SELECT hs.h, o.feat_idx, o.label_idx, sum(o.obs) AS obs FROM (
  SELECT x.g, x.feat_idx, y.label_idx, sum(x.value) AS obs FROM {prefix}_x x JOIN v_tr_y y ON y.row_id = x.row_id
  GROUP BY x.g, x.feat_idx, y.label_idx) o JOIN {prefix}_hs hs ON hs.h <> o.g
GROUP BY hs.h, o.feat_idx, o.label_idx
""",
    )
    C.add(
        f"{prefix}_fc",
        f"""
SELECT hs.h, s.sel_idx AS feat_idx, coalesce(sum(c.fc), 0.0) AS fc FROM v_selected s CROSS JOIN {prefix}_hs hs
LEFT JOIN (SELECT g, feat_idx, sum(value) AS fc FROM {prefix}_x GROUP BY g, feat_idx) c ON c.feat_idx = s.sel_idx AND c.g <> hs.h
GROUP BY hs.h, s.sel_idx
""",
    )
    C.add(
        f"{prefix}_grid",
        f"""
SELECT f.h, f.feat_idx, li.label_idx, coalesce(o.obs, 0.0) AS n1c, f.fc - coalesce(o.obs, 0.0) AS n0c
FROM {prefix}_fc f CROSS JOIN v_label_index li
LEFT JOIN {prefix}_obs o ON o.h = f.h AND o.feat_idx = f.feat_idx AND o.label_idx = li.label_idx
""",
    )
    C.add(
        f"{prefix}_coef",
        f"""
SELECT CAST(c.i - 1 AS INTEGER) AS cand, g.h, g.feat_idx, g.label_idx,
  ln((g.n1c + {al}[c.i]) / (t.N1 + {al}[c.i] * (SELECT count(*) FROM v_selected)))
  - ln((g.n0c + {al}[c.i]) / (t.N0 + {al}[c.i] * (SELECT count(*) FROM v_selected))) AS w
FROM {prefix}_grid g JOIN (SELECT h, label_idx, sum(n1c) AS N1, sum(n0c) AS N0 FROM {prefix}_grid GROUP BY h, label_idx) t
  ON t.h = g.h AND t.label_idx = g.label_idx
CROSS JOIN range(1, {len(alphas) + 1}) c(i)
""",
    )
    C.add(
        f"{prefix}_pc",
        f"""
SELECT s.cand, s.h, CASE WHEN s.g = s.h THEN 'validation' ELSE 'train' END AS split, count(*) AS n_pred,
       sum(CASE WHEN y.row_id IS NULL THEN 0 ELSE 1 END) AS tp
FROM (SELECT c.cand, c.h, x.row_id, x.g, c.label_idx, sum(x.value * c.w) AS score
      FROM {prefix}_x x JOIN {prefix}_coef c ON c.feat_idx = x.feat_idx
      GROUP BY c.cand, c.h, x.row_id, x.g, c.label_idx) s
LEFT JOIN v_tr_y y ON y.row_id = s.row_id AND y.label_idx = s.label_idx
WHERE s.score > 0
GROUP BY s.cand, s.h, CASE WHEN s.g = s.h THEN 'validation' ELSE 'train' END
""",
    )
    C.add(
        f"{prefix}_tt",
        f"""
SELECT hs.h, CASE WHEN t.g = hs.h THEN 'validation' ELSE 'train' END AS split, sum(t.n_true) AS n_true
FROM (SELECT f.g, count(*) AS n_true FROM v_tr_y y JOIN {prefix}_folds f ON f.row_id = y.row_id GROUP BY f.g) t
CROSS JOIN {prefix}_hs hs GROUP BY hs.h, CASE WHEN t.g = hs.h THEN 'validation' ELSE 'train' END
""",
    )
    C.add(
        f"{prefix}_f1",
        f"""
SELECT CAST(c.i - 1 AS INTEGER) AS cand, {al}[c.i] AS alpha, tt.h AS fold, tt.split,
  {sdiv('2 * coalesce(pc.tp, 0)', '2 * coalesce(pc.tp, 0) + (coalesce(pc.n_pred, 0) - coalesce(pc.tp, 0)) + (tt.n_true - coalesce(pc.tp, 0))')} AS f1
FROM {prefix}_tt tt CROSS JOIN range(1, {len(alphas) + 1}) c(i)
LEFT JOIN {prefix}_pc pc ON pc.cand = c.i - 1 AND pc.h = tt.h AND pc.split = tt.split
""",
    )
    C.add(
        f"{prefix}_curve",
        f"""
SELECT cand, alpha,
  avg(f1) FILTER (WHERE split = 'train') AS train_mean, stddev_pop(f1) FILTER (WHERE split = 'train') AS train_std,
  avg(f1) FILTER (WHERE split = 'validation') AS val_mean, stddev_pop(f1) FILTER (WHERE split = 'validation') AS val_std
FROM {prefix}_f1 GROUP BY cand, alpha
""",
    )


import numpy as _np  # noqa: E402

nb_cv_ctes("v_nbg", [float(a) for a in _np.linspace(0.04, 0.02, 10)])
nb_cv_ctes("v_nbc", [float(a) for a in _np.logspace(-3, 1, 20)])


# ---- held-out evaluation of the NB pipeline (no top-k: thresholded predictions)
# rows without a known label are dropped before scoring
C.add("v_te_rows", "SELECT DISTINCT row_id FROM v_te_truth")
C.add(
    "v_te_eval_flags",
    f"""
SELECT row_id, label_idx, max(t) AS t, max(p) AS p FROM (
  SELECT row_id, label_idx, 1 AS t, 0 AS p FROM v_te_truth
  UNION ALL SELECT row_id, label_idx, 0 AS t, 1 AS p FROM v_te_scores
  WHERE proba >= {dbl(THRESHOLD)} AND row_id IN (SELECT row_id FROM v_te_rows)) u
GROUP BY row_id, label_idx
""",
)
C.add(
    "v_te_micro",
    f"""
SELECT {sdiv('tp', 'tp + fp')} AS precision, {sdiv('tp', 'tp + fn')} AS recall, {f1_sql('tp', 'fp', 'fn')} AS f1,
  {sdiv('tp', 'tp + fp + fn')} AS jaccard,
  {sdiv('fp + fn', '(SELECT count(*) FROM v_te_rows) * (SELECT count(*) FROM v_label_index)')} AS hamming_loss
FROM (SELECT CAST(sum(t * p) AS BIGINT) AS tp, CAST(sum((1 - t) * p) AS BIGINT) AS fp, CAST(sum(t * (1 - p)) AS BIGINT) AS fn
      FROM v_te_eval_flags) s
""",
)

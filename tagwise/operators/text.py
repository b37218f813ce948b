"""Word n-gram TF-IDF (T1-T11): fit gives a vocabulary state table, transform gives long
``(row_id, feat_idx, value)`` rows; nothing is ever densified.

Physical plan (see README "Scale notes"): a document is one row of words. Capped vocabularies are counted by ``frequent``,
which sums only n-grams that can reach the cap; without a cap every n-gram is counted per document and term, then per term.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyspark.ml.feature import NGram, RegexTokenizer, StopWordsRemover

from tagwise.functions.exprs import TOKEN_GAP_PATTERN, tokens  # noqa: F401
from tagwise.functions.stopwords import token_stop_words
from tagwise.operators import frequent
from tagwise.operators.indexing import WINDOW_LIMIT, dense_index
from tagwise.plans.broadcast import join_state
from tagwise.session import materialize

VECTORIZER_KEYS = {"max_features", "ngram_range", "min_df", "max_df", "sublinear_tf", "use_idf", "smooth_idf", "stop_words", "norm"}


@dataclass(frozen=True)
class VectorizerParams:
    """Vectorizer parameters (F3). Defaults follow the reference code (see SURVEY D1)."""

    max_features: int | None = 10000
    ngram_range: tuple[int, int] = (1, 3)
    min_df: int | float = 3
    max_df: int | float = 0.7
    sublinear_tf: bool = True
    use_idf: bool = True
    smooth_idf: bool = True
    stop_words: tuple[str, ...] | None = field(default_factory=lambda: tuple(token_stop_words()))
    norm: str | None = "l2"

    @classmethod
    def from_dict(cls, d: dict) -> "VectorizerParams":
        unknown = set(d) - VECTORIZER_KEYS
        if unknown:
            raise ValueError(f"Unknown vectorizer parameter(s): {sorted(unknown)}")
        d = dict(d)
        if d.get("stop_words") == "english":
            d["stop_words"] = tuple(token_stop_words())
        if "ngram_range" in d:
            d["ngram_range"] = tuple(d["ngram_range"])
        return replace(cls(), **d)


def doc_grams(docs: DataFrame, params: VectorizerParams, text_col: str = "description") -> DataFrame:
    """T1-T3 per row: ``(row_id, _toks, _grams)`` — stop-word-filtered tokens and all n-grams in order
    (unigrams, then bigrams, then trigrams ...), over the whole text.

    Tokens come from one built-in regex extraction; stop words and n-grams use Spark ML's
    ``StopWordsRemover`` / ``NGram`` transformers (JVM, hash-set lookup and sliding windows), which are
    several times faster than the equivalent SQL higher-order functions.
    """
    lo, hi = params.ngram_range
    cur = _tokenized(docs.select("row_id", F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_low")), params)
    gram_cols = []
    for n in range(lo, hi + 1):
        if n == 1:
            gram_cols.append(F.col("_toks"))
            continue
        cur = NGram(n=n, inputCol="_toks", outputCol=f"_g{n}").transform(cur)
        gram_cols.append(F.col(f"_g{n}"))
    allg = gram_cols[0] if len(gram_cols) == 1 else F.concat(*gram_cols)
    return cur.select("row_id", "_raw", "_toks", allg.alias("_grams"))


def _tokenized(lowered: DataFrame, params: VectorizerParams) -> DataFrame:
    """``_raw`` tokens and ``_toks`` without stop words of the text ``_low``."""
    # maximal runs of >= 2 word characters == gaps of non-word characters, tokens of length >= 2
    cur = RegexTokenizer(inputCol="_low", outputCol="_raw", pattern=TOKEN_GAP_PATTERN, gaps=True, minTokenLength=2, toLowercase=False).transform(lowered)
    if not params.stop_words:
        return cur.withColumn("_toks", F.col("_raw"))
    return StopWordsRemover(inputCol="_raw", outputCol="_toks", stopWords=list(params.stop_words), caseSensitive=True).transform(cur)


# stands between the texts of rows that share a row_id; no token is equal to it, as texts are lower-cased
TEXT_BREAK = "XX"


def doc_words(docs: DataFrame, params: VectorizerParams, text_col: str = "description") -> DataFrame:
    """``(row_id, words)``, one row per row_id: the tokens that n-grams are made of, in order."""
    texts = F.collect_list(F.lower(F.coalesce(F.col(text_col), F.lit(""))))  # one, but for repeated keys
    lowered = docs.groupBy("row_id").agg(F.array_join(texts, f" {TEXT_BREAK} ").alias("_low"))
    return _tokenized(lowered, params).select("row_id", F.col("_toks").alias("words"))


def counts_by_number(params: VectorizerParams) -> bool:
    """Whether the vocabulary is counted by ``frequent``."""
    return params.max_features is not None and params.ngram_range[0] == 1


def kept_words(docs: DataFrame, params: VectorizerParams, text_col: str = "description") -> DataFrame | None:
    """``doc_words`` written down, for a fit and a transform of the same rows: they read the words three times. None: the
    vocabulary is not counted by them."""
    return materialize(doc_words(docs, params, text_col)) if counts_by_number(params) else None


def doc_terms(docs: DataFrame, params: VectorizerParams, text_col: str = "description") -> DataFrame:
    """(row_id, term) for every n-gram occurrence.

    The outer explode keeps Catalyst from inferring a "size(grams) > 0" filter, which would be pushed below the
    exchange and run the whole tokeniser chain again there; rows without terms drop out by their null term.
    """
    terms = doc_grams(docs, params, text_col).select("row_id", F.explode_outer("_grams").alias("term"))
    return terms.filter(F.col("term").isNotNull())


def by_row(docs: DataFrame) -> DataFrame:
    """Hash-partition documents by row_id once; per-row aggregates downstream then need no further exchange, and AQE
    sizes the partitions by their bytes."""
    return docs.repartition("row_id")


def term_counts(docs: DataFrame, params: VectorizerParams, text_col: str = "description") -> DataFrame:
    """T4: raw term counts per row ``(row_id, term, tf)``."""
    terms = doc_terms(by_row(docs.select("row_id", text_col)), params, text_col)
    return terms.groupBy("row_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def doc_freq(tc: DataFrame) -> DataFrame:
    """T5 input: per term document frequency and total count."""
    return tc.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf"))


def df_bounds(params: VectorizerParams, n_docs: int) -> tuple[float, float]:
    lo = params.min_df if isinstance(params.min_df, int) else params.min_df * n_docs
    hi = params.max_df if isinstance(params.max_df, int) else params.max_df * n_docs
    if hi < lo:
        raise ValueError("max_df corresponds to < documents than min_df")
    return float(lo), float(hi)


def prune_terms(stats: DataFrame, params: VectorizerParams, n_docs: int) -> DataFrame:
    """T5: drop terms with df < min_df or df > max_df (fractions are of the document count)."""
    lo, hi = df_bounds(params, n_docs)
    return stats.filter((F.col("df") >= F.lit(lo)) & (F.col("df") <= F.lit(hi)))


def pruned_terms(docs: DataFrame, params: VectorizerParams, n_docs: int, text_col: str = "description", words: DataFrame | None = None) -> DataFrame:
    """T5 over the rows: ``(term, df, ttf)`` of the terms within the df bounds; with a cap, of those that can reach it."""
    lo, hi = df_bounds(params, n_docs)
    if counts_by_number(params):
        words = doc_words(docs, params, text_col) if words is None else words
        found = frequent.candidate_terms(words, params.ngram_range[1], lo, (lo, hi), params.max_features, TEXT_BREAK)
        if found is not None:
            return prune_terms(found, params, n_docs)
    return prune_terms(doc_freq(term_counts(docs, params, text_col)), params, n_docs)


def cap_terms(kept: DataFrame, max_features: int | None) -> DataFrame:
    """The ``max_features`` most frequent terms; ties at the cut broken by term (TakeOrdered)."""
    if max_features is None:
        return kept
    return kept.orderBy(F.col("ttf").desc(), F.col("term").asc()).limit(max_features)


def idf_expr(n_docs: int, smooth: bool = True):
    """ln((1+n)/(1+df)) + 1 (smoothed) or ln(n/df) + 1."""
    if smooth:
        return F.log(F.lit(float(n_docs + 1)) / (F.col("df") + F.lit(1.0))) + F.lit(1.0)
    return F.log(F.lit(float(n_docs)) / F.col("df")) + F.lit(1.0)


@dataclass
class TfidfState:
    """Fitted vectorizer: vocabulary ``(term, feat_idx, df, idf)`` plus the scalars needed to transform."""

    vocab: DataFrame
    n_docs: int
    n_features: int
    params: VectorizerParams
    lookup: frequent.Lookup | None = field(default=None, repr=False, compare=False)  # the vocabulary as numbers, once it was used


def fit_tfidf(docs: DataFrame, params: VectorizerParams = VectorizerParams(), text_col: str = "description", words: DataFrame | None = None) -> TfidfState:
    """T5/T6/T8 fit on the given (training) rows only. Only the surviving terms are kept, not the counts of all terms in
    the rows; ``words`` are the rows' ``kept_words``, if they are there."""
    n_docs = docs.count()
    kept = cap_terms(pruned_terms(docs, params, n_docs, text_col, words), params.max_features)
    kept = materialize(kept)
    n_feat = kept.count()
    if n_feat == 0:
        raise ValueError("After pruning, no terms remain. Try a lower min_df or a higher max_df.")
    vocab = dense_index(kept, "term", "feat_idx", n_feat)
    vocab = vocab.select("term", "feat_idx", "df", "ttf", idf_expr(n_docs, params.smooth_idf).alias("idf"))
    if n_feat > WINDOW_LIMIT:
        vocab = materialize(vocab)
    return TfidfState(vocab, n_docs, n_feat, params)


def weight_expr(tf_col: str, params: VectorizerParams):
    tf = F.col(tf_col).cast("double")
    w = (F.lit(1.0) + F.log(tf)) if params.sublinear_tf else tf
    return w * F.col("idf") if params.use_idf else w


def l2_normalize(x: DataFrame, value_col: str = "value") -> DataFrame:
    """Divide each row's values by the row's L2 norm; rows of zeros stay zero.

    The window is partitioned by row_id; input coming from ``transform_tfidf`` is already
    partitioned that way, so this adds no exchange.
    """
    w = Window.partitionBy("row_id")
    norm = F.sqrt(F.sum(F.col(value_col) * F.col(value_col)).over(w))
    return x.withColumn(value_col, F.coalesce(F.try_divide(F.col(value_col), norm), F.lit(0.0)))


def known_terms(docs: DataFrame, state: TfidfState, text_col: str = "description", words: DataFrame | None = None) -> DataFrame | None:
    """``(row_id, feat_idx, idf, tf)`` by the vocabulary as numbers; None if it is too large to send to every task."""
    if state.n_features > frequent.MAX_WORDS:
        return None
    if state.lookup is None:
        rows = state.vocab.select("term", "feat_idx", "idf").collect()  # at most MAX_WORDS
        state.lookup = frequent.Lookup([r["term"] for r in rows], [r["feat_idx"] for r in rows], [r["idf"] for r in rows])
    if not state.lookup.fits():
        return None
    words = doc_words(docs, state.params, text_col) if words is None else words
    return frequent.count_known(words, state.lookup, docs.schema["row_id"].dataType.simpleString())


def transform_tfidf(docs: DataFrame, state: TfidfState, text_col: str = "description", words: DataFrame | None = None) -> DataFrame:
    """Long tf-idf rows for any documents; unknown terms are dropped at the vocabulary join,
    before counting, so only in-vocabulary occurrences are aggregated."""
    p = state.params
    counted = known_terms(docs, state, text_col, words)
    if counted is None:
        terms = doc_terms(by_row(docs.select("row_id", text_col)), p, text_col)
        vocab = state.vocab.select("term", "feat_idx", "idf")
        counted = join_state(terms, vocab, "term", state.n_features).groupBy("row_id", "feat_idx", "idf").agg(F.count(F.lit(1)).alias("tf"))
    x = counted.select("row_id", "feat_idx", weight_expr("tf", p).alias("value"))
    return l2_normalize(x) if p.norm == "l2" else x


# fixed values: the preprocessor grid the reference tuned
GRID_MAX_FEATURES = (15000, 20000)
GRID_NGRAM_MAX = (2, 3)
GRID_MAX_DF = (0.6, 0.7)
GRID_MIN_DF = (2, 3)
GRID_K = (5000, 6000)


def vocab_grid(docs: DataFrame, n_docs: int, base: VectorizerParams = VectorizerParams()) -> DataFrame:
    """For every configuration, how many terms survive the df rule, the vocabulary size after the
    cap, the selected-feature count and the total-count cut of the cap.

    Term statistics are computed once with the widest n-gram range; they are then reduced to a
    histogram over (n-gram length, df, total count), and every configuration is a filter over it."""
    p = replace(base, ngram_range=(1, max(GRID_NGRAM_MAX)), max_features=None)
    stats = doc_freq(term_counts(docs, p))
    hist = stats.groupBy(F.size(F.split("term", " ")).alias("n"), "df", "ttf").agg(F.count(F.lit(1)).alias("cnt"))
    cfgs = [
        (mf, ng, mx, mn, k)
        for mf in GRID_MAX_FEATURES
        for ng in GRID_NGRAM_MAX
        for mx in GRID_MAX_DF
        for mn in GRID_MIN_DF
        for k in GRID_K
    ]
    cfg = F.array(
        *[
            F.struct(F.lit(mf).alias("max_features"), F.lit(ng).alias("ngram_max"), F.lit(mx).alias("max_df"),
                     F.lit(mn).alias("min_df"), F.lit(k).alias("k_features"))
            for mf, ng, mx, mn, k in cfgs
        ]
    )
    keys = ["max_features", "ngram_max", "max_df", "min_df", "k_features"]
    per = hist.select("n", "df", "ttf", "cnt", F.explode(cfg).alias("c")).select("n", "df", "ttf", "cnt", "c.*")
    per = per.filter(
        (F.col("n") <= F.col("ngram_max")) & (F.col("df") >= F.col("min_df")) & (F.col("df") <= F.col("max_df") * F.lit(float(n_docs)))
    )
    by_ttf = per.groupBy(*keys, "ttf").agg(F.sum("cnt").alias("cnt"))
    w = Window.partitionBy(*keys).orderBy(F.col("ttf").desc())  # one row per distinct total count
    cum = by_ttf.withColumn("above", F.sum("cnt").over(w) - F.col("cnt"))
    return cum.groupBy(*keys).agg(
        F.sum("cnt").alias("n_candidates"),
        F.min(F.when(F.col("above") < F.col("max_features"), F.col("ttf"))).alias("cut_ttf"),
    ).select(
        *keys,
        "n_candidates",
        F.least(F.col("n_candidates"), F.col("max_features").cast("long")).alias("n_terms"),
        F.least(F.col("n_candidates"), F.col("max_features").cast("long"), F.col("k_features").cast("long")).alias("n_features"),
        "cut_ttf",
    )


# fixed values: the character analyzer collapses runs of two or more whitespace characters to one space
WS_RUN_PATTERN = r"[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]{2,}"


def char_grams(docs: DataFrame, n: int, text_col: str = "description") -> DataFrame:
    """(row_id, term) for every character n-gram of the lower-cased whole text (whitespace runs
    collapsed). Characters are split once and windowed with Spark ML's ``NGram``; the window's
    separators sit at fixed odd positions, so dropping every second character restores the gram."""
    t = F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), WS_RUN_PATTERN, " ")
    chars = by_row(docs.select("row_id", text_col)).select("row_id", F.split(t, "", -1).alias("_chars"))
    chars = chars.select("row_id", F.filter("_chars", lambda c: F.length(c) > 0).alias("_chars"))
    g = NGram(n=n, inputCol="_chars", outputCol="_g").transform(chars)
    g = g.select("row_id", F.explode_outer("_g").alias("_w")).filter(F.col("_w").isNotNull())
    return g.select("row_id", F.regexp_replace("_w", r"(?s)(.) ", "$1").alias("term"))


def char_vocabulary(docs: DataFrame, n_docs: int, n: int = 3, params: VectorizerParams = VectorizerParams()) -> DataFrame:
    """Character n-gram vocabulary with the same df pruning and frequency cap as the word vocabulary."""
    tc = char_grams(docs, n).groupBy("row_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    return cap_terms(prune_terms(doc_freq(tc), params, n_docs), params.max_features)


def word_char_space(word_vocab: DataFrame, char_vocab: DataFrame) -> DataFrame:
    """Union of the two term spaces, kept apart by a prefix ('w:' words, 'c:' characters)."""
    w = word_vocab.select(F.concat(F.lit("w:"), "term").alias("term"), "df", "ttf")
    c = char_vocab.select(F.concat(F.lit("c:"), "term").alias("term"), "df", "ttf")
    return w.unionByName(c)

"""Preprocessor grid with metrics (L22): every configuration (vocabulary cap, n-gram length, document-frequency bounds,
selection size) is fitted on the training rows and scored on held-out rows, all of them in shared passes.

The features of all configurations lie in one table: a superset vocabulary whose terms carry a bitmap of the vectorizers
that keep them. The weight tf x idf of a term does not depend on the vectorizer, only the row's norm does, so a row has one
weight per term and one norm per vectorizer. Contingency sums have one column per vectorizer, selections of one vectorizer
are nested by rank, and the naive Bayes coefficients of all configurations are columns of one table: the texts are tokenised
once for the vocabulary and once for each split's weights, however many configurations there are.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagwise.functions.exprs import f1_from_counts, safe_div
from tagwise.operators import frequent
from tagwise.operators import text as TX
from tagwise.operators.indexing import dense_index
from tagwise.operators.labels import fit_labels, multi_hot, restrict_labels
from tagwise.operators.select import label_rows
from tagwise.plans.broadcast import join_state, small
from tagwise.session import materialize

MAX_VECTORIZERS = 62  # bits of a long


@dataclass(frozen=True)
class Config:
    max_features: int
    ngram_max: int
    max_df: float
    min_df: int
    k_features: int

    @property
    def vectorizer(self) -> tuple:
        return self.max_features, self.ngram_max, self.max_df, self.min_df


def reference_grid() -> list[Config]:
    return [Config(mf, ng, mx, mn, k) for mf in TX.GRID_MAX_FEATURES for ng in TX.GRID_NGRAM_MAX for mx in TX.GRID_MAX_DF
            for mn in TX.GRID_MIN_DF for k in TX.GRID_K]


def _bit(i: int):
    return F.col("mask").bitwiseAND(F.lit(1 << i)) != 0


def superset_vocabulary(docs: DataFrame, n_docs: int, vectorizers: list[tuple], base: TX.VectorizerParams, words: DataFrame) -> tuple[DataFrame, int]:
    """``(term, feat_idx, idf, mask)`` of the terms that any vectorizer keeps; bit i stands for ``vectorizers[i]``. Numbered
    by term, so features of every vectorizer are in the order that its own vocabulary would have. Of all terms only those
    that can reach a vectorizer's cap are counted; ``words`` are the rows' words."""
    widest = replace(base, ngram_range=(1, max(v[1] for v in vectorizers)), max_features=None,
                     min_df=min(v[3] for v in vectorizers), max_df=max(v[2] for v in vectorizers))
    bounds = [TX.df_bounds(replace(base, min_df=v[3], max_df=v[2]), n_docs) for v in vectorizers]
    sure = max(lo for lo, _ in bounds), min(hi for _, hi in bounds)  # terms within it are in every vectorizer's bounds
    found = frequent.candidate_terms(words, widest.ngram_range[1], min(lo for lo, _ in bounds), sure, max(v[0] for v in vectorizers),
                                     TX.TEXT_BREAK, min(v[1] for v in vectorizers))
    if found is None:
        found = TX.doc_freq(TX.term_counts(docs, widest))
    stats = materialize(TX.prune_terms(found, widest, n_docs))
    parts = None
    for rule in sorted({v[1:] for v in vectorizers}):
        ngram_max, max_df, min_df = rule
        own = [(i, v[0]) for i, v in enumerate(vectorizers) if v[1:] == rule]
        kept = TX.prune_terms(stats.where(F.size(F.split("term", " ")) <= ngram_max), replace(widest, max_df=max_df, min_df=min_df), n_docs)
        top = TX.cap_terms(kept, max(cap for _, cap in own))  # bounded by the largest cap: ranked in one task
        rank = F.row_number().over(Window.orderBy(F.col("ttf").desc(), F.col("term").asc()))
        mask = sum((F.when(F.col("rank") <= cap, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, cap in own), F.lit(0).cast("long"))
        part = top.withColumn("rank", rank).select("term", "df", mask.alias("mask"))
        parts = part if parts is None else parts.unionByName(part)
    merged = materialize(parts.groupBy("term", "df").agg(F.bit_or("mask").alias("mask")))
    n = merged.count()
    if n == 0:
        raise ValueError("After pruning, no terms remain. Try a lower min_df or a higher max_df.")
    vocab = dense_index(merged, "term", "feat_idx", n)
    return materialize(vocab.select("term", "feat_idx", "mask", TX.idf_expr(n_docs, base.smooth_idf).alias("idf"))), n


def lookup_of(vocab: DataFrame, n_terms: int) -> frequent.Lookup | None:
    """The vocabulary as numbers; None if it is too large to send to every task."""
    if n_terms > frequent.MAX_WORDS:
        return None
    rows = vocab.select("term", "feat_idx", "idf").collect()  # at most MAX_WORDS
    lookup = frequent.Lookup([r["term"] for r in rows], [r["feat_idx"] for r in rows], [r["idf"] for r in rows])
    return lookup if lookup.fits() else None


def superset_weights(docs: DataFrame, vocab: DataFrame, n_terms: int, base: TX.VectorizerParams, ngram_max: int, words: DataFrame, lookup: frequent.Lookup | None) -> DataFrame:
    """``(row_id, feat_idx, mask, w)``: weights before the norm."""
    if lookup is not None:
        counted = frequent.count_known(words, lookup, docs.schema["row_id"].dataType.simpleString())
        counted = join_state(counted, vocab.select("feat_idx", "mask"), "feat_idx", n_terms)
    else:
        terms = TX.doc_terms(TX.by_row(docs.select("row_id", "description")), replace(base, ngram_range=(1, ngram_max)))
        counted = join_state(terms, vocab, "term", n_terms).groupBy("row_id", "feat_idx", "mask", "idf").agg(F.count(F.lit(1)).alias("tf"))
    return counted.select("row_id", "feat_idx", "mask", TX.weight_expr("tf", base).alias("w"))


def contingency(weights: DataFrame, y: DataFrame, n_vectorizers: int, n_labels: int, l2: bool) -> DataFrame:
    """``(v, feat_idx, label_idx, obs, fc, n_pos)`` of every vectorizer, feature of it and label."""
    ids = range(n_vectorizers)
    row = Window.partitionBy("row_id")  # a row's terms are bounded by the vocabulary
    norm = [F.sqrt(F.sum(F.when(_bit(i), F.col("w") * F.col("w"))).over(row)) if l2 else F.lit(1.0) for i in ids]
    # a row's columns of all vectorizers go no further than its task: totals are summed with the labels, as label -1
    labs = y.groupBy("row_id").agg(F.collect_list("label_idx").alias("labs"))
    x = weights.join(labs, "row_id", "left").select("feat_idx", "mask", "w", "labs", *[n.alias(f"n{i}") for i, n in enumerate(norm)])
    x = x.select("feat_idx", "mask", "labs", *[F.when(_bit(i), F.coalesce(F.try_divide("w", f"n{i}"), F.lit(0.0))).alias(f"x{i}") for i in ids])
    x = x.withColumn("label_idx", F.explode(F.concat(F.array(F.lit(-1)), F.coalesce("labs", F.array().cast("array<int>")))))
    sums = F.array(*[F.coalesce(F.sum(f"x{i}"), F.lit(0.0)) for i in ids])
    sums = materialize(x.groupBy("feat_idx", "mask", "label_idx").agg(sums.alias("s")))
    totals = sums.where("label_idx < 0").select("feat_idx", "mask", F.col("s").alias("fc"))
    seen = sums.where("label_idx >= 0").select("feat_idx", "label_idx", F.col("s").alias("obs"))
    cells = totals.withColumn("label_idx", F.explode(F.sequence(F.lit(0), F.lit(n_labels - 1))))
    pos = small(label_rows(y), n_labels)
    full = cells.join(seen, ["feat_idx", "label_idx"], "left").join(pos, "label_idx", "left")
    own = F.filter(F.sequence(F.lit(0), F.lit(n_vectorizers - 1)), lambda i: F.getbit(F.col("mask"), i) == 1)
    long = full.withColumn("v", F.explode(own))
    at = lambda c: F.coalesce(F.element_at(c, F.col("v") + 1), F.lit(0.0)).alias(c)
    return long.select("v", "feat_idx", "label_idx", at("obs"), at("fc"), F.coalesce("n_pos", F.lit(0)).alias("n_pos"))


def coefficients(grid: DataFrame, configs: list[Config], vectorizers: list[tuple], n_rows: int, alpha: float) -> tuple[DataFrame, DataFrame]:
    """Naive Bayes coefficients ``(feat_idx, label_idx, c0, c1, ...)``, a column per configuration and 0 where it has not
    selected the feature; and ``(cfg, n_terms, n_features)``."""
    spark = grid.sparkSession
    e = F.col("n_pos") / F.lit(float(n_rows)) * F.col("fc")
    chi2 = grid.groupBy("v", "feat_idx").agg(F.sum(F.try_divide((F.col("obs") - e) * (F.col("obs") - e), e)).alias("score"))
    # a vectorizer's features are bounded by its cap
    order = Window.partitionBy("v").orderBy(F.round("score", 9).desc_nulls_last(), F.col("feat_idx").desc())
    ranked = materialize(chi2.select("v", "feat_idx", F.row_number().over(order).alias("rank")))
    table = spark.createDataFrame([(i, vectorizers.index(c.vectorizer), c.k_features) for i, c in enumerate(configs)], "cfg int, v int, k int")
    picked = ranked.join(F.broadcast(table), "v").where("rank <= k").select("cfg", "v", "feat_idx")
    sizes = picked.groupBy("cfg").agg(F.count(F.lit(1)).alias("n_features"))
    terms = ranked.groupBy("v").agg(F.count(F.lit(1)).alias("n_terms"))
    sizes = materialize(F.broadcast(table).join(terms, "v").join(sizes, "cfg").select("cfg", "n_terms", "n_features"))
    cells = materialize(grid.join(picked, ["v", "feat_idx"]).select("cfg", "feat_idx", "label_idx", F.col("obs").alias("n1"), (F.col("fc") - F.col("obs")).alias("n0")))
    totals = cells.groupBy("cfg", "label_idx").agg(F.sum("n1").alias("all1"), F.sum("n0").alias("all0")).join(F.broadcast(sizes), "cfg")
    a = F.lit(float(alpha))
    rate = lambda n, total: F.log((F.col(n) + a) / (F.col(total) + a * F.col("n_features")))
    w = cells.join(totals, ["cfg", "label_idx"]).select("cfg", "feat_idx", "label_idx", (rate("n1", "all1") - rate("n0", "all0")).alias("w"))
    wide = w.groupBy("feat_idx", "label_idx").agg(*[F.coalesce(F.sum(F.when(F.col("cfg") == i, F.col("w"))), F.lit(0.0)).alias(f"c{i}") for i in range(len(configs))])
    return materialize(wide), sizes


def preprocessor_grid(train_parsed: DataFrame, test_parsed: DataFrame, configs: list[Config] | None = None, alpha: float = 1.0,
                      min_label_pct: float = 5.0, base: TX.VectorizerParams = TX.VectorizerParams()) -> tuple[DataFrame, dict[str, float]]:
    """One row per configuration: sizes and micro metrics of naive Bayes on the held-out rows; and the seconds of the shared
    fit and of the shared scoring (configurations run together and have no seconds of their own)."""
    configs = reference_grid() if configs is None else configs
    vectorizers = list(dict.fromkeys(c.vectorizer for c in configs))
    if not 1 <= len(vectorizers) <= MAX_VECTORIZERS:
        raise ValueError(f"1 to {MAX_VECTORIZERS} vectorizers can be compared, not {len(vectorizers)}")
    t0 = time.time()
    labels = fit_labels(train_parsed, min_label_pct)
    train, test = (materialize(restrict_labels(d, labels).select("row_id", "description", "labels")) for d in (train_parsed, test_parsed))
    y, truth = materialize(multi_hot(train, labels)), multi_hot(test, labels)
    n_train, n_test, ngram_max = train.count(), test.count(), max(v[1] for v in vectorizers)
    words = materialize(TX.doc_words(train, base))
    vocab, n_terms = superset_vocabulary(train, n_train, vectorizers, base, words)
    lookup = lookup_of(vocab, n_terms)
    weights = superset_weights(train, vocab, n_terms, base, ngram_max, words, lookup)
    grid = materialize(contingency(weights, y, len(vectorizers), labels.n_labels, base.norm == "l2"))
    coef, sizes = coefficients(grid, configs, vectorizers, n_train, alpha)
    t1 = time.time()
    # a row's norm is a positive factor of its scores, and the prediction is their sign
    ids = range(len(configs))
    held = superset_weights(test, vocab, n_terms, base, ngram_max, TX.doc_words(test, base), lookup).drop("mask")
    products = join_state(held, coef, "feat_idx", n_terms * labels.n_labels)
    products = products.select("row_id", "label_idx", F.lit(0).alias("t"), *[(F.col("w") * F.col(f"c{i}")).alias(f"s{i}") for i in ids])
    true = truth.select("row_id", "label_idx", F.lit(1).alias("t"), *[F.lit(0.0).alias(f"s{i}") for i in ids])
    scored = products.unionByName(true).groupBy("row_id", "label_idx").agg(F.max("t").alias("t"), *[F.sum(f"s{i}").alias(f"s{i}") for i in ids])
    hit = lambda t, p, i: F.sum(F.when((F.col("t") == t) & ((F.col(f"s{i}") > 0) == F.lit(p)), 1).otherwise(0))
    counts = scored.agg(F.array(*[F.struct(F.lit(i).alias("cfg"), hit(1, True, i).alias("tp"), hit(0, True, i).alias("fp"), hit(1, False, i).alias("fn")) for i in ids]).alias("all"))
    counts = materialize(counts.select(F.inline("all")))
    spark = train_parsed.sparkSession
    named = spark.createDataFrame([(i, c.max_features, c.ngram_max, c.max_df, c.min_df, c.k_features) for i, c in enumerate(configs)],
                                  "cfg int, max_features int, ngram_max int, max_df double, min_df int, k_features int")
    tp, fp, fn = (F.coalesce(F.col(c), F.lit(0)) for c in ("tp", "fp", "fn"))
    out = named.join(sizes, "cfg").join(counts, "cfg").select(
        "max_features", "ngram_max", "max_df", "min_df", "k_features", "n_terms", "n_features",
        f1_from_counts(tp, fp, fn).alias("f1"), safe_div(tp, tp + fp).alias("precision"), safe_div(tp, tp + fn).alias("recall"),
        safe_div(fp + fn, F.lit(n_test * labels.n_labels)).alias("hamming_loss"), safe_div(tp, tp + fp + fn).alias("jaccard"),
        F.lit(n_train).cast("long").alias("n_samples_train"), F.lit(n_test).cast("long").alias("n_samples_test"),
    )
    return out, {"fit_seconds": t1 - t0, "score_seconds": time.time() - t1}

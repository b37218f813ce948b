"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))

The pairwise term is computed in linear time by the sum-of-squares identity. A document is one field of hashed words
(each distinct word once, damped by its count, unit length in all), one field of binned structure statistics of the
whole text, and one field of metadata (declared length against real length). Labels, language, source and ids are
never inputs.

The model is fitted on a bounded sample of labelled rows: at most ``sample_rows`` per label value, those with the
smallest hash of their id, so the fit does not depend on partitioning. Scoring is one Arrow pass without a shuffle.

Defined results: null and empty texts have no words and are scored from their (zero) statistics; a null n_chars is
its own metadata bin; equal rows get equal scores; a table without labelled rows gives every document the score 0.5;
labels other than 0 and 1 and null labels are ignored; conflicting labels of one id all count; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagwise.session import materialize
from tagwise.sources.tables import table

WORD_BITS = 14
RANK = 8
SAMPLE_ROWS = 6_000  # labelled rows per label value that the fit may use
EPOCHS = 6
BATCH = 256
RATE = 0.1
DECAY = 1e-5
BINS = 24  # bins of each statistic
GOOD_SHARE = 0.85  # weight of label 1 in the fit: rejecting a good document costs more than keeping a bad one

STATISTICS = (
    "length", "words", "word_length", "upper_words", "capital_words", "lines", "line_repeats", "distinct_words", "top_word",
    "word_punctuation", "symbols", "digits", "marks", "bars", "stops", "spaces", "other_script", "repeat_run", "declared",
)
N_FEATURES = (1 << WORD_BITS) + BINS * len(STATISTICS)

_SYMBOLS = re.compile(r"[#$%&*+<=>@\\^_`{|}~\[\]]")
_DIGITS = re.compile(r"[0-9]")
_TAIL = re.compile(r"[!#$%&*|?]{2,}(?:\s|$)")


def _log_bin(x: float) -> int:
    return min(BINS - 1, int(2 * math.log2(1 + x)))


def _share_bin(x: float) -> int:
    """Bins of a share: finer near zero, where rare events tell documents apart."""
    return 0 if x <= 0 else min(BINS - 1, 1 + int((BINS - 2) * math.sqrt(min(1.0, x))))


def statistics_bins(text: str, words: list[str], counts: Counter, n_chars: int | None) -> list[int]:
    n, w = max(1, len(text)), max(1, len(words))
    lines = text.split("\n")
    run = 0
    if len(counts) < len(words):
        run = sum(map(str.__eq__, words, words[1:]))
    return [
        _log_bin(len(text)),
        _log_bin(len(words)),
        _share_bin(len(text) / w / 40),
        _share_bin(sum(map(str.isupper, words)) / w),
        _share_bin(sum(map(str.istitle, words)) / w),
        _log_bin(len(lines)),
        _share_bin(1 - len(set(lines)) / len(lines)),
        _share_bin(len(counts) / w),
        _share_bin(max(counts.values(), default=0) / w),
        _share_bin(len(_TAIL.findall(text)) / w),
        _share_bin(len(_SYMBOLS.findall(text)) / n),
        _share_bin(len(_DIGITS.findall(text)) / n),
        _share_bin((text.count("!") + text.count("?")) / n),
        _share_bin(text.count("|") / w),
        _share_bin(text.count(".") / w),
        _share_bin((text.count(" ") + text.count("\n")) / n),
        0 if text.isascii() else 1 + min(BINS - 2, int((BINS - 2) * (len(text.encode("utf-8", "replace")) / n - 1))),
        _share_bin(run / w),
        BINS - 1 if n_chars is None else 0 if n_chars == len(text) else 1 + min(BINS - 3, abs(n_chars - len(text)).bit_length()),
    ]


_WORDS: dict[str, int] = {}  # a worker's memo of word hashes, bounded


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and values of one document."""
    global _WORDS
    text = text or ""
    words = text.split()
    counts = Counter(words)
    if len(_WORDS) + len(counts) > 200_000:
        _WORDS = {}
    memo = _WORDS
    ids = []
    for word in counts:
        h = memo.get(word)
        if h is None:
            h = memo[word] = zlib.crc32(word.encode("utf-8", "replace")) & ((1 << WORD_BITS) - 1)
        ids.append(h)
    x = 1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))
    x /= max(1e-9, math.sqrt(float((x * x).sum())))
    stats = [(1 << WORD_BITS) + i * BINS + b for i, b in enumerate(statistics_bins(text, words, counts, n_chars))]
    weight = 1 / math.sqrt(len(stats))
    return np.array(ids + stats, np.int32), np.concatenate([x, np.full(len(stats), weight)]).astype(np.float32)


@dataclass
class FactorisationMachine:
    bias: float
    w: np.ndarray
    v: np.ndarray

    def raw(self, ids: np.ndarray, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid; rows are runs of ``ids`` that begin at ``starts`` (no run is empty)."""
        if not len(starts):
            return np.zeros(0)
        vx = self.v[ids] * x[:, None]
        s = np.add.reduceat(vx, starts)
        pairs = 0.5 * ((s * s).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), starts))
        return self.bias + np.add.reduceat(self.w[ids] * x, starts) + pairs

    def score(self, ids: np.ndarray, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(ids, x, starts), -30, 30)))


def _ragged(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.cumsum([0] + [len(i) for i, _ in rows[:-1]]) if rows else np.zeros(0, np.int64)
    return np.concatenate([i for i, _ in rows]), np.concatenate([x for _, x in rows]).astype(np.float64), starts


def fit_machine(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = EPOCHS, rank: int = RANK, seed: int = 7) -> FactorisationMachine:
    """Logistic loss, label 1 weighted to GOOD_SHARE of the mass, mini-batch AdaGrad."""
    rng = np.random.default_rng(seed)
    m = FactorisationMachine(0.0, np.zeros(N_FEATURES), rng.normal(0, 0.02, (N_FEATURES, rank)))
    if not len(rows) or len(set(y.tolist())) < 2:
        return FactorisationMachine(0.0 if not len(rows) else 4.0 * (2 * float(y[0]) - 1), m.w, np.zeros_like(m.v))
    gw, gv, gb = np.full(N_FEATURES, 1e-6), np.full((N_FEATURES, rank), 1e-6), 1e-6
    weight = np.where(y == 1, GOOD_SHARE / y.mean(), (1 - GOOD_SHARE) / (1 - y.mean()))
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            pick = order[at : at + BATCH]
            ids, x, starts = _ragged([rows[i] for i in pick])
            g = (m.score(ids, x, starts) - y[pick]) * weight[pick] / len(pick)
            size = np.diff(np.append(starts, len(ids)))
            vx = m.v[ids] * x[:, None]
            s = np.repeat(np.add.reduceat(vx, starts), size, axis=0)
            gx = np.repeat(g, size) * x
            used, back = np.unique(ids, return_inverse=True)
            dw = np.bincount(back, gx) + DECAY * m.w[used]
            dv = np.stack([np.bincount(back, gx * (s[:, f] - vx[:, f])) for f in range(rank)], axis=1) + DECAY * m.v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            gb += g.sum() ** 2
            m.w[used] -= RATE * dw / np.sqrt(gw[used])
            m.v[used] -= RATE * 0.5 * dv / np.sqrt(gv[used])
            m.bias -= RATE * g.sum() / math.sqrt(gb)
    return m


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from; a null id has no label and counts as held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> FactorisationMachine:
    """Fit on at most ``sample_rows`` texts per label value of ``labels (doc_id, quality)`` outside the held-out part.
    Repeated labels, and repeated rows of one doc_id and text, count once."""

    def bounded(rows: DataFrame, *more: str) -> DataFrame:
        order = [F.xxhash64("doc_id"), F.col("doc_id"), *more]
        return rows.where("quality = 0").orderBy(*order).limit(sample_rows).union(rows.where("quality = 1").orderBy(*order).limit(sample_rows))

    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(~held_out(F.col("doc_id")))
    # both samples' sizes are bounded by the parameter, so they may be broadcast
    found = docs.select("doc_id", "text", "n_chars").join(F.broadcast(bounded(known.distinct())), "doc_id")
    keys = ["doc_id", "quality", "text_hash"]
    found = found.withColumn("text_hash", F.xxhash64("text")).groupBy(*keys).agg(F.min("text").alias("text"), F.min("n_chars").alias("n_chars"))
    found = materialize(found)
    chosen = found.join(F.broadcast(bounded(found.select(*keys), "text_hash")), keys).select("doc_id", "quality", "text", "n_chars")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                found = [features(t, n) for t, n in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()),
                        part.column(1),
                        pa.array([i.tobytes() for i, _ in found], pa.binary()),
                        pa.array([x.tobytes() for _, x in found], pa.binary()),
                    ],
                    names=["doc_id", "quality", "ids", "x"],
                )

    got = chosen.mapInArrow(extract, "doc_id long, quality int, ids binary, x binary").toArrow().sort_by([("doc_id", "ascending"), ("ids", "ascending")])
    rows = [(np.frombuffer(i, np.int32), np.frombuffer(x, np.float32)) for i, x in zip(got["ids"].to_pylist(), got["x"].to_pylist(), strict=True)]
    return fit_machine(rows, got["quality"].to_numpy().astype(np.float64))


def scorer(spark: SparkSession, machine: FactorisationMachine) -> Any:
    """A column function (text, n_chars) -> score. The model has a fixed size (2^14 words and the bins)."""
    model = spark.sparkContext.broadcast(machine)

    def score(batches: Iterator[tuple[Any, Any]]) -> Iterator[Any]:
        import pandas as pd

        for text, n_chars in batches:
            out = []
            for k in range(0, len(text), 256):
                lengths = n_chars.iloc[k : k + 256].astype(object).where(n_chars.iloc[k : k + 256].notna(), None)
                rows = [features(t, None if n is None else int(n)) for t, n in zip(text.iloc[k : k + 256], lengths, strict=True)]
                out.append(model.value.score(*_ragged(rows)))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    # a plain annotation-free iterator function, so that the eval type is given by hand
    from pyspark.sql.functions import PandasUDFType, pandas_udf

    return pandas_udf(score, T.DoubleType(), PandasUDFType.SCALAR_ITER)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    score = scorer(spark, fit(docs, table(spark, sf_dir, "labels")))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text", "n_chars").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

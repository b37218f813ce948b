"""Word n-grams as numbers, for vocabularies that are capped at the most frequent terms.

An n-gram is in no more documents and occurs no more often than each of its words and shorter n-grams. So n-grams are
counted level by level, and only those whose parts are all frequent enough for the cap: of a level's n-grams the rest
cannot be in the vocabulary. Words are told by their place in the list of frequent words (bounded by the cap), an
n-gram by one number to the base of that list's length. Counting runs over Arrow batches of documents; sums per term are
Spark aggregates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.session import materialize

SLICE_WORDS = 1 << 19  # words of one step of a task
MAX_WORDS = 200_000  # frequent words or vocabulary terms that are sent to every task


def fits(n_words: int, n_max: int) -> bool:
    return n_words <= MAX_WORDS and max(n_words, 2) ** n_max < 1 << 62


def _slices(batches):
    """Batches cut so that each holds about ``SLICE_WORDS`` elements of its last column's lists (at least one row)."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(b.column(b.num_columns - 1)), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < b.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + SLICE_WORDS, side="right")))
            yield b.slice(first, last - first)
            first = last


def _flat(lists) -> tuple[np.ndarray, pa.Array]:
    return pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()


def _counts(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, rows that hold each, occurrences."""
    found, place, ttf = np.unique(key, return_inverse=True, return_counts=True)
    held = np.unique(row * max(len(found), 1) + place) % max(len(found), 1)
    return found, np.bincount(held, minlength=len(found)), ttf


def _codes(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Place of each word in ``known``, -1 if it is not there."""
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _longer(row: np.ndarray, code: np.ndarray, gram: np.ndarray, n: int, base: int) -> np.ndarray:
    """Numbers of the n-grams that begin at each place, from those one word shorter; -1 where there is none."""
    out = np.full(len(gram), -1, dtype=np.int64)
    last = len(gram) - n + 1
    if last > 0:
        end = code[n - 1 :]
        ok = (gram[:last] >= 0) & (gram[1 : last + 1] >= 0) & (end >= 0) & (row[:last] == row[n - 1 :])
        out[:last][ok] = gram[:last][ok] * base + end[ok]
    return out


def _only(gram: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """``gram`` with -1 for numbers that are not in ``kept`` (sorted)."""
    if not len(kept):
        return np.full(len(gram), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(kept, gram), len(kept) - 1)
    return np.where(kept[at] == gram, gram, -1)


def word_stats(words: DataFrame) -> DataFrame:
    """``(term, df, ttf)`` of single words from ``(row_id, words)``, one row per document."""

    def count(batches):
        for b in _slices(batches):
            row, flat = _flat(b.column(1))
            if len(flat):
                coded = flat.dictionary_encode()
                found, df, ttf = _counts(row, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
                yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(found)), pa.array(df), pa.array(ttf)], ["term", "df", "ttf"])

    parts = words.select("row_id", "words").mapInArrow(count, "term string, df long, ttf long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("ttf").alias("ttf"))


def _gram_stats(coded: DataFrame, n: int, base: int, shorter: list) -> DataFrame:
    """``(gram, df, ttf)`` of the n-grams whose shorter n-grams are all frequent; ``shorter[i]`` is the broadcast, sorted
    list of frequent n-grams of i + 2 words (None: not told apart)."""

    def count(batches):
        for b in _slices(batches):
            row, flat = _flat(b.column(0))
            code = flat.to_numpy(zero_copy_only=False).astype(np.int64)
            gram = code
            for m in range(2, n + 1):
                gram = _longer(row, code, gram, m, base)
                if m < n and shorter[m - 2] is not None:
                    gram = _only(gram, shorter[m - 2].value)
            there = gram >= 0
            if there.any():
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in _counts(row[there], gram[there])], ["gram", "df", "ttf"])

    parts = coded.select("codes").mapInArrow(count, "gram long, df long, ttf long")
    return parts.groupBy("gram").agg(F.sum("df").alias("df"), F.sum("ttf").alias("ttf"))


def _spelled(stats: DataFrame, n: int, known) -> DataFrame:
    """``(term, df, ttf)`` with the n-grams' words."""

    def spell(batches):
        words = known.value
        for b in batches:
            gram, parts = b.column(0).to_numpy(zero_copy_only=False), []
            for _ in range(n):
                parts.append(words.take(pa.array(gram % len(words))))
                gram = gram // len(words)
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(*parts[::-1], " "), b.column(1), b.column(2)], ["term", "df", "ttf"])

    return stats.select("gram", "df", "ttf").mapInArrow(spell, "term string, df long, ttf long")


def _cut(stats: DataFrame, most: float, cap: int) -> int:
    """Total count of the ``cap``-th most frequent term with a document frequency of at most ``most``; 0 if there are fewer."""
    top = stats.where(F.col("df") <= F.lit(most)).select("ttf").orderBy(F.col("ttf").desc()).limit(cap)  # bounded by the cap
    got = top.agg(F.count(F.lit(1)).alias("n"), F.min("ttf").alias("cut")).first()
    return int(got["cut"]) if got["n"] >= cap else 0


def candidate_terms(words: DataFrame, n_max: int, least: float, sure: tuple[float, float], cap: int, no_word: str, sure_n: int | None = None) -> DataFrame | None:
    """``(term, df, ttf)`` of all n-grams of 1 to ``n_max`` words that can be among the ``cap`` most frequent ones with a
    document frequency of at least ``least``; exact counts. The terms that set the cut have a document frequency in ``sure``
    and at most ``sure_n`` words (None: any number).
    ``words`` holds one row per document; no n-gram goes over ``no_word``. None: the words are too many to send to every task."""
    sc = words.sparkSession.sparkContext
    low, most = sure
    singles = materialize(word_stats(words).where((F.col("term") != no_word) & (F.col("df") >= F.lit(float(least)))))
    cut = _cut(singles.where(F.col("df") >= F.lit(low)), most, cap)
    if not fits(singles.where(F.col("ttf") >= cut).count(), n_max):
        return None
    known = pa.array(sorted(r["term"] for r in singles.where(F.col("ttf") >= cut).select("term").collect()), pa.string())  # at most MAX_WORDS
    if not len(known):
        return singles
    list_of = sc.broadcast(known)

    def encode(batches):
        for b in batches:
            lists = b.column(0)
            code = pa.array(_codes(lists.flatten(), list_of.value).astype(np.int32))
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), code)], ["codes"])

    coded = materialize(words.select("words").mapInArrow(encode, "codes array<int>"))
    found, shorter = singles, []
    for n in range(2, n_max + 1):
        stats = _gram_stats(coded, n, len(known), shorter).where((F.col("df") >= F.lit(float(least))) & (F.col("ttf") >= cut))
        stats = materialize(stats)
        found = found.unionByName(_spelled(stats, n, list_of))
        if n < n_max:
            if sure_n is None or n <= sure_n:
                cut = max(cut, _cut(found.where(F.col("df") >= F.lit(low)), most, cap))
            own = stats.where(F.col("ttf") >= cut).select("gram")
            many = own.count() > MAX_WORDS * 20
            shorter.append(None if many else sc.broadcast(np.sort(np.array([r["gram"] for r in own.collect()], dtype=np.int64))))
    return found.where(F.col("ttf") >= cut)


class Lookup:
    """A vocabulary's terms as numbers: its words, and for each length the sorted numbers of the terms with their features."""

    def __init__(self, terms: list[str], feats: list[int], idf: list[float]):
        split = [t.split(" ") for t in terms]
        self.words = pa.array(sorted({w for s in split for w in s}), pa.string())
        place = {w.as_py(): i for i, w in enumerate(self.words)}
        self.n_max = max((len(s) for s in split), default=0)
        self.idf = np.zeros(max(feats, default=-1) + 1)
        self.idf[feats] = idf
        self.grams = []
        for n in range(1, self.n_max + 1):
            own = []
            for s, f in zip(split, feats, strict=True):
                if len(s) == n:
                    number = 0
                    for w in s:
                        number = number * len(self.words) + place[w]
                    own.append((number, f))
            table = np.array(sorted(own), dtype=np.int64).reshape(-1, 2)
            self.grams.append((table[:, 0].copy(), table[:, 1].copy()))

    def fits(self) -> bool:
        return fits(len(self.words), max(self.n_max, 1))


def count_known(words: DataFrame, lookup: Lookup, key_type: str) -> DataFrame:
    """``(row_id, feat_idx, idf, tf)`` of the vocabulary's terms in ``(row_id, words)``, one row per document."""
    sent = words.sparkSession.sparkContext.broadcast(lookup)

    def count(batches):
        look = sent.value
        width = len(look.idf)
        for b in _slices(batches):
            row, flat = _flat(b.column(1))
            code = _codes(flat, look.words)
            gram, keys = code, []
            for n, (numbers, feats) in enumerate(look.grams, 1):
                gram = code if n == 1 else _longer(row, code, gram, n, len(look.words))
                if len(numbers):
                    at = np.minimum(np.searchsorted(numbers, gram), len(numbers) - 1)
                    hit = numbers[at] == gram
                    keys.append(row[hit] * width + feats[at[hit]])
            if keys:
                key, tf = np.unique(np.concatenate(keys), return_counts=True)
                feat = key % width
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(key // width)), pa.array(feat.astype(np.int32)), pa.array(look.idf[feat]), pa.array(tf)],
                    ["row_id", "feat_idx", "idf", "tf"],
                )

    return words.select("row_id", "words").mapInArrow(count, f"row_id {key_type}, feat_idx int, idf double, tf long")

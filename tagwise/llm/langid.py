"""Language identification by rank-order profiles.

A profile is the list of the most frequent n-grams (1 to 3 characters of words padded by ``_``) in rank order; ties go
to the smaller n-gram. A document's profile is compared to each language's by the out-of-place distance: the sum over
its n-grams of the difference between both ranks, and ``profile`` for an n-gram that the language lacks.

Language profiles are counted over all training rows: each task counts n-grams per language, and the partial
counts are summed by a shuffle of n-grams. Only the profiles (languages x ``profile`` rows)
reach the driver; languages are the label values of the training rows.

Defined results: null texts and texts without a letter give ``und`` with score 0; equal distances go to the smaller
language name; without training rows every text is ``und``; equal rows get equal results; a null doc_id counts as
held out; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagwise.sources.tables import table

PROFILE = 300
MEMO_GRAMS = 500_000  # n-grams a task counts before it hands them on


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def gram_codes(text: str | None) -> np.ndarray:
    """All n-grams of a text as integers in the order of the n-grams (21 bits a character), repeats included.

    The words stand in one string between single ``_``; a pair belongs to the word that gave its letter, and a triple
    is inside one word unless its middle is ``_``.
    """
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    letter = letters()[c]
    if not letter.any():
        return np.zeros(0, np.int64)
    # each run of other characters becomes one `_`, and one stands at either end
    c = np.where(letter, c, ord("_"))[letter | np.concatenate([[False], letter[:-1]])]
    c = np.concatenate([[ord("_")], c, np.full(int(letter[-1]), ord("_"))])
    letter = c != ord("_")
    one, two = c << 42, c[1:] << 21
    three = (one[:-2] | two[:-1] | c[2:])[letter[1:-1]]
    return np.concatenate([one[letter], one[:-1] | two, three])


def gram_text(code: int) -> str:
    return "".join(chr(x) for x in (code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF) if x)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def gram_counts(train: DataFrame) -> DataFrame:
    """``(lang, text)`` -> ``(lang, gram, n)`` over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}  # codes and their counts so far

        def merge(lang: str, codes: list[np.ndarray]) -> None:
            new, n = np.unique(np.concatenate(codes), return_counts=True)
            if lang in held:
                both, back = np.unique(np.concatenate([held[lang][0], new]), return_inverse=True)
                new, n = both, np.bincount(back, np.concatenate([held[lang][1], n])).astype(np.int64)
            held[lang] = [new, n]

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (codes, n) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], names=["lang", "gram", "n"])

        for b in batches:
            for k in range(0, b.num_rows, 64):
                part, by_lang = b.slice(k, 64), {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    by_lang.setdefault(lang, []).append(gram_codes(text))
                for lang, codes in by_lang.items():
                    merge(lang, codes)
                if sum(len(c) for c, _ in held.values()) > MEMO_GRAMS:
                    yield from out()
                    held.clear()
        yield from out()

    return train.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_profiles(train: DataFrame, profile: int = PROFILE) -> dict[str, list[int]]:
    """The ``profile`` most frequent n-grams of each language, in rank order."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.col("gram"))
    top = gram_counts(train.where("lang IS NOT NULL AND text IS NOT NULL")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= profile)
    found: dict[str, list[int]] = {}
    for r in sorted(top.collect(), key=lambda r: (r["lang"], r["rank"])):
        found.setdefault(r["lang"], []).append(r["gram"])
    return found


class Profiles:
    """Distances to the language profiles."""

    def __init__(self, profiles: dict[str, list[int]], profile: int = PROFILE):
        self.langs, self.profile = sorted(profiles), profile
        grams = sorted({g for lang in self.langs for g in profiles[lang]})
        self.grams, at = np.array([*grams, np.iinfo(np.int64).max], np.int64), {g: i for i, g in enumerate(grams)}
        self.ranks = np.full((len(self.langs), len(self.grams)), -1, np.int64)
        for j, lang in enumerate(self.langs):
            for r, g in enumerate(profiles[lang]):
                self.ranks[j, at[g]] = r

    def top(self, codes: np.ndarray) -> np.ndarray:
        """The most frequent n-grams in rank order."""
        codes = np.sort(codes)
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        n, seen = np.diff(np.append(first, len(codes))), codes[first]
        if len(seen) > self.profile:  # all that can be among the first, ties at the edge included
            least = np.partition(n, len(n) - self.profile)[len(n) - self.profile]
            seen, n = seen[n >= least], n[n >= least]
        return seen[np.argsort(-n, kind="stable")][: self.profile]

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = gram_codes(text)
        if not len(codes) or not self.langs:
            return "und", 0.0
        top = self.top(codes)
        at = np.searchsorted(self.grams, top)
        ranks = np.where(self.grams[at] == top, self.ranks[:, at], -1)
        distance = np.where(ranks < 0, self.profile, np.abs(ranks - np.arange(len(top)))).sum(axis=1)
        best = int(np.argmin(distance))
        return self.langs[best], 1 - float(distance[best]) / (self.profile * len(top))


def identify(docs: DataFrame, profiles: dict[str, list[int]], profile: int = PROFILE) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, lang_pred, score)``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Profiles(profiles, profile)
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                found = [known.predict(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = learn_profiles(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, profiles).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

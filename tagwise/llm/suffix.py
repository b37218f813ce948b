"""Exact substring dedup by bucket-pointer refinement of q-gram buckets.

Every byte that lies in a ``window``-byte string which also starts anywhere else is removed. Window starts are bucketed
by a q-gram of their window and the buckets refined, instead of sorting whole suffixes:

1. Each window start points to one q-gram inside its window: the one with the smallest hash, leftmost among equals.
   Equal windows point to equal q-grams at equal offsets, so only starts in one q-gram's bucket can be equal.
   Neighbouring starts share their pointer, so a bucket entry is a *run* of starts: (document, first, number).
   A q-gram bucket with one entry is resolved: none of its windows repeats.
2. Buckets are refined by the bytes at the later (and earlier) offsets that the run's windows cover: a run's class
   identifies the whole stretch of text under its windows. Runs whose class has several entries are resolved: all
   their windows repeat. A bucket with a single class is resolved too.
3. What remains are buckets of several classes (the edges of repeated passages). They are refined once more, down to
   single windows: the starts of one entry per class are bucketed by the window's own hash; a bucket with two
   entries is a repeated window.

A bucket identifier is a 64-bit hash; a window's final bucket is one 64-bit hash of its q-gram's identifier and its own.
Work and shuffle are proportional to the number of runs, about ``2 / (window - q + 2)`` of the bytes, plus the windows
at edges. Buckets with one entry go through partial aggregates; the others are refined by windows over a bucket's
entries, so a passage in every document brings one narrow entry per document to one task.

Defined results: null counts as empty; texts shorter than a window lose nothing; equal texts of at least a window lose
everything; matches never cross rows; rows that repeat doc_id and text are copies of each other, rows of one doc_id with
different texts are told apart by a hash of the text, as are rows without a doc_id; extra columns are ignored; an empty table gives an empty result. Kept bytes may cut a
character in two when equal strings begin or end inside one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagwise.plans.broadcast import small
from tagwise.session import materialize
from tagwise.sources.tables import table

WINDOW = 200
QGRAM = 100
BLOCK = 1 << 18  # window starts handled at once
_POS = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(32))


class _Rolling:
    """Hashes of any stretch of a block of bytes, by prefix sums modulo 2^64."""

    def __init__(self, data: np.ndarray):
        self.power, self.inverse = _powers(1 << (max(len(data), BLOCK + 2 * WINDOW) - 1).bit_length())
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_CODES[data] * self.power[: len(data)], out=self.prefix[1:])

    def stretch(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.prefix[stop] - self.prefix[start]) * self.inverse[start] + (stop - start).astype(np.uint64))

    def every(self, width: int) -> np.ndarray:
        n = len(self.prefix) - width
        return _mix((self.prefix[width:] - self.prefix[:n]) * self.inverse[:n] + np.uint64(width))


_CODES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def runs(data: np.ndarray, window: int = WINDOW, q: int = QGRAM) -> tuple[np.ndarray, ...]:
    """Bucket entries of a text: (first start, number of starts, q-gram bucket, class) as arrays."""
    found = []
    for at in range(0, max(len(data) - window + 1, 0), BLOCK):
        roll = _Rolling(data[at : at + BLOCK + window - 1])
        h = roll.every(q)
        low = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
        span, width = 1, window - q + 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if rest := width - span:
            low = np.minimum(low[:-rest], low[rest:])
        pointer = (low & _POS).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], pointer[1:] != pointer[:-1]]))
        stop = np.append(first[1:], len(pointer))
        # the class covers the stretch under all windows of the run, and where the q-gram lies in it
        shape = ((pointer[first] - first) * 1024 + (stop - first)).astype(np.uint64)
        found.append((first + at, stop - first, h[pointer[first]], _mix(roll.stretch(first, stop + window - 1) + shape * np.uint64(_BASE))))
    if not found:
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate([f[i] for f in found]) for i in range(4))


def _text_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``key``: the doc_id where it names one text; else a hash of the text, and of the doc_id if any."""
    number, digest = F.col(doc_id).cast("long"), F.xxhash64(text)
    ids = docs.select(number.alias("several"), digest.alias("digest")).where("several IS NOT NULL")
    several = materialize(ids.groupBy("several").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select("several"))
    key, n = F.coalesce(number, digest), several.count()
    if n:
        docs = docs.join(small(several, n), number == F.col("several"), "left")
        key = F.when(F.col("several").isNotNull(), F.xxhash64("several", text)).otherwise(key)
    return docs.withColumn("key", key).drop("several")


def bucket_entries(docs: DataFrame, window: int, q: int) -> DataFrame:
    """``(key, text)`` -> ``(key, run, more, bucket, class)``; run = first start * 1024 + number of starts.

    Runs of one class within one text are one entry, the others' numbers packed into ``more`` (null if there are none),
    so lines that a text repeats over and over and periodic texts make no hot bucket.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 128):
                part = b.slice(k, 128)
                rows, out, more = [], [], []
                for i, t in enumerate(part.column(1).to_pylist()):
                    first, n, bucket, kind = runs(np.frombuffer(_text_bytes(t), np.uint8), window, q)
                    if not len(first):
                        continue
                    run = first * 1024 + n
                    order = np.lexsort((run, kind))
                    lead = np.flatnonzero(np.concatenate([[True], kind[order][1:] != kind[order][:-1]]))
                    if len(lead) < len(order):
                        groups = np.split(run[order], lead[1:])
                        more += [g[1:].tobytes() if len(g) > 1 else None for g in groups]
                    else:
                        more += [None] * len(lead)
                    rows.append(np.full(len(lead), i))
                    lead = order[lead]
                    out.append((run[lead], bucket[lead].view(np.int64), kind[lead].view(np.int64)))
                if rows:
                    run, bucket, kind = (pa.array(np.concatenate([o[i] for o in out])) for i in range(3))
                    key = part.column(0).take(pa.array(np.concatenate(rows)))
                    yield pa.RecordBatch.from_arrays([key, run, pa.array(more, pa.binary()), bucket, kind], names=["key", "run", "more", "bucket", "class"])

    return docs.select("key", "text").where(F.octet_length("text") >= window).mapInArrow(
        scan, "key long, run long, more binary, bucket long, class long"
    )


def _windows(joined: DataFrame, window: int) -> DataFrame:
    """Window buckets of the edge entries: ``(key, text, edges)`` -> ``(bucket, key, start, open)``.

    An edge is (run, bucket, open); ``open`` is false for entries whose windows are known to repeat: they only serve
    as partners and need no place.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                cols: list[list[np.ndarray]] = [[], [], [], []]
                for key, text, edges in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    data = np.frombuffer(_text_bytes(text), np.uint8)
                    for e in edges or ():
                        first, n = divmod(e["run"], 1024)
                        h = _Rolling(data[first : first + n + window - 1]).every(window)
                        cols[0].append(_mix(h + np.uint64(e["bucket"] * _BASE % (1 << 64))))
                        cols[1].append(np.full(n, key, np.int64))
                        cols[2].append(np.arange(first, first + n, dtype=np.int64) if e["open"] else np.full(n, -1, np.int64))
                if cols[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(cols[0]).view(np.int64)), pa.array(np.concatenate(cols[1])), pa.array(np.concatenate(cols[2]))],
                        names=["window", "key", "start"],
                    )

    return joined.mapInArrow(scan, "window long, key long, start long")


def repeated_starts(docs: DataFrame, window: int = WINDOW, q: int = QGRAM) -> tuple[DataFrame, DataFrame]:
    """Window starts of ``(key, text)`` whose window also starts elsewhere, as two tables of one row per key:
    ``(key, whole, more)`` with runs of starts (``more``: packed) and ``(key, hits)`` with single starts at edges."""
    entries = bucket_entries(docs, window, q)
    # buckets with a single entry are resolved; the count is combined before the shuffle
    size = F.lit(1) + F.coalesce((F.octet_length("more") / 8).cast("long"), F.lit(0))
    shared = entries.groupBy("bucket").agg(F.sum(size).alias("n")).where("n > 1").select("bucket")
    held = entries.join(shared, "bucket")
    by_class, by_bucket = Window.partitionBy("bucket", "class"), Window.partitionBy("bucket")
    refined = (
        held.withColumn("copies", F.sum(size).over(by_class))
        .withColumn("nth", F.row_number().over(by_class.orderBy("key", "run")))
        .withColumn("mixed", F.min("class").over(by_bucket) != F.max("class").over(by_bucket))
    )
    is_edge = F.col("mixed") & (F.col("nth") == 1)
    per_key = (
        refined.where((F.col("copies") > 1) | is_edge)
        .groupBy("key")
        .agg(
            F.collect_list(F.when(F.col("copies") > 1, F.col("run"))).alias("whole"),
            F.collect_list("more").alias("more"),
            F.collect_list(F.when(is_edge, F.struct("run", "bucket", (F.col("copies") == 1).alias("open")))).alias("edges"),
        )
    )
    marks = materialize(per_key)
    # a left join of all rows, so that this exchange of the texts equals the one before the cut and is reused by it
    joined = docs.join(marks.select("key", "edges"), "key", "left").select("key", "text", "edges")
    windows = _windows(joined, window)
    hits = (
        windows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("window")))
        .where("n > 1 AND start >= 0")
        .groupBy("key")
        .agg(F.collect_set("start").alias("hits"))
    )
    return marks.select("key", "whole", "more"), hits


def _removed(size: int, window: int, whole: Iterable[int] | None, more: Iterable[bytes] | None, hits: Iterable[int] | None) -> np.ndarray:
    """Maximal removed runs as an array of (begin, end)."""
    w, h = (np.array([] if x is None else x, np.int64) for x in (whole, hits))
    w = np.sort(np.concatenate([w, *(np.frombuffer(m, np.int64) for m in ([] if more is None else more))]))
    begin = np.concatenate([w // 1024, h])
    end = np.concatenate([w // 1024 + w % 1024 - 1 + window, h + window])
    if not len(begin):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.minimum(np.maximum.accumulate(end[order]), size)
    first = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
    return np.stack([begin[first], reach[np.append(first[1:], len(begin)) - 1]], axis=1)


def _marked(docs: DataFrame, window: int, q: int) -> DataFrame:
    """``(key, doc_id, text, whole, more, hits)`` for every row."""
    keyed = _keyed(docs.select("doc_id", "text"))
    whole, hits = repeated_starts(keyed, window, q)
    return keyed.join(whole, "key", "left").join(hits, "key", "left")


def remove_repeats(docs: DataFrame, window: int = WINDOW, q: int = QGRAM) -> DataFrame:
    """``docs`` with columns doc_id and text -> ``(doc_id, kept binary, removed array<struct<begin,end>>, n_bytes)``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                kept, spans, sizes = [], [], []
                for text, w, m, h in zip(*(c.to_pylist() for c in part.columns[1:]), strict=True):
                    data = _text_bytes(text)
                    gone = _removed(len(data), window, w, m, h).tolist()
                    kept.append(_kept(data, gone))
                    spans.append([{"begin": x, "end": y} for x, y in gone])
                    sizes.append(len(data))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(kept, pa.binary()), pa.array(spans, _SPANS), pa.array(sizes, pa.int64())],
                    names=["doc_id", "kept", "removed", "n_bytes"],
                )

    joined = _marked(docs, window, q)
    return joined.select("doc_id", "text", "whole", "more", "hits").mapInArrow(cut, f"doc_id {kind}, kept binary, removed array<struct<begin:bigint,end:bigint>>, n_bytes long")


def _kept(data: bytes, gone: list[list[int]]) -> bytes:
    edges = [0, *(x for pair in gone for x in pair), len(data)]
    return b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))


def drop_repeats(docs: DataFrame, window: int = WINDOW, q: int = QGRAM) -> DataFrame:
    """``docs`` with all its columns, repeated strings cut out of ``text`` and ``n_chars`` set for texts that changed.

    Characters of which only some bytes are left are dropped.
    """
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    keyed = _keyed(keyed, "row.doc_id", "row.text").select("key", F.col("row.text").alias("text"), "row")
    whole, hits = repeated_starts(keyed, window, q)

    def changed(text: str, *marks: Iterable | None) -> str:
        data = _text_bytes(text)
        return _kept(data, _removed(len(data), window, *marks).tolist()).decode("utf-8", "ignore")

    def cut(text: Iterator) -> Iterator:
        import pandas as pd

        for t, w, m, h in text:
            yield pd.Series([x if a is None and c is None else changed(x, a, b, c) for x, a, b, c in zip(t, w, m, h, strict=True)], dtype=object)

    cut_text = F.pandas_udf(cut, "string", F.PandasUDFType.SCALAR_ITER)
    joined = keyed.join(whole, "key", "left").join(hits, "key", "left")
    done = joined.select("row", cut_text("row.text", "whole", "more", "hits").alias("cut"))
    new = {
        "text": F.col("cut"),
        "n_chars": F.when(F.col("cut").eqNullSafe(F.col("row.text")), F.col("row.n_chars")).otherwise(F.length("cut")).cast("long"),
    }
    return done.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    total = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return done.select(
        "doc_id",
        "n_bytes",
        total.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

"""Ranked lexical search: hybrid term-at-a-time / document-at-a-time over document shards.

Queries are taken in blocks of bounded size. For a block, one Arrow pass over the documents writes the postings of the
block's terms (one narrow row per document), from which Spark sums document frequencies and so the weights.

* Term at a time: the postings of short lists (at most ``SHORT`` documents) are joined with the queries that hold the
  term and summed per (query, document) by Spark. A query's kth largest sum is a floor that every shard knows.
* Document at a time: postings are dealt into shards of a bounded number of postings and cogrouped with their
  accumulators. Per query, the accumulators are one more sorted iterator with a bound (their largest sum) beside the
  long lists with theirs. Documents are visited in ascending order in windows; iterators whose bounds cannot reach the
  kth score together open no document: they are only probed for documents that the others opened, the largest bound
  first, and only while partial score plus remaining bounds can still enter the result.

Nothing is approximate: shards return their k best, merged by (score, id). Scores are 64-bit integers.

Defined results: a null text holds no term; documents without a term count in nothing and are not returned; repeated
rows are documents of their own; a document without an id is ranked after others of its score; repeated query rows
count once, equal item ids with different texts are queries of their own; queries without a term get no rows, nor do
any queries if no document has a term; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagwise.session import materialize
from tagwise.sources.tables import table

K = 10
SHORT = 1024  # documents of a list that is summed term at a time
SHARD_POSTINGS = 1 << 20
QUERY_BYTES = 4 << 20  # text of a block of queries; what is broadcast of a block grows with it and with nothing else
# bytes of terms: digits, letters in lower case and every byte of a character beyond ASCII; all others separate
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


@dataclass
class Block:
    """A block of queries: its vocabulary, and per query the item id and its distinct terms."""

    words: dict[bytes, int]
    items: list[int]
    held: list[list[int]]


def query_blocks(queries: DataFrame, block_bytes: int) -> Iterator[Block]:
    """Blocks of distinct ``(item_id, text)``, dealt by hash; a block holds about ``block_bytes`` of text or one query."""
    rows = queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).where("text IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for b in range(blocks):
        words: dict[bytes, int] = {}
        items, held = [], []
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text")
        for r in own.toArrow().to_pylist():
            found = [words.setdefault(t, len(words)) for t in dict.fromkeys(terms(r["text"]))]
            if found:
                items.append(r["item_id"])
                held.append(found)
        if items:
            yield Block(words, items, held)


def postings(docs: DataFrame, words: dict[bytes, int]) -> DataFrame:
    """``(doc_id, text)`` -> ``(row, doc_id, n, terms, tfs)`` for every document with a term: n counts all its terms with
    repeats, the lists hold those of ``words``."""
    known = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for b in batches:
            keep, ns, ids, tfs = [], [], [], []
            for at, text in enumerate(b.column("text").cast(pa.binary()).to_pylist()):
                found = terms(text or b"")
                if found:
                    own = [(i, c) for t, c in Counter(found).items() if (i := get(t)) is not None]
                    keep.append(at)
                    ns.append(len(found))
                    ids.append([i for i, _ in own])
                    tfs.append([c for _, c in own])
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("row").take(at), b.column("doc_id").take(at), pa.array(ns, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                names=["row", "doc_id", "n", "terms", "tfs"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "row long, doc_id long, n long, terms array<int>, tfs array<int>")


def _best(docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((docs, -scores))[:k]
    return docs[order], scores[order]


def search(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, floor: int, seen: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents (position, score) over sorted lists (documents, scores); results below ``floor`` may be left
    out. Equal scores: the smaller position. ``seen`` gets the postings that were read from the lists."""
    lists = sorted(((d, s, int(s.max())) for d, s in lists if len(d)), key=lambda x: x[2])
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    reach = np.cumsum([bound for _, _, bound in lists])  # of an iterator and all of smaller bounds together
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    beat, lo, width, opened = max(floor - 1, 0), 0, 512, 0
    while lo < n_docs:
        hi = min(n_docs, lo + width)
        first = int(np.searchsorted(reach, beat, side="right"))  # iterators before it open no document
        if first == len(lists):
            break
        part = np.zeros(hi - lo, np.int64)
        for d, s, _ in lists[first:]:
            a, b = np.searchsorted(d, (lo, hi))
            part[d[a:b] - lo] += s[a:b]
            opened += int(b - a)
        found = np.flatnonzero(part)
        for j in range(first - 1, -1, -1):
            found = found[part[found] + reach[j] > beat]
            if not len(found):
                break
            d, s, _ = lists[j]
            at = np.searchsorted(d, found + lo)
            hit = (at < len(d)) & (d[np.minimum(at, len(d) - 1)] == found + lo)
            part[found[hit]] += s[at[hit]]
            opened += int(hit.sum())
        found = found[part[found] > beat]
        if len(found):
            docs, scores = _best(np.concatenate([docs, found + lo]), np.concatenate([scores, part[found]]), k)
            if len(docs) == k:
                beat = max(beat, int(scores[-1]))  # later documents lose ties
        lo, width = hi, min(2 * width, 8192)
    if seen is not None:
        seen.append(opened)
    return docs, scores


FOUND = "query int, doc_id long, score long"


def _shard(index: pa.Table, sums: pa.Table, block: Block, weight: np.ndarray, long_list: np.ndarray, floors: np.ndarray, k: int) -> list[tuple[int, int | None, int]]:
    """All queries of a block against one shard: rows (row, doc_id, m, terms, tfs) and accumulators (query, row, part)."""
    ids = index.column("doc_id")
    known = ids.fill_null(0).to_numpy()
    row, order = index.column("row").to_numpy(), np.lexsort((index.column("row").to_numpy(), known, ids.is_null().to_numpy()))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    lists = index.column("terms").combine_chunks()
    term, tf = lists.flatten().to_numpy(), index.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(index.num_rows), lists.value_lengths().to_numpy())
    keep = long_list[term]
    term, tf, owner = term[keep], tf[keep], owner[keep]
    score = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * index.column("m").to_numpy()[owner]))
    by_term = np.lexsort((place[owner], term))
    term, doc, score = term[by_term], place[owner][by_term], score[by_term]
    # accumulators by query, then by place
    by_row = np.argsort(row)
    at = place[by_row[np.searchsorted(row[by_row], sums.column("row").to_numpy())]] if sums.num_rows else np.zeros(0, np.int64)
    query, part = sums.column("query").to_numpy(), sums.column("part").to_numpy()
    by_query = np.lexsort((at, query))
    query, at, part = query[by_query], at[by_query], part[by_query]
    out = []
    for q, held in enumerate(block.held):
        a, b = np.searchsorted(query, (q, q + 1))
        own = [(at[a:b], part[a:b])]
        for t in held:
            if long_list[t]:
                s, e = np.searchsorted(term, (t, t + 1))
                own.append((doc[s:e], score[s:e]))
        docs, scores = search(own, len(order), k, int(floors[q]))
        out += [(q, ids[int(order[d])].as_py(), int(s)) for d, s in zip(docs, scores, strict=True)]
    return out


def _search_block(docs: DataFrame, block: Block, k: int, short: int, shard_postings: int) -> DataFrame | None:
    spark = docs.sparkSession
    index = materialize(postings(docs, block.words))
    n_docs, n_terms = index.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    df = np.zeros(len(block.words), np.int64)  # one number per term of the block
    for b in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toArrow().to_batches():
        df[b["t"].to_numpy()] = b["df"].to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    index = index.select("row", "doc_id", F.expr(f"10 + (90 * n * {n_docs}L) div {n_terms}L").alias("m"), "terms", "tfs")

    # term at a time: short lists, summed per query and document
    brief = [(t, int(weight[t])) for t in np.flatnonzero((df > 0) & (df <= short) & (weight > 0)).tolist()]
    asked = [(t, q) for q, held in enumerate(block.held) for t in held]
    ask = spark.createDataFrame(asked, "t int, query int").join(spark.createDataFrame(brief, "t int, w long"), "t")
    ask = ask.groupBy("t", "w").agg(F.collect_list("query").alias("queries"))  # at most the block's queries
    each = index.select("row", "m", F.explode(F.arrays_zip("terms", "tfs")).alias("p")).select("row", "m", F.col("p.terms").alias("t"), F.col("p.tfs").cast("long").alias("tf"))
    scored = each.join(F.broadcast(ask), "t").select("row", F.explode("queries").alias("query"), F.expr("w * ((1000000000L * tf) div (1000 * tf + 8 * m))").alias("part"))
    sums = materialize(scored.groupBy("query", "row").agg(F.sum("part").alias("part")))
    top = Window.partitionBy("query").orderBy(F.desc("part"))
    kth = sums.withColumn("i", F.row_number().over(top)).where(F.col("i") <= k).groupBy("query").agg(F.min("part").alias("floor"), F.count(F.lit(1)).alias("n"))
    floors = np.ones(len(block.items), np.int64)
    for r in kth.where(F.col("n") == k).collect():  # one row per query of the block
        floors[r["query"]] = r["floor"]

    # document at a time: shards of long lists, each with its accumulators
    long_list = (df > short) & (weight > 0)
    shards = max(1, -(-int(df.sum()) // shard_postings), -(-sums.count() // shard_postings))
    shard = F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard")
    sent = spark.sparkContext.broadcast((block, weight, long_list, floors))

    def run(own: pa.Table, part: pa.Table) -> pa.Table:
        block, weight, long_list, floors = sent.value
        cols = list(zip(*_shard(own, part, block, weight, long_list, floors, k), strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["query", "doc_id", "score"])

    cells = index.select(shard, "row", "doc_id", "m", "terms", "tfs").groupBy("shard").cogroup(sums.select(shard, "query", "row", "part").groupBy("shard"))
    found = materialize(cells.applyInArrow(run, FOUND))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    items = spark.createDataFrame(list(enumerate(block.items)), "query int, item_id long")
    return ranked.join(F.broadcast(items), "query").select("item_id", "rank", "doc_id", "score")


RANKED = "item_id long, rank int, doc_id long, score long"


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = K, short: int = SHORT, shard_postings: int = SHARD_POSTINGS, block_bytes: int = QUERY_BYTES) -> DataFrame:
    """``(doc_id, text)`` and ``(item_id, text)`` -> ``(item_id, rank, doc_id, score)``: the k best documents per query."""
    parts = [_search_block(docs, block, k, short, shard_postings) for block in query_blocks(queries, block_bytes)]
    out = docs.sparkSession.createDataFrame([], RANKED)
    for part in parts:
        out = out if part is None else out.union(part)
    return out


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))

"""Document fingerprints by locally consistent parsing.

A text is a sequence of symbols that is parsed into phrases level by level, until one name is left. On each level runs
of one symbol are phrases of their own; between runs, symbols are relabelled by deterministic coin tossing (the lowest
bit in which a symbol differs from the one before it, with its value), four times, which leaves labels below 6; phrases
begin at local maxima of the labels. A phrase's name is a hash of its symbols and the symbol of the next level. Where a
phrase begins depends on a few neighbours only, so the interior of equal substrings is parsed alike at any offset, on
every level.

A fingerprint holds the ``SKETCH`` smallest hashed names of phrases from level ``FROM_LEVEL`` up (some 10 characters
and longer; always the last name, the whole text's) as 8 hexadecimal digits each. The likeness of two fingerprints is
2 J / (1 + J) with J their estimated Jaccard similarity: the share of phrases in common, 0.5 where half of the text is.

On Spark, documents are sorted by descending id with one range shuffle; within a partition the next document is the
next row of the stream, parsed in batches of a bounded number of characters. Only the first and last document of each
partition wait for a second, small step that joins neighbouring partitions.

Defined results: a null text counts as empty; the empty text has a fingerprint of its own; documents without an id come
last in the order, equal ids are ordered by a hash of the text; repeated rows are documents of their own; the last
document's next is the first, a single document is its own next; an empty table gives an empty result; extra columns
are ignored. A document is parsed in one piece: the memory of a task grows with its longest text (about 60 bytes a
character), not with the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagwise.session import materialize
from tagwise.sources.tables import table

SKETCH = 32
FROM_LEVEL = 2
BATCH_CHARS = 1 << 19
TOSSES = 4  # 64-bit names -> 128 -> 14 -> 8 -> 6 labels
# odd 64-bit multipliers of the names' hashes; any would do, the fingerprints depend on them
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_S29, _S32 = np.uint64(29), np.uint64(32)
_LONGEST = 64  # no phrase between runs is longer: at most some 12 symbols lie between local maxima of 6 labels
_POWERS = np.cumprod(np.full(_LONGEST, _A, np.uint64))
# place of the lowest set bit of 16 bits (of none: 0); label of a symbol below 128 (column) from the one before it (row):
# twice the lowest bit in which they differ, plus that bit's value
_LOW = np.array([max((x & -x).bit_length() - 1, 0) for x in range(1 << 16)], np.uint8)
_DIFFER = _LOW[np.arange(128)[:, None] ^ np.arange(128)]
_TOSS = (2 * _DIFFER + (np.arange(128) >> _DIFFER & 1)).astype(np.uint8).ravel()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _S32)) * _A
    x = (x ^ (x >> _S29)) * _B
    return x ^ (x >> _S32)


_MIXED = mix(np.arange(1 << 16, dtype=np.uint64))  # of the code points of the basic plane


def _labels(x: np.ndarray, fresh: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Coin tossing: labels below 6 that differ between neighbours. ``fresh`` marks symbols that have none before them;
    the labels of symbols in a ``run`` mean nothing."""
    low = x.astype(np.uint16)
    d = np.empty_like(low)
    d[0] = 1
    np.bitwise_xor(low[1:], low[:-1], out=d[1:])
    d[fresh] = 1
    bit = np.take(_LOW, d)
    label = 2 * bit + ((low >> bit) & 1).astype(np.uint8)
    far = np.flatnonzero((d == 0) & ~run)  # neighbours that differ in higher bits only
    if len(far):
        d = x[far] ^ x[far - 1]
        bit = (np.frexp((d & -d).astype(np.float64))[1] - 1).astype(np.uint64)
        label[far] = 2 * bit + ((x[far] >> bit) & np.uint64(1))
    before = np.empty(len(x), np.uint16)
    for _ in range(TOSSES - 1):
        before[0] = label[0] ^ 1
        before[1:] = label[:-1]
        before[fresh] = label[fresh] ^ 1
        before <<= 7
        before |= label
        label = np.take(_TOSS, before)
    return label


def parse(x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: symbols of concatenated sequences (``first`` marks each sequence's first symbol) -> the index of each
    phrase's first symbol and its name. Phrases do not cross sequences; a sequence of two or more gets shorter."""
    n = len(x)
    same = np.zeros(n + 1, bool)  # same[i]: equal to the symbol before, in one sequence
    same[1:n] = (x[1:] == x[:-1]) & ~first[1:]
    run = same[:-1] | same[1:]
    fresh = first.copy()  # a stretch without runs begins
    fresh[1:] |= run[:-1]
    fresh &= ~run
    label = _labels(x, fresh, run)
    begins = first | (run & ~same[:-1]) | fresh
    if n > 3:
        # local maxima, not the first two and not the last of a stretch
        up = label[1:] > label[:-1]
        peak = up[1:-1] & ~up[2:] & (label[2:-1] != label[3:])
        peak &= ~(run[2:-1] | begins[2:-1] | begins[3:] | fresh[1:-2])
        begins[2:-1] |= peak
    at = np.flatnonzero(begins)
    size = np.diff(at, append=n)
    place = np.arange(n, dtype=np.int32)
    place -= np.repeat(at.astype(np.int32), size)
    mixed = np.take(_MIXED, x) if int(x.max()) < len(_MIXED) else mix(x)
    name = np.add.reduceat(mixed * np.take(_POWERS, place, mode="clip"), at)
    whole = run[at]
    if whole.any():
        name[whole] = mixed[at[whole]] * _B + size[whole].astype(np.uint64) * _C
    return at, mix(name ^ _C)


def names(texts: list[str], from_level: int = FROM_LEVEL) -> tuple[np.ndarray, np.ndarray]:
    """(text, name) of all phrases from ``from_level`` up and of each text's last name."""
    sizes = np.array([len(t) for t in texts], np.int64)
    x = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    empty = np.flatnonzero(sizes == 0)
    found_owner, found = [empty], [np.full(len(empty), _C, np.uint64)]
    level = 0
    while len(x):
        first = np.ones(len(x), bool)
        first[1:] = owner[1:] != owner[:-1]
        alone = first & np.append(first[1:], True)
        if level >= from_level:
            found_owner.append(owner)
            found.append(x)
        elif alone.any():
            found_owner.append(owner[alone])
            found.append(mix(x[alone] + _A) if level == 0 else x[alone])
        if alone.any():
            x, owner, first = x[~alone], owner[~alone], first[~alone]
            if not len(x):
                break
        at, x = parse(x, first)
        owner = owner[at]
        level += 1
    return np.concatenate(found_owner), mix(np.concatenate(found))


def sketches(texts: list[str], size: int = SKETCH) -> list[np.ndarray]:
    """The ``size`` smallest distinct hashed names of each text, cut to 32 bits, ascending."""
    owner, name = names(texts)
    order = np.lexsort((name, owner))
    owner, name = owner[order], name[order]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
    owner, name = owner[new], (name[new] >> _S32).astype(np.uint32)
    begin = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [name[a : min(b, a + size)] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]


def shown(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    """Share of phrases in common, from the ``size`` smallest names of both together."""
    x, y = set(a.tolist()), set(b.tolist())
    least = sorted(x | y)[:size]
    both = sum(1 for v in least if v in x and v in y)
    return 2 * both / (len(least) + both)


def edited(text: str, following: str) -> str:
    """The last half of ``text`` (rounded down) replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
EDGES = f"{RESULT}, pid int, edge string, text string"
_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string())


def _pairs(ids: list[int | None], texts: list[str], own: list[np.ndarray]) -> list[tuple]:
    """Results of all but the last of consecutive documents."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    other = sketches(changed) if changed else []
    return [
        (i, len(t), sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), shown(a), shown(c), likeness(a, c), likeness(a, b))
        for i, t, e, a, b, c in zip(ids, texts, changed, own, own[1:], other, strict=False)
    ]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition in order -> results of all but its last document, which comes with its text like the first one."""
    ids: list[int | None] = []
    texts: list[str] = []
    own: list[np.ndarray] = []
    chars, begun, pid = 0, False, None

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [()] * len(_KINDS)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _KINDS, strict=True)], names=[c.split()[0] for c in EDGES.split(", ")])

    def flush() -> list[tuple]:
        own.extend(sketches(texts[len(own) :]))
        rows = [(*r, pid, None, None) for r in _pairs(ids, texts, own)]
        del ids[:-1], texts[:-1], own[:-1]
        return rows

    for b in batches:
        for i, text, pid in zip(*(x.to_pylist() for x in b.columns), strict=True):
            text = text or ""
            if not begun:
                begun = True
                yield batch([(i, len(text), None, None, None, None, None, pid, "first", text)])
            ids.append(i)
            texts.append(text)
            chars += len(text)
            if chars > BATCH_CHARS:
                yield batch(flush())
                chars = 0
    if begun:
        yield batch([*flush(), (ids[0], len(texts[0]), None, None, None, None, None, pid, "last", texts[0])])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(doc_id, text, following)`` -> results."""
    for b in batches:
        rows = []
        for i, text, following in zip(*(x.to_pylist() for x in b.columns), strict=True):
            rows += _pairs([i, None], [text, following], sketches([text, following]))
        cols = list(zip(*rows, strict=True)) or [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _KINDS[:7], strict=True)], names=[c.split()[0] for c in RESULT.split(", ")])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` -> one row per document, compared with its edited text and the next document by descending id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row", F.monotonically_increasing_id())
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("row")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    done = materialize(ranged.select("doc_id", "text", F.spark_partition_id().alias("pid")).mapInArrow(_stream, EDGES))
    # the partitions' edges: the last document of each with the first of the next that has rows, the very last with the very first
    edges = done.where("edge IS NOT NULL")
    begins = edges.where("edge = 'first'").select("pid")  # one row per partition
    chain = begins.select("pid", F.coalesce(F.lead("pid").over(Window.orderBy("pid")), F.min("pid").over(Window.partitionBy())).alias("next_pid"))
    last = edges.where("edge = 'last'").select("doc_id", "text", "pid").join(chain, "pid")
    following = edges.where("edge = 'first'").select(F.col("pid").alias("next_pid"), F.col("text").alias("following"))
    ends = last.join(following, "next_pid").select("doc_id", "text", "following").mapInArrow(_edges, RESULT)
    return done.where("edge IS NULL").select(*[c.split()[0] for c in RESULT.split(", ")]).union(ends)


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))

"""BPE encoding and decoding with tree concatenation.

White space never survives this kind of pre-tokenizer, and no match, normal form or special token spans a space or
line feed, so a text's ids are the ids of its chunks (runs without those two characters) in order. Chunks repeat, so
each worker keeps a bounded memo of the library's own answer per chunk.

Texts longer than ``leaf_chars`` are halved recursively, wherever the middle falls (also inside a word or an unsplit
run of any length). The leaves become rows that are encoded in parallel; then the leaves of a text are concatenated
pairwise up the tree. At each join a window around the seam is encoded again and grown until its first tokens agree
with the left side and its last tokens with the right side, in id and in place; if they never agree the window has
grown to both whole sides, which is the plain encoding. Agreement means that every adjacent pair of the spliced ids
occurs in an encoding of its own characters, which for merge ranks makes the splice the encoding of the whole.

Defined results: null counts as empty; empty and blank texts give no ids and an empty decoded text; equal rows give
equal results, once each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwise.sources.tables import table

VOCABULARY = "word_bpe_49k.json"
LEAF_CHARS = 1 << 14
MEMO = 800_000  # chunks, and pieces of chunks, that a worker remembers
SLICE = 64  # texts handled at once


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer, one per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


# fixed values: the pieces that this kind of pre-tokenizer makes of printable ASCII and Latin-1 letters in lower case;
# other characters are left to the library
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


class ChunkMemo:
    """ids (little-endian unsigned 32-bit) of chunks and of the pieces they consist of, at most MEMO of each."""

    def __init__(self, path: str):
        self.path, self.tok = path, tokenizer(path)
        self.ids: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def learn(self, chunks: list[str]) -> None:
        """Plain chunks are split into the pre-tokenizer's own pieces, which repeat far more often than chunks."""
        plain, split = PLAIN.fullmatch, PIECES.findall
        parts = [split(c.lower()) if plain(c) and "<|" not in c else [c] for c in chunks]
        new = set(chain.from_iterable(parts)).difference(self.pieces)
        if len(self.pieces) + len(new) > MEMO:
            self.pieces = {}
            new = set(chain.from_iterable(parts))
        self.pieces_of(list(new))
        get = self.pieces.__getitem__
        self.ids.update((c, get(p[0]) if len(p) == 1 else b"".join(map(get, p))) for c, p in zip(chunks, parts, strict=True))

    def pieces_of(self, pieces: list[str]) -> None:
        """Encode many pieces in one call, joined by spaces; a token belongs to the piece that holds its first character."""
        for at in range(0, len(pieces), 4096):
            part = pieces[at : at + 4096]
            e = self.tok.encode(" ".join(part), add_special_tokens=False)
            begin = np.cumsum([0] + [len(c) + 1 for c in part[:-1]])
            cut = [*np.searchsorted([x for x, _ in e.offsets], begin, "left").tolist(), len(e.ids)]
            raw = np.array(e.ids, "<u4").tobytes()
            self.pieces.update(zip(part, (raw[4 * i : 4 * j] for i, j in zip(cut, cut[1:], strict=False)), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        known = set().union(*split)
        new = known.difference(self.ids)
        if len(self.ids) + len(new) > MEMO:
            self.ids, new = {}, known
        self.learn(list(new))
        get = self.ids.__getitem__
        return [b"".join(map(get, s)) for s in split]


@lru_cache(maxsize=4)
def memo(path: str) -> ChunkMemo:
    return ChunkMemo(path)


# --- tree concatenation -----------------------------------------------------------------------------------------

Part = tuple[str, np.ndarray, np.ndarray]  # characters of one chunk, its ids, the first character of each id


def encode_chunk(path: str, chunk: str) -> Part:
    e = tokenizer(path).encode(chunk, add_special_tokens=False)
    return chunk, np.array(e.ids, np.uint32), np.array([s for s, _ in e.offsets], np.int64)


def _fresh(starts: np.ndarray, i: int) -> bool:
    """Whether id ``i`` is the first of its character."""
    return i == 0 or starts[i] != starts[i - 1]


def concat_parts(path: str, x: Part, y: Part, window: int = 32) -> Part:
    """Encoding of ``x + y`` (one chunk) from the encodings of both."""
    (xt, xi, xs), (yt, yi, ys) = x, y
    if not xt or not yt:
        return x if not yt else y
    n = len(xt)
    ys = ys + n
    while True:
        i = int(np.searchsorted(xs, max(n - window, 0), "right")) - 1
        while i > 0 and (not _fresh(xs, i) or xt[xs[i]] == "'"):
            i -= 1
        p = int(xs[i]) if i > 0 else 0
        j = int(np.searchsorted(ys, n + window, "left"))
        while j < len(ys) and not _fresh(ys, j):
            j += 1
        q = int(ys[j]) if j < len(ys) else n + len(yt)
        _, wi, ws = encode_chunk(path, xt[p:] + yt[: q - n])
        ws = ws + p
        whole_left, whole_right = p == 0, q == n + len(yt)
        # left side: the first two ids of the window are those of x at the same places, and x's lie clear of the seam
        left = whole_left or (
            len(wi) > 2 and i + 2 < len(xi) and (wi[:2] == xi[i : i + 2]).all() and (ws[:3] == xs[i : i + 3]).all() and _fresh(xs, i + 2)
        )
        # right side: two ids in a row that window and y share in id and place, before the window's own end
        cut = None if whole_right else _agreement(wi, ws, yi[:j], ys[:j], n)
        if left and (whole_right or cut is not None):
            a, b = (len(wi), len(yi)) if cut is None else cut
            i = 0 if whole_left else i
            return xt + yt, np.concatenate([xi[:i], wi[:a], yi[b:]]), np.concatenate([xs[:i], ws[:a], ys[b:]])
        window *= 4


def _agreement(wi: np.ndarray, ws: np.ndarray, yi: np.ndarray, ys: np.ndarray, seam: int) -> tuple[int, int] | None:
    """First positions (in window, in y) past the seam from which two ids agree, with more of the window to follow."""
    at = {int(s): k for k, s in enumerate(ys) if _fresh(ys, k)}
    for a in range(len(wi) - 3):
        b = at.get(int(ws[a])) if ws[a] > seam and _fresh(ws, a) else None
        if b is not None and b + 2 < len(yi) and (wi[a : a + 2] == yi[b : b + 2]).all() and (ws[a : a + 3] == ys[b : b + 3]).all():
            return a, b
    return None


Node = tuple[Part, bytes, "Part | None"]  # first chunk, ids between, last chunk (None: the node is one chunk)


def encode_leaf(path: str, leaf: str) -> Node:
    chunks = leaf.replace("\n", " ").split(" ")
    head = encode_chunk(path, chunks[0])
    if len(chunks) == 1:
        return head, b"", None
    mid = memo(path).encode([" ".join(chunks[1:-1])])[0]
    return head, mid, encode_chunk(path, chunks[-1])


def _raw(p: Part) -> bytes:
    return p[1].astype("<u4").tobytes()


def concat_nodes(path: str, a: Node, b: Node) -> Node:
    (ah, am, at), (bh, bm, bt) = a, b
    joined = concat_parts(path, at or ah, bh)
    if at is None:
        return (joined, bm, bt) if bt else (joined, b"", None)
    if bt is None:
        return ah, am, joined
    return ah, am + _raw(joined) + bm, bt


def concat_tree(path: str, nodes: list[Node]) -> bytes:
    while len(nodes) > 1:
        nodes = [concat_nodes(path, *nodes[i : i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
    head, mid, tail = nodes[0]
    return _raw(head) + mid + (_raw(tail) if tail else b"")


def decode(path: str, ids: bytes) -> str:
    """The library's decode(ids, skip_special_tokens=False): without a decoder, the tokens joined by spaces."""
    names = token_names(path)
    return " ".join(map(names.__getitem__, array("I", ids)))


@lru_cache(maxsize=4)
def token_names(path: str) -> list[str]:
    tok = tokenizer(path)
    assert tok.decoder is None, "decode() joins tokens by spaces, which holds for vocabularies without a decoder"
    return [tok.id_to_token(i) for i in range(tok.get_vocab_size())]


# --- on tables --------------------------------------------------------------------------------------------------


def _pack(p: Part | None) -> dict[str, Any] | None:
    return p and {"text": p[0], "ids": p[1].astype("<u4").tobytes(), "starts": p[2].astype("<i8").tobytes()}


def _unpack(d: dict[str, Any] | None) -> Part | None:
    return d and (d["text"], np.frombuffer(d["ids"], "<u4"), np.frombuffer(d["starts"], "<i8"))


PART = "struct<text:string,ids:binary,starts:binary>"


def encode_decode(docs: DataFrame, path: str | None = None, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``(doc_id, text)`` -> ``(doc_id, ids binary, decoded string)``; ids are little-endian unsigned 32-bit.

    ``ids_array`` turns the binary into an array. Texts of more than two leaves take the tree path: equal long texts
    are encoded once, and their result is joined back by content hash.
    """
    path = path or public_path(VOCABULARY)
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select("doc_id", text.alias("text"))
    is_long = F.length("text") > 2 * leaf_chars

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, SLICE):
                part = b.slice(k, SLICE)
                ids = memo(path).encode(part.column(1).to_pylist())
                decoded = pa.array([decode(path, x) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), decoded], names=["doc_id", "ids", "decoded"])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 4):
                part = b.slice(k, 4)
                nodes = [encode_leaf(path, t) for t in part.column(2).to_pylist()]
                rows = [{"head": _pack(h), "mid": m, "tail": _pack(t)} for h, m, t in nodes]
                arrays = [pa.array([r[c] for r in rows], kind) for c, kind in _NODE.items()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *arrays], names=["blob", "leaf", *_NODE])

    def join(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("leaf").to_pylist()
        ids = concat_tree(path, [(_unpack(r["head"]), r["mid"], _unpack(r["tail"])) for r in rows])
        return pa.table({"blob": [rows[0]["blob"]], "ids": pa.array([ids], pa.binary()), "decoded": [decode(path, ids)]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    short = docs.where(~is_long).mapInArrow(whole, f"doc_id {kind}, ids binary, decoded string")
    long = docs.where(is_long).withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))
    halves = F.pow(F.lit(2), F.ceil(F.log2(F.length("text") / F.lit(leaf_chars)))).cast("int")
    cut = lambda k: F.floor(F.length("text") * k.cast("long") / F.col("n")).cast("int")
    pieces = (
        long.dropDuplicates(["blob"])
        .withColumn("n", halves)
        .withColumn("leaf", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .select("blob", "leaf", F.substring("text", cut(F.col("leaf")) + 1, cut(F.col("leaf") + 1) - cut(F.col("leaf"))).alias("text"))
    )
    nodes = pieces.repartition("blob", "leaf").mapInArrow(leaves, f"blob string, leaf int, head {PART}, mid binary, tail {PART}")
    joined = nodes.groupBy("blob").applyInArrow(join, "blob string, ids binary, decoded string")
    return short.union(long.select("doc_id", "blob").join(joined, "blob").select("doc_id", "ids", "decoded"))


_P = pa.struct([("text", pa.string()), ("ids", pa.binary()), ("starts", pa.binary())])
_NODE = {"head": _P, "mid": pa.binary(), "tail": _P}


def ids_array(ids: bytes) -> list[int]:
    return list(chain(np.frombuffer(ids, "<u4").tolist()))


def op6_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = encode_decode(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )

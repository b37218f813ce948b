"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents are cut into pieces of at most ``capacity`` tokens; pieces of exactly the capacity fill a sequence alone.
The others are dealt at random into blocks of about ``block_items``. Every block evolves on several islands (one row
group per block and island): an individual is a partition of the block's pieces into bins, crossover injects whole
well-filled bins of one parent into the other, bins that now hold a piece twice are dissolved, and their displaced
pieces are placed again by best fit. After each epoch every island sends its elite to the next island of its block.
A block stops as soon as it meets the lower bound on the number of bins. The best individual of a block is kept;
bins that it could not fill are pooled over all blocks and dealt anew, until one block is left, so what remains
unfilled does not grow with the number of blocks.

Defined results: null and empty texts are pieces with only the end id; ties in fitness go to the older individual;
equal rows are separate pieces; a null doc_id stays null; extra columns are ignored; an empty table packs nothing.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwise.llm.bpe import public_path, tokenizer
from tagwise.session import materialize
from tagwise.sources.tables import table

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
END = 0
BLOCK_ITEMS = 8192
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 6
LEVELS = 4  # how often open bins are pooled and dealt anew
MEMO = 800_000

# --- token ids ---------------------------------------------------------------------------------------------------

# fixed values: runs of white space beyond one plain space or line feed between words; texts that hold one are
# encoded whole, since only at a single separator a chunk's ids do not depend on its neighbours
RUNS = ("  ", "\n\n", " \n", "\n ")
OTHER_SPACE = [
    chr(c)
    for c in (0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
]


# fixed value: the pattern by which byte-level pre-tokenization splits
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteChunks:
    """ids of texts under a byte-level vocabulary, by a bounded memo of the library's ids per word with its space."""

    def __init__(self, path: str):
        self.tok = tokenizer(path)
        names = [self.tok.id_to_token(i) for i in range(self.tok.get_vocab_size())]
        # byte-level names of a space and a line feed; in plain texts they only begin a chunk
        self.opens = np.array([n[:1] in ("\u0120", "\u010a") for n in names])
        self.feed = names.index("\u010a")
        self.ranks = self._by_ranks(json.loads(self.tok.to_str())["model"], names)
        self.forget()

    def _by_ranks(self, model: dict, names: list[str]):
        """The same encoding by token ranks, several times as fast, where the merges make tokens in the order of their
        ids; else the library's own."""
        import tiktoken

        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        plain = {n: i for i, n in enumerate(names) if n not in special}
        made = [plain["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if made != sorted(set(made)) or len(made) + 256 != len(plain) or min(made) != 256:
            return lambda text: self.tok.encode(text, add_special_tokens=False).ids
        ranks = {bytes(byte[c] for c in n): i for n, i in plain.items()}
        coder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: coder.encode(text, allowed_special="all")

    def forget(self) -> None:
        space = np.array(self.tok.encode(" ", add_special_tokens=False).ids, "<u4").tobytes()
        self.ids: dict[str, bytes] = {"": space}

    def plain(self, t: str) -> bool:
        if any(r in t for r in RUNS) or t[:1] in (" ", "\n", ""):
            return False
        return not any(c in t for c in (OTHER_SPACE[:8] if t.isascii() else OTHER_SPACE))

    def encode_many(self, chunks: list[str]) -> list[bytes]:
        """ids of many chunks by one call: each follows a space, or its own line feed; their tokens start with it."""
        out = []
        for at in range(0, len(chunks), 4096):
            part = chunks[at : at + 4096]
            ids = np.array(self.ranks("".join(c if c[:1] == "\n" else " " + c for c in part)), "<u4")
            raw, cut = ids.tobytes(), [*np.flatnonzero(self.opens[ids]).tolist(), len(ids)]
            out += [raw[4 * i : 4 * j] for i, j in zip(cut, cut[1:], strict=False)]
        return out

    def encode_first(self, chunks: list[str]) -> list[bytes]:
        """ids of chunks that begin a text (no space before them), one a line; the line feeds' own tokens are cut."""
        ids = np.array(self.ranks("\n".join(chunks)), "<u4")
        raw, cut = ids.tobytes(), [-1, *np.flatnonzero(ids == self.feed).tolist(), len(ids)]
        return [raw[4 * (i + 1) : 4 * j] for i, j in zip(cut, cut[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " \n").split(" ") if self.plain(t) else None for t in texts]
        known = set().union(*(s[1:] for s in split if s))
        new = known.difference(self.ids)
        if len(self.ids) + len(new) > MEMO:
            self.forget()
            new = known.difference(self.ids)
        todo = list(new)
        self.ids.update(zip(todo, self.encode_many(todo), strict=True))
        get = self.ids.__getitem__
        plain = [s[0] for s in split if s]
        first = iter(self.encode_first(plain) if plain else ())
        return [
            next(first) + b"".join(map(get, s[1:])) if s else np.array(self.tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            for s, t in zip(split, texts, strict=True)
        ]


@lru_cache(maxsize=2)
def byte_chunks(path: str) -> ByteChunks:
    return ByteChunks(path)


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Piece lengths of ``n`` tokens: all full but the first, which holds the rest."""
    full, rest = divmod(n, capacity)
    return ([rest] if rest else []) + [capacity] * full


PIECE = "piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``(doc_id, text)`` -> one row per piece: doc_id, piece, start, length, ids_crc32 (of little-endian ids)."""
    path = path or public_path(VOCABULARY)
    stop = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                row, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(byte_chunks(path).encode([t or "" for t in part.column(1).to_pylist()])):
                    ids += stop
                    at = 0
                    for j, n in enumerate(cut_lengths(len(ids) // 4, capacity)):
                        row.append(i)
                        piece.append(j)
                        start.append(at)
                        length.append(n)
                        crc.append(zlib.crc32(ids[4 * at : 4 * (at + n)]))
                        at += n
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {PIECE}")


# --- one island --------------------------------------------------------------------------------------------------


def best_fit(items: np.ndarray, lengths: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Place ``items`` (longest first) into the open bin that they fill best, else into a new one.

    ``bins`` (bin of each item) and ``room`` (free tokens of each bin) change in place. Open bins are kept by room,
    with one bit per room that has a bin, so the tightest bin is the lowest set bit from the item's length on.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, r in enumerate(room):
        if r > 0:
            by_room[r].append(b)
            mask |= 1 << r
    for i in items[np.argsort(-lengths[items], kind="stable")].tolist():
        n = int(lengths[i])
        above = mask >> n
        if above:
            r = n + (above & -above).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                mask &= ~(1 << r)
        else:
            b, r = len(room), capacity
            room.append(capacity)
        bins[i] = b
        room[b] = r = r - n
        if r:
            by_room[r].append(b)
            mask |= 1 << r


def compact(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fills(bins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.bincount(bins, weights=lengths).astype(np.int64)


def fitness(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> float:
    """Fewer bins first; among equals, the fuller the full bins the better (mean squared fill)."""
    f = fills(bins, lengths) / capacity
    return -len(f) + float((f * f).mean())


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No partition has fewer bins: by volume, and by pieces too long to share a bin with pieces of size k or more."""
    best = -(-int(lengths.sum()) // capacity)
    s = np.sort(lengths)
    total = np.concatenate([[0], np.cumsum(s)])
    for k in np.unique(np.linspace(0, capacity // 2, 65).astype(int)):
        lo, mid, hi = np.searchsorted(s, [k, capacity // 2 + 1, capacity - k + 1], "left")
        middle = int(total[hi] - total[lo])
        best = max(best, int(len(s) - mid) + max(0, -(-(middle - int(hi - mid) * capacity) // capacity)))
    return best


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Child of ``a`` with a share of ``b``'s best-filled bins injected whole."""
    f = fills(b, lengths)
    order = np.argsort(-(f + rng.random(len(f))), kind="stable")[: max(1, len(f) // 2)]
    inject = np.zeros(len(f), bool)
    inject[rng.choice(order, max(1, len(f) // 8), replace=False)] = True
    new = inject[b]
    gone = np.zeros(int(a.max()) + 1, bool)
    gone[a[new]] = True  # bins of a that hold an injected piece are dissolved
    # besides, the emptiest bins of a are dissolved, so that their pieces get another chance to fill others
    fa = fills(a, lengths)
    gone[np.argsort(fa, kind="stable")[: max(1, len(fa) // 50)]] = True
    displaced = np.flatnonzero(gone[a] & ~new)
    child = a.copy()
    child[new] = len(gone) + b[new]
    stays = np.ones(len(a), bool)
    stays[displaced] = False
    child[stays] = compact(child[stays])
    room = (capacity - fills(child[stays], lengths[stays])).tolist()
    best_fit(displaced, lengths, child, room, capacity)
    return compact(child)


def first_individual(lengths: np.ndarray, capacity: int, rng: np.random.Generator | None) -> np.ndarray:
    """Best-fit decreasing; with ``rng``, a random third of the pieces is placed first, for a varied population."""
    bins, room, every = np.zeros(len(lengths), np.int64), [], np.arange(len(lengths))
    if rng is not None:
        early = rng.random(len(lengths)) < 1 / 3
        best_fit(every[early], lengths, bins, room, capacity)
        every = every[~early]
    best_fit(every, lengths, bins, room, capacity)
    return compact(bins)


def evolve(lengths: np.ndarray, people: list[np.ndarray], seed: int, capacity: int = CAPACITY, population: int = POPULATION, generations: int = GENERATIONS):
    """Population after ``generations`` steady-state generations, best first; ends early at the lower bound."""
    rng = np.random.default_rng(seed)
    bound = lower_bound(lengths, capacity)
    people = list(people) or [first_individual(lengths, capacity, None)]
    score = [fitness(p, lengths, capacity) for p in people]
    for _ in range(population + generations * population):
        if -int(np.floor(max(score))) <= bound:
            break
        if len(people) < population:
            child = first_individual(lengths, capacity, rng)
        else:
            x, y = (max(rng.choice(len(people), 2, replace=False).tolist(), key=lambda i: score[i]) for _ in range(2))
            child = crossover(people[x], people[y], lengths, capacity, rng)
        people.append(child)
        score.append(fitness(child, lengths, capacity))
        keep = sorted(range(len(people)), key=lambda i: -score[i])[:population]
        people, score = [people[i] for i in keep], [score[i] for i in keep]
    return people, score, bound


# --- islands on Spark --------------------------------------------------------------------------------------------

STATE = "block long, island int, rank int, score double, done boolean, ids array<long>, lengths array<int>, bins array<int>"


def _state(block: int, island: int, ids: np.ndarray, lengths: np.ndarray, evolved: Any) -> pa.Table:
    people, score, bound = evolved
    n = len(people)
    done = -int(np.floor(score[0])) <= bound
    return pa.table(
        {
            "block": pa.array([block] * n, pa.int64()),
            "island": pa.array([island] * n, pa.int32()),
            "rank": pa.array(range(n), pa.int32()),
            "score": pa.array(score, pa.float64()),
            "done": pa.array([done] * n),
            "ids": pa.array([ids] * n, pa.list_(pa.int64())),
            "lengths": pa.array([lengths.astype(np.int32)] * n, pa.list_(pa.int32())),
            "bins": pa.array([p.astype(np.int32) for p in people], pa.list_(pa.int32())),
        }
    )


def _two_arguments(f: Any, first: Any) -> Any:
    """``f`` with its first argument bound, in the form that grouped functions must have."""
    return lambda key, rows: f(first, key, rows)


def _evolve_blocks(items: DataFrame, capacity: int, islands: int, epochs: int) -> DataFrame:
    """``(block, id, length)`` -> ``(block, id, length, bin)``: the best individual of each block."""

    def begin(key: Any, rows: pa.Table) -> pa.Table:
        block, island = (k.as_py() for k in key)
        rows = rows.sort_by("id")
        ids, lengths = rows["id"].to_numpy(), rows["length"].to_numpy().astype(np.int64)
        return _state(block, island, ids, lengths, evolve(lengths, [], 1000 * block + island, capacity))

    def go_on(epoch: int, key: Any, rows: pa.Table) -> pa.Table:
        block, island = (k.as_py() for k in key)
        rows = rows.sort_by([("score", "descending"), ("rank", "ascending")])
        if rows["done"][0].as_py():
            return rows.select([c.split()[0] for c in STATE.split(", ")]).slice(0, 1)
        ids, lengths = (rows[c][0].values.to_numpy().astype(np.int64) for c in ("ids", "lengths"))
        people = [b.values.to_numpy() for b in rows["bins"]]
        return _state(block, island, ids, lengths, evolve(lengths, people, 1000 * block + island + 7919 * epoch, capacity))

    isles = items.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    state = isles.groupBy("block", "island").applyInArrow(begin, STATE)
    for epoch in range(1, epochs):
        # migration: each island's elite also goes to the next island of its block
        elite = state.where("rank = 0").withColumn("island", ((F.col("island") + 1) % islands).cast("int"))
        state = state.union(elite).groupBy("block", "island").applyInArrow(_two_arguments(go_on, epoch), STATE)
    lead = state.where("rank = 0").groupBy("block").agg(F.max_by(F.struct("ids", "lengths", "bins"), F.struct("score", -F.col("island"))).alias("s"))
    return lead.select("block", F.explode(F.arrays_zip("s.ids", "s.lengths", "s.bins")).alias("x")).select(
        "block", F.col("x.ids").alias("id"), F.col("x.lengths").cast("long").alias("length"), F.col("x.bins").alias("bin")
    )


def pack(items: DataFrame, capacity: int = CAPACITY, block_items: int = BLOCK_ITEMS, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``(id long, length long)`` with unique ids and lengths 1 to ``capacity`` -> ``(id, sequence_id, offset)``."""
    placed = items.where(F.col("length") >= capacity).select("id", (-F.col("id") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = items.where(F.col("length") < capacity).select("id", "length")
    base, left = 0, rest.count()
    for level in range(1, LEVELS + 1):
        if not left:
            break
        blocks = -(-left // block_items)
        dealt = rest.select(F.pmod(F.xxhash64("id", F.lit(level)), F.lit(blocks)).alias("block"), "id", "length")
        done = materialize(_evolve_blocks(dealt, capacity, islands, epochs))
        fill = done.groupBy("block", "bin").agg(F.sum("length").alias("fill"), F.collect_list(F.struct("id", "length")).alias("of"))
        # offsets within a bin: running length over its pieces (a bin holds at most `capacity` of them)
        laid = F.aggregate(
            F.array_sort("of"),
            F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<id:bigint,offset:bigint>>").alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["length"]).alias("at"), F.concat(acc["out"], F.array(F.struct(x["id"].alias("id"), acc["at"].alias("offset")))).alias("out")
            ),
            lambda acc: acc["out"],
        )
        rest = materialize(fill.where(F.col("fill") < capacity).select(F.explode("of").alias("x")).select("x.id", "x.length"))
        now = rest.count()
        # pieces that leave most bins open are too long to share; dealing them anew would not close more
        last = blocks == 1 or level == LEVELS or now > 0.9 * left
        fixed = (fill if last else fill.where(F.col("fill") >= capacity)).select(
            (F.lit(base) + F.col("block") * (1 << 20) + F.col("bin")).alias("sequence_id"), F.explode(laid).alias("x")
        )
        placed = placed.union(fixed.select("x.id", "sequence_id", "x.offset"))
        if last:
            break
        base, left = base + (blocks << 20), now
    return placed


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


def packed_documents(docs: DataFrame) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    pieces = materialize(token_pieces(docs).withColumn("id", F.monotonically_increasing_id()))
    where = pack(pieces.select("id", "length"))
    return pieces.join(where, "id").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

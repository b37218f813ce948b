"""Merkle dataset manifest: digests, inclusion proofs and their check by cogrouped subtree exchange.

Leaves form one tree per group (three children a node, the last run may be shorter); the groups' roots form one tree
over the groups. A tree is cut into superblocks of 3^LEVELS nodes, which reduce to one node each:

1. climb: superblocks are reduced bottom-up by aggregates, one table per LEVELS levels, until every tree is one node;
2. exchange: top-down, the nodes of a superblock and the outer nodes it needs (the siblings on the way from its own
   node to the root) are cogrouped by superblock in ``applyInPandas``. One call finishes the local reduction, joins
   local and outer siblings into each node's proof and, for leaves, folds the proof with the leaf in question.

Positions come from a range sort with per-partition counts, so a group of any size is spread over all tasks and no
task holds more than a few superblocks at once; small groups share a cogroup. Broadcast are only tables of one row per
partition; everything else is left to Spark's own size check.

Defined results: rows without a source are a group of their own, the first; rows without an id come first in their
group; rows that share an id are ordered by their leaf; repeated rows are leaves of their own; an empty table gives an
empty result; columns of the input beyond the leaf's fields are ignored. A row without an id is not tampered with.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagwise.operators.indexing import dense_index
from tagwise.session import materialize
from tagwise.sources.tables import table

FAN = 3
LEVELS = 7
_LOCAL_BITS = (1 << 33) - 1  # monotonically_increasing_id = partition id << 33 | position in partition


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def _placed(leaves: DataFrame) -> tuple[DataFrame, int, int]:
    """Every leaf with its tree, position, and the tree's size and start; the number of trees and the largest size.

    ``leaves``: name, item, leaf, tampered. Equal rows keep apart by their place in the written table, so a hot group of
    copies is split over range partitions like any other rows.
    """
    rows = materialize(leaves).withColumn("row_key", F.monotonically_increasing_id())
    order = ["name", "item", "leaf", "row_key"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    here = F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_BITS))
    ranged = materialize(ranged.select("name", "item", "leaf", "tampered", F.spark_partition_id().alias("pid"), here.alias("at")))
    runs = materialize(ranged.groupBy("pid", "name").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")))
    sizes = runs.groupBy("pid").agg(F.sum("n").alias("size"))  # one row per partition
    offsets = sizes.select("pid", (F.sum("size").over(Window.orderBy("pid")) - F.col("size")).alias("offset"))
    placed = runs.join(F.broadcast(offsets), "pid")
    trees = materialize(placed.groupBy("name").agg(F.sum("n").alias("n"), F.min(F.col("offset") + F.col("first")).alias("start")))
    n_trees, largest = trees.agg(F.count(F.lit(1)), F.max("n")).first()
    trees = materialize(dense_index(trees, "name", "tree", n_trees).withColumn("tree", F.col("tree").cast("long")))
    before = F.sum("n").over(Window.partitionBy("name").orderBy("pid")) - F.col("n")
    runs = runs.select("pid", "name", (before - F.col("first")).alias("shift"))
    homes = materialize(runs.join(trees, "name").select("pid", "name", "shift", "tree", "n", "start"))
    nodes = ranged.join(homes, ["pid", "name"]).select("tree", (F.col("at") + F.col("shift")).alias("pos"), "n", "start", F.col("leaf").alias("node"), "item", "tampered")
    return nodes, n_trees, largest or 0


def _height(n: Column, levels: int) -> Column:
    """Levels that a superblock of a tree of ``n`` nodes is reduced by."""
    return sum(((n > FAN**j).cast("int") for j in range(levels)), F.lit(0))


def climb(nodes: DataFrame, levels: int) -> DataFrame:
    """Superblocks ``(tree, pos, n, start, node)`` -> their nodes, one row each; ``base`` is the start one table below."""
    up = lambda row: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(row) - 1) / FAN).cast("int")),
        lambda i: F.sha2(F.array_join(F.slice(row, i * FAN + 1, FAN), "").cast("binary"), 256),
    )
    block = FAN**levels
    blocks = nodes.groupBy("tree", F.expr(f"pos div {block}").alias("block"), "n", "start").agg(F.array_sort(F.collect_list(F.struct("pos", "node"))).alias("own"))
    row = F.transform("own", lambda x: x["node"]).cast("array<string>")
    h = _height(F.col("n"), levels)
    top = F.when(h > 0, F.aggregate(F.sequence(F.lit(1), h), row, lambda acc, _: up(acc).cast("array<string>"))).otherwise(row)
    return blocks.select(
        "tree",
        F.col("block").alias("pos"),
        F.expr(f"(n + {block - 1}) div {block}").alias("n"),
        F.expr(f"start div {block}").alias("start"),
        F.element_at(top, 1).alias("node"),
        F.col("start").alias("base"),
    )


def _tables(nodes: DataFrame, largest: int, levels: int) -> list[DataFrame]:
    """The node tables of all trees above ``nodes``, the last with one node per tree."""
    out = []
    while True:
        nodes = materialize(climb(nodes, levels))
        out.append(nodes)
        largest = -(-largest // FAN**levels)
        if largest <= 1:
            return out


def _cell(start: str, big: str, block: str, size: int) -> list[Column]:
    """Key of a superblock; the trees that fit one are dealt into shared cells by the place where they start."""
    home = F.when(F.expr(big), F.col("tree")).otherwise(F.expr(f"({start} + tree) div {size}"))
    return [home.alias("home"), F.when(F.expr(big), F.expr(block)).otherwise(F.lit(-1)).alias("part")]


def _around(row: list[str], height: int) -> list[list[tuple[str, str]]]:
    """For each level and node the siblings to its left and right, joined."""
    out = []
    for _ in range(height):
        runs = [row[i : i + FAN] for i in range(0, len(row), FAN)]
        out.append([("".join(r[:j]), "".join(r[j + 1 :])) for r in runs for j in range(len(r))])
        row = [digest("".join(r)) for r in runs]
    return out


def _way(around: list[list[tuple[str, str]]], i: int, lefts: list[str], rights: list[str]) -> tuple[list[str], list[str]]:
    a, b = [], []
    for level in around:
        left, right = level[i]
        a.append(left)
        b.append(right)
        i //= FAN
    return a + lefts, b + rights


def _superblocks(nodes: pd.DataFrame, outer: pd.DataFrame, levels: int):
    """Each superblock of a cell: its rows in order, the ways of its nodes to the root, and its outer row."""
    known = {int(o.tree): o for o in outer.itertuples(index=False)}
    for tree, own in nodes.groupby("tree", sort=False):
        own = own.sort_values("pos", kind="stable")
        o = known[int(tree)]
        height = sum(int(own["n"].iloc[0]) > FAN**j for j in range(levels))
        around = _around(own["node"].tolist(), height)
        lefts, rights = list(o.lefts), list(o.rights)
        yield own, [_way(around, i, lefts, rights) for i in range(len(own))], o


WAYS = "tree long, pos long, n long, start long, base long, node string, lefts array<string>, rights array<string>, subroot string, root string"


def _ways(nodes: pd.DataFrame, outer: pd.DataFrame, levels: int) -> pd.DataFrame:
    out = []
    for own, ways, o in _superblocks(nodes, outer, levels):
        for r, (lefts, rights) in zip(own.itertuples(index=False), ways, strict=True):
            out.append((r.tree, r.pos, r.n, r.start, r.base, r.node, lefts, rights, o.subroot, o.root))
    return pd.DataFrame(out, columns=[c.split()[0] for c in WAYS.split(", ")])


PROOFS = "item string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proofs(nodes: pd.DataFrame, outer: pd.DataFrame, levels: int) -> pd.DataFrame:
    out = []
    for own, ways, o in _superblocks(nodes, outer, levels):
        for item, leaf, tampered, (lefts, rights) in zip(own["item"], own["node"], own["tampered"], ways, strict=True):
            node = tampered if isinstance(tampered, str) else leaf
            for a, b in zip(lefts, rights, strict=True):
                node = digest(a + node + b)
            proof = digest("".join([x for pair in zip(lefts, rights, strict=True) for x in pair]))
            out.append((item, leaf, o.subroot, o.root, proof, node, node == o.root))
    return pd.DataFrame(out, columns=[c.split()[0] for c in PROOFS.split(", ")])


def exchange(nodes: DataFrame, outer: DataFrame, run, schema: str, levels: int) -> DataFrame:
    """Cogroup the nodes of each superblock with its outer row, the way of the superblock's own node to the root."""
    size = FAN**levels
    here = nodes.select("*", *_cell("start", f"n > {size}", f"pos div {size}", size))
    above = outer.select("tree", "lefts", "rights", "subroot", "root", *_cell("base", "n > 1", "pos", size))
    cells = here.groupBy("home", "part").cogroup(above.groupBy("home", "part"))
    return cells.applyInPandas(lambda own, around: run(own, around, levels), schema)


def _no_way() -> Column:
    return F.array().cast("array<string>")


def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``(name, item, leaf, tampered)`` -> one row per leaf: item (as text), leaf, subroot, root, proof_sha256, folded_root, verified.

    ``name`` orders the trees (UTF-8 bytewise, not null), ``item`` the leaves of a tree (null first), ``tampered`` is the
    leaf to be folded instead of ``leaf`` (null: ``leaf`` itself). The digest of the siblings stands for the proof.
    """
    spark = leaves.sparkSession
    nodes, n_trees, largest = _placed(leaves)
    if not n_trees:
        return spark.createDataFrame([], PROOFS)
    tables = _tables(nodes.drop("item", "tampered"), largest, levels)
    # the tree over the trees: its leaves are the subroots
    subroots = tables[-1].select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(n_trees).cast("long").alias("n"), F.lit(0).cast("long").alias("start"), "node", "base",
    )
    over = _tables(subroots.drop("base"), n_trees, levels)
    outer = over[-1].select("*", _no_way().alias("lefts"), _no_way().alias("rights"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
    for level in reversed(over[:-1]):
        outer = exchange(level, outer, _ways, WAYS, levels)
    outer = exchange(subroots, outer, _ways, WAYS, levels)
    outer = outer.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), F.lit(1).cast("long").alias("n"), "base", "lefts", "rights", F.col("node").alias("subroot"), "root")
    for level in reversed(tables[:-1]):
        outer = exchange(level, materialize(outer), _ways, WAYS, levels)
    return exchange(nodes.withColumn("item", F.col("item").cast("string")), materialize(outer), _proofs, PROOFS, levels)


def document_leaves(docs: DataFrame) -> DataFrame:
    """The leaves of ``documents``: one per row, grouped by source; tampering deletes the line feeds of every document
    whose id has an even CRC-32."""
    own = lambda text: leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.col("text").contains("\n")
    return docs.select(
        F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), "source")).alias("name"),
        F.col("doc_id").cast("long").alias("item"),
        own(F.col("text")).alias("leaf"),
        F.when(hit, own(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).alias("tampered"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents, with the proof of every document checked against its tampered text."""
    found = manifest(document_leaves(table(spark, sf_dir, "documents")))
    return found.select(F.col("item").cast("long").alias("doc_id"), *[c.split()[0] for c in PROOFS.split(", ")[1:]])

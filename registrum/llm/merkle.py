"""Merkle manifest of a document table, with a witness for each row.

Leaves are hashed where the rows are; only digests and ids are sorted and grouped, never a text. Per
language they stand in the order of doc_id, and every `ARITY` consecutive nodes become their hash until
one remains. Leaves are dealt out in aligned blocks of `ARITY ** BLOCK_LEVELS`. Each block is one streaming
append (`Appender`): a node that is complete gets the siblings before it as its partial witness, and each
sibling that is completed later extends the witnesses of the open subtrees beside it. The block roots are
then appended in the same way, block by block of blocks, and the roots of the languages last; what they add
extends the witnesses below. So no task holds more than one block, and a language may hold any share.

Defined results: a null doc_id comes first, rows with equal ids in the order of their leaves; equal rows
have equal leaves at neighbouring places, each with its own witness. Null fields count as `-` in the leaf,
an empty text as `0:`. A row with null doc_id is never tampered with. An empty table has no row and no root.
Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrum.llm.common import discard, written
from registrum.llm.ordering import positions, small

ARITY = 8
#: Levels of a block's tree: 8 ** 4 = 4,096 nodes are appended in one task.
BLOCK_LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<left:string,right:string>"


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


class Appender:
    """A tree under append. `open[level]` are the complete nodes whose run is not full; `witness[level]`
    holds for every complete node of the level the siblings to its left and right."""

    def __init__(self, arity: int = ARITY):
        self.arity = arity
        self.open: list[list[str]] = []
        self.witness: list[list[list[str]]] = []

    def append(self, node: str, level: int = 0) -> None:
        """Add a complete node: it starts with the open siblings on its left, and extends theirs."""
        if level == len(self.open):
            self.open.append([])
            self.witness.append([])
        run, kept = self.open[level], self.witness[level]
        for sibling in kept[len(kept) - len(run) :]:
            sibling[1] += node
        kept.append(["".join(run), ""])
        run.append(node)
        if len(run) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """Close the run of a level, whatever its length: its hash is appended above."""
        node = _digest("".join(self.open[level]))
        self.open[level] = []
        self.append(node, level + 1)

    def close(self, levels: int | None) -> str:
        """End the stream and return the root: after so many levels exactly (other blocks follow or came
        before), or (None) as soon as one node remains."""
        level = 0
        while levels is not None and level < levels or levels is None and (len(self.witness[level]) > 1):
            if self.open[level]:
                self._complete(level)
            level += 1
        return self.open[level][-1]

    def path(self, leaf: int, levels: int) -> list[tuple[str, str]]:
        """The witness of a leaf: (left, right) of its ancestors from below."""
        return [tuple(self.witness[level][leaf // self.arity**level]) for level in range(levels)]


def witnesses(nodes: list[str], whole: bool, arity: int = ARITY, block_levels: int = BLOCK_LEVELS) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root and witnesses of one block; `whole`: it is the only block of its tree."""
    tree = Appender(arity)
    for node in nodes:
        tree.append(node)
    levels = None if whole else block_levels
    root = tree.close(levels)
    if levels is None:
        levels = next(i for i, made in enumerate(tree.witness) if len(made) == 1)
    return root, [tree.path(i, levels) for i in range(len(nodes))]


def append_blocks(nodes: DataFrame, arity: int = ARITY, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """nodes (key, pos, n, node) with `block`, its `block_root` and the witness `path` inside it."""
    size = arity**block_levels
    rows = nodes.withColumn("block", F.floor(F.col("pos") / size).cast("long"))

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        root, paths = witnesses(group.column("node").to_pylist(), group.column("n")[0].as_py() <= size, arity, block_levels)
        path = pa.array([[{"left": a, "right": b} for a, b in p] for p in paths], pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))
        return group.append_column("block_root", pa.array([root] * len(group), pa.string())).append_column("path", path)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.groupBy("key", "block").applyInArrow(build, f"{schema}, block_root string, path array<{STEP}>")


def _above(blocks: DataFrame, arity: int, block_levels: int) -> DataFrame:
    """blocks (key, pos, n, node) -> (key, pos, path, root): what the appends above add to a block's witness."""
    size = arity**block_levels
    built = written(append_blocks(blocks, arity, block_levels), "merkle-blocks")
    if not built.where(F.col("n") > size).limit(1).count():
        return built.select("key", "pos", "path", F.col("block_root").alias("root"))
    up = _above(_next(built, size), arity, block_levels).select("key", F.col("pos").alias("block"), F.col("path").alias("_path"), "root")
    joined = built.join(small(up), ["key", "block"])
    out = written(joined.select("key", "pos", F.concat("path", "_path").alias("path"), "root"), "merkle-above")
    discard(built)
    return out


def _next(built: DataFrame, size: int) -> DataFrame:
    """The blocks of `built` as nodes of the level above; the block of a one-block tree stays its only node."""
    one = built.where(F.col("pos") % size == 0)
    return one.select("key", F.col("block").alias("pos"), F.ceil(F.col("n") / size).cast("long").alias("n"), F.col("block_root").alias("node"))


def key_of(column: str) -> Column:
    """A never-null string that sorts as the column does, null first."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _leaf(text: Column) -> Column:
    def part(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(text if c == "text" else F.col(c)) for c in FIELDS]), 256)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, key, leaf, tampered): `tampered` is the leaf of the row as the audit alters it."""
    altered = F.translate(F.col("text").cast("string"), _UPPER, _UPPER.lower())
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = docs.select(*FIELDS).select(F.col("doc_id").cast("long").alias("doc_id"), key_of("lang").alias("key"), _leaf(F.col("text")).alias("leaf"), F.when(hit, _leaf(altered)).alias("tampered"))
    return rows.select("doc_id", "key", "leaf", F.coalesce("tampered", "leaf").alias("tampered"))


def manifest(docs: DataFrame, arity: int = ARITY, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Per row: doc_id, key, leaf, tampered, subroot, root and `path`, its whole witness: (left, right)
    siblings of each level from the leaf to the root."""
    size = arity**block_levels
    digests = written(leaves(docs).withColumn("row", F.monotonically_increasing_id()), "merkle-digests")
    placed = positions(digests, "key", ["doc_id", "leaf", "row"], "merkle-leaves")
    discard(digests)
    built = written(append_blocks(placed.withColumn("node", F.col("leaf")).drop("row"), arity, block_levels), "merkle-appended")
    discard(placed)
    # the block roots as further appends; the trees of one block are complete and add no step
    within = _above(_next(built, size), arity, block_levels)
    subroots = written(within.where("pos = 0").select("key", F.col("root").alias("node")), "merkle-subroots")
    placed_trees = positions(subroots.select(F.lit("").alias("key"), F.col("key").alias("tree"), "node"), "key", ["tree"], "merkle-trees")
    over = _above(placed_trees.select("key", "pos", "n", "node"), arity, block_levels)
    trees = placed_trees.select("pos", F.col("tree").alias("key")).join(over.select("pos", F.col("path").alias("_top"), F.col("root").alias("_root")), "pos").drop("pos")
    above = within.join(small(trees), "key").select("key", F.col("pos").alias("block"), F.concat("path", "_top").alias("_above"), F.col("root").alias("subroot"), F.col("_root").alias("root"))
    above = written(above, "merkle-witnesses")
    return built.join(small(above), ["key", "block"]).select("doc_id", "key", "leaf", "tampered", "subroot", "root", F.concat("path", "_above").alias("path"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its witness give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step.left, node, step.right), 256))


def proof(path: Column) -> Column:
    """Hash of the siblings of a witness, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step.left, step.right)), ""), 256)


def audited(docs: DataFrame) -> DataFrame:
    """The manifest with each row's proof and the root that its (perhaps tampered) content folds to."""
    rows = manifest(docs)
    folded = rows.withColumns({"proof_sha256": proof(F.col("path")), "folded_root": fold(F.col("tampered"), F.col("path"))})
    return folded.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))

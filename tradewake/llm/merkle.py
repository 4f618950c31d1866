"""A Merkle manifest of a table: one tree per group of rows, one over the groups, and a proof for every row.

Trees have eight children a node and are stored in blocks: aligned subtrees of 512 leaves, each an array of digests in
van Emde Boas order. That order splits a tree at half its height, stores the upper part, then the lower parts one
after the other, each ordered in the same way, so any path from a leaf to the root lies in few stretches of memory
whatever the size of a cache line. The place of a node follows from its depth and index alone, for building and for
finding siblings. The roots of the blocks are the leaves of the blocks above, and so on until a tree has a single block.

Scale: texts are hashed once, where they are read; only ids and digests are moved. Rows are ordered by range, so no
group, however large, is in one task; a block is a bounded number of rows, held one at a time. Going up, each level is
512 times smaller than the one below. Going down, a block gets the siblings of its root from the block above it,
in one row, and hands them to its rows with their own. The driver sees a count per level.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stored
from .common import with_lookup
from .sharding import numbered

FANOUT = 8
HEIGHT = 3  # of a block: from its leaves to its root
BLOCK = FANOUT**HEIGHT
_HEX = 64  # bytes of a digest as text

Digests = list[str]


# ---------------------------------------------------------------- one block

def _nodes(levels: int) -> int:
    """The nodes of a complete tree of so many levels."""
    return (FANOUT**levels - 1) // (FANOUT - 1)


def address(depth: int, index: int, levels: int) -> int:
    """The place of a node in van Emde Boas order: its depth from the root and its index there, in a tree of ``levels``."""
    place = 0
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        lower = levels - upper
        width = FANOUT ** (depth - upper)  # nodes of one lower tree at this depth
        place += _nodes(upper) + index // width * _nodes(lower)
        depth, index, levels = depth - upper, index % width, lower
    return place


@cache
def _addresses(levels: int) -> list[list[int]]:
    """By height above the leaves: the place of every node."""
    return [
        [address(levels - 1 - up, i, levels) for i in range(FANOUT ** (levels - 1 - up))] for up in range(levels)
    ]


def height_of(leaves: int) -> int:
    """Rounds of hashing from so many leaves to a single node."""
    height = 0
    while leaves > 1:
        leaves = -(-leaves // FANOUT)
        height += 1
    return height


def digest(parts: str) -> str:
    return sha256(parts.encode()).hexdigest()


class Block:
    """An aligned subtree, built from its leaves."""

    def __init__(self, nodes: bytes, leaves: int, height: int):
        self.nodes, self.leaves, self.height = nodes, leaves, height

    @classmethod
    def build(cls, leaves: Digests, height: int) -> Block:
        places = _addresses(height + 1)
        nodes = bytearray(_HEX * _nodes(height + 1))

        def put(up: int, row: Digests) -> None:
            for place, node in zip(places[up], row):
                nodes[_HEX * place : _HEX * (place + 1)] = node.encode()

        row = leaves
        put(0, row)
        for up in range(1, height + 1):
            row = [digest("".join(row[i : i + FANOUT])) for i in range(0, len(row), FANOUT)]
            put(up, row)
        return cls(bytes(nodes), len(leaves), height)

    def node(self, up: int, index: int) -> str:
        at = _HEX * _addresses(self.height + 1)[up][index]
        return self.nodes[at : at + _HEX].decode()

    def root(self) -> str:
        return self.node(self.height, 0)

    def siblings(self, leaf: int) -> str:
        """The siblings on the way from a leaf to the root of the block, from the lowest level on."""
        found, width, index = [], self.leaves, leaf
        for up in range(self.height):
            first = index - index % FANOUT
            found += [self.node(up, i) for i in range(first, min(first + FANOUT, width)) if i != index]
            width, index = -(-width // FANOUT), index // FANOUT
        return "".join(found)


def fold(leaf: str, rank: int, leaves: int, siblings: str, at: int = 0) -> tuple[str, int]:
    """The root that follows from a leaf and its siblings, and the number of digests used up, in a tree of ``leaves``."""
    node = leaf
    while leaves > 1:
        first = rank - rank % FANOUT
        before, others = rank - first, min(FANOUT, leaves - first) - 1
        left, right, end = (_HEX * (at + n) for n in (0, before, others))
        node = digest(siblings[left:right] + node + siblings[right:end])
        at += others
        rank, leaves = rank // FANOUT, -(-leaves // FANOUT)
    return node, at


# ---------------------------------------------------------------- many blocks

def _by_block(batches: Iterator[pa.RecordBatch], of: Callable[[pa.Table], list], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Call ``of`` with the rows of each block; they come in the order of tree and block, the first two columns."""
    held: list[pa.RecordBatch] = []

    def rows_of(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = of(pa.Table.from_batches(parts))
        if rows:
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind.type) for column, kind in zip(columns, schema)], schema=schema
            )

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tree, block = (batch.column(i).to_numpy() for i in range(2))
        borders = np.flatnonzero((tree[1:] != tree[:-1]) | (block[1:] != block[:-1])) + 1
        for start, stop in zip([0, *borders.tolist()], [*borders.tolist(), batch.num_rows]):
            if held and (tree[start], block[start]) != last:
                yield from rows_of(held)
                held = []
            last = (tree[start], block[start])
            held.append(batch.slice(start, stop - start))
    if held:
        yield from rows_of(held)


def _in_blocks(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("tree", "block").sortWithinPartitions("tree", "block", *order)


def blocks_of(leaves: DataFrame) -> DataFrame:
    """(tree, block, n, nodes, root): the blocks over leaves (tree, rank, n, node), n being the leaves of the whole tree."""
    schema = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("nodes", pa.binary()), ("root", pa.string())])

    def build(rows: pa.Table) -> list:
        tree, block, n = (rows.column(name)[0].as_py() for name in ("tree", "block", "n"))
        built = Block.build(rows.column("node").to_pylist(), HEIGHT if n > BLOCK else height_of(n))
        return [(tree, block, n, built.nodes, built.root())]

    ordered = _in_blocks(leaves.select("tree", _block().alias("block"), "rank", "n", "node"), "rank")
    return ordered.mapInArrow(
        lambda batches: _by_block(batches, build, schema), "tree long, block long, n long, nodes binary, root string"
    )


def _block() -> Column:
    return F.floor(F.col("rank") / BLOCK).cast("long")


def _up(n: Column) -> Column:
    """The number of blocks over so many leaves."""
    return F.ceil(n / BLOCK).cast("long")


def levels_of(leaves: DataFrame) -> list[DataFrame]:
    """The blocks of all trees, level by level; the last level has one block a tree that got that far."""
    levels = [stored(blocks_of(leaves), "merkle-blocks")]
    # A tree is done when it has one block; the others go on with the roots of their blocks.
    while not (more := levels[-1].filter(F.col("n") > BLOCK)).isEmpty():
        roots = more.select("tree", F.col("block").alias("rank"), _up(F.col("n")).alias("n"), F.col("root").alias("node"))
        levels.append(stored(blocks_of(roots), "merkle-blocks"))
    return levels


def roots_of(levels: list[DataFrame]) -> DataFrame:
    """(tree, root) of every tree."""
    tops = [level.filter(F.col("n") <= BLOCK).select("tree", "root") for level in levels]
    return _union(tops)


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.union(frame)
    return whole


def paths_down(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """(tree, block, n, nodes, path): the lowest blocks, each with the siblings from its root upwards.

    ``above`` (tree, path) has what lies beyond the root of each tree.
    """
    path = None
    for level in reversed(levels):
        top = level.filter(F.col("n") <= BLOCK).join(above, "tree").select("tree", "block", "n", "nodes", "path")
        heads = top
        if path is not None:
            # The blocks of larger trees are leaves of the level above.
            lower = level.filter(F.col("n") > BLOCK).join(
                path.select("tree", F.col("rank").alias("block"), "path"), ["tree", "block"]
            )
            heads = top.union(lower.select("tree", "block", "n", "nodes", "path"))
        heads = stored(heads, "merkle-heads")
        if level is not levels[0]:
            members = _leaves_of_blocks(heads)
            path = stored(members, "merkle-paths")
    return heads


def _leaves_of_blocks(heads: DataFrame) -> DataFrame:
    """(tree, rank, path): for every leaf of these blocks its siblings in the block, then those of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tree, block, n, nodes, path = (column[row].as_py() for column in batch.columns)
                members = _block_at(nodes, block, n)
                found = [members.siblings(i) + path for i in range(members.leaves)]
                ranks = np.arange(members.leaves) + block * BLOCK
                yield pa.RecordBatch.from_pydict(
                    {"tree": np.full(members.leaves, tree), "rank": ranks, "path": pa.array(found, pa.string())}
                )

    return heads.mapInArrow(run, "tree long, rank long, path string")


def _block_at(nodes: bytes, block: int, n: int) -> Block:
    return Block(nodes, min(BLOCK, n - block * BLOCK), HEIGHT if n > BLOCK else height_of(n))


# ---------------------------------------------------------------- the manifest

def leaf_of(columns: list[Column]) -> Column:
    """The digest of a row: of each value its UTF-8 length, a colon and the value, or a dash for null."""
    texts = [column.cast("string") for column in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def manifest(
    rows: DataFrame,
    group_col: str,
    id_col: str,
    columns: list[str],
    changed: dict[str, Column] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root): a row's digests, and the root that its proof leads to.

    A row's leaf is the digest of ``columns``. The leaves of a group ascend by id (null first, equal ids by leaf); while
    several nodes remain, every eight become the digest of their concatenation. What remains is the group's
    subroot; subroots, ordered by group (null first, as bytes), become the root in the same way. ``proof_sha256`` is the
    digest of the siblings from the leaf to the root.

    ``changed`` gives the values that some columns now have in the rows ``where``; their folded root follows from the
    changed leaf and the siblings of the original one, and differs from the root. Every row is a leaf, repeated ones
    too (equal rows can trade places); columns not listed have no effect. No rows give no rows.
    """
    given = {name: F.col(name) for name in columns}
    other = F.lit(None).cast("string")
    if where is not None:
        other = F.when(where, leaf_of(list((given | (changed or {})).values())))
    leaves = rows.select(
        F.col(group_col).alias("group"), F.col(id_col).alias("id"), leaf_of(list(given.values())).alias("node"), other.alias("other")
    )
    placed = stored(numbered(leaves, [F.col(c) for c in ("group", "id", "node", "other")], "place"), "merkle-leaves")
    # A flag beside the group lets null be a group of its own in an ordinary join.
    named = {"name": F.coalesce(F.col("group").cast("string"), F.lit("")), "none": F.col("group").isNull()}
    placed = placed.withColumns(named)
    groups = placed.groupBy("name", "none").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    trees = stored(numbered(groups, [F.col("first")], "tree"), "merkle-trees")
    entries = stored(
        with_lookup(placed.select("name", "none", "id", "node", "other", "place"), trees, ["name", "none"], F.col("place"))
        .select("tree", (F.col("place") - F.col("first")).alias("rank"), "n", "id", "node", "other"),
        "merkle-entries",
    )

    levels = levels_of(entries)
    n_trees = trees.count()
    subroots = stored(
        roots_of(levels).select(
            F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"),
            F.lit(n_trees).cast("long").alias("n"), F.col("root").alias("node"),
        ),
        "merkle-subroots",
    )
    top_levels = levels_of(subroots)
    root = next((row.root for row in roots_of(top_levels).take(1)), None)
    top = paths_down(top_levels, subroots.limit(1).select("tree", F.lit("").alias("path")))
    above = _leaves_of_blocks(top).select(F.col("rank").alias("tree"), "path")
    heads = paths_down(levels, above)

    # Every block's row comes first among the rows of its block.
    of_trees = subroots.select(F.col("rank").alias("tree"), F.col("node").alias("subroot"))
    heads = with_lookup(heads, of_trees, ["tree"], F.col("block"), small=100_000)
    id_type = rows.schema[id_col].dataType
    nothing = F.lit(None)
    members = entries.select(
        "tree", _block().alias("block"), "rank", "n", "id", "node", "other",
        nothing.cast("binary").alias("nodes"), nothing.cast("string").alias("path"), nothing.cast("string").alias("subroot"),
    )
    firsts = heads.select(
        "tree", "block", F.lit(-1).cast("long").alias("rank"), "n", nothing.cast(id_type).alias("id"),
        nothing.cast("string").alias("node"), nothing.cast("string").alias("other"), "nodes", "path", "subroot",
    )

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def of(block: pa.Table) -> list:
            head = {name: block.column(name)[0].as_py() for name in ("tree", "block", "n", "nodes", "path", "subroot")}
            inside = _block_at(head["nodes"], head["block"], head["n"])
            found = []
            columns = (block.column(name).to_pylist()[1:] for name in ("rank", "id", "node", "other"))
            for rank, id_, node, other in zip(*columns):
                siblings = inside.siblings(rank % BLOCK) + head["path"]
                folded, used = fold(other or node, rank, head["n"], siblings)
                folded, _ = fold(folded, head["tree"], n_trees, siblings, used)
                found.append((id_, node, head["subroot"], root, digest(siblings), folded))
            return found

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal schema
            for batch in batches:
                if schema is None:
                    schema = pa.schema([("id", batch.schema.field("id").type)] + [(name, pa.string()) for name in _PROVEN])
                yield batch

        source = typed()
        first = next(source, None)
        if first is not None:
            yield from _by_block(_again(first, source), of, schema)

    return _in_blocks(firsts.union(members), "rank").mapInArrow(
        prove, f"id {id_type.simpleString()}, " + ", ".join(f"{name} string" for name in _PROVEN)
    )


_PROVEN = ("leaf", "subroot", "root", "proof_sha256", "folded_root")


def _again(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest

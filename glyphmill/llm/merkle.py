"""Operator 13: Merkle manifest of a dataset, its subtrees in van Emde Boas layout.

Rows become leaf digests. Per group the leaves, in order of id, form a tree of
runs of ``FANOUT``: while several nodes remain, each run of consecutive nodes
(the last one may be shorter) becomes its digest. The groups' roots, in order
of the group, form one more such tree, whose root covers all.

A tree is cut into aligned subtrees of ``HEIGHT`` levels of runs, so a subtree
has ``BLOCK`` leaves at most. Each is one row: its nodes are laid out by
splitting it recursively at half height, the top part first, then the bottom
parts one after the other. A node's place follows from its depth and index by
arithmetic alone (``veb_address``); building a subtree and finding siblings
both use it, and neither has to know the size of a cache line or a page. The
subtrees' roots are the leaves of the next round, until a single subtree holds
what is left of each tree. Proofs then go down the rounds: a row is joined
with the path above its own subtree only.

No step holds more than one subtree: positions come from a range-partitioned
sort and per-partition counts, so a group of any size is spread over many
tasks. Rows with equal group and id are ordered by their digest, then
arbitrarily (they are equal). A null id comes first in its group, null is a
group of its own and the first one. An empty table has an empty manifest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphmill.llm.columns import quoted
from glyphmill.sources.scratch import materialize

BITS = 4
FANOUT = 1 << BITS
HEIGHT = 3
BLOCK = FANOUT**HEIGHT
DIGEST = 32

PATH = "array<struct<left: string, right: string>>"


# ---- layout of one subtree


def veb_size(levels: int) -> int:
    """Nodes of a full tree with so many levels of nodes."""
    return (FANOUT**levels - 1) // (FANOUT - 1)


def veb_address(levels: int, depth: int, index):
    """Place of the node ``index`` (a number or an array) at ``depth``; the root has depth 0 and place 0."""
    place = index * 0
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        # below the cut: skip the top part and the bottom parts to the left
        depth, bottom = depth - top, levels - top
        place = place + veb_size(top) + (index >> (BITS * depth)) * veb_size(bottom)
        index = index & ((1 << (BITS * depth)) - 1)
        levels = bottom
    return place


@lru_cache(maxsize=None)
def _places(height: int, level: int) -> np.ndarray:
    """Places of all nodes at a level counted from the leaves."""
    depth = height - level
    return veb_address(height + 1, depth, np.arange(FANOUT**depth))


def block_height(n: int, leaves: int) -> int:
    """Levels of runs in a subtree: all if the tree has more subtrees, else as many as leave a single node."""
    if n > BLOCK:
        return HEIGHT
    height = 0
    while FANOUT**height < leaves:
        height += 1
    return height


def _digest(children: bytes) -> bytes:
    """Digest of raw digests, taken as lower-case hex text."""
    return sha256(children.hex().encode()).digest()


def build_block(leaves: np.ndarray, height: int) -> np.ndarray:
    """All nodes of a subtree by place; leaves and nodes are rows of ``DIGEST`` bytes."""
    used = max(int(_places(height, level)[-(-len(leaves) // FANOUT**level) - 1]) for level in range(height + 1))
    nodes = np.zeros((used + 1, DIGEST), np.uint8)
    for level in range(height + 1):
        nodes[_places(height, level)[: len(leaves)]] = leaves
        if level < height:
            runs = b"".join(_digest(leaves[i : i + FANOUT].tobytes()) for i in range(0, len(leaves), FANOUT))
            leaves = np.frombuffer(runs, np.uint8).reshape(-1, DIGEST)
    return nodes


def siblings(nodes: np.ndarray, height: int, count: int, level: int, index: int) -> tuple[str, str]:
    """Hex digests left and right of a node within its run, ``count`` leaves being in the subtree."""
    first = index - index % FANOUT
    run = nodes[_places(height, level)[first : min(first + FANOUT, -(-count // FANOUT**level))]]
    at = index - first
    return run[:at].tobytes().hex(), run[at + 1 :].tobytes().hex()


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf digest and its siblings, level by level, lead to."""
    for left, right in path:
        leaf = sha256((left + leaf + right).encode()).hexdigest()
    return leaf


# ---- leaves and positions


def encoded(column: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    """Lower-case hex SHA-256 of the encoded values, one after the other."""
    return F.sha2(F.concat(*(encoded(c) for c in columns)).cast("binary"), 256)


def _numbered(rows: DataFrame, group: str | None, order: list[str], name: str) -> DataFrame:
    """Rows with ``pos``, their rank from 0 in the group, and ``n``, the group's size; null is a group too.

    The rows are range-partitioned by group and order and stored. A row's rank
    is its place among the group's rows in its partition plus the rows of the
    group in the partitions before: no task sees a whole group.
    """
    by = ([group] if group else []) + order
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = materialize(ranged.withColumn("row", F.monotonically_increasing_id()), name)
    ranged = ranged.withColumn("part", F.shiftright("row", 33))
    keys = ["part"] + ([group] if group else [])
    counts = materialize(ranged.groupBy(*keys).agg(F.min("row").alias("first"), F.count("*").alias("rows")), f"{name}-counts")
    # as many rows a group as it has partitions
    within = Window.partitionBy(*([group] if group else []))
    before = F.sum("rows").over(within.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select(
        F.col("part").alias("_part"),
        *([F.col(group).alias("_group")] if group else []),
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(within).alias("n"),
    )
    match = F.col("part") == F.col("_part")
    if group:
        match = match & F.col(group).eqNullSafe(F.col("_group"))
    return ranged.join(bases, match).withColumn("pos", F.col("row") + F.col("shift")).drop("row", "part", "_part", "_group", "shift")


# ---- rounds of subtrees


@dataclass(frozen=True)
class Forest:
    """Per round the subtrees (tree, n, block, nodes, root and lists of what goes with the leaves); the trees' roots."""

    rounds: list[DataFrame]
    roots: DataFrame


@F.arrow_udf(T.StructType([T.StructField("nodes", T.BinaryType()), T.StructField("root", T.BinaryType())]))
def _built(members: pa.Array, n: pa.Array) -> pa.Array:
    nodes, roots = [], []
    for leaves, size in zip(members, n.to_pylist(), strict=True):
        raw = b"".join(leaves.as_py())
        digests = np.frombuffer(raw, np.uint8).reshape(-1, DIGEST)
        block = build_block(digests, block_height(size, len(digests)))
        nodes.append(block.tobytes())
        roots.append(block[0].tobytes())
    return pa.StructArray.from_arrays([pa.array(nodes, pa.binary()), pa.array(roots, pa.binary())], ["nodes", "root"])


def build_forest(leaves: DataFrame, name: str, carry: tuple[str, ...] = ()) -> Forest:
    """Trees over (tree, pos, n, digest); ``carry`` columns stay with the leaves, as lists by position."""
    most, rounds, roots = leaves.agg(F.max("n")).first()[0] or 0, [], None
    while True:
        own = carry if not rounds else ()
        members = F.array_sort(F.collect_list(F.struct("pos", "digest", *own)))
        block = F.floor(F.col("pos") / F.lit(BLOCK)).cast("long").alias("block")
        grouped = leaves.groupBy("tree", "n", block).agg(members.alias("members"))
        built = grouped.select(
            "tree", "n", "block", _built(F.col("members.digest"), F.col("n")).alias("b"), *(F.col(f"members.{c}") for c in own)
        )
        built = materialize(built.select("tree", "n", "block", "b.nodes", "b.root", *own), f"{name}-{len(rounds)}")
        rounds.append(built)
        finished = built.where(F.col("n") <= BLOCK).select("tree", F.col("root").alias("digest"))
        roots = finished if roots is None else roots.unionByName(finished)
        if most <= BLOCK:
            return Forest(rounds, roots)
        most = -(-most // BLOCK)
        up = F.ceil(F.col("n") / F.lit(BLOCK)).cast("long").alias("n")
        leaves = built.where(F.col("n") > BLOCK).select("tree", F.col("block").alias("pos"), up, F.col("root").alias("digest"))


def _inner_paths(nodes: np.ndarray, height: int, count: int, lowest: int) -> Callable[[int], list[tuple[str, str]]]:
    """Path of a node at level ``lowest`` to the subtree's root."""

    @lru_cache(maxsize=None)
    def path(level: int, index: int) -> list[tuple[str, str]]:
        if level == height:
            return []
        return [siblings(nodes, height, count, level, index), *path(level + 1, index // FANOUT)]

    return lambda index: path(lowest, index)


def _subtree(row: dict) -> tuple[np.ndarray, int, int]:
    nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, DIGEST)
    count = min(BLOCK, row["n"] - row["block"] * BLOCK)
    return nodes, block_height(row["n"], count), count


def _above(row: dict) -> list[tuple[str, str]]:
    return [(step["left"], step["right"]) for step in row["path"]]


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each leaf of a subtree its tree, position and path to the very root."""
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1).to_pylist()[0]
            nodes, height, count = _subtree(row)
            inner, above = _inner_paths(nodes, height, count, 0), _above(row)
            for start in range(0, count, FANOUT**2):
                indices = range(start, min(count, start + FANOUT**2))
                paths = [[{"left": a, "right": b} for a, b in inner(i) + above] for i in indices]
                yield pa.record_batch(
                    [pa.array([row["tree"]] * len(paths), pa.int64()), pa.array([row["block"] * BLOCK + i for i in indices], pa.int64()),
                     pa.array(paths, kind)],
                    ["tree", "pos", "path"],
                )


def expand(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Paths (tree, pos, path) of the leaves of subtrees, given the paths (tree, block, path) of their roots."""
    joined = blocks.select("tree", "n", "block", "nodes").join(paths, ["tree", "block"])
    return joined.mapInArrow(_expanded, f"tree long, pos long, path {PATH}")


def block_paths(forest: Forest, above: DataFrame) -> DataFrame:
    """Paths (tree, block, path) of the first round's subtrees, given those (tree, path) of the trees' roots."""
    paths = None
    for blocks in reversed(forest.rounds):
        last = blocks.where(F.col("n") <= BLOCK).select("tree", "block").join(above, "tree").select("tree", "block", "path")
        paths = last if paths is None else last.unionByName(expand(upper, paths).withColumnRenamed("pos", "block"))
        upper = blocks
    return paths


def _verified(root: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                nodes, height, count = _subtree(row)
                # what is above a run of leaves is the same for all of them
                above = _above(row)
                tails = _inner_paths(nodes, height, count, 1) if height else lambda _: []
                leaves, subroot = nodes[_places(height, 0)[:count]], row["subroot"].hex()
                joined: dict[int, tuple[list, str]] = {}
                out: list[list] = [[], [], []]
                for index in range(count):
                    leaf, run = leaves[index].tobytes().hex(), index // FANOUT
                    if run not in joined:
                        tail = (tails(run) if height else []) + above
                        joined = {run: (tail, "".join(a + b for a, b in tail))}
                    tail, text = joined[run]
                    own = [siblings(nodes, height, count, 0, index)] if height else []
                    changed = row["changed"][index]
                    out[0].append(leaf)
                    out[1].append(sha256(("".join(a + b for a, b in own) + text).encode()).hexdigest())
                    out[2].append(fold(leaf if changed is None else changed.hex(), own + tail))
                yield pa.record_batch(
                    [pa.array(row["id"], pa.int64()), pa.array(out[0]), pa.array([subroot] * count), pa.array([root] * count),
                     pa.array(out[1]), pa.array(out[2]), pa.array([folded == root for folded in out[2]])],
                    ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    return verify


# ---- manifest


@dataclass(frozen=True)
class Manifest:
    """Digests of all rows by group: a forest of the groups' trees and one tree of their roots, ``None`` without rows.

    ``groups`` has each group and the number of its tree.
    """

    groups: DataFrame
    forest: Forest
    top: Forest
    root: str | None


def build_manifest(
    rows: DataFrame, leaf: Column, id_col: str = "doc_id", group_col: str = "source", changed: Column | None = None
) -> Manifest:
    """The manifest of ``rows``, each with the hex digest ``leaf``.

    ``changed`` is the hex digest a row has when it is verified later, null if
    it is unchanged; it has no influence on the manifest. The id is cast to a
    long, the group to a string. Columns of any other name are ignored.
    """
    thin = rows.select(
        quoted(group_col).cast("string").alias("group"),
        quoted(id_col).cast("long").alias("id"),
        F.unhex(leaf).alias("digest"),
        F.unhex(F.lit(None).cast("string") if changed is None else changed).alias("changed"),
        # tells rows apart that are equal, so that they need not meet in one task
        F.monotonically_increasing_id().alias("salt"),
    )
    # texts are read and hashed here, once
    thin = materialize(thin, "manifest-leaves")
    numbered = _numbered(thin, "group", ["id", "digest", "salt"], "manifest-sorted").drop("salt")
    sizes = materialize(thin.groupBy("group").agg(F.count("*").alias("rows")), "manifest-groups")
    groups = _numbered(sizes, None, ["group"], "manifest-trees")
    groups = materialize(groups.select(F.col("group").alias("of"), F.col("pos").alias("tree"), F.col("n").alias("trees")), "manifest-order")
    leaves = numbered.join(groups, F.col("group").eqNullSafe(F.col("of"))).select("tree", "pos", "n", "digest", "id", "changed")
    forest = build_forest(leaves, "manifest", ("id", "changed"))
    tops = forest.roots.join(groups, "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("trees").alias("n"), "digest"
    )
    top = build_forest(tops, "manifest-top")
    root = top.roots.first()
    return Manifest(groups.select(F.col("of").alias("group"), "tree"), forest, top, root and bytes(root["digest"]).hex())


def verify_rows(manifest: Manifest) -> DataFrame:
    """Per row: leaf, subroot, root, digest of its proof, the root it folds to as it is now, and whether that is the root."""
    spark, rounds = manifest.groups.sparkSession, manifest.forest.rounds
    start = spark.createDataFrame([(0, [])], f"tree long, path {PATH}")
    above = expand(manifest.top.rounds[0], block_paths(manifest.top, start)).select(F.col("pos").alias("tree"), "path")
    above = materialize(above, "manifest-above")
    paths = block_paths(manifest.forest, above)
    subroots = manifest.forest.roots.withColumnRenamed("digest", "subroot")
    joined = rounds[0].drop("root").join(paths, ["tree", "block"]).join(subroots, "tree")
    return joined.select("n", "block", "nodes", "id", "changed", "path", "subroot").mapInArrow(
        _verified(manifest.root or ""),
        "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )

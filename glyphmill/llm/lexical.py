"""Operator 12: ranked lexical search by dual-tree pruning.

Documents and items are sparse vectors over the items' terms: a document's
coordinate is the saturated count of a term, an item's its weight. A score is
their product, all in integers. Both sides form binary trees that keep alike
vectors together, and each node holds the largest value of every coordinate
below it. The product of two nodes' maxima bounds the score of every pair
below them. A pair of nodes goes as a whole if the bound is less than the
weakest of the kth best scores its items have so far; a bound that equals it
stays, as ties go by document id. What is left at the leaves is scored. So the
result is that of scoring every pair.

Jobs for a batch of items: the documents become vectors (and are counted),
vectors become trees of ``CHUNK`` documents, stored with their maxima; while
they are built the most promising leaf of each tree is scored, which gives
first kth scores over all documents; then every tree is searched from these.
Memory is bound by a chunk and a batch. Items are taken in batches of at most
``ITEMS_AT_ONCE`` and about ``CELLS`` coordinates, the documents are read once
a batch.

Terms are the maximal runs of ASCII letters and digits and of characters
beyond ASCII, A-Z lower-cased. A null text has none, neither has an empty one;
such documents are never found, such items find nothing. Rows with equal item
id and text are one item; with equal id and different texts they are ranked
apart. Every document row is ranked, repeated ones as well. A null document id
comes after the others at equal scores.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glyphmill.llm.columns import as_text, byte_list, quoted, slices
from glyphmill.sources.scratch import materialize

# Bounds of a batch of items.
ITEMS_AT_ONCE = 256
CELLS = 4_000_000
# Documents in a tree, and in one of its leaves; items in a leaf.
CHUNK = 4096
LEAF = 32
ITEM_LEAF = 8
# Coordinates documents are split by: their products with so many item nodes.
SIGNATURE = 32
# Power iterations that find the axis along which a node is split.
AXIS_STEPS = 6

_SEPARATED = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of bytes beyond ASCII, lower-cased."""
    return text.translate(_SEPARATED).split()


# ---- items


@dataclass(frozen=True)
class Plan:
    """A batch of items in the order of their tree: ids, and per item its terms' numbers and weights."""

    ids: list[int | None]
    rows: list[tuple[np.ndarray, np.ndarray]]
    n_terms: int
    n_docs: int
    n_tokens: int
    k: int

    def saturated(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Coordinates of documents with ``n`` tokens, from counts; one entry each."""
        length = 75 + (25 * n * self.n_docs) // self.n_tokens
        return (1_000_000_000 * tf) // (1000 * tf + 12 * length)


def halves(n: int, leaf: int) -> list[np.ndarray]:
    """Borders of the nodes of a binary tree over ``n`` places, by level, down to ``leaf`` places at most."""
    levels = [np.array([0, n])]
    while np.diff(levels[-1]).max() > leaf:
        last = levels[-1]
        middle = (last[:-1] + last[1:]) // 2
        levels.append(np.append(np.stack([last[:-1], middle], 1).ravel(), n))
    return levels


def tree_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """An order in which the nodes of ``halves`` hold alike rows: each is split at the median along its main axis."""
    size = np.sqrt((points.astype(float) ** 2).sum(axis=1, keepdims=True))
    unit, order = points / np.maximum(size, 1e-9), np.arange(len(points))
    first = np.random.default_rng(0).standard_normal(points.shape[1])
    for borders in halves(len(points), leaf)[:-1]:
        for lo, hi in zip(borders[:-1], borders[1:], strict=True):
            own = unit[order[lo:hi]]
            own, axis = own - own.mean(axis=0), first
            for _ in range(AXIS_STEPS):
                axis = own.T @ (own @ axis)
                axis = axis / max(1e-12, float(np.abs(axis).max()))
            order[lo:hi] = order[lo:hi][np.argsort(own @ axis, kind="stable")]
    return order


class Items:
    """Weights of a plan's items as a matrix, and the maxima of the nodes by level."""

    def __init__(self, plan: Plan):
        # products are exact in doubles up to 2 ** 53, which allows fast multiplication
        largest = max((int(w.sum()) for _, w in plan.rows), default=0) * 1_000_000
        self.kind = np.float64 if largest < 1 << 53 else np.int64
        self.matrix = np.zeros((len(plan.rows), plan.n_terms), self.kind)
        for row, (where, weight) in enumerate(plan.rows):
            self.matrix[row, where] = weight
        self.borders = halves(len(plan.rows), ITEM_LEAF)
        self.maxima = [np.maximum.reduceat(self.matrix, b[:-1], axis=0) for b in self.borders]
        self.depth = len(self.borders) - 1


# ---- documents


def _vectors(vocabulary: dict[bytes, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents with terms as their number of tokens and the counts of the items' terms."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            for part in slices(batch):
                ids, lengths, where, counts = [], [], [], []
                for doc_id, text in zip(part["doc_id"].to_pylist(), byte_list(part["text"]), strict=True):
                    own = terms(text)
                    if not own:
                        continue
                    found = Counter(map(number, own))
                    found.pop(None, None)
                    ids.append(doc_id)
                    lengths.append(len(own))
                    where.append(sorted(found))
                    counts.append([found[t] for t in where[-1]])
                yield pa.record_batch(
                    [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(where, pa.list_(pa.int32())),
                     pa.array(counts, pa.list_(pa.int64()))],
                    ["doc_id", "n", "terms", "counts"],
                )

    return vectors


@dataclass
class Tree:
    """Documents in tree order as sparse rows; nodes by level as sparse rows of maxima."""

    ids: np.ndarray
    unknown: np.ndarray  # 1 where the id is null
    starts: np.ndarray
    where: np.ndarray
    value: np.ndarray
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    FIELDS = {"ids": np.int64, "unknown": np.uint8, "starts": np.int64, "where": np.int32, "value": np.int32}
    NODE = (np.int64, np.int32, np.int32)

    def node(self, level: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        starts, where, value = self.nodes[level]
        return where[starts[k] : starts[k + 1]], value[starts[k] : starts[k + 1]]

    def leaf(self, lo: int, hi: int, columns: np.ndarray, kind: type) -> np.ndarray:
        """The documents from ``lo`` to ``hi`` as a matrix over the given terms, which hold all of theirs."""
        matrix = np.zeros((hi - lo, len(columns)), kind)
        a, b = self.starts[lo], self.starts[hi]
        rows = np.repeat(np.arange(hi - lo), np.diff(self.starts[lo : hi + 1]))
        matrix[rows, np.searchsorted(columns, self.where[a:b])] = self.value[a:b]
        return matrix

    def stored(self) -> dict[str, object]:
        row: dict[str, object] = {name: getattr(self, name).tobytes() for name in self.FIELDS}
        return row | {"nodes": [part.tobytes() for level in self.nodes for part in level]}

    @classmethod
    def read(cls, row: dict) -> Tree:
        parts = [np.frombuffer(raw, cls.NODE[i % 3]) for i, raw in enumerate(row["nodes"])]
        nodes = [tuple(parts[i : i + 3]) for i in range(0, len(parts), 3)]
        return cls(**{name: np.frombuffer(row[name], kind) for name, kind in cls.FIELDS.items()}, nodes=nodes)


TREE_SCHEMA = (
    "ids binary, unknown binary, starts binary, where binary, value binary, nodes array<binary>, item int, score long"
)


def _largest(where: list[np.ndarray], value: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Maxima by term of several sparse rows."""
    if not where or not sum(map(len, where)):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    all_where, all_value = np.concatenate(where), np.concatenate(value)
    order = np.argsort(all_where, kind="stable")
    found, first = np.unique(all_where[order], return_index=True)
    return found, np.maximum.reduceat(all_value[order], first)


def plant(ids: list[int | None], n: np.ndarray, sizes: np.ndarray, where: np.ndarray, tf: np.ndarray, plan: Plan, items: Items) -> Tree:
    """The tree of a chunk of documents, ordered by their products with the maxima of item nodes."""
    value = plan.saturated(tf, np.repeat(n, sizes)).astype(np.int32)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    level = max(i for i, b in enumerate(items.borders) if len(b) - 1 <= SIGNATURE)
    weights = items.maxima[level].astype(np.float64)
    signature = np.zeros((len(ids), len(weights)))
    rows = np.repeat(np.arange(len(ids)), sizes)
    for j, weight in enumerate(weights):
        signature[:, j] = np.bincount(rows, weight[where] * value, len(ids))
    borders, order = halves(len(ids), LEAF), tree_order(signature, LEAF)
    pieces = [slice(starts[i], starts[i + 1]) for i in order]
    where = np.concatenate([where[p] for p in pieces]).astype(np.int32)
    value = np.concatenate([value[p] for p in pieces])
    starts = np.concatenate([[0], np.cumsum(sizes[order])]).astype(np.int64)
    leaves = [
        _largest([where[starts[lo] : starts[hi]]], [value[starts[lo] : starts[hi]]])
        for lo, hi in zip(borders[-1][:-1], borders[-1][1:], strict=True)
    ]
    levels = [leaves]
    while len(levels[0]) > 1:
        pairs = zip(levels[0][::2], levels[0][1::2], strict=True)
        levels.insert(0, [_largest([a[0], b[0]], [a[1], b[1]]) for a, b in pairs])
    nodes = [
        (
            np.concatenate([[0], np.cumsum([len(w) for w, _ in level])]).astype(np.int64),
            np.concatenate([w for w, _ in level]).astype(np.int32),
            np.concatenate([v for _, v in level]).astype(np.int32),
        )
        for level in levels
    ]
    known = np.array([0 if i is None else i for i in ids], np.int64)
    unknown = np.array([i is None for i in ids], np.uint8)
    return Tree(known[order], unknown[order], starts, where, value, nodes)


# ---- search


class Best:
    """The best documents of each item so far, and the least score that may still enter."""

    def __init__(self, plan: Plan, items: Items, least: np.ndarray | None = None):
        self.k, self.items = plan.k, items
        self.found = [(np.zeros(0, np.int64),) * 3 for _ in plan.ids]  # scores, unknown ids, ids
        self.least = np.ones(len(plan.ids), np.int64) if least is None else np.maximum(least, 1)

    def weakest(self, level: int) -> np.ndarray:
        """By item node of a level."""
        return np.minimum.reduceat(self.least, self.items.borders[level][:-1])

    def add(self, rows: np.ndarray, scores: np.ndarray, unknown: np.ndarray, ids: np.ndarray) -> None:
        enter = scores >= self.least[rows][:, None]
        for i in np.flatnonzero(enter.any(axis=1)):
            row, new = rows[i], enter[i]
            own = [np.concatenate(pair) for pair in zip(self.found[row], (scores[i, new], unknown[new], ids[new]), strict=True)]
            order = np.lexsort((own[2], own[1], -own[0]))[: self.k]
            self.found[row] = tuple(column[order] for column in own)
            if len(order) == self.k:
                self.least[row] = max(self.least[row], int(own[0][order[-1]]))


def _bounds(tree: Tree, items: Items, level: int, node: int, item_level: int, item_nodes: np.ndarray) -> np.ndarray:
    where, value = tree.node(level, node)
    return items.maxima[item_level][np.ix_(item_nodes, where)] @ value.astype(items.kind)


def _score_leaf(tree: Tree, items: Items, best: Best, node: int, item_nodes: np.ndarray, borders: np.ndarray) -> None:
    lo, hi = borders[node], borders[node + 1]
    columns, _ = tree.node(len(tree.nodes) - 1, node)
    item_borders = items.borders[-1]
    rows = np.concatenate([np.arange(item_borders[a], item_borders[a + 1]) for a in item_nodes])
    scores = items.matrix[np.ix_(rows, columns)] @ tree.leaf(lo, hi, columns, items.kind).T
    best.add(rows, scores.astype(np.int64), tree.unknown[lo:hi].astype(np.int64), tree.ids[lo:hi])


def search_tree(tree: Tree, items: Items, best: Best) -> int:
    """Update ``best`` by the documents of a tree, most promising nodes first; returns the leaves scored."""
    depth, borders, scored = len(tree.nodes) - 1, halves(len(tree.ids), LEAF)[-1], 0
    root = np.array([0])
    bound = _bounds(tree, items, 0, 0, 0, root)
    queue = [(-bound.max(), 0, 0, 0, root, bound)]
    while queue:
        _, level, node, item_level, item_nodes, bound = heapq.heappop(queue)
        item_nodes = item_nodes[bound >= best.weakest(item_level)[item_nodes]]
        if not len(item_nodes):
            continue
        if level == depth and item_level == items.depth:
            _score_leaf(tree, items, best, node, item_nodes, borders)
            scored += 1
            continue
        if item_level < items.depth:
            item_nodes, item_level = np.stack([2 * item_nodes, 2 * item_nodes + 1], 1).ravel(), item_level + 1
        for child in (2 * node, 2 * node + 1) if level < depth else (node,):
            below = min(level + 1, depth)
            bound = _bounds(tree, items, below, child, item_level, item_nodes)
            stay = bound >= best.weakest(item_level)[item_nodes]
            if stay.any():
                heapq.heappush(queue, (-bound[stay].max(), below, child, item_level, item_nodes[stay], bound[stay]))
    return scored


def _first_scores(tree: Tree, items: Items, best: Best) -> None:
    """Score the most promising leaf of a tree for each leaf of items."""
    last, borders = len(tree.nodes) - 1, halves(len(tree.ids), LEAF)[-1]
    every = np.arange(len(items.borders[-1]) - 1)
    bounds = np.stack([_bounds(tree, items, last, node, items.depth, every) for node in range(len(borders) - 1)])
    chosen = bounds.argmax(axis=0)
    for node in np.unique(chosen):
        _score_leaf(tree, items, best, node, every[chosen == node], borders)


def _planted(plan: Plan) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Trees of the documents of a task, then the scores that the items reached on the way."""

    def planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        items = Items(plan)
        best = Best(plan, items)

        def row_of(table: pa.Table) -> pa.RecordBatch:
            flat = table.combine_chunks()
            listed = flat["terms"].chunk(0)
            sizes = np.asarray(pc.list_value_length(listed), dtype=np.int64)
            where, tf = np.asarray(listed.flatten()), np.asarray(flat["counts"].chunk(0).flatten())
            tree = plant(flat["doc_id"].to_pylist(), np.asarray(flat["n"].chunk(0)), sizes, where, tf, plan, items)
            _first_scores(tree, items, best)
            stored = tree.stored() | {"item": None, "score": None}
            return pa.RecordBatch.from_pylist([stored], schema)

        schema = pa.schema(
            [pa.field(name, pa.binary()) for name in Tree.FIELDS]
            + [pa.field("nodes", pa.list_(pa.binary())), pa.field("item", pa.int32()), pa.field("score", pa.int64())]
        )
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(map(len, held)) >= CHUNK:
                table = pa.Table.from_batches(held)
                yield row_of(table.slice(0, CHUNK))
                held = table.slice(CHUNK).to_batches()
        if sum(map(len, held)):
            yield row_of(pa.Table.from_batches(held))
        rows = [(i, int(s)) for i, (scores, _, _) in enumerate(best.found) for s in scores]
        empty = {name: None for name in [*Tree.FIELDS, "nodes"]}
        yield pa.RecordBatch.from_pylist([empty | {"item": i, "score": s} for i, s in rows], schema)

    return planted


def _searched(plan: Plan, least: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best documents of each item within a task's trees."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(plan)
        best = Best(plan, items, np.array(least, np.int64))
        for batch in batches:
            for i in range(len(batch)):
                search_tree(Tree.read(batch.slice(i, 1).to_pylist()[0]), items, best)
        columns: list[list] = [[], [], [], []]
        for item, found in enumerate(best.found):
            for score, unknown, doc_id in zip(*(column.tolist() for column in found), strict=True):
                for column, value in zip(columns, (item, plan.ids[item], None if unknown else doc_id, score), strict=True):
                    column.append(value)
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["item", "item_id", "doc_id", "score"])

    return searched


def _batches(items: DataFrame) -> Iterator[list[tuple[int | None, Counter]]]:
    """Items with terms, a bounded number at a time, streamed to the driver."""
    batch: list[tuple[int | None, Counter]] = []
    known: set[bytes] = set()
    for row in items.toLocalIterator():
        own = Counter(terms(bytes(row["text"])))
        if not own:
            continue
        grown = len(known | own.keys()) * (len(batch) + 1)
        if batch and (len(batch) == ITEMS_AT_ONCE or grown > CELLS):
            yield batch
            batch, known = [], set()
        batch.append((row["item_id"], own))
        known |= own.keys()
    if batch:
        yield batch


def _search_batch(spark: SparkSession, docs: DataFrame, batch: list[tuple[int | None, Counter]], k: int) -> DataFrame | None:
    vocabulary = {term: i for i, term in enumerate(sorted(set().union(*(own for _, own in batch))))}
    schema = "doc_id long, n long, terms array<int>, counts array<long>"
    vectors = materialize(docs.mapInArrow(_vectors(vocabulary), schema), "lexical-vectors")
    n_docs, n_tokens = vectors.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    # one row a term of the batch
    held = dict(vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(i, 0) + 1))) for t, i in vocabulary.items()}
    rows = []
    for _, own in batch:
        listed = sorted((vocabulary[t], tf * weight[t]) for t, tf in own.items())
        rows.append((np.array([t for t, _ in listed], np.int32), np.array([w for _, w in listed], np.int64)))
    loose = Plan([item for item, _ in batch], rows, len(vocabulary), n_docs, n_tokens, k)
    order = tree_order(Items(loose).matrix, ITEM_LEAF)
    plan = Plan([loose.ids[i] for i in order], [rows[i] for i in order], loose.n_terms, n_docs, n_tokens, k)
    trees = materialize(vectors.mapInArrow(_planted(plan), TREE_SCHEMA), "lexical-trees")
    best = Window.partitionBy("item").orderBy(F.col("score").desc())
    first = trees.where(F.col("item").isNotNull()).select("item", "score", F.row_number().over(best).alias("rank"))
    # the kth score reached is one that the final kth score can't be below
    reached = dict(first.where(F.col("rank") <= k).where(F.col("rank") == k).select("item", "score").collect())
    least = [reached.get(i, 1) for i in range(len(batch))]
    stored = trees.where(F.col("item").isNull()).drop("item", "score")
    found = stored.mapInArrow(_searched(plan, least), "item int, item_id long, doc_id long, score long")
    by = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Each item's ``k`` best documents with a score above 0: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    texts = docs.where(quoted(text_col).isNotNull()).select(
        quoted(id_col).cast("long").alias("doc_id"), as_text(quoted(text_col)).cast("binary").alias("text")
    )
    wanted = items.select(
        quoted(item_id_col).cast("long").alias("item_id"), as_text(quoted(item_text_col)).cast("binary").alias("text")
    ).distinct()
    out = None
    for batch in _batches(wanted):
        found = _search_batch(spark, texts, batch, k)
        if found is None:
            break
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out

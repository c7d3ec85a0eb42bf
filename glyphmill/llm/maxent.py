"""Operator 2: language-model scoring with a hashed maximum-entropy model.

P(word | context) = P(class | context) * product of P(branch | node, context)
over the nodes from the root of the class's tree down to the word. All softmax
factors are log-linear in hashed features of the context: the word before, the
two before, and skip features that leave words out. A class holds the words with
a common ending. Every word of the training texts has a leaf of its own, the
commoner the nearer to the root, and is a context of its own; each class has one
more leaf for words that training has not. With all weights at zero the model is
the smoothed unigram model.

Nothing sent to a worker holds all words: a word's place is its rank by count in
its class, from which its path follows, and the weight of the ranks up to any
one follows from how many words have each count.

Training is distributed: in each round every trainer takes gradient steps on
its share of the corpus, and the changes are averaged, weighted by tokens.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.columns import as_text, lower_words, quoted, remainder, slices
from glyphmill.sources.scratch import materialize

# Added to every count, of words in training and of the one unknown word.
SMOOTHING = 0.1
# Words looked up in every worker; all others are numbered by a join.
KNOWN_WORDS = 1 << 18
# Classes, and branches of a node of their trees.
CLASSES, MEMBERS = 24, 12
# Rows of hashed weights: at least so many, and so many times the root of the number of different words.
FEATURE_ROWS = 1 << 14
ROWS_BY_ROOT = 32
FEATURES = 4

ROUNDS = 4
TRAINERS_PER_CORE = 4
BATCH_TOKENS = 8192
RATE = 0.15

END = b""  # no word is empty


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c) over all texts of ``rows`` (text as bytes); the end of a text counts as a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
            )
            counts.clear()
            return batch

        for batch in batches:
            for text in batch["text"]:
                counts.update(lower_words(text.as_py()))
            counts[END] += batch.num_rows
            if len(counts) > KNOWN_WORDS:
                yield flush()
        yield flush()

    return rows.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


class _Index(dict):
    """Number of a word: its own if it is among the known ones, else that of its class."""

    def __init__(self, words: list[bytes], endings: dict[bytes, int]):
        super().__init__((word, i) for i, word in enumerate(words))
        self.own, self.endings = len(words), endings

    def __missing__(self, word: bytes) -> int:
        return self.own + self.endings.get(word[-2:], CLASSES - 1)


@dataclass
class Trees:
    """Where the words of each class stand, by rank: the commonest word of a class has rank 0.

    Level 0 of a class is its root. Of the branches of a level's nodes, taken in
    order, the first end in words and the others in nodes of the next level, so
    the words below a node have consecutive ranks.
    """

    leaves: np.ndarray  # classes x levels: words that stand there
    nodes: np.ndarray  # classes x levels: numbers before those of the nodes there
    first: np.ndarray  # words of the classes before
    ranks: np.ndarray  # where the count changes, through all classes
    mass: np.ndarray  # smoothed counts of all words before these

    @classmethod
    def of(cls, kinds: list[list[tuple[int, int]]]) -> Trees:
        """From (count, words that have it) of each class."""
        shapes, masses, many = [], [0.0], []
        for one in kinds:
            one = sorted(one, reverse=True)
            shapes.append(_shape([c + SMOOTHING for c, _ in one], [n for _, n in one]))
            masses += [n * (c + SMOOTHING) for c, n in one]
            many += [n for _, n in one]
        levels = max(map(len, shapes)) + 1
        leaves = np.array([[0, *x, *[0] * (levels - 1 - len(x))] for x in shapes], np.int64)
        inner = np.zeros_like(leaves)
        inner[:, 0] = 1
        for level in range(1, levels):
            inner[:, level] = np.maximum(0, MEMBERS * inner[:, level - 1] - leaves[:, level])
            inner[leaves[:, level:].sum(axis=1) == leaves[:, level], level] = 0  # no word further down
        return cls(
            leaves=leaves,
            nodes=(np.cumsum(inner) - inner.ravel()).reshape(inner.shape),
            first=np.concatenate([[0], np.cumsum(leaves.sum(axis=1))]),
            ranks=np.concatenate([[0], np.cumsum(many)]),
            mass=np.cumsum(masses),
        )

    def paths(self, group: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(lengths, nodes, branches): for each word the nodes above it from the root on, one word after the other."""
        ends = np.cumsum(self.leaves, axis=1)
        level = (rank[:, None] >= ends[group]).sum(axis=1)
        slot = rank - ends[group, level] + self.leaves[group, level]
        start = np.cumsum(level) - level
        nodes, branches = np.empty(int(level.sum()), np.int64), np.empty(int(level.sum()), np.int64)
        for up in range(self.leaves.shape[1] - 1, 0, -1):
            these = np.flatnonzero(level >= up)
            k, at = group[these], start[these] + up - 1
            above, branches[at] = np.divmod(slot[these], MEMBERS)
            nodes[at] = self.nodes[k, up - 1] + above
            slot[these] = self.leaves[k, up - 1] + above
        return level, nodes, branches

    def bias(self, nodes: np.ndarray) -> np.ndarray:
        """Logarithms of the shares that a node's branches have of its words' counts: nodes x members."""
        flat, ends = self.nodes.ravel(), np.cumsum(self.leaves, axis=1)
        group, level = np.divmod(np.searchsorted(flat, nodes, side="right") - 1, self.leaves.shape[1])
        slot = ((nodes - self.nodes[group, level])[:, None] * MEMBERS + np.arange(MEMBERS + 1)).ravel()
        group, level = np.repeat(group, MEMBERS + 1), np.repeat(level + 1, MEMBERS + 1)
        rank = ends[group, -1]  # of the first word of each branch
        left = np.arange(len(slot))
        while len(left):
            k, at = group[left], level[left]
            beyond = slot[left] - self.leaves[k, at]
            here = beyond <= 0
            rank[left[here]] = (ends[k, at] + beyond)[here]
            deeper = ~here & (at + 1 < self.leaves.shape[1])
            left = left[deeper]
            slot[left], level[left] = MEMBERS * beyond[deeper], at[deeper] + 1
        mass = np.diff(np.interp(self.first[group] + rank, self.ranks, self.mass).reshape(len(nodes), MEMBERS + 1), axis=1)
        with np.errstate(divide="ignore"):
            return np.maximum(np.log(mass / mass.sum(axis=1, keepdims=True)), -60.0).astype(np.float32)


def _shape(mass: list[float], kinds: list[int]) -> list[int]:
    """Words at each level below the root, of words in falling order: ``kinds`` words with each of ``mass``.

    A word stands at a level if it has as much as the open branches there have
    on average; and as many more words as leave no more to the next level than fit there.
    """
    left, weight, inner = sum(kinds), math.fsum(m * n for m, n in zip(mass, kinds, strict=True)), 1
    one, of_one, out = 0, kinds[0], []
    while left:
        open_ = MEMBERS * inner
        taken, least = 0, left
        if left > open_:
            below = -((open_ - left) // (MEMBERS - 1))  # nodes enough for all others
            least = max(0, open_ - below)
        while taken < least or (left > taken and taken < open_ - 1 and mass[one] * (open_ - taken) >= weight):
            n = min(of_one, (least if taken < least else open_ - 1) - taken)
            taken, of_one, weight = taken + n, of_one - n, weight - n * mass[one]
            if not of_one and one + 1 < len(kinds):
                one += 1
                of_one = kinds[one]
        out.append(taken)
        left, inner = left - taken, open_ - taken
    return out


@dataclass
class Vocabulary:
    """What scoring needs for each known word, each class's unknown word, and words added for some texts."""

    words: list[bytes]
    endings: dict[bytes, int]
    tokens: int  # N
    types: int  # V
    least: int | None  # level of counts from which on words are known
    trees: Trees
    rows: int  # of hashed weights
    group: np.ndarray
    rank: np.ndarray
    within: np.ndarray  # log10 of the last factor; for unknown words without their own count
    base: np.ndarray  # the same of the unigram model
    seen: np.ndarray  # whether training has the word; unknown for other words
    group_bias: np.ndarray
    path_start: np.ndarray
    path_length: np.ndarray
    path_node: np.ndarray  # rows of the next two
    path_branch: np.ndarray
    node: np.ndarray
    node_bias: np.ndarray

    @cached_property
    def index(self) -> _Index:
        """Built once per worker; workers hold one vocabulary for all their tasks."""
        return _Index(self.words, self.endings)

    @property
    def own(self) -> int:
        """How many words are known."""
        return len(self.base) - CLASSES

    def tables(self) -> Vocabulary:
        """Without the words, for workers that get their numbers."""
        return replace(self, words=[], endings={})

    @property
    def unit(self) -> np.ndarray:
        """Numbers of the words as contexts, from 1; all words of the corpus have different ones."""
        return (self.trees.first[self.group] + self.rank + 1).astype(np.uint64)

    def with_words(self, places: np.ndarray) -> Vocabulary:
        """With more words behind the others, by rank through all classes."""
        if not len(places):
            return self
        group = np.searchsorted(self.trees.first, places, side="right") - 1
        rank = places - self.trees.first[group]
        length, nodes, branches = self.trees.paths(group, rank)
        new = np.setdiff1d(nodes, self.node)
        at = np.searchsorted(self.node, nodes)
        known = self.node[np.minimum(at, len(self.node) - 1)] == nodes
        at = np.where(known, at, np.searchsorted(new, nodes) + len(self.node))
        start = np.cumsum(length) - length + len(self.path_node)
        return replace(
            self,
            group=np.concatenate([self.group, group]),
            rank=np.concatenate([self.rank, rank]),
            within=np.concatenate([self.within, np.zeros(len(places))]),
            path_start=np.concatenate([self.path_start, start]),
            path_length=np.concatenate([self.path_length, length]),
            path_node=np.concatenate([self.path_node, at.astype(np.int32)]),
            path_branch=np.concatenate([self.path_branch, branches.astype(np.int8)]),
            node=np.concatenate([self.node, new]),
            node_bias=np.concatenate([self.node_bias, self.trees.bias(new)]),
        )


def _level(count: Column) -> Column:
    return F.floor(F.log2(count) * 16).cast("int")


def _class(endings: dict[bytes, int]) -> Column:
    """Class of ``word``, by its last two bytes."""
    out = F.lit(CLASSES - 1)
    for ending, k in endings.items():
        out = F.when(F.substring("word", -2, 2) == F.lit(ending), F.lit(k)).otherwise(out)
    return out


def build_vocabulary(counts: DataFrame) -> Vocabulary:
    """Reduce the counts to what all workers need: known words, and the trees that all words stand in.

    The known words are those from the least count on of which at most
    ``KNOWN_WORDS`` have it. Of the others the workers get how many of a class have
    each count (in a corpus of N words fewer than the root of 2N); ``word_places`` has their
    ranks. Endings (last two bytes) are at most 65,793.
    """
    levels = sorted(
        (r["l"], r["n"]) for r in counts.groupBy(_level(F.col("c")).alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()
    )
    least, total = None, 0
    for one, n in reversed(levels):
        total += n
        if total > KNOWN_WORDS:
            break
        least = one
    known = {}
    if least is not None:
        found = counts.where(_level(F.col("c")) >= F.lit(least)).select("word", "c").toArrow()
        known = dict(zip(found["word"].to_pylist(), found["c"].to_pylist(), strict=True))
    if END not in known:  # always looked up
        found = counts.where(F.col("word") == F.lit(END)).first()
        known[END] = int(found["c"]) if found else 0
    known = sorted(((c, w) for w, c in known.items()), key=lambda x: (-x[0], x[1]))
    last = F.substring("word", -2, 2)
    by_ending = {
        bytes(r["e"]): (int(r["c"]), int(r["v"]))
        for r in counts.groupBy(last.alias("e")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    }
    tokens, types = sum(c for c, _ in by_ending.values()), sum(v for _, v in by_ending.values())
    # class 0 is the end of a text, then the commonest endings, the last class has the rest
    common = sorted((e for e in by_ending if e), key=lambda e: (-by_ending[e][0], e))[: CLASSES - 2]
    endings = {e: i + 1 for i, e in enumerate(common)} | {b"": 0}
    kinds: list[list[tuple[int, int]]] = [[(0, 1)] for _ in range(CLASSES)]  # the unknown words
    if END not in by_ending:
        kinds[0] = [(0, 2)]  # the end of a text is a word even if training has none
    for r in counts.groupBy(_class(endings).alias("k"), "c").agg(F.count(F.lit(1)).alias("n")).collect():
        kinds[r["k"]].append((int(r["c"]), int(r["n"])))
    trees = Trees.of(kinds)
    words = [w for _, w in known]
    c = np.array([x for x, _ in known], float)
    every = np.arange(CLASSES)
    own = np.array([endings.get(w[-2:], CLASSES - 1) for w in words], np.int64)
    taken, ranks = [0] * CLASSES, []
    for k in own.tolist():
        ranks.append(taken[k])
        taken[k] += 1
    group = np.concatenate([own, every])
    rank = np.concatenate([np.array(ranks, np.int64), np.diff(trees.first) - 1])
    length, nodes, branches = trees.paths(group, rank)
    node, path_node = np.unique(nodes, return_inverse=True)
    level_base = math.log10(tokens + SMOOTHING * (types + 1))
    share = np.diff(np.interp(trees.first, trees.ranks, trees.mass))
    return Vocabulary(
        words=words,
        endings=endings,
        tokens=tokens,
        types=types,
        least=least,
        trees=trees,
        rows=feature_rows(types),
        group=group,
        rank=rank,
        within=np.concatenate([np.zeros(len(words)), np.full(CLASSES, -math.log10(SMOOTHING))]),
        base=np.concatenate([np.log10(c + SMOOTHING) - level_base, np.full(CLASSES, -level_base)]),
        seen=np.concatenate([c > 0, np.zeros(CLASSES, bool)]),
        group_bias=np.log(share / share.sum()).astype(np.float32),
        path_start=np.cumsum(length) - length,
        path_length=length,
        path_node=path_node.astype(np.int32),
        path_branch=branches.astype(np.int8),
        node=node,
        node_bias=trees.bias(node),
    )


def word_places(counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, c, place) of the words that are not known: their ranks through all classes, by count, then by bytes."""
    rare = counts.where(F.col("word") != F.lit(END))
    if vocabulary.least is not None:
        rare = rare.where(_level(F.col("c")) < F.lit(vocabulary.least))
    order = ["k", F.desc("c"), "word"]
    ranked = rare.withColumn("k", _class(vocabulary.endings)).repartitionByRange(*order).sortWithinPartitions(*order)
    ranked = materialize(ranked.withColumn("at", F.monotonically_increasing_id()), "ranked-words")
    part = F.shiftright("at", 33)
    before, offsets = 0, [(-1, 0)]
    for r in sorted(ranked.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets.append((r["part"], before - (r["part"] << 33)))
        before += r["n"]
    known = np.bincount(vocabulary.group[: vocabulary.own], minlength=CLASSES)
    first = vocabulary.trees.first
    others = np.diff(first) - 1 - known
    shift = first[:-1] + known - np.cumsum(others) + others
    offset = F.broadcast(counts.sparkSession.createDataFrame(offsets, "part long, offset long"))
    place = F.col("at") + F.col("offset") + F.array(*[F.lit(int(x)) for x in shift])[F.col("k")].cast("long")
    return ranked.withColumn("part", part.cast("long")).join(offset, "part").select("word", "c", place.alias("place"))


def feature_rows(types: int) -> int:
    """A power of two, at least ``FEATURE_ROWS``, in proportion to the root of the number of different words."""
    return max(FEATURE_ROWS, 1 << math.ceil(math.log2(max(1.0, ROWS_BY_ROOT * math.sqrt(types)))))


def _mixed(key: np.ndarray) -> np.ndarray:
    key = key * np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    return key


def _upper(key: np.ndarray, rows: int) -> np.ndarray:
    return (key >> np.uint64(64 - rows.bit_length() + 1)).astype(np.int64)


def context_features(units: np.ndarray, starts: np.ndarray, types: int) -> np.ndarray:
    """Hashes of what is before each position: features x positions.

    ``units`` are the context units of all words of some texts, one after
    another, from 1 to below ``types``; ``starts`` marks where a text begins.
    """
    n = len(units)
    before = np.zeros((3, n), np.uint64)
    place = np.arange(n) - np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    for k in (1, 2, 3):
        if n > k:
            before[k - 1, k:] = np.where(place[k:] >= k, units[:-k], np.uint64(0))
    one, two, three = before
    wide = np.uint64(types)
    keys = (one, one * wide + two, two, one * wide + three)
    return np.stack([_mixed(key * np.uint64(FEATURES) + np.uint64(j + 1)) for j, key in enumerate(keys)])


def member_rows(features: np.ndarray, node: np.ndarray, rows: int = FEATURE_ROWS) -> np.ndarray:
    """Rows of the member weights: the context feature together with the node, mixed; the upper bits are taken."""
    key = features.astype(np.uint64) ^ (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    key *= np.uint64(0xBF58476D1CE4E5B9)
    return _upper(key, rows)


@dataclass
class Weights:
    groups: np.ndarray  # rows x classes
    members: np.ndarray  # rows x members

    @classmethod
    def of(cls, flat: np.ndarray) -> Weights:
        """Views into one flat array."""
        rows = len(flat) // (CLASSES + MEMBERS)
        return cls(flat[: rows * CLASSES].reshape(rows, CLASSES), flat[rows * CLASSES :].reshape(rows, MEMBERS))


WEIGHTS = FEATURE_ROWS * (CLASSES + MEMBERS)  # at least


def _largest(z: np.ndarray) -> np.ndarray:
    """Of each row. Halves are compared as wholes, since numpy reduces short rows one by one."""
    while z.shape[1] > 1:
        half = z.shape[1] // 2
        z = np.maximum(z[:, :half], z[:, half : 2 * half]) if z.shape[1] % 2 == 0 else np.maximum(z[:, :-1], z[:, -1:])
    return z


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that begin at ``first``.

    numpy sums runs column by column, so two columns of an even number go
    together as one of complex numbers.
    """
    if values.shape[1] % 2 or values.dtype != np.float32:
        return np.add.reduceat(values, first, axis=0)
    return np.add.reduceat(values.view(np.complex64), first, axis=0).view(np.float32)


def _odds(bias: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Logarithms of what probabilities are in proportion to."""
    z = np.take(weights, rows[0], axis=0)
    for row in rows[1:]:
        z += np.take(weights, row, axis=0)
    z += bias
    return z


def _powers(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(e to the power of ``z``, sums by row); rows too large or small for that are first shifted in ``z``."""
    one = np.ones(z.shape[1], z.dtype)
    with np.errstate(over="ignore"):
        power = np.exp(z)
        total = power @ one
    odd = np.flatnonzero(~((total > 1e-20) & (total < 1e20)))
    if len(odd):
        z[odd] -= _largest(z[odd])
        power[odd] = np.exp(z[odd])
        total[odd] = power[odd] @ one
    return power, total


def _softmax(bias: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    power, total = _powers(_odds(bias, weights, rows))
    power /= total[:, None]
    return power


def _log_chosen(bias: np.ndarray, weights: np.ndarray, rows: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Logarithm of the probability of one outcome of each position."""
    z = _odds(bias, weights, rows)
    _, total = _powers(z)
    return z[np.arange(len(which)), which].astype(np.float64) - np.log(total.astype(np.float64))


def _branches(vocabulary: Vocabulary, numbers: np.ndarray, features: np.ndarray, rows: int) -> Iterator[tuple]:
    """(position, bias, rows of the weights, branch) for the roots, then for the nodes further down to some words."""
    start, more = vocabulary.path_start[numbers], vocabulary.path_length[numbers] - 1
    every = np.arange(len(numbers))
    below = np.repeat(every, more)
    at = np.arange(len(below)) + np.repeat(start + 1 - np.cumsum(more) + more, more)
    for position, step in ((every, start), (below, at)):
        node = vocabulary.path_node[step]
        hashes = features if position is every else np.take(features, position, axis=1)
        inner = member_rows(hashes, vocabulary.node[node], rows)
        yield position, np.take(vocabulary.node_bias, node, axis=0), inner, vocabulary.path_branch[step]


def log10_probabilities(vocabulary: Vocabulary, weights: Weights, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each word by class and branches, without the last factor."""
    rows = len(weights.groups)
    features = context_features(vocabulary.unit[numbers], starts, int(vocabulary.trees.first[-1]) + 1)
    out = np.empty(len(numbers))
    for at in range(0, len(numbers), BATCH_TOKENS):
        part = slice(at, at + BATCH_TOKENS)
        group = vocabulary.group[numbers[part]]
        found = _log_chosen(vocabulary.group_bias, weights.groups, _upper(features[:, part], rows), group)
        for position, bias, inner, branch in _branches(vocabulary, numbers[part], features[:, part], rows):
            if len(position):
                found += np.bincount(position, _log_chosen(bias, weights.members, inner, branch), len(group))
        out[part] = found / math.log(10)
    return out


def _run_sums(values: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows in ``order``, by runs that begin at ``first``. Most are short: only others are summed as runs."""
    length = np.diff(first, append=len(order))
    sums = np.take(values, order[first], axis=0)
    two, more = np.flatnonzero(length == 2), np.flatnonzero(length > 2)
    sums[two] += np.take(values, order[first[two] + 1], axis=0)
    if len(more):
        length = length[more]
        start = np.cumsum(length) - length
        at = np.arange(start[-1] + length[-1]) + np.repeat(first[more] - start, length)
        sums[more] = segment_sums(np.take(values, order[at], axis=0), start)
    return sums


def _put_rows(table: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """``table[rows] = values``, each row copied as one item."""
    item = np.dtype((np.void, table.shape[1] * table.itemsize))
    table.view(item)[rows] = np.ascontiguousarray(values).view(item)


def _step(weights: np.ndarray, seen: np.ndarray, rows: np.ndarray, error: np.ndarray, rate: float) -> None:
    """A gradient step for the rows that occur, scaled by the gradients seen so far (as in Adagrad)."""
    every = np.arange(rows.shape[1])
    for row in rows:
        key = np.sort((row << 32) | every)  # faster than to sort positions by row
        ordered, order = key >> 32, key & 0xFFFFFFFF
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        gradient = _run_sums(error, order, first)
        touched = ordered[first]
        size = np.take(seen, touched) + (gradient * gradient) @ np.ones(gradient.shape[1], gradient.dtype)
        seen[touched] = size
        gradient *= (-rate / np.sqrt(size + 1.0))[:, None]
        gradient += np.take(weights, touched, axis=0)
        _put_rows(weights, touched, gradient)


def train(vocabulary: Vocabulary, weights: Weights, seen: tuple, numbers: np.ndarray, starts: np.ndarray) -> None:
    """Gradient steps on the words of some texts, in batches; changes ``weights`` and ``seen``."""
    rows = len(weights.groups)
    features = context_features(vocabulary.unit[numbers], starts, int(vocabulary.trees.first[-1]) + 1)
    for at in range(0, len(numbers), BATCH_TOKENS):
        part = slice(at, at + BATCH_TOKENS)
        group, outer = vocabulary.group[numbers[part]], _upper(features[:, part], rows)
        error = _softmax(vocabulary.group_bias, weights.groups, outer)
        error[np.arange(len(group)), group] -= 1.0
        _step(weights.groups, seen[0], outer, error, RATE)
        for position, bias, inner, branch in _branches(vocabulary, numbers[part], features[:, part], rows):
            if len(position):
                error = _softmax(bias, weights.members, inner)
                error[np.arange(len(branch)), branch] -= 1.0
                _step(weights.members, seen[1], inner, error, RATE)


NUMBERED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, n_rare long, low binary, "
    "high binary, classes binary, rare array<struct<word:binary,j:int,n:int>>"
)
NAMES = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "n_rare", "low", "high", "classes", "rare"]


def _bytes_of(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary value for each run of ``values``."""
    offsets = np.concatenate([[0], np.cumsum(lengths) * values.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def number_words(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The words of each text as numbers, whole; words that are not known are also listed in ``rare``.

    The numbers are of 32 bits, stored in halves since the ``high`` ones are mostly 0 and
    shrink; -1 - j is the j-th of the different words of the text that are not known, whose
    class is byte j of ``classes``. n_known and base are sums over the known ones.
    """
    known = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, index = known.value, known.value.index
        own = index.own
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch):
                split = [lower_words(t) for t in part["text"].to_pylist()]
                lengths = np.array([len(w) + 1 for w in split])
                flat = []
                for words in split:
                    flat += words
                    flat.append(END)
                numbers = np.fromiter(map(index.get, flat, repeat(-1)), np.int64, len(flat))
                places = np.cumsum(lengths) - lengths
                unknown = np.flatnonzero(numbers < 0)
                each = np.maximum(numbers, 0)
                sums = [
                    np.add.reduceat(np.where(numbers < 0, none, of_word[each]), places)
                    for of_word, none in ((vocabulary.seen.astype(np.int64), 0), (vocabulary.base, vocabulary.base[own]))
                ]
                text = np.searchsorted(places, unknown, side="right") - 1
                kinds, many, classes, listed = [], [], [], np.zeros(len(split), np.int64)
                before, first = -1, {}
                for at, i in zip(unknown.tolist(), text.tolist(), strict=True):
                    if i != before:
                        before, first = i, {}
                        done = len(kinds)
                    word = flat[at]
                    j = first.setdefault(word, len(first))
                    if done + j == len(kinds):
                        kinds.append(word)
                        many.append(1)
                        classes.append(index[word] - own)
                        listed[i] += 1
                    else:
                        many[done + j] += 1
                    numbers[at] = -1 - j
                offsets = np.concatenate([[0], np.cumsum(listed)])
                j = np.arange(len(kinds)) - np.repeat(offsets[:-1], listed)
                rare = pa.StructArray.from_arrays(
                    [pa.array(kinds, pa.binary()), pa.array(j.astype(np.int32)), pa.array(many, pa.int32())],
                    names=["word", "j", "n"],
                )
                columns = [
                    pa.array(np.arange(row, row + part.num_rows)),
                    part["doc_id"],
                    part["held_out"],
                    pa.array(lengths),
                    *(pa.array(x) for x in sums),
                    pa.array(np.bincount(text, minlength=len(split))),
                    _bytes_of((numbers & 0xFFFF).astype(np.uint16), lengths),
                    _bytes_of((numbers >> 16).astype(np.int16), lengths),
                    _bytes_of(np.array(classes, np.uint8), listed),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), rare),
                ]
                row += part.num_rows
                yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    return rows.mapInArrow(run, NUMBERED)


def with_places(numbered: DataFrame, places: DataFrame) -> DataFrame:
    """With the places of the words in ``rare`` that training has, joined, and what they add to the sums.

    They are rare by construction, so no key of that join is hot.
    """
    rare = numbered.select("row", F.explode("rare").alias("r")).select("row", "r.*")
    found = (
        rare.join(places, "word")
        .groupBy("row")
        .agg(
            F.sum(F.col("n") * F.log10(F.col("c") + F.lit(SMOOTHING))).alias("rare_log"),
            F.sum("n").alias("rare_known"),
            F.collect_list(F.struct("j", "place")).alias("places"),
        )
    )
    rare_known = F.coalesce("rare_known", F.lit(0))
    unseen_log = (F.col("n_rare") - rare_known) * F.lit(math.log10(SMOOTHING))
    return numbered.drop("rare").join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + rare_known).cast("long").alias("n_known"),
        (F.col("base") + F.coalesce("rare_log", F.lit(0.0)) + unseen_log).alias("base"),
        unseen_log.alias("unseen_log"),
        "low",
        "high",
        "classes",
        "places",
    )


def _read(vocabulary: Vocabulary, part: pa.RecordBatch) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """(vocabulary with the words of some texts, numbers of all words and ends, whether a text begins there)."""
    low, high = (
        np.frombuffer(b"".join(part[name].to_pylist()), kind).astype(np.int64)
        for name, kind in (("low", np.uint16), ("high", np.int16))
    )
    numbers = (high << 16) | low
    lengths = part["n_tokens"].to_numpy()
    starts = np.zeros(len(numbers), bool)
    starts[np.cumsum(lengths) - lengths] = True
    classes = part["classes"].to_pylist()
    listed = np.array([len(x) for x in classes])
    before = np.cumsum(listed) - listed
    of_rare = vocabulary.own + np.frombuffer(b"".join(classes), np.uint8).astype(np.int64)
    lists = part["places"]
    found = lists.flatten()
    texts = np.repeat(np.arange(len(lists)), pc.fill_null(lists.value_lengths(), 0).to_numpy())
    places, which = np.unique(found.field("place").to_numpy(), return_inverse=True)
    of_rare[before[texts] + found.field("j").to_numpy()] = vocabulary.own + CLASSES + which
    unknown = np.flatnonzero(numbers < 0)
    text = np.searchsorted(np.cumsum(lengths), unknown, side="right")
    numbers[unknown] = of_rare[before[text] - 1 - numbers[unknown]]
    return vocabulary.with_words(places), numbers, starts


def fit_weights(rows: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Train on every text of ``rows`` (as of ``with_places``) once.

    Round by round another share of the texts is used. Each trainer starts from
    the common weights, takes its steps and sends back the change (of a size that
    the vocabulary fixes); changes are averaged in a tree. There are a few trainers per
    core, however many splits the table has, and each reads its share as a stream.
    """
    context = rows.sparkSession.sparkContext
    known = context.broadcast(vocabulary.tables())
    weights = np.zeros(vocabulary.rows * (CLASSES + MEMBERS), np.float32)
    trainers = TRAINERS_PER_CORE * context.defaultParallelism

    def one_round(start: Broadcast) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = start.value.copy()
            seen = (np.zeros(known.value.rows, np.float32), np.zeros(known.value.rows, np.float32))
            tokens = 0
            for batch in batches:
                for part in slices(batch):
                    vocabulary, numbers, starts = _read(known.value, part)
                    train(vocabulary, Weights.of(own), seen, numbers, starts)
                    tokens += len(numbers)
            if tokens:
                change = (own - start.value).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([tokens]), pa.array([change], pa.binary())], names=["n", "change"])

        return run

    def add(a: tuple, b: tuple) -> tuple:
        return (a[0] + b[0], a[1] + b[1])

    for number in range(rounds):
        share = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == number)
        share = share.select("n_tokens", "low", "high", "classes", "places").coalesce(trainers)
        start = context.broadcast(weights)
        # a core adds up the changes of its trainers before they are shuffled
        changes = share.mapInArrow(one_round(start), "n long, change binary").coalesce(context.defaultParallelism).rdd.map(
            lambda r: (r["n"], np.frombuffer(r["change"], np.float32) * np.float32(r["n"]))
        )
        depth = max(2, math.ceil(math.log(max(2, context.defaultParallelism), 16)))
        tokens, total = changes.treeAggregate((0, np.zeros(1, np.float32)), add, add, depth=depth)
        if tokens:
            weights = weights + total / np.float32(tokens)
        start.unpersist()
    known.unpersist()
    return weights


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def _scored(rows: DataFrame, vocabulary: Vocabulary, weights: np.ndarray) -> DataFrame:
    context = rows.sparkSession.sparkContext
    known, learnt = context.broadcast(vocabulary.tables()), context.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Weights.of(learnt.value)
        for batch in batches:
            for part in slices(batch):
                vocabulary, numbers, starts = _read(known.value, part)
                scores = log10_probabilities(vocabulary, model, numbers, starts) + vocabulary.within[numbers]
                score = np.add.reduceat(scores, np.flatnonzero(starts)) + part["unseen_log"].to_numpy()
                columns = [part[name] for name in ("doc_id", "held_out", "n_tokens", "n_known", "base")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(score)], names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score"]
                )

    return rows.mapInArrow(run, SCORED)


def score_documents(docs: DataFrame, folds: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the documents of all folds but the first, score all.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score: log10 probabilities of the whole text under the smoothed unigram and
    the maximum-entropy model. Null text is empty: only its end is scored.
    Repeated rows are scored, and learnt from, each. Without any training text
    every word is unknown. Other columns are ignored; an empty table gives no rows.

    Texts are split into words once and stored as numbers. Words beyond the known
    ones, which any worker looks up, are numbered by a join with the counts.
    """
    held_out = (remainder(quoted(id_col), folds) == 0).alias("held_out")
    rows = docs.select(
        quoted(id_col).cast("long").alias("doc_id"), as_text(quoted(text_col)).cast("binary").alias("text"), held_out
    )
    counts = materialize(word_counts(rows.where(~F.col("held_out"))), "word-counts")
    vocabulary = build_vocabulary(counts)
    numbered = materialize(number_words(rows, vocabulary), "numbered")
    read = materialize(with_places(numbered, word_places(counts, vocabulary)), "placed")
    weights = fit_weights(read.where(~F.col("held_out")), vocabulary)
    return materialize(_scored(read, vocabulary, weights), "scored").select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )

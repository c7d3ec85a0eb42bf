"""Operator 7: near duplicates with SetSketch registers.

A document's set of five-word shingles becomes a sketch: registers that hold
truncated, exponentially spaced minima of hash values. Sketches of parts merge
by the larger register, and equal registers tell of similar sets. Bands of
registers propose pairs, the joint likelihood of both sketches estimates their
similarity, and the full sets confirm it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.columns import SLICE_ROWS, id_and_text, lower_words, slices
from glyphmill.llm.components import components
from glyphmill.sources.scratch import materialize

SHINGLE = 5
# Two sets at the threshold of 0.75 share no band with a probability of (1 - 0.75^4)^32 = 5 in a million.
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
# The sketch: base of the spacing, rate, highest register value (16 bits).
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
# An estimate is off by 0.038 (one deviation) at 0.75; five of these are allowed for.
MARGIN = 0.2
# Bits of the filter that keeps sets of documents without a candidate from being written: at least and at most.
FILTER_BITS = (1 << 16, 1 << 26)

# Cells of the table that orders shingles by how often they occur.
CELLS = 1 << 18

_REMEMBERED = 200_000
_FLAT = 1 << 16
_rng = np.random.Generator(np.random.PCG64(20240707))
_MULTIPLIERS = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _rng.integers(0, 1 << 63, SHINGLE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(words: list[bytes]) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; all of a shorter text is one shingle."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    if len(_WORDS) > _REMEMBERED:
        _WORDS.clear()
    ids = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    size = min(n, SHINGLE)
    total = np.full(n - size + 1, size, np.uint64) * _PLACES[SHINGLE]
    for k in range(size):
        total += ids[k : n - size + 1 + k] * _PLACES[k]
    return np.unique(_mix(total))


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The sketch of each (not empty) set: one row of ``REGISTERS`` 16-bit values."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    least = np.empty((len(sets), REGISTERS), np.uint64)
    buffer = np.empty_like(flat)
    for i in range(REGISTERS):
        np.multiply(flat, _MULTIPLIERS[i], out=buffer)
        np.add(buffer, _OFFSETS[i], out=buffer)
        np.minimum.reduceat(buffer, starts, out=least[:, i])
    # the least of n uniform values, as the least of n exponential ones
    x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    values = np.floor(1.0 - np.log(np.maximum(x, 1e-300)) / math.log(BASE))
    return np.clip(values, 0, TOP).astype("<u2")


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of each pair of sketches, given the sizes of the sets.

    The likelihood is that of the numbers of registers in which either sketch
    is larger or both are equal, looked up on a grid of hundredths.
    """
    if not len(a):
        return np.zeros(0)
    above = (a > b).sum(axis=1)[:, None]
    below = (a < b).sum(axis=1)[:, None]
    same = REGISTERS - above - below
    share = (n_a / (n_a + n_b))[:, None]
    grid = np.linspace(0.0, 1.0, 101)[None, :]

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1.0) / BASE) / math.log(BASE)

    tiny = 1e-9
    up, down = p(share - (1 - share) * grid), p((1 - share) - share * grid)
    possible = grid <= np.minimum(share / (1 - share), (1 - share) / share) + 0.005
    fit = above * np.log(np.maximum(up, tiny)) + below * np.log(np.maximum(down, tiny))
    fit += same * np.log(np.maximum(1.0 - up - down, tiny))
    return grid[0][np.argmax(np.where(possible, fit, -np.inf), axis=1)]


def _slices(texts: list[bytes]) -> Iterator[list[np.ndarray]]:
    """Sets of the texts, in groups of bounded size, as they come."""
    group, size = [], 0
    for text in texts:
        group.append(shingle_set(lower_words(text)))
        size += len(group[-1])
        if size > _FLAT:
            yield group
            group, size = [], 0
    if group:
        yield group


SIGNATURES = "doc_id long, key long, n long, s1 long, s2 long, sketch binary"


def row_hash(doc_id: Column, text: Column) -> Column:
    """A hash of id and text (a long and bytes without null), as ids may clash."""
    return F.xxhash64(F.coalesce(doc_id, F.lit(-1)), doc_id.isNull(), text)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", row_hash(F.col("doc_id"), F.col("text")).alias("key"))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, s1, s2, sketch): size, 128-bit hash and sketch of each text's set; no sketch for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sizes, hashes, sketches = [], [], []
                for sets in _slices(part["text"].to_pylist()):
                    sizes += [len(s) for s in sets]
                    hashes += [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                    full = [s for s in sets if len(s)]
                    rows = iter(registers(full)) if full else iter(())
                    sketches += [next(rows).tobytes() if len(s) else None for s in sets]
                pair = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        part["key"],
                        pa.array(sizes, pa.int64()),
                        pa.array(pair[:, 0].copy()),
                        pa.array(pair[:, 1].copy()),
                        pa.array(sketches, pa.binary()),
                    ],
                    names=["doc_id", "key", "n", "s1", "s2", "sketch"],
                )
        _WORDS.clear()  # the worker goes on to other work

    return _keyed(docs).mapInArrow(run, SIGNATURES)


def bands(sketches: DataFrame) -> DataFrame:
    """(node, n, band, key): each band's registers as one long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 4 * SLICE_ROWS):
                keys = np.frombuffer(b"".join(part["sketch"].to_pylist()), "<i8")
                rows = part.num_rows
                columns = [np.repeat(part[c].to_numpy(), BANDS) for c in ("node", "n")]
                columns += [np.tile(np.arange(BANDS, dtype=np.int32), rows), keys]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "n", "band", "key"])

    return sketches.select("node", "n", "sketch").mapInArrow(run, "node long, n long, band int, key long")


def _estimate_column(a: Column, b: Column, n_a: Column, n_b: Column) -> Column:
    @F.arrow_udf("double")
    def run(a: pa.Array, b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
        left, right = (np.frombuffer(b"".join(x.to_pylist()), "<u2").reshape(-1, REGISTERS) for x in (a, b))
        sizes = [x.to_numpy().astype(float) for x in (n_a, n_b)]
        out = [
            estimate(left[i : i + 2048], right[i : i + 2048], sizes[0][i : i + 2048], sizes[1][i : i + 2048])
            for i in range(0, len(left), 2048)
        ]
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return run(a, b, n_a, n_b)


def _shared_column(a: Column, b: Column) -> Column:
    @F.arrow_udf("long")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        shared = []
        for x, y in zip(a, b, strict=True):
            left, right = (np.frombuffer(v.as_py(), "<u8") for v in (x, y))
            both = np.concatenate([left, right])
            both.sort()
            shared.append(int((both[1:] == both[:-1]).sum()))
        return pa.array(shared, pa.int64())

    return run(a, b)


class _Search:
    """What the steps of one search share."""

    def __init__(self, docs: DataFrame, sketches: DataFrame, percent: int):
        self.docs, self.sketches, self.percent = docs, sketches, percent

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose estimate does not rule them out."""
        side = self.sketches.select("node", "n", "sketch")
        left, right = (side.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}")) for x in "ab")
        joined = pairs.join(left, "a").join(right, "b")
        guess = _estimate_column(F.col("sketch_a"), F.col("sketch_b"), F.col("n_a"), F.col("n_b"))
        least = self.percent / 100 - MARGIN
        return joined.select("a", "b", "n_a", "n_b", guess.alias("guess")).where(F.col("guess") >= least).drop("guess")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """(node, shingles) of the documents in ``nodes``, and of few others; stored.

        The text is read again. A bit filter of the nodes, bounded in size, is
        sent along; where it is too full to tell, more sets are written, and
        the join by node stays exact.
        """
        bits = FILTER_BITS[0]
        while bits < min(FILTER_BITS[1], 16 * nodes.count()):
            bits *= 2
        place = F.pmod(F.xxhash64("node"), F.lit(bits))
        words = (
            nodes.select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(node), {bits}) & 63 as int))").alias("bit"))
            .groupBy("w")
            .agg(F.bit_or("bit").alias("bit"))
            .collect()
        )
        table = np.zeros(bits // 64, np.int64)
        for row in words:
            table[row["w"]] = row["bit"]
        packed = table.tobytes()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, done = np.frombuffer(packed, np.uint64), set()
            for batch in batches:
                at = batch["place"].to_numpy()
                hit = (known[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
                # repeated rows once a task
                keys = batch["node"].to_pylist()
                rows = [i for i in np.flatnonzero(hit).tolist() if keys[i] not in done and not done.add(keys[i])]
                for i in range(0, len(rows), SLICE_ROWS):
                    part = batch.take(pa.array(rows[i : i + SLICE_ROWS]))
                    found = [shingle_set(lower_words(t)).tobytes() for t in part["text"].to_pylist()]
                    yield pa.RecordBatch.from_arrays(
                        [part["node"], pa.array(found, pa.binary())], names=["node", "shingles"]
                    )
            _WORDS.clear()

        rows = _keyed(self.docs.where(F.col("doc_id").isNotNull())).withColumnRenamed("key", "node").select(
            "node", F.pmod(F.xxhash64("node"), F.lit(bits)).alias("place"), "text"
        )
        return materialize(rows.mapInArrow(run, "node long, shingles binary"), "shingle-sets")

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (u, v) that their full sets confirm."""
        left, right = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s_{x}")) for x in "ab")
        joined = pairs.join(left, "a").join(right, "b")
        shared = _shared_column(F.col("s_a"), F.col("s_b"))
        return (
            joined.select("a", "b", "n_a", "n_b", shared.alias("shared"))
            .where(100 * F.col("shared") >= self.percent * (F.col("n_a") + F.col("n_b") - F.col("shared")))
            .select(F.col("a").alias("u"), F.col("b").alias("v"))
        )


def near_duplicates(docs: DataFrame, percent: int = 75, with_key: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; with ``with_key`` also its ``row_hash``, key.

    Documents are linked if their shingle sets share at least ``percent`` % of
    their union; ``component_id`` is the least doc_id reachable by links and
    ``kept`` marks that document. Texts without words have an empty set and are
    linked with nothing, a null doc_id as well (its component is null, it is
    kept). Repeated rows get equal results. Rows with equal doc_id and different
    texts are documents of their own: each is linked by its own text. Columns
    other than doc_id and text are ignored; an empty table gives no rows.

    How large groups stay cheap: equal sets are one node. In each bucket of
    equal band registers the most central member is compared with the others.
    Documents of buckets that are not connected by that are compared if they
    share one of their rarest shingles, which all links do.
    """
    rows = id_and_text(docs)
    signed = materialize(signatures(rows), "signatures")
    named = signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # a node is a set, known by the key of one of its rows; ids come back at the end
    classes = named.groupBy("s1", "s2").agg(F.min("key").alias("node"), F.min("doc_id").alias("least"))
    classes = materialize(classes.withColumnsRenamed({"s1": "_1", "s2": "_2"}), "classes", thin=True)
    # sketches are wide, so the thin keys go to them
    sketches = named.join(classes.select("node"), F.col("key") == F.col("node"), "left_semi")
    sketches = sketches.select(F.col("key").alias("node"), "n", "sketch").dropDuplicates(["node"])
    sketches = materialize(sketches, "sketches")
    search = _Search(rows, sketches, percent)

    # buckets with company, and how central each node is: how many it meets over all bands
    placed = bands(sketches)
    sizes = placed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialize(placed.join(sizes, ["band", "key"]), "shared-buckets", thin=True)
    central = materialize(shared.groupBy("node").agg(F.sum("size").alias("met")), "central", thin=True)
    members = materialize(
        shared.join(central, "node").select("band", "key", "node", "n", "met"), "bucket-members", thin=True
    )

    links = materialize(_star(search, members), "links", thin=True)
    first = materialize(components(links), "components", thin=True)
    open_nodes = materialize(_unsettled(members, first), "unsettled-nodes", thin=True)
    more = _between_components(search, open_nodes)
    joined = components(materialize(more, "links", thin=True))
    # what belongs together beyond the first components
    joined = joined.select(F.col("node").alias("_first"), F.col("component").alias("_second"))
    both = first.unionByName(joined.select(F.col("_first").alias("node"), F.col("_first").alias("component")))
    label = both.distinct().join(joined, F.col("component") == F.col("_first"), "left").select(
        "node", F.coalesce("_second", "component").alias("component")
    )
    label = materialize(label, "components", thin=True)
    roots = label.join(classes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("root"))
    rooted = label.join(materialize(roots, "roots", thin=True), "component").select(F.col("node").alias("_node"), "root")

    known = signed.join(classes, F.expr("s1 = _1 AND s2 = _2 AND n > 0 AND doc_id IS NOT NULL"), "left")
    final = known.join(rooted, F.col("node") == F.col("_node"), "left")
    component = F.coalesce("root", "least", "doc_id")
    return final.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        *(["key"] if with_key else []),
    )


def _star(search: _Search, members: DataFrame) -> DataFrame:
    """Compare each bucket's members with its most central one (of these, the one with the least id)."""
    hubs = members.groupBy("band", "key").agg(F.max(F.struct("met", (-F.col("node")).alias("minus"), "n")).alias("hub"))
    hubs = materialize(
        hubs.select("band", "key", (-F.col("hub.minus")).alias("b"), F.col("hub.n").alias("n_hub")), "hubs", thin=True
    )
    pairs = members.join(hubs, ["band", "key"]).where(F.col("node") != F.col("b"))
    pairs = pairs.where(_sizes_allow(search.percent, "n", "n_hub"))
    likely = _likely_pairs(search, pairs.select(F.col("node").alias("a"), "b"))
    nodes = likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return search.confirmed(likely, search.sets(nodes))


def _unsettled(members: DataFrame, label: DataFrame) -> DataFrame:
    """(node, n, label) of the members of buckets that hold more than one component."""
    named = label.select(F.col("node").alias("_node"), "component")
    tagged = members.join(named, F.col("node") == F.col("_node"), "left").select(
        "band", "key", "node", "n", F.coalesce("component", "node").alias("label")
    )
    tagged = materialize(tagged, "labelled-members", thin=True)
    mixed = tagged.groupBy("band", "key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    mixed = materialize(mixed.select("band", "key"), "mixed-buckets", thin=True)
    return tagged.join(mixed, ["band", "key"]).select("node", "n", "label").distinct()


def _between_components(search: _Search, nodes: DataFrame) -> DataFrame:
    """All links (u, v) between nodes of different components, as links of their labels.

    Sets whose similarity reaches the threshold share one of their first
    shingles, whatever the common order; with the rare ones first, documents
    that only have a common passage, or a common origin, share none of these. So
    this finds every link without comparing each with each. The order is by
    counts of hash cells, a table of fixed size.
    """
    sets = search.sets(nodes.select("node"))
    own = materialize(nodes.join(sets, "node"), "unsettled-sets")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in slices(batch):
                items = np.frombuffer(b"".join(part["shingles"].to_pylist()), "<u8")
                total += np.bincount((items % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])

    counted = own.select("shingles").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counted = counted.toArrow()
    order = np.zeros(CELLS, np.int64)
    order[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    frequency, percent = own.sparkSession.sparkContext.broadcast(order), search.percent

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", "n", "label"]
        for batch in batches:
            for part in slices(batch):
                firsts = []
                for packed in part["shingles"]:
                    items = np.frombuffer(packed.as_py(), "<u8")
                    ranked = items[np.lexsort((items, frequency.value[items % np.uint64(CELLS)]))]
                    firsts.append(ranked[: len(items) + (-percent * len(items)) // 100 + 1])
                sizes = [len(f) for f in firsts]
                columns = [np.repeat(part[c].to_numpy(), sizes) for c in names]
                columns.append(np.concatenate([np.arange(k, dtype=np.int64) for k in sizes]))
                columns.append(np.concatenate(firsts).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*names, "place", "shingle"])

    head = own.select("node", "n", "label", "shingles").mapInArrow(
        heads, "node long, n long, label long, place long, shingle long"
    )
    head = materialize(head, "first-shingles", thin=True)
    spans = head.groupBy("shingle").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    met = materialize(head.join(materialize(spans.select("shingle"), "met-shingles", thin=True), "shingle"), "met-first-shingles", thin=True)
    left, right = (met.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "label", "place")]) for x in "ab")
    # at the first shingle two alike sets share, what comes after it must suffice
    rest = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    enough = (100 + percent) * rest >= percent * (F.col("n_a") + F.col("n_b"))
    pairs = left.join(right, "shingle").where("label_a < label_b").where(_sizes_allow(percent, "n_a", "n_b") & enough)
    likely = _likely_pairs(search, pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    links = search.confirmed(likely, own.select("node", "shingles"))
    u, v = (nodes.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")) for x in "uv")
    return links.join(u, "u").join(v, "v").select(F.col("label_u").alias("u"), F.col("label_v").alias("v")).distinct()


def _sizes_allow(percent: int, a: str, b: str) -> Column:
    """Sets of very different size can't reach the threshold."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _likely_pairs(search: _Search, pairs: DataFrame) -> DataFrame:
    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return materialize(search.likely(ordered), "candidates", thin=True)

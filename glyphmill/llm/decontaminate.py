"""Operator 8: benchmark decontamination, in DataFrame operations only.

Windows of a document that are as long as a benchmark item get a SimHash
fingerprint. Fingerprints are cut into blocks, one more than the radius: two
that differ in at most ``RADIUS`` bits have an equal block, so a join by block
finds all of them. A radius can't cover every pair that is similar enough (many
words may differ at an edge, or one word many times), so windows and items that
share a shingle of their prefixes are candidates as well, which leaves out none
(see ``_prefix``). Candidates are then verified by the exact similarity of their
weighted shingles.

A window that shares no shingle with an item has similarity 0 with it. So
windows are laid only where document and item share a shingle, such that the
two occurrences coincide; a bit filter of the items' shingles finds these places
without a join. A document with such places is stored once with them; places
move by themselves, and a window is cut from its document once for each
different start, so a row never holds more than a document or a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions.arrays import bind, running_sum
from glyphmill.llm.columns import as_text, quoted, row_key
from glyphmill.sources.scratch import materialize, thinned

SHINGLE = 5
SIMILARITY = 0.75
BITS = 64
# A changed word or two stay within the radius. At similarity 0.75 up to a seventh of the words may differ; what
# then lies beyond it is found by prefixes. Blocks of 8 bits let 3 % of unlike pairs of equal size meet.
RADIUS = 7
BLOCKS = RADIUS + 1
_BLOCK_BITS = BITS // BLOCKS
# Bits of the filter of item shingles: so many for each of them, within these bounds. A benchmark of over a million
# shingles makes it let more through, never less.
FILTER_BITS_EACH = 16
LEAST_FILTER_BITS, MOST_FILTER_BITS = 1 << 19, 1 << 24
_FILTER_HASHES = 3
_FILTER_SHIFT = 20


def word_list(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null text has none."""
    return F.array_remove(F.split(F.lower(as_text(text)), r"[^\p{L}\p{N}]+"), "")


def _shingles(words: Column, size: int) -> Column:
    """Hash of each run of ``size`` words; the i-th begins at word i."""
    starts = F.sequence(F.lit(1), F.size(words) - F.lit(size - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(F.size(words) >= size, hashes).otherwise(F.array().cast("array<bigint>"))


def item_table(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, words, size, gram): ``gram`` is the shingle length, less than five for a shorter item.

    Items without words are left out.
    """
    words = benchmark.select(quoted(id_col).alias("item_id"), word_list(quoted(text_col)).alias("words"))
    sized = words.where(F.size("words") > 0).withColumn("size", F.size("words"))
    return sized.withColumn("gram", F.least(F.col("size"), F.lit(SHINGLE)))


def _by_gram(words: Column, gram: Column, grams: list[int]) -> Column:
    """Shingles of the length a column names, out of a few known lengths."""
    return F.coalesce(*[F.when(gram == g, _shingles(words, g)) for g in grams])


def _filter_places(h: Column, bits: int) -> list[Column]:
    return [F.shiftrightunsigned(h, _FILTER_SHIFT * k).bitwiseAND(F.lit(bits - 1)) for k in range(_FILTER_HASHES)]


def _bit_filter(hashes: DataFrame) -> tuple[Column, int]:
    """The filter as a constant, and its bits: words of 64 bits, at most MOST_FILTER_BITS / 64 of them reach the driver."""
    wanted = FILTER_BITS_EACH * hashes.count()
    bits = min(MOST_FILTER_BITS, max(LEAST_FILTER_BITS, 1 << max(0, wanted - 1).bit_length()))
    places = hashes.select(F.explode(F.array(*_filter_places(F.col("h"), bits))).alias("p"))
    rows = (
        places.select((F.shiftright("p", 6)).cast("int").alias("w"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bit"))
        .groupBy("w")
        .agg(F.bit_or("bit").alias("bit"))
        .collect()
    )
    table = [0] * (bits // 64)
    for row in rows:
        table[row["w"]] = row["bit"]
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>"), bits


def _in_filter(table: Column, bits: int, h: Column) -> Column:
    found = F.lit(True)
    for place in _filter_places(h, bits):
        word = F.get(table, F.shiftright(place, 6).cast("int"))
        found = found & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return found


def fingerprint(words: Column) -> Column:
    """SimHash of the words, each weighted by how often it occurs: the majority of their hashes' bits."""

    def of(hashes: Column) -> Column:
        def bit(b: Column) -> Column:
            votes = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.getbit(h, b))
            # shiftleft takes a fixed distance from Python, a column through SQL only
            return F.when(2 * votes > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(
                F.lit(0).cast("bigint")
            )

        set_bits = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), bit)
        return F.aggregate(set_bits, F.lit(0).cast("bigint"), lambda all_bits, one: all_bits.bitwiseOR(one))

    return bind(F.transform(words, lambda w: F.xxhash64(w)), of)


def _blocks(print_col: Column) -> Column:
    """(block, value) of each block of a fingerprint."""
    mask = (1 << _BLOCK_BITS) - 1
    return F.array(
        *[
            F.struct(
                F.lit(b).alias("block"),
                F.shiftrightunsigned(print_col, b * _BLOCK_BITS).bitwiseAND(F.lit(mask)).alias("value"),
            )
            for b in range(BLOCKS)
        ]
    )


def _prefix(shingles: Column, similarity: float) -> Column:
    """The first shingles in order of their hashes, as many as may be missing in a similar text, and one more.

    Similarity is at most shared over own shingles (counted with multiplicity), so of ``n`` at least
    ``similarity * n`` are shared. Two that share so many have a common one in both prefixes.
    """
    needed = F.ceil(F.size(shingles) * F.lit(similarity) - F.lit(1e-9)).cast("int")
    return F.array_distinct(F.slice(F.array_sort(shingles), 1, F.size(shingles) - needed + 1))


def _told_apart(values: Column) -> Column:
    """Elements of a hash array with equal ones numbered, so that no two are equal; linear in its length."""

    def numbered(ordered: Column) -> Column:
        new = F.transform(ordered, lambda x, i: F.when((i > 0) & (F.get(ordered, i - 1) == x), F.lit(0)).otherwise(F.lit(1)))

        def count(flags: Column) -> Column:
            firsts = F.filter(F.transform(flags, lambda f, i: F.when(f == 1, i)), lambda i: i.isNotNull())
            return bind(
                firsts,
                lambda first: bind(
                    running_sum(flags),
                    lambda group: F.transform(ordered, lambda x, i: F.xxhash64(x, i - F.get(first, F.get(group, i) - 1))),
                ),
            )

        return bind(new, count)

    once = F.size(F.array_distinct(values)) == F.size(values)
    return F.when(once, F.transform(values, lambda x: F.xxhash64(x, F.lit(0)))).otherwise(bind(F.array_sort(values), numbered))


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of the lesser over sum of the greater multiplicities of the elements of two arrays of hashes."""
    shared = F.size(F.array_intersect(_told_apart(a), _told_apart(b)))
    return bind(shared, lambda s: s / (F.size(a) + F.size(b) - s))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document and benchmark item found in it.

    Returns doc_id, k1, k2 (the row's key, see ``row_key``), item_id, start (the
    window's first word, from 0), n_words and similarity, for the window most
    similar to the item (the first of equal ones). Words are lower-cased runs of
    letters and digits; null or empty texts and items have none and match
    nothing; of a document shorter than the item the window is all of it.
    Repeated rows give one result. Other columns are ignored. An empty table on
    either side gives no rows.

    Texts are read once and never shuffled; what moves are windows at shared
    shingles. Equal windows are fingerprinted and verified once, however many
    documents hold them.
    """
    items = materialize(item_table(benchmark), "items")
    grams = sorted(r["gram"] for r in items.select("gram").distinct().collect())
    schema = "doc_id long, k1 long, k2 long, item_id long, start int, n_words int, similarity double"
    if not grams:
        return docs.sparkSession.createDataFrame([], schema)
    placed = items.select("size", "gram", F.posexplode(_by_gram(F.col("words"), F.col("gram"), grams)).alias("at", "h"))
    anchors = materialize(thinned(placed.select("h", "at", "size").distinct()), "item-shingles")
    table, bits = _bit_filter(anchors.select("h").distinct())

    # places in the documents that may hold a shingle of an item
    doc_id = quoted("doc_id").cast("long")
    text = as_text(quoted("text"))
    key = row_key(doc_id, text)

    def places(words: Column) -> Column:
        found = []
        for gram in grams:
            found.append(
                bind(
                    _shingles(words, gram),
                    lambda hashes: F.filter(
                        F.transform(hashes, lambda h, i: F.when(_in_filter(table, bits, h), F.struct(i.alias("pos"), h.alias("h")))),
                        lambda place: place.isNotNull(),
                    ),
                )
            )
        return F.concat(*found)

    held = docs.select(
        doc_id.alias("doc_id"),
        key[0].alias("k1"),
        key[1].alias("k2"),
        F.explode(F.array(bind(word_list(text), lambda w: F.struct(w.alias("words"), places(w).alias("places"))))).alias("d"),
    )
    held = held.where(F.size("d.places") > 0).select("doc_id", "k1", "k2", F.size("d.words").alias("total"), "d.words", "d.places")
    held = materialize(held.withColumn("row", F.monotonically_increasing_id()), "documents-with-places")
    hits = held.select("row", "k1", "k2", "total", F.inline("places"))
    # the window begins where the item would, but within the document
    begin = F.greatest(F.least(F.col("pos") - F.col("at"), F.col("total") - F.col("size")), F.lit(0))
    starts = hits.join(anchors, "h").groupBy("k1", "k2", "size", begin.alias("start")).agg(F.min("row").alias("row"))
    # as many as the document has words and the benchmark sizes, at most; of repeated rows one is taken
    starts = starts.groupBy("k1", "k2").agg(F.collect_list(F.struct("size", "start")).alias("starts"), F.min("row").alias("row"))
    starts = materialize(thinned(starts.select("row", "starts")), "window-starts")
    once = held.select("row", "doc_id", "k1", "k2", "words").join(starts, "row")
    windows = (
        once.select("doc_id", "k1", "k2", "words", F.explode("starts").alias("at"))
        .select("doc_id", "k1", "k2", "at.size", "at.start", F.slice("words", F.col("at.start") + 1, F.col("at.size")).alias("words"))
        .withColumn("w1", F.xxhash64(F.lit(1), "words"))
        .withColumn("w2", F.xxhash64(F.lit(2), "words"))
    )
    windows = materialize(windows, "windows")
    distinct = materialize(windows.groupBy("w1", "w2", "size").agg(F.first("words").alias("words")), "distinct-windows")

    prints = distinct.select("w1", "w2", "size", fingerprint(F.col("words")).alias("print"))
    prints = materialize(thinned(prints), "window-prints")
    item_prints = materialize(items.select("item_id", "size", fingerprint(F.col("words")).alias("item_print")), "item-prints")
    near = (
        prints.select("*", F.explode(_blocks(F.col("print"))).alias("b")).select("w1", "w2", "size", "print", "b.*")
        .join(
            item_prints.select("*", F.explode(_blocks(F.col("item_print"))).alias("b")).select(
                "item_id", "size", "item_print", "b.*"
            ),
            ["size", "block", "value"],
        )
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("w1", "w2", "size", "item_id")
    )

    def prefixes(frame: DataFrame, *keys: str) -> DataFrame:
        shingles = _by_gram(F.col("words"), F.least(F.col("size"), F.lit(SHINGLE)), grams)
        return frame.select(*keys, "size", F.explode(bind(shingles, lambda s: _prefix(s, similarity))).alias("h"))

    item_prefixes = materialize(thinned(prefixes(items, "item_id").distinct()), "item-prefixes")
    covered = prefixes(distinct, "w1", "w2").join(item_prefixes, ["size", "h"]).select("w1", "w2", "size", "item_id")
    near = materialize(thinned(near.unionByName(covered).distinct()), "near-windows")
    item_words = items.select("item_id", "gram", F.col("words").alias("item_words"))
    compared = near.join(distinct, ["w1", "w2", "size"]).join(item_words, "item_id")
    own, other = (_by_gram(F.col(c), F.col("gram"), grams) for c in ("words", "item_words"))
    value = bind(own, lambda a: bind(other, lambda b: weighted_similarity(a, b)))
    verified = compared.select("w1", "w2", "size", "item_id", value.alias("similarity")).where(
        F.col("similarity") >= similarity
    )
    verified = materialize(thinned(verified), "verified-windows")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("minus"))).alias("best")
    return (
        windows.select("doc_id", "k1", "k2", "size", "start", "w1", "w2")
        .join(verified, ["w1", "w2", "size"])
        .groupBy("doc_id", "k1", "k2", "item_id", "size")
        .agg(best)
        .select(
            "doc_id", "k1", "k2", "item_id", (-F.col("best.minus")).alias("start"), F.col("size").alias("n_words"),
            F.col("best.similarity").alias("similarity"),
        )
    )

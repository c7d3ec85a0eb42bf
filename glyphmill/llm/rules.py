"""Operator 10: quality rules with adaptive thresholds.

Text statistics are taken in one pass and stored as a thin table. Mergeable
quantile sketches of each statistic (counts in exponentially spaced buckets,
which add up) are kept per language and source; fences derived from their
quantiles replace fixed cutoffs and are joined back to filter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.llm.columns import SPACE, as_text, quoted, slices
from glyphmill.sources.scratch import materialize

# Fixed value: the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

# Width of a bucket: a quantile is off by at most half of this share of its value.
GROWTH = 1.02
# The wider level counts in a group's quantiles as that many documents of its own.
PRIOR_DOCS = 50


@dataclass(frozen=True)
class Fence:
    """A document is out if its value is above ``middle + spread * deviation + slack``.

    ``low``, ``middle`` and ``high`` are the group's quantiles. The deviation is
    ``high - middle``, but at most that of the language plus the group's own
    ``middle - low``: bad documents, as long as they are fewer than half, raise
    the high quantile alone, and a source full of them can't lift its fence by
    it. ``slack`` is how far any document may always lie from its group, so that
    a group of equal documents does not reject the first that differs.
    """

    spread: float
    slack: float
    low: float = 0.2
    middle: float = 0.5
    high: float = 0.8


FENCES = {
    "symbol_rate": Fence(spread=3.0, slack=0.2),
    "repeat_rate": Fence(spread=3.0, slack=0.3),
    "dup_line_rate": Fence(spread=3.0, slack=0.35),
    "word_length": Fence(spread=3.0, slack=2.5),
    "word_shortness": Fence(spread=3.0, slack=0.1),
}

STATISTICS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words that lie in a window of ``size`` words found at least twice in the text."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    window = ids[:n]
    for shift in range(1, size):
        window = window * len(numbers) + ids[shift : shift + n]
        if shift + 1 < size:
            window = np.unique(window, return_inverse=True)[1].astype(np.int64)
    _, which, counts = np.unique(window, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[which] > 1)
    marked = np.zeros(len(words), bool)
    for shift in range(size):
        marked[starts + shift] = True
    return int(marked.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    seen: set[bytes] = set()
    n = 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
        elif line.strip():
            seen.add(line)
    return n


def text_statistics(text: bytes) -> tuple[int, ...]:
    words = text.split()
    spaces = sum(text.count(SPACE[i : i + 1]) for i in range(len(SPACE)))
    chars = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    symbols = sum(text.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    lines = text.count(b"\n") + 1
    return len(words), chars - spaces, symbols, lines, repeated_lines(text), repeated_words(words)


def statistics(docs: DataFrame, group_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """One thin row per document: doc_id, the group columns and the statistics of the whole text.

    Null texts are empty, null group values form a group of their own.
    """
    names = [part.split()[0] for part in STATISTICS.split(", ")]
    groups = [quoted(c).cast("string").alias(c) for c in group_cols]
    rows = docs.select(
        quoted("doc_id").cast("long").alias("doc_id"), *groups, as_text(quoted("text")).cast("binary").alias("_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = np.array([text_statistics(t) for t in part["_text"].to_pylist()], np.int64)
                columns = [part["doc_id"], *(part[c] for c in group_cols), *(pa.array(c) for c in found.T)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *group_cols, *names])

    schema = ", ".join(["doc_id long", *(f"`{c}` string" for c in group_cols), STATISTICS])
    return rows.mapInArrow(run, schema)


def measures() -> dict[str, Column]:
    """The statistics as rates, so that documents of any length compare; null without words."""
    n = F.nullif(F.col("n_words"), F.lit(0))
    return {
        "symbol_rate": F.col("n_symbols") / n,
        "repeat_rate": F.col("n_repeat_words") / n,
        "dup_line_rate": F.col("n_dup_lines") / F.col("n_lines"),
        "word_length": F.col("word_chars") / n,
        "word_shortness": n / F.col("word_chars"),
    }


def bucket(value: Column) -> Column:
    """The sketch's bucket: powers of ``GROWTH``; 0 has one of its own."""
    return F.when(value <= 0, F.lit(-100_000)).otherwise(F.ceil(F.log(value) / F.lit(math.log(GROWTH)))).cast("int")


def bucket_value(index: Column) -> Column:
    middle = 2.0 / (1.0 + 1.0 / GROWTH) / GROWTH
    return F.when(index <= -100_000, F.lit(0.0)).otherwise(F.pow(F.lit(GROWTH), index) * F.lit(middle))


def sketch(thin: DataFrame, group_cols: tuple[str, ...]) -> DataFrame:
    """Counts by group, measure and bucket. Sketches merge by adding counts of equal buckets."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(m).alias("measure"), bucket(v).alias("bucket")) for m, v in measures().items()])
    )
    return (
        thin.select(*group_cols, cells.alias("cell"))
        .select(*group_cols, "cell.*")
        .where(F.col("bucket").isNotNull())
        .groupBy(*group_cols, "measure", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge_sketches(cells: DataFrame, group_cols: tuple[str, ...]) -> DataFrame:
    """The sketch of coarser groups (or of several tables in union)."""
    return cells.groupBy(*group_cols, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(cells: DataFrame, group_cols: tuple[str, ...], limits: dict[str, Fence]) -> DataFrame:
    """Per group: its number of documents and for each measure a struct ``low, middle, high``.

    A sketch has a bounded number of buckets, so the running sums are short.
    """
    by = Window.partitionBy(*group_cols, "measure")
    ranked = cells.withColumn("below", F.sum("n").over(by.orderBy("bucket"))).withColumn("total", F.sum("n").over(by))
    columns = [F.max("total").alias("docs")]
    for name, fence in limits.items():
        own = F.col("measure") == name
        parts = [
            bucket_value(F.min(F.when(own & (F.col("below") >= F.lit(q) * F.col("total")), F.col("bucket")))).alias(level)
            for level, q in (("low", fence.low), ("middle", fence.middle), ("high", fence.high))
        ]
        columns.append(F.struct(*parts).alias(name))
    return ranked.groupBy(*group_cols).agg(*columns)


def shrunk(own: Column, wider: Column, docs: Column, prior_docs: float) -> Column:
    """A group's quantiles moved towards the wider level's, which weigh ``prior_docs`` documents."""
    weight = docs / (docs + F.lit(float(prior_docs)))
    return F.struct(
        *[
            F.coalesce(own[q] * weight + wider[q] * (1.0 - weight), own[q], wider[q]).alias(q)
            for q in ("low", "middle", "high")
        ]
    )


def fence_value(own: Column, wider: Column, fence: Fence) -> Column:
    """The highest value that stays in a group of these quantiles, ``wider`` being its language's."""
    deviation = F.least(own["high"] - own["middle"], wider["high"] - wider["middle"] + own["middle"] - own["low"])
    return own["middle"] + F.lit(fence.spread) * deviation + F.lit(fence.slack)


def fences(cells: DataFrame, limits: dict[str, Fence], prior_docs: float) -> DataFrame:
    """Per language and source the highest value of each measure that stays, as ``max_<measure>``.

    The quantiles of a language are shrunk towards those of all documents, those
    of a source towards its language's.
    """
    overall = quantiles(merge_sketches(cells, ()), (), limits).select(*[F.col(m).alias(f"all_{m}") for m in limits])
    by_lang = quantiles(merge_sketches(cells, ("lang",)), ("lang",), limits).join(F.broadcast(overall))  # of one row
    langs = by_lang.select(
        F.col("lang").alias("_of"),
        *[shrunk(F.col(m), F.col(f"all_{m}"), F.col("docs"), prior_docs).alias(f"lang_{m}") for m in limits],
    )
    by_source = quantiles(cells, ("lang", "source"), limits).join(langs, F.expr("lang <=> _of"))
    own = by_source.select(
        "lang",
        "source",
        *[f"lang_{m}" for m in limits],
        *[shrunk(F.col(m), F.col(f"lang_{m}"), F.col("docs"), prior_docs).alias(m) for m in limits],
    )
    return own.select(
        "lang",
        "source",
        *[fence_value(F.col(m), F.col(f"lang_{m}"), fence).alias(f"max_{m}") for m, fence in limits.items()],
    )


def adaptive_rules(
    docs: DataFrame, limits: dict[str, Fence] | None = None, prior_docs: float = PRIOR_DOCS
) -> tuple[DataFrame, DataFrame]:
    """(verdicts, fences): one row per document, and the table of fences it was judged by.

    ``base_failed`` holds for documents under 50 words or with over half of the
    words in repeated windows; ``kept`` is false for these, else it tells
    whether every measure lies within the fence of the document's language and
    source. The sketches are of documents with words that pass the base rules.
    The fewer documents a group has, the more its fences are those of its
    language, and a language's those of all: there is no size at which they
    change over. Repeated rows get equal verdicts and count each; an empty table
    gives no rows.
    """
    limits, groups = limits or FENCES, ("lang", "source")
    thin = materialize(statistics(docs, groups), "statistics")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    cells = materialize(sketch(thin.where(~failed), groups), "sketch")
    chosen = fences(cells, limits, prior_docs).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    # written, so that the join below sees two plain inputs: broadcast by measured size, or skewed parts split
    table = materialize(chosen, "fences")
    within = F.lit(True)
    for name, value in measures().items():
        if name in limits:
            within = within & F.coalesce(value <= F.col(f"max_{name}"), F.lit(True))
    verdicts = (
        thin.join(table, F.expr("lang <=> _lang AND source <=> _source"), "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & within)
        .drop("_lang", "_source")
    )
    return verdicts, table.withColumnsRenamed({"_lang": "lang", "_source": "source"})

"""Lexicon sentiment as plain column expressions: no shuffle, no Python worker."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions.arrays import bind, with_fixed
from glyphmill.functions.lexicon import SPANISH_POLARITY, PolarityLexicon, term_pattern
from glyphmill.functions.membership import key_filter
from glyphmill.functions.numeric import round_exact
from glyphmill.functions.text import filled, stable_unit, tokens
from glyphmill.sources.scratch import materialize


def evidence(distinct_tokens: Column, words: Iterable[str]) -> Column:
    """How many of the distinct tokens are listed (a hash-set test per token)."""
    listed = sorted(words)
    return F.size(F.filter(distinct_tokens, lambda token: token.isin(listed)))


def polarity_counts(text: Column, lexicon: PolarityLexicon) -> Column:
    """struct(positive, negative): distinct listed tokens of either polarity."""
    found = F.regexp_extract_all(text, F.lit(term_pattern(lexicon.positive | lexicon.negative)), F.lit(0))
    return bind(
        F.array_distinct(F.transform(found, F.lower)),
        lambda distinct: F.struct(
            evidence(distinct, lexicon.positive).alias("positive"),
            evidence(distinct, lexicon.negative).alias("negative"),
        ),
    )


def label_of(positive: Column, negative: Column) -> Column:
    """POS or NEG by majority; NEU for a tie or no evidence."""
    return F.when(positive > negative, "POS").when(negative > positive, "NEG").otherwise("NEU")


def confidence_of(text: Column, positive: Column, negative: Column) -> Column:
    """A base from the text's stable unit plus a margin for the evidence, at most 0.99."""
    margin = F.least(F.abs(positive - negative) * F.lit(0.1), F.lit(0.3))
    raw = F.lit(0.6) + F.lit(0.3) * stable_unit(text) + margin
    return F.least(round_exact(raw), F.lit(0.99))


def lexicon_sentiment(corpus: DataFrame, lexicon: PolarityLexicon = SPANISH_POLARITY) -> DataFrame:
    """Add ``label`` and ``confidence`` to an ``(id, text)`` corpus.

    The lists become one pattern, whatever their size; lists too large for a
    plan belong in a table (``join_sentiment``).
    """
    prepared = corpus.withColumn("text", filled(F.col("text")))
    counted = with_fixed(prepared, "_found", polarity_counts(F.col("text"), lexicon))
    return _judged(counted).drop("_found")


def _judged(counted: DataFrame) -> DataFrame:
    positive, negative = F.col("_found.positive"), F.col("_found.negative")
    return counted.withColumns(
        {
            "label": label_of(positive, negative),
            "confidence": confidence_of(F.col("text"), positive, negative),
        }
    )


def polarity_table(terms: DataFrame) -> DataFrame:
    """One row per term from ``(term, polarity)``: whether it is listed as ``positive`` and as ``negative``."""
    return terms.groupBy("term").agg(
        F.max(F.coalesce(F.col("polarity") == "positive", F.lit(False))).alias("positive"),
        F.max(F.coalesce(F.col("polarity") == "negative", F.lit(False))).alias("negative"),
    )


def join_sentiment(corpus: DataFrame, terms: DataFrame) -> DataFrame:
    """``lexicon_sentiment`` with the lexicon as a table ``(term, polarity)``, of any size.

    Each row's distinct tokens that a bit filter of the terms lets pass are joined
    with the terms and counted per row; the counts come back to the texts by a key made of the row's id and text, so
    rows repeated with both share them. Rows without evidence are neutral.
    """
    prepared = corpus.withColumn("text", filled(F.col("text")))
    key = F.sha2(F.concat_ws("\x00", F.coalesce("id", F.lit("\x01")), "text"), 256)
    keyed = prepared.withColumn("_key", key)
    distinct = F.array_distinct(F.transform(tokens(F.col("text")), F.lower))
    known = materialize(polarity_table(terms), "terms")
    likely = key_filter(known, "term")
    passed = F.filter(distinct, lambda term: bind(F.xxhash64(term), likely.may_hold))
    found = keyed.select("_key", F.explode(passed).alias("term")).distinct()
    counts = found.join(known, "term").groupBy("_key").agg(
        F.struct(
            F.count_if("positive").cast("int").alias("positive"), F.count_if("negative").cast("int").alias("negative")
        ).alias("_found")
    )
    none = F.struct(F.lit(0).alias("positive"), F.lit(0).alias("negative"))
    counted = keyed.join(counts, "_key", "left").withColumn("_found", F.coalesce("_found", none))
    return _judged(counted).select(*prepared.columns, "label", "confidence")

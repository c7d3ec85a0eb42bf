"""Entity extraction and the roll-up of entities to rows.

The work is local to a row, so a corpus of any size needs no shuffle: spans come
from one row's own arrays and the text never leaves its task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions.arrays import bind, running_sum, with_fixed
from glyphmill.functions.lexicon import SPANISH_CLINICAL, EntityLexicon, term_pattern, term_score
from glyphmill.functions.membership import KeyFilter, key_filter
from glyphmill.functions.numeric import compensated_sum, round_exact
from glyphmill.functions.text import WORD, filled, stable_unit, tokens
from glyphmill.operators.schemas import ENTITY, SPAN_FIELDS
from glyphmill.sources.scratch import materialize

# Drops the rows of empty arrays. A plain explode has Spark test the array's size
# below the projection that makes it, which makes the array a second time.
_ELEMENT = "ordinal IS NOT NULL"

def _matches_with_ends(text: Column, pattern: str, found: Column) -> Column:
    """struct(found, ends): the matches and the end offset of each, in code points.

    ``split`` gives the gaps around the matches; an end is the running sum of
    gap and match lengths.
    """
    gaps = F.split(text, pattern, -1)
    return bind(
        F.struct(found.alias("found"), gaps.alias("gaps")),
        lambda s: F.struct(
            s["found"].alias("found"),
            running_sum(
                F.transform(s["found"], lambda hit, i: F.length(F.get(s["gaps"], i)) + F.length(hit))
            ).alias("ends"),
        ),
    )


def lexicon_entities(corpus: DataFrame, lexicon: EntityLexicon = SPANISH_CLINICAL) -> DataFrame:
    """Add ``entities``, ``n_entities`` and ``confidence`` to an ``(id, text)`` corpus.

    Every occurrence of a listed term becomes an entity, in text order, with its
    surface form and the span ``[start, end)``. The lexicon becomes one pattern,
    whatever its size; a lexicon too large for a plan belongs in a table
    (``join_entities``).
    """
    types = lexicon.term_types()
    prepared = corpus.withColumn("text", filled(F.col("text")))
    if not types:
        return roll_up(prepared.withColumn("entities", F.array().cast(f"array<{ENTITY.simpleString()}>")))

    pattern = term_pattern(types)
    known = F.create_map(
        *[
            part
            for term, kind in types.items()
            for part in (F.lit(term), F.struct(F.lit(kind).alias("type"), F.lit(term_score(term)).alias("score")))
        ]
    )

    def build(s: Column) -> Column:
        def entity(surface: Column, i: Column) -> Column:
            end = F.get(s["ends"], i)
            return bind(
                F.try_element_at(known, F.lower(surface)),
                lambda term: F.when(
                    term.isNotNull(),
                    F.struct(
                        surface.alias("text"),
                        term["type"].alias("type"),
                        (end - F.length(surface)).alias("start"),
                        end.alias("end"),
                        term["score"].alias("score"),
                    ),
                ),
            )

        return F.filter(F.transform(s["found"], entity), lambda e: e.isNotNull())

    text = F.col("text")
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    entities = bind(_matches_with_ends(text, pattern, hits), build)
    return roll_up(with_fixed(prepared, "entities", entities))


def roll_up(frame: DataFrame) -> DataFrame:
    """Add ``n_entities`` and ``confidence`` (mean score, 0.0 without entities)."""
    entities = F.coalesce(F.col("entities"), F.array().cast(f"array<{ENTITY.simpleString()}>"))
    scores = F.transform(F.col("entities"), lambda e: e["score"])
    return (
        frame.withColumn("entities", entities)
        .withColumn("n_entities", F.size("entities"))
        .withColumn(
            "confidence",
            F.when(F.col("n_entities") == 0, F.lit(0.0)).otherwise(
                round_exact(compensated_sum(scores) / F.greatest(F.col("n_entities"), F.lit(1)))
            ),
        )
    )


def normalize_spans(frame: DataFrame, raw_spans: str = "raw_spans") -> DataFrame:
    """Bring raw model spans into the entity schema and roll them up.

    ``raw_spans`` is an array of structs with any of the keys in ``SPAN_FIELDS``;
    a missing or null field falls back as listed there.
    """
    have = set(frame.schema[raw_spans].dataType.elementType.fieldNames())

    def entity(span: Column) -> Column:
        return F.struct(
            *[
                F.coalesce(
                    *[span[key].cast(kind) for key in keys if key in have], F.lit(default).cast(kind)
                ).alias(field)
                for field, (keys, kind, default) in SPAN_FIELDS.items()
            ]
        )

    return roll_up(frame.withColumn("entities", F.transform(F.col(raw_spans), entity)).drop(raw_spans))


def flatten_entities(rows: DataFrame) -> DataFrame:
    """One row per entity: ``id, ordinal, text, type, start, end, score``."""
    exploded = rows.select("id", F.posexplode_outer("entities").alias("ordinal", "e"))
    return exploded.where(_ELEMENT).select("id", "ordinal", "e.*")


def token_spans(corpus: DataFrame, likely: KeyFilter | None = None) -> DataFrame:
    """One row per token occurrence: ``id, text, start, end`` (code points).

    With a filter only tokens whose lower-case form may be a key become rows, so
    the other tokens are never more than elements of their row's array.
    """
    text = filled(F.col("text"))

    def rows(s: Column) -> Column:
        def span(token: Column, i: Column) -> Column:
            end = F.get(s["ends"], i)
            return F.struct(token.alias("text"), (end - F.length(token)).alias("start"), end.alias("end"))

        if likely is None:
            return F.transform(s["found"], span)
        hashes = F.transform(s["found"], lambda token: F.xxhash64(F.lower(token)))
        passed = bind(hashes, lambda hs: F.transform(s["found"], lambda _, i: likely.may_hold(F.get(hs, i))))
        spans = bind(
            passed,
            lambda ok: F.transform(s["found"], lambda token, i: F.when(F.get(ok, i), span(token, i))),
        )
        return F.filter(spans, lambda t: t.isNotNull())

    spans = bind(_matches_with_ends(text, f"{WORD}+", tokens(text)), rows)
    exploded = corpus.select("id", F.posexplode_outer(spans).alias("ordinal", "t"))
    return exploded.where(_ELEMENT).select("id", "t.*")


def lexicon_table(terms: DataFrame) -> DataFrame:
    """One row per term from ``(term, type, priority)``: the lowest priority wins.

    ``min_by`` combines on the map side, so a term listed very often stays cheap.
    """
    score = round_exact(F.lit(0.7) + F.lit(0.29) * stable_unit(F.col("term")))
    return terms.groupBy("term").agg(F.min_by("type", "priority").alias("type")).withColumn("score", score)


def join_entities(corpus: DataFrame, terms: DataFrame) -> DataFrame:
    """Entities from a lexicon held as a table: ``id, text, type, start, end, score``.

    The terms, one row each, are stored when this is called, and a bit filter of
    them is made. It is tested inside each row's array of tokens, so only likely
    terms become rows. Spark broadcasts the terms if their bytes allow it;
    otherwise tokens and terms meet by shuffle and the partitions of frequent
    terms are split.
    """
    known = materialize(lexicon_table(terms), "terms")
    found = token_spans(corpus, key_filter(known, "term")).withColumn("term", F.lower("text"))
    return found.join(known, "term").select("id", "text", "type", "start", "end", "score")

"""The bit filter of keys: nothing listed is missed, little else passes."""

import pytest
from pyspark.sql import functions as F

from glyphmill.functions.membership import key_filter
from glyphmill.operators.entities import join_entities, token_spans


def words(spark, items):
    return spark.createDataFrame([(w,) for w in items], "w string")


def passed(spark, made, items):
    frame = words(spark, items).where(made.may_hold(F.xxhash64("w")))
    return {row["w"] for row in frame.collect()}


def test_no_key_is_missed_and_few_others_pass(spark):
    keys = [f"key{i}" for i in range(3000)]
    others = [f"other{i}" for i in range(3000)]
    made = key_filter(words(spark, [*keys, None, *keys[:100]]), "w")
    assert 64 * len(made.words) <= 2 * 16 * len(keys)
    found = passed(spark, made, keys + others)
    assert set(keys) <= found and len(found) - len(keys) < 300


def test_a_full_filter_lets_more_pass(spark):
    keys = [f"key{i}" for i in range(2000)]
    made = key_filter(words(spark, keys), "w", most_bits=128)
    assert len(made.words) == 2 and set(keys) <= passed(spark, made, keys)


def test_empty_tables_let_nothing_pass(spark):
    for made in (key_filter(words(spark, []), "w"), key_filter(words(spark, [None]), "w")):
        assert passed(spark, made, ["a", "", "b"]) == set()


def test_bits_are_checked(spark):
    with pytest.raises(ValueError, match="most_bits"):
        key_filter(words(spark, []), "w", most_bits=100)


def test_only_likely_tokens_become_rows(spark, corpus):
    texts = [" ".join(f"w{i}" for i in range(k, k + 200)) for k in range(0, 2000, 200)] + [None, "", "W7 ¡W7! w7"]
    likely = key_filter(words(spark, ["w7", "w1500"]), "w")
    every = {tuple(r) for r in token_spans(corpus(texts)).collect()}
    some = {tuple(r) for r in token_spans(corpus(texts), likely).collect()}
    listed = {r for r in every if r[1].lower() in ("w7", "w1500")}
    assert len(listed) == 5 and listed <= some <= every and len(some) < len(every) / 5


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_long_lexicons_give_exact_entities(spark, corpus, broadcast_limit, limit):
    broadcast_limit(limit)
    terms = [(f"w{i}", "A" if i % 2 else "B", 0) for i in range(0, 1000, 3)]
    found = join_entities(
        corpus(["w3 w4 W6", "x w999"]), spark.createDataFrame(terms, "term string, type string, priority int")
    ).collect()
    assert sorted((r["id"], r["text"], r["type"], r["start"], r["end"]) for r in found) == [
        ("0", "W6", "B", 6, 8),
        ("0", "w3", "A", 0, 2),
        ("1", "w999", "A", 2, 6),
    ]

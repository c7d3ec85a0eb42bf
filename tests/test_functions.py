import random
import re

import pytest
from pyspark.sql import functions as F

from glyphmill.functions.arrays import running_sum
from glyphmill.functions.lexicon import unit_of
from glyphmill.functions.numeric import compensated_sum, round_exact
from glyphmill.functions.text import stable_unit, tokens


def test_round_exact_equals_python_round(spark):
    rng = random.Random(5)
    values = [rng.random() for _ in range(2000)]
    values += [i / 20000 for i in range(20000) if i % 2]  # decimal ties
    values += [s * rng.random() * 10.0 ** rng.randrange(1, 17) for _ in range(1000) for s in (1, -1)]
    values += [k + i / 20000 for k in (2, 77, 4095, 10**7) for i in range(1, 2000, 2)]
    values += [2.0**39, 2.0**39 - 2.0**-14, 1e300, -2.0, 2.00005, 1024.03125]
    values += [0.03125, 0.09375, 0.78125, -0.78125, 0.0, 1.0, 1.99995, 2.67545, 123.456789, -0.5, 1e-9, 4.9999e-5, -5e-05]
    frame = spark.createDataFrame([(v,) for v in values], "v double").select("v", round_exact(F.col("v")).alias("r"))
    wrong = [(v, r) for v, r in frame.collect() if r != round(v, 4)]
    assert not wrong


def test_round_exact_keeps_null_and_nan(spark):
    frame = spark.createDataFrame([(None,), (float("nan"),)], "v double").select(round_exact(F.col("v")))
    first, second = (row[0] for row in frame.collect())
    assert first is None and second != second


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 128, 5000])
def test_running_sum(spark, n):
    values = [random.Random(n).randrange(9) for _ in range(n)]
    row = spark.createDataFrame([(values,)], "v array<int>").select(running_sum(F.col("v")).alias("s")).first()
    total, wanted = 0, []
    for value in values:
        total += value
        wanted.append(total)
    assert row["s"] == wanted


def test_compensated_sum_equals_python_sum(spark):
    rng = random.Random(3)
    rows = [([round(0.7 + 0.29 * rng.random(), 4) for _ in range(n)],) for n in (0, 1, 2, 50, 999)]
    found = spark.createDataFrame(rows, "v array<double>").select("v", compensated_sum(F.col("v")).alias("s"))
    for row in found.collect():
        assert row["s"] == sum(row["v"])


def test_tokens_and_unit_equal_python(spark, corpus, edge_texts):
    texts = [t for t in edge_texts if t is not None] + ["٣٤ ⅷ x² _a_ áb", "日本語 テスト", "naïve—café"]
    rows = corpus(texts).select("text", tokens(F.col("text")).alias("t"), stable_unit(F.col("text")).alias("u"))
    for row in rows.collect():
        assert row["t"] == re.findall(r"\w+", row["text"])
        assert row["u"] == unit_of(row["text"])

"""Toxicity by window compression: held-out accuracy, plain Python, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphmill.llm import toxicity

from samples import prose

INSULTS = ["snarkfool", "grimlout", "vilewretch", "muckbrain"]


def texts(n, first=0):
    plain = [(first + i, prose(first + i, 60 + i % 90), 0) for i in range(n)]
    toxic = []
    for i in range(n):
        words = prose(first + n + i, 60 + i % 90).split()
        for k in range(2):
            words.insert((i * 7 + 31 * k) % len(words), INSULTS[(i + k) % len(INSULTS)])
        toxic.append((first + n + i, " ".join(words), 1))
    return plain + toxic


@pytest.fixture(scope="module")
def model(spark, frame_of):
    rows = texts(120)
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows], "doc_id long, toxic int, text string")
    return toxicity.fit_toxicity(frame_of([(i, t) for i, t, _ in rows]), labels)


def test_held_out_accuracy(model, frame_of):
    rows = texts(60, first=10_000)
    docs = frame_of([(i, t) for i, t, _ in rows])
    found = {r[0]: r[1] for r in docs.select("doc_id", toxicity.toxicity_score(model, F.col("text"))).collect()}
    assert sum((found[i] >= 0.3) == bool(y) for i, _, y in rows) >= 0.95 * len(rows)


def test_score_equals_plain_python(model, frame_of, edge_docs):
    own = toxicity.Evidence(model)
    score = toxicity.toxicity_score(model, F.col("text")).alias("s")
    for row in edge_docs.select("text", score, toxicity.evidence(model, F.col("text")).alias("e")).collect():
        words = (row["text"] or "").encode().lower().split()
        windows = {b" " + b" ".join(words[i : i + 4]) + b" " for i in range(0, len(words), 2)}
        saved = [len(own.ordinary.compress(w)) - len(own.toxic.compress(w)) for w in windows]
        reached = [sum(s >= t for s in saved) for t in toxicity.THRESHOLDS]
        assert row["e"]["n_windows"] == len(windows) and row["e"]["reached"] == reached
        x = [np.log1p(n) for n in reached] + [np.sqrt(n / max(1, len(windows))) for n in reached]
        linear = sum(a * b for a, b in zip(x, model.weights)) + model.weights[-1]
        assert row["s"] == pytest.approx(1 / (1 + np.exp(-np.clip(linear, -35, 35))))


def test_edges(model, edge_docs, no_docs):
    score = toxicity.toxicity_score(model, F.col("text")).alias("s")
    found = edge_docs.select("doc_id", "text", score).collect()
    assert all(0.0 <= r["s"] <= 1.0 for r in found)
    assert len({r["s"] for r in found if not (r["text"] or "").strip()}) == 1
    assert no_docs.select(score).count() == 0


def test_one_bad_window_in_a_long_text_is_named(model, frame_of):
    words = prose(5, 5000).split()
    words.insert(4000, "Snarkfool")
    found = frame_of([(1, " ".join(words))]).select(toxicity.toxic_windows(model, F.col("text"), 4).alias("w")).first()["w"]
    assert any("snarkfool" in w for w in found)


def test_long_texts_teach_too(spark, frame_of):
    rows = [(i, prose(i, 4000) + " muckbrain" * 3, 1) for i in range(12)] + [(20 + i, prose(20 + i, 4000), 0) for i in range(12)]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(frame_of([(i, t) for i, t, _ in rows]), labels)
    assert b"muckbrain" in model.toxic and b"muckbrain" not in model.ordinary


def test_odd_labels(spark, frame_of, no_docs):
    def fit(docs, rows):
        return toxicity.fit_toxicity(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))

    def scores(model):
        return [r["s"] for r in docs.select(toxicity.toxicity_score(model, F.col("text")).alias("s")).collect()]

    docs = frame_of([(1, "a b c"), (2, None), (None, "x"), (3, "d e")])
    assert set(scores(fit(docs, []))) == {0.5}
    assert all(s > 0.99 for s in scores(fit(docs, [(1, 1), (1, 1), (2, 0), (None, 0), (3, None)])))
    assert all(s < 0.01 for s in scores(fit(docs, [(1, 1), (1, 0), (3, 0)])))  # contradicting labels of 1
    assert set(scores(fit(no_docs, [(1, 1)]))) == {0.5}
    both = fit(docs, [(1, 1), (3, 0)])  # one text each
    assert all(0.0 <= s <= 1.0 for s in scores(both))

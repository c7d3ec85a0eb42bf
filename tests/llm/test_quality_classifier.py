"""Compression classifier: held-out accuracy and edge cases."""

import math

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from glyphmill.llm import quality
from glyphmill.llm.queries import op3_quality

from samples import prose


def texts(n):
    good = [(i, prose(i, 80 + i % 50).capitalize() + ".", 1) for i in range(n)]
    bad = [(n + i, " ".join(w + "***" for w in prose(n + i, 80).upper().split()), 0) for i in range(n)]
    return good + bad


@pytest.fixture(scope="module")
def model(spark, frame_of):
    rows = texts(120)
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows], "doc_id long, quality int, text string")
    return quality.fit_quality(frame_of([(i, t) for i, t, _ in rows]), labels)


def test_held_out_accuracy(model, frame_of):
    rows = [(i + 10_000, t, y) for i, t, y in texts(60)]
    docs = frame_of([(i, t) for i, t, _ in rows])
    found = {r[0]: r[1] for r in docs.select("doc_id", quality.quality_score(model, F.col("text"))).collect()}
    assert sum((found[i] >= 0.5) == bool(y) for i, _, y in rows) >= 0.95 * len(rows)


def test_edges(model, edge_docs, no_docs):
    score = quality.quality_score(model, F.col("text")).alias("s")
    found = edge_docs.select("doc_id", "text", score).collect()
    assert all(0.0 <= r["s"] <= 1.0 for r in found)
    empty = {r["s"] for r in found if not r["text"]}
    assert len(empty) == 1  # null and empty alike
    assert no_docs.select(score).count() == 0


def test_whole_text_counts(model):
    good, bad = model.compressors()
    start = prose(1, 400).encode()
    junk = b" ".join(w + b"***" for w in prose(2, 4000).upper().encode().split())
    assert quality.size_difference(start, good, bad) > quality.size_difference(start + junk, good, bad)
    assert quality.size_difference(b"", good, bad) == 0.0


def test_missing_labels(spark, frame_of, no_docs):
    labels = "doc_id long, quality int"
    docs = frame_of([(1, "a b c"), (2, None), (None, "x")])
    none = quality.fit_quality(docs, spark.createDataFrame([], labels))
    one = quality.fit_quality(docs, spark.createDataFrame([(1, 1), (2, 0), (None, 0), (1, None)], labels))
    score = [docs.select(quality.quality_score(m, F.col("text")).alias("s")).first()["s"] for m in (none, one)]
    assert score[0] == 0.5 and score[1] > 0.99
    assert quality.fit_quality(no_docs, spark.createDataFrame([(1, 1)], labels)).slope == 0.0


def test_copies_do_not_fill_the_sample(spark, frame_of):
    rows = [(i, "same text " * 30, 1) for i in range(300)] + [(1000 + i, t, y) for i, t, y in texts(40)]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    model = quality.fit_quality(frame_of([(i, t) for i, t, _ in rows]), labels)
    assert model.slope > 0


def plain_score(model, text):
    """The score by whole compressed sizes in plain Python, block by block."""
    sizes = []
    for content in (model.good, model.bad):
        dictionary = zstandard.ZstdCompressionDict(content)
        packer = zstandard.ZstdCompressor(
            level=quality.LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        data = (text or "").encode()
        sizes.append(sum(len(packer.compress(data[i : i + 2048])) for i in range(0, len(data), 2048)))
    difference = (sizes[1] - sizes[0]) / sum(sizes) if sum(sizes) else 0.0
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, model.slope * difference + model.offset))))


def test_score_equals_plain_python(model, edge_docs):
    found = edge_docs.select("text", quality.quality_score(model, F.col("text")).alias("s")).collect()
    assert len(found) == edge_docs.count()
    for row in found:
        assert row["s"] == pytest.approx(plain_score(model, row["text"]), abs=1e-9)


def test_calibration_equals_another_solver():
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(0.1, 0.1, 300), rng.normal(-0.05, 0.1, 100)])
    y = np.repeat([1.0, 0.0], [300, 100])
    weight = np.where(y == 1, 2.0, 0.5)
    slope, offset = quality._logistic(x, y, weight)
    scale, a, b = np.abs(x).max(), 0.0, 0.0
    for _ in range(60_000):  # plain gradient ascent
        p = 1 / (1 + np.exp(-(a * x / scale + b)))
        a += 0.005 * (float((weight * (y - p) * x).sum()) / scale - 1e-2 * a)
        b += 0.005 * (float((weight * (y - p)).sum()) - 1e-6 * b)
    assert slope == pytest.approx(a / scale, rel=1e-3) and offset == pytest.approx(b, rel=1e-3, abs=1e-4)


def test_held_out_accuracy_on_the_test_tables(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    found = op3_quality(spark, sf).where("held_out").join(truth, "doc_id").select("predicted", "score", "quality").collect()
    good, bad = ([r for r in found if r["quality"] == y] for y in (1, 0))
    assert len(good) > 40 and len(bad) > 3
    wins = sum((g["score"] > b["score"]) + 0.5 * (g["score"] == b["score"]) for g in good for b in bad)
    assert wins >= 0.9 * len(good) * len(bad)
    assert sum(r["predicted"] for r in good) >= 0.95 * len(good)


def test_a_class_of_long_texts_only_teaches(spark, frame_of):
    rows = [(i, (t + " ") * 3 if y else " ".join(u for _, u, z in texts(40) if not z)[i % 7 :], y) for i, t, y in texts(40)]
    assert min(len(t) for _, t, y in rows if not y) > 10_000
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    model = quality.fit_quality(frame_of([(i, t) for i, t, _ in rows]), labels, fit_chars=4000)
    assert model.slope > 0 and model.good and model.bad
    docs = frame_of([(i + 5000, t) for i, t, _ in texts(20)])
    found = {r[0]: r[1] for r in docs.select("doc_id", quality.quality_score(model, F.col("text"))).collect()}
    assert all((found[i + 5000] >= 0.5) == bool(y) for i, _, y in texts(20))


def test_pieces_come_from_all_over_a_long_text(spark):
    size = quality.PIECE_CHARS
    text = "".join(chr(0x4E00 + i // 100) for i in range(20 * size))
    frame = spark.createDataFrame([(text, 7), ("short é", 7), ("", 7)], "t string, h long")
    part = quality.fitting_part(F.col("t"), F.col("h"), F.length("t"), 4 * size)
    long, short, empty = (r[0] for r in frame.select(part).collect())
    assert (short, empty) == ("short é", "") and len(long) == 4 * size
    for k in range(4):
        piece = long[k * size : (k + 1) * size]
        at = text.index(piece)
        assert 5 * size * k <= at and at + size <= 5 * size * (k + 1)


def test_contradicting_and_repeated_labels(spark, frame_of):
    rows = texts(40)
    named = [(i, y) for i, _, y in rows] + [(0, 0), (0, 1), (1, 1), (1, 1)]
    model = quality.fit_quality(
        frame_of([(i, t) for i, t, _ in rows]), spark.createDataFrame(named, "doc_id long, quality int")
    )
    assert model.slope > 0
    with pytest.raises(ValueError, match="fit_rows"):
        quality.fit_quality(frame_of([]), spark.createDataFrame([], "doc_id long, quality int"), fit_rows=0)


def test_fitting_starts_no_workers_for_rows_of_python(spark, frame_of, monkeypatch):
    from pyspark import SparkContext

    docs = frame_of([(i, prose(i, 80) + (" good fine" if i % 2 else " bad poor") * 5) for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    monkeypatch.setattr(SparkContext, "parallelize", lambda *a, **b: pytest.fail("rows made by Python workers"))
    assert quality.fit_quality(docs, labels).good

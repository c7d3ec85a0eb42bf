"""Operator 11: toxicity by compression distance.

Two zstandard dictionaries are built, one from toxic and one from ordinary
labelled text. Both start with the segments that are common in either; then
follow those that are more frequent in the texts of the one class than chance
allows. A text is cut into overlapping windows of a few words. Each window is
compressed with both dictionaries, and how many bytes the toxic one saves is
its evidence. How many windows of a text reach each of several thresholds is
turned into a probability by a logistic model. Its weights, and so the meaning
of the thresholds, are calibrated on labelled texts compressed with
dictionaries that were built without them.

A null text is an empty text; it has no windows and gets the score of a text
without evidence. Equal texts get equal scores. A word of any length is a
word, so a window may be as long as the text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.columns import as_text, byte_list, hash_sample, lower_words, quoted, slices
from glyphmill.sources.scratch import materialize

WINDOW_WORDS = 4
STEP_WORDS = 2
# Bytes saved from which a window counts, each threshold with weights of its own.
THRESHOLDS = (1, 2, 3, 4, 5, 6, 8)
# Lengths in bytes of the segments dictionaries are made of.
SEGMENTS = (6, 7, 8, 9)
COMMON_BYTES = 2048
OWN_BYTES = 2048
# Segments counted in a task before the counts are passed on.
HELD_SEGMENTS = 700_000
# Segments fetched to fill a dictionary: with overlaps merged each adds a byte at least.
MOST_SEGMENTS = 4096
# A segment belongs to a class if its share of the class's texts is so many standard errors higher.
LEAST_SIGMAS = 4.0
# Matches below this length are left to chance, in both dictionaries.
MIN_MATCH = 5


@dataclass(frozen=True)
class WindowModel:
    """Both dictionaries, and the weights of the features with the constant last."""

    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]

    def probability(self, features: np.ndarray) -> np.ndarray:
        linear = features @ np.array(self.weights[:-1]) + self.weights[-1]
        return 1.0 / (1.0 + np.exp(-np.clip(linear, -35.0, 35.0)))


def _compressor(content: bytes):
    own = zstandard.ZstdCompressionParameters(
        window_log=14, hash_log=14, chain_log=14, search_log=4, min_match=MIN_MATCH, strategy=zstandard.STRATEGY_GREEDY,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    if len(content) < 8:  # the least a dictionary may have
        return zstandard.ZstdCompressor(compression_params=own)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=own)
    return zstandard.ZstdCompressor(compression_params=own, dict_data=dictionary)


def windows(text: bytes) -> Iterator[bytes]:
    """A few lower-cased words each, from every second word on, with spaces around."""
    words = lower_words(text)
    for start in range(0, len(words), STEP_WORDS):
        yield b" " + b" ".join(words[start : start + WINDOW_WORDS]) + b" "


class Evidence:
    """Bytes saved by window."""

    def __init__(self, model: WindowModel):
        self.toxic, self.ordinary = _compressor(model.toxic), _compressor(model.ordinary)

    def saved(self, window: bytes) -> int:
        return len(self.ordinary.compress(window)) - len(self.toxic.compress(window))

    def counts(self, text: bytes) -> tuple[int, list[int]]:
        """Number of different windows, and of those that reach each threshold."""
        own = set(windows(text))
        toxic, ordinary = self.toxic.compress, self.ordinary.compress
        saved = Counter([len(ordinary(w)) - len(toxic(w)) for w in own])
        return len(own), [sum(n for s, n in saved.items() if s >= t) for t in THRESHOLDS]


def features(counted: list[tuple[int, list[int]]]) -> np.ndarray:
    """For each threshold the count on a log scale and the root of the share."""
    total = np.array([max(1, n) for n, _ in counted], dtype=float)[:, None]
    reached = np.array([c for _, c in counted], dtype=float).reshape(len(counted), len(THRESHOLDS))
    return np.hstack([np.log1p(reached), np.sqrt(reached / total)])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each class and half hold a segment, added up within a task."""
    counts: dict[tuple[int, int], Counter] = {(y, half): Counter() for y in (0, 1) for half in (0, 1)}
    held = 0

    def emit() -> Iterator[pa.RecordBatch]:
        for (y, half), counter in counts.items():
            if counter:
                n = len(counter)
                yield pa.record_batch(
                    [pa.array(list(counter), pa.binary()), pa.array([y] * n, pa.int32()), pa.array([half] * n, pa.int32()),
                     pa.array(list(counter.values()), pa.int64())],
                    ["segment", "label", "half", "n"],
                )
                counter.clear()

    for batch in batches:
        for part in slices(batch, 32):
            columns = (byte_list(part["text"]), part["label"].to_pylist(), part["half"].to_pylist())
            for text, label, half in zip(*columns, strict=True):
                line = b" " + b" ".join(lower_words(text)) + b" "
                found = {line[i : i + n] for n in SEGMENTS for i in range(len(line) - n + 1)}
                counts[label, half].update(found)
                held += len(found)
            if held > HELD_SEGMENTS:
                yield from emit()
                held = 0
    yield from emit()


def _joined(segments: list[bytes], size: int) -> bytes:
    """Segments in order of worth; one that continues the text so far overlaps it."""
    out = b""
    for segment in segments:
        if segment in out:
            continue
        overlap = next(k for k in range(len(segment) - 1, -1, -1) if out.endswith(segment[:k]))
        if len(out) + len(segment) - overlap > size:
            break
        out += segment[overlap:]
    return out


def _dictionaries(counts: DataFrame, texts: dict[tuple[int, int], int], halves: tuple[int, ...]) -> tuple[bytes, bytes]:
    """Dictionaries of toxic and ordinary text from the given halves of the sample."""

    def per(y: int) -> Column:
        return sum((F.col(f"n{y}{half}") for half in halves), F.lit(0))

    toxic, ordinary = (max(1, sum(texts.get((y, half), 0) for half in halves)) for y in (1, 0))
    share = (per(1) + per(0)) / F.lit(toxic + ordinary)
    error = F.sqrt(share * (F.lit(1.0) - share) * F.lit(1 / toxic + 1 / ordinary))
    sigmas = (per(1) / F.lit(toxic) - per(0) / F.lit(ordinary)) / F.greatest(error, F.lit(1e-9))
    both = F.least(per(1) / F.lit(toxic), per(0) / F.lit(ordinary))
    judged = counts.select("segment", both.alias("both"), sigmas.alias("sigmas"), per(1).alias("in1"), per(0).alias("in0"))

    def best(frame: DataFrame, worth: Column) -> list[bytes]:
        top = frame.orderBy(worth.desc(), "segment").limit(MOST_SEGMENTS)
        return [bytes(r["segment"]) for r in top.select("segment").collect()]

    common = _joined(best(judged.where("both > 0"), F.col("both")), COMMON_BYTES)
    # two texts hold a segment of a class, so that it isn't one text's own
    own = [
        _joined(best(judged.where((sign * F.col("sigmas") >= LEAST_SIGMAS) & (F.col(held) >= 2)), sign * F.col("sigmas")), OWN_BYTES)
        for sign, held in ((1, "in1"), (-1, "in0"))
    ]
    return common + own[0], common + own[1]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by damped Newton steps; the constant, last, has no penalty."""
    design = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    beta = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -35, 35)))
        gradient = design.T @ (weight * (y - p)) - penalty @ beta
        hessian = (design * (weight * p * (1 - p) + 1e-9)[:, None]).T @ design + penalty
        step = np.linalg.solve(hessian, gradient)
        beta += step * min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _constant(probability: float) -> WindowModel:
    odds = np.log(probability / (1 - probability)) if 0 < probability < 1 else 35.0 if probability else -35.0
    return WindowModel(b"", b"", (0.0,) * (2 * len(THRESHOLDS)) + (float(odds),))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    fit_rows: int = 2000,
) -> WindowModel:
    """Fit on a bounded sample of the documents that ``labels`` names by id.

    Of each class about ``fit_rows`` different texts are taken by their hash,
    whole, whatever their length; copies count once. An id with contradicting
    labels takes no part, nor do rows with a null id, label or text; equal
    labels of an id count once. A text with labels of both classes, under
    different ids, is taken in both. If only one class is known the score is 0
    or 1 for all texts, 0.5 without any label.
    """
    text = as_text(quoted(text_col))
    texts = docs.where(quoted(text_col).isNotNull()).select(
        quoted(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text")
    )
    named = (
        labels.select(quoted(id_col).cast("long").alias("id"), quoted(label_col).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .where("label = most")
        .drop("most")
    )
    hashed = materialize(texts.drop("text").join(named, "id").select("h", "label"), "toxicity-labels")
    rows = {r["label"]: r["count"] for r in hashed.groupBy("label").count().collect()}
    if not rows.get(0) or not rows.get(1):
        return _constant(1.0 if rows.get(1) else 0.0 if rows.get(0) else 0.5)
    picked = [
        row
        for y in (0, 1)
        for row in hash_sample(hashed.where(F.col("label") == y), "h", fit_rows).select("h", "label").distinct().collect()
    ]
    few = F.broadcast(docs.sparkSession.createDataFrame(picked, "h long, label int"))
    half = F.pmod(F.shiftright("h", 40), F.lit(2)).cast("int")
    sample = texts.select("h", "text").join(few, "h").groupBy("h", "label").agg(F.min("text").alias("text"))
    # dealt out again: the sample may have come from few partitions
    sample = materialize(sample.withColumn("half", half).repartition("h", "label"), "toxicity-sample")
    texts_of = {(r["label"], r["half"]): r["count"] for r in sample.groupBy("label", "half").count().collect()}
    counted = sample.select("text", "label", "half").mapInArrow(_segments, "segment binary, label int, half int, n long")
    cases = [
        F.sum(F.when((F.col("label") == y) & (F.col("half") == half_), F.col("n")).otherwise(0)).alias(f"n{y}{half_}")
        for y in (0, 1)
        for half_ in (0, 1)
    ]
    counts = counted.groupBy("segment").agg(*cases)
    counts = materialize(counts.where("n00 + n01 + n10 + n11 >= 2"), "toxicity-segments")
    # each half is judged with dictionaries built from the other
    others = {half_: WindowModel(*_dictionaries(counts, texts_of, (1 - half_,)), ()) for half_ in (0, 1)}
    found = [
        row
        for half_, model in others.items()
        for row in sample.where(F.col("half") == half_).select("label", evidence(model, F.col("text")).alias("e")).collect()
    ]
    x = features([(r["e"]["n_windows"], r["e"]["reached"]) for r in found])
    y = np.array([float(r["label"]) for r in found])
    # the sample is balanced, the data is not: weigh each class by its count
    weight = np.where(y == 1, rows[1] / max(1, y.sum()), rows[0] / max(1, len(y) - y.sum()))
    weights = _logistic(x, y, weight * len(y) / weight.sum())
    return WindowModel(*_dictionaries(counts, texts_of, (0, 1)), tuple(float(w) for w in weights))


def evidence(model: WindowModel, text: Column) -> Column:
    """A text's different windows, and how many of them reach each threshold."""

    @F.arrow_udf("n_windows long, reached array<long>")
    def count(column: pa.Array) -> pa.Array:
        found = [_cached(model).counts(t) for part in slices(column) for t in byte_list(part)]
        return pa.StructArray.from_arrays(
            [pa.array([n for n, _ in found], pa.int64()), pa.array([c for _, c in found], pa.list_(pa.int64()))],
            ["n_windows", "reached"],
        )

    return count(as_text(text))


def toxicity_score(model: WindowModel, text: Column) -> Column:
    """The calibrated probability that a text is toxic, over the whole text."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        found = [_cached(model).counts(t) for part in slices(column) for t in byte_list(part)]
        return pa.array(model.probability(features(found)), pa.float64())

    return score(as_text(text))


def toxic_windows(model: WindowModel, text: Column, least_saved: int = THRESHOLDS[-1]) -> Column:
    """The windows of a text with at least so many bytes saved, in order of first appearance, each once."""

    @F.arrow_udf("array<string>")
    def pick(column: pa.Array) -> pa.Array:
        own, found = _cached(model), []
        for part in slices(column):
            for t in byte_list(part):
                found.append([w.decode().strip() for w in dict.fromkeys(windows(t)) if own.saved(w) >= least_saved])
        return pa.array(found, pa.list_(pa.string()))

    return pick(as_text(text))


_EVIDENCE: dict[WindowModel, Evidence] = {}


def _cached(model: WindowModel) -> Evidence:
    if model not in _EVIDENCE:
        _EVIDENCE.clear()
        _EVIDENCE[model] = Evidence(model)
    return _EVIDENCE[model]

"""Operator 3: compression classifier for text quality.

Two zstandard dictionaries are built, one from good and one from bad labelled
texts. A text is cut into blocks, each block is compressed with either
dictionary, and the normalised difference of the summed sizes is turned into a
probability by a logistic curve fitted on other labelled rows. Blocks keep the
difference comparable: in a long text compressed as a whole, its own
repetitions would drown what the dictionary knows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.columns import as_text, byte_list, hash_sample, quoted, slices

BLOCK_BYTES = 2048
DICTIONARY_BYTES = 32 * 1024
LEVEL = 3
# The bounded sample the model is fitted on: about this many different texts of a class, each of
# at most this many characters, those of a longer text being pieces from all over it. Scoring has no such bound.
FIT_ROWS = 1500
FIT_CHARS = 20_000
# Characters of such a piece.
PIECE_CHARS = 1000


@dataclass(frozen=True)
class CompressionModel:
    """Both dictionaries and the calibration ``1 / (1 + exp(-(slope * difference + offset)))``."""

    good: bytes
    bad: bytes
    slope: float
    offset: float

    def compressors(self) -> tuple:
        return tuple(_compressor(content) for content in (self.good, self.bad))

    def probability(self, difference: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * difference + self.offset, -35.0, 35.0)))


def _compressor(content: bytes):
    options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not content:
        return zstandard.ZstdCompressor(**options)
    # trained dictionaries start with this magic number, anything else is plain content
    kind = zstandard.DICT_TYPE_FULLDICT if content[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=kind)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=dictionary, **options)


def size_difference(text: bytes, good, bad) -> float:
    """(size with bad dictionary - size with good) / sum, over all blocks; 0 for an empty text."""
    with_good = with_bad = 0
    for start in range(0, len(text), BLOCK_BYTES):
        block = text[start : start + BLOCK_BYTES]
        with_good += len(good.compress(block))
        with_bad += len(bad.compress(block))
    return (with_bad - with_good) / (with_bad + with_good) if text else 0.0


def _dictionary(texts: list[bytes]) -> bytes:
    blocks = [t[i : i + BLOCK_BYTES] for t in texts for i in range(0, len(t), BLOCK_BYTES)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: take the text itself
        return b"\n".join(texts)[-DICTIONARY_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted one-variable logistic regression by damped Newton steps, lightly regularised."""
    scale = float(np.abs(x).max()) or 1.0
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    ridge = np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -35, 35)))
        gradient = design.T @ (weight * (y - p)) - ridge @ beta
        hessian = (design * (weight * p * (1 - p) + 1e-9)[:, None]).T @ design + ridge
        step = np.linalg.solve(hessian, gradient)
        beta += step * min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def fitting_part(text: Column, text_hash: Column, chars: Column, most: int) -> Column:
    """The whole text, or of a text of over ``most`` characters as many in pieces.

    The text is cut into as many stretches as there are pieces, and each gives
    one, at a place that depends on the text's hash.
    """
    size = min(PIECE_CHARS, most)
    n = most // size
    stretch = F.floor(chars / F.lit(n))

    def piece(i: Column) -> Column:
        place = F.pmod(F.xxhash64(text_hash, i), stretch - F.lit(size) + F.lit(1))
        return F.substring(text, (i * stretch + place + 1).cast("int"), F.lit(size))

    pieces = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), piece)
    return F.when(chars <= most, text).otherwise(F.array_join(pieces, ""))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    fit_rows: int = FIT_ROWS,
    fit_chars: int = FIT_CHARS,
) -> CompressionModel:
    """Fit on a bounded sample of the documents that ``labels`` names by id.

    Rows with a null label, id or text take no part; a text labelled more than
    once takes part under each of its labels. Of each class about ``fit_rows``
    texts are taken by their hash, each different text once, so that copies
    don't fill the sample; a text of over ``fit_chars`` characters takes part
    with as many, in pieces from all over it. Only ids and hashes are joined;
    the sample's texts are then picked by a broadcast of these hashes. Without
    any row of one class, the score is a constant: 1 or 0 if only the other is
    known, 0.5 if there are no labels.
    """
    if fit_rows < 1 or fit_chars < 1:
        raise ValueError(f"fit_rows and fit_chars must be positive, got {fit_rows} and {fit_chars}")
    text = quoted(text_col).cast("string")
    texts = docs.where(quoted(text_col).isNotNull()).select(
        quoted(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), F.length(text).alias("chars"), text.alias("text")
    )
    named = labels.select(quoted(id_col).cast("long").alias("id"), quoted(label_col).cast("int").alias("label"))
    hashed = texts.drop("text").join(named.where(F.col("label").isNotNull()), "id")
    counts = {int(r["label"]): int(r["n"]) for r in hashed.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return CompressionModel(b"", b"", 0.0, 35.0 if counts.get(1) else -35.0 if counts.get(0) else 0.0)
    wanted = [
        r
        for value in (0, 1)
        for r in hash_sample(hashed.where(F.col("label") == value), "h", fit_rows).select("h", "label").distinct().collect()
    ]
    # an Arrow table needs no Python worker; a list of rows would start some of another kind, which stay
    columns = [pa.array([r[c] for r in wanted], kind) for c, kind in (("h", pa.int64()), ("label", pa.int32()))]
    picked = docs.sparkSession.createDataFrame(pa.table(columns, names=["h", "label"]))
    part = fitting_part(F.col("text"), F.col("h"), F.col("chars"), fit_chars)
    sample = (
        texts.join(F.broadcast(picked), "h")
        .select("h", "label", part.alias("text"))
        .groupBy("h", "label")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    sample.sort(key=lambda r: (r["h"], r["label"]))
    by_label = {v: [r["text"].encode() for r in sample if r["label"] == v] for v in (0, 1)}
    # two thirds make the dictionaries, the rest the calibration; a class of one text serves both
    build = {v: texts[: -(-2 * len(texts) // 3)] for v, texts in by_label.items()}
    check = {v: texts[len(build[v]) :] or texts for v, texts in by_label.items()}
    contents = {v: _dictionary(texts) for v, texts in build.items()}
    good, bad = _compressor(contents[1]), _compressor(contents[0])
    x = np.array([size_difference(t, good, bad) for v in (0, 1) for t in check[v]])
    y = np.array([float(v) for v in (0, 1) for _ in check[v]])
    # the sample is balanced, the data is not: weigh each class by its count
    weight = np.array([counts[v] / len(check[v]) for v in (0, 1) for _ in check[v]])
    slope, offset = _logistic(x, y, weight * len(x) / weight.sum())
    return CompressionModel(contents[1], contents[0], slope, offset)


def quality_score(model: CompressionModel, text: Column) -> Column:
    """The calibrated probability of a good text, over the whole text. Null counts as empty."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        good, bad = _cached(model)
        found = [size_difference(t, good, bad) for part in slices(column) for t in byte_list(part)]
        differences = np.array(found, dtype=float)
        return pa.array(model.probability(differences), pa.float64())

    return score(as_text(text))


_COMPRESSORS: dict[CompressionModel, tuple] = {}


def _cached(model: CompressionModel) -> tuple:
    if model not in _COMPRESSORS:
        _COMPRESSORS.clear()
        _COMPRESSORS[model] = model.compressors()
    return _COMPRESSORS[model]

"""What the operators share: tokens, row keys and held-out rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the white space [\x20\x09-\x0D] that separates words and is stripped from lines.
SPACE = b" \t\n\x0b\x0c\r"

# Documents handled at a time inside a task.
SLICE_ROWS = 256


def slices(batch: pa.RecordBatch | pa.Array, rows: int = SLICE_ROWS) -> Iterator:
    """A batch a few rows at a time, so that a task holds the Python objects of these only."""
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()  # the next batch need not come on top of this one


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_text(column: Column) -> Column:
    """Null text is empty text."""
    return F.coalesce(column.cast("string"), F.lit(""))


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(as_text(doc_id).cast("binary")) % F.lit(folds)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text`` (as bytes, never null), whatever else the frame holds."""
    return docs.select(
        quoted(id_col).cast("long").alias("doc_id"), as_text(quoted(text_col)).cast("binary").alias("text")
    )


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """128 bits that tell rows apart by id and text; rows equal in both share their fate anyway."""
    return [F.xxhash64(F.lit(salt), F.coalesce(doc_id, F.lit(-1)), doc_id.isNull(), text) for salt in (1, 2)]


def byte_list(column: pa.Array) -> list[bytes]:
    """The bytes of a string or binary column, without decoding; null is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Runs of anything but white space. ``bytes.split`` splits at exactly ``SPACE``."""
    return text.split()


def lower_words(text: bytes) -> list[bytes]:
    """The same with A-Z lower-cased. ``bytes.lower`` touches ASCII letters only."""
    return text.lower().split()


def hash_sample(frame: DataFrame, hash_col: str, rows: int) -> DataFrame:
    """The rows whose hash lies in a share of all values that holds about ``rows`` different hashes.

    All rows if there are no more. The same data gives the same sample, and no
    task or driver has to sort or hold more than the sample.
    """
    found = frame.agg(F.approx_count_distinct(hash_col)).first()[0]
    if found <= rows:
        return frame
    return frame.where(F.pmod(F.col(hash_col), F.lit(1 << 32)) < F.lit((rows << 32) // found))

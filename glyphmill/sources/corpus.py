"""Raw text files to the uniform ``(id, text)`` corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glyphmill.functions.text import filled
from glyphmill.params import SourceParams

ID_STRATEGIES = ("monotonic", "content", "position", "table_position")


def read_raw(
    spark: SparkSession, path: str, multi_line: bool = True, partitions: int | None = None
) -> DataFrame:
    """Parquet if the path ends in ``.parquet``, else CSV with a header.

    In CSV every column is a string and a doubled quote inside a quoted field is
    one quote. Records may span lines, which makes each file one split;
    ``multi_line=False`` is for files where they don't, which Spark splits.
    ``partitions`` shuffles the rows to that many: for a few files that can't be
    split, in front of a costly model. Without it nothing is shuffled.
    """
    if path.endswith(".parquet"):
        frame = spark.read.parquet(path)
    else:
        frame = spark.read.options(header=True, multiLine=multi_line, escape='"').csv(path)
    return frame if partitions is None else frame.repartition(partitions)


def position_id(raw_path: str) -> Column:
    """``file:row``: the file below the source's parent folder and the row's place in it, from 0.

    The scan gives both, so the ids are equal however the files are split, dealt
    out or read, and differ for equal texts. A file whose path doesn't hold the
    parent folder as it is written (a glob, an escaped character) is named by
    its whole path. Rewriting or renaming files changes the ids. CSV has no row
    places: such sources raise ``ValueError``.
    """
    _need_parquet(raw_path)
    parent = raw_path.rstrip("/").rpartition("/")[0]
    path = F.col("_metadata.file_path")
    name = F.substring_index(path, f"{parent}/", -1) if parent else path
    return F.concat_ws(":", name, F.col("_metadata.row_index").cast("string"))


def _need_parquet(raw_path: str) -> None:
    if not raw_path.endswith(".parquet"):
        raise ValueError(f"position ids need a Parquet source, got {raw_path}")


def file_offsets(spark: SparkSession, raw_path: str) -> DataFrame:
    """``_file, _before``: each file of a Parquet source and the rows in all files before it, by path.

    The rows are counted without reading a column; the window holds one row per file.
    """
    files = spark.read.parquet(raw_path).groupBy(F.col("_metadata.file_path").alias("_file")).count()
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("_file", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))


def with_table_position(frame: DataFrame, raw_path: str, text: Column) -> DataFrame:
    """``id, text`` with ``source:row``: the source's own name and the row's place in the whole table, from 0.

    The files follow each other by path, so however many there are, the ids are
    those of one file that holds them in a row. Adding or rewriting a file
    changes the ids of the rows behind it (``position_id`` keeps those).
    """
    _need_parquet(raw_path)
    rows = frame.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"), text.alias("text")
    )
    place = (F.col("_before") + F.col("_row")).cast("string")
    row_id = F.concat_ws(":", F.lit(raw_path.rstrip("/").rpartition("/")[2]), place)
    return rows.join(F.broadcast(file_offsets(frame.sparkSession, raw_path)), "_file").select(row_id.alias("id"), "text")


def normalize(frame: DataFrame, source: SourceParams, id_strategy: str = "monotonic") -> DataFrame:
    """Project any frame to ``id string, text string``.

    Without an id column, or if the data lacks it, ids are generated:
    ``monotonic`` ids are unique but hold for one run only, ``content`` ids are
    the SHA-256 of the text, so they are stable and equal for equal texts.
    ``position`` ids are the file and the row's place in it (``position_id``):
    stable and unique, for Parquet only. ``table_position`` ids number the rows
    through all files of the source (``with_table_position``).
    """
    if source.text_column not in frame.columns:
        raise ValueError(
            f"text column {source.text_column!r} is not in {source.raw_path}; columns: {', '.join(frame.columns)}"
        )
    if id_strategy not in ID_STRATEGIES:
        raise ValueError(f"id_strategy must be one of {ID_STRATEGIES}, got {id_strategy!r}")
    text = F.col(f"`{source.text_column}`").cast("string")
    if source.id_column and source.id_column in frame.columns:
        row_id = F.col(f"`{source.id_column}`").cast("string")
    elif id_strategy == "content":
        row_id = F.sha2(filled(text), 256)
    elif id_strategy == "position":
        row_id = position_id(source.raw_path)
    elif id_strategy == "table_position":
        return with_table_position(frame, source.raw_path, text)
    else:
        row_id = F.monotonically_increasing_id().cast("string")
    return frame.select(row_id.alias("id"), text.alias("text"))


def read_text(spark: SparkSession, source: SourceParams, id_strategy: str = "monotonic") -> DataFrame:
    """Read a source and normalise it to ``(id, text)``."""
    return normalize(read_raw(spark, source.raw_path, source.multi_line, source.partitions), source, id_strategy)

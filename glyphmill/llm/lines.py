"""Operator 5: line deduplication with levelled sorted runs.

What is known of lines is kept in runs: sorted tables of line hashes with the
number of documents that hold the line. A batch writes its own run at level 0;
when a level has as many runs as its fan-out, they are merged into one of the
next level. A batch is filtered by a merge anti-join with the few runs there
are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm.columns import SPACE, as_text, quoted, row_key, slices
from glyphmill.sources.scratch import materialize, scratch_path

FANOUT = 4
BATCHES = 4


def line_key(line: bytes) -> bytes:
    """What makes two lines equal: white space stripped at both ends, A-Z lower-cased."""
    return line.strip(SPACE).lower()


def line_hash(key: bytes) -> bytes:
    """128 bits, so that even 10^12 different lines are unlikely to collide once."""
    return xxhash.xxh3_128_digest(key)


def line_hashes(docs: DataFrame, least_chars: int = 1) -> DataFrame:
    """(k1, k2, h1, h2): the row's key and each different line hash of the row, once.

    ``docs`` has k1, k2 and text (binary). Keys under ``least_chars`` code points are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                digests, counts = [], []
                for text in part["text"].to_pylist():
                    keys = {line_key(line) for line in text.split(b"\n")}
                    own = [line_hash(k) for k in keys if len(k) >= least_chars and _long_enough(k, least_chars)]
                    digests += own
                    counts.append(len(own))
                hashes = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                rows = [np.repeat(part[c].to_numpy(), counts) for c in ("k1", "k2")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (*rows, hashes[:, 0].copy(), hashes[:, 1].copy())],
                    names=["k1", "k2", "h1", "h2"],
                )

    return docs.select("k1", "k2", "text").mapInArrow(run, "k1 long, k2 long, h1 long, h2 long")


def _long_enough(key: bytes, least: int) -> bool:
    return least <= 1 or len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least


class LineRuns:
    """Levels of sorted runs below a shared folder.

    ``levels`` lists the paths of each level and is all the state there is; save
    it to go on later. Runs are never changed, so readers of older levels are safe.
    """

    def __init__(self, spark: SparkSession, root: str, fanout: int = FANOUT, levels: list[list[str]] | None = None):
        if fanout < 2:
            raise ValueError(f"fanout must be at least 2, got {fanout}")
        self.spark, self.root, self.fanout = spark, root.rstrip("/"), fanout
        self.levels: list[list[str]] = [list(level) for level in levels or []]

    def _write(self, counts: DataFrame) -> str:
        path = f"{self.root}/run-{uuid.uuid4().hex}"
        counts.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2").write.parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        schema = "h1 long, h2 long, n_docs long"
        return reduce(DataFrame.unionByName, [self.spark.read.schema(schema).parquet(p) for p in paths])

    def add(self, hashes: DataFrame) -> None:
        """Add a batch: rows (h1, h2), each document's different lines once."""
        counts = hashes.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"))
        self._place(self._write(counts), 0)

    def _place(self, path: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) == self.fanout:
            merged = self._read(self.levels[level]).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"))
            self.levels[level] = []
            self._place(self._write(merged), level + 1)

    def frequent(self, least_docs: int = 1) -> DataFrame:
        """The hashes found in at least ``least_docs`` documents of all batches so far."""
        paths = [p for level in self.levels for p in level]
        if not paths:
            return self.spark.createDataFrame([], "h1 long, h2 long")
        known = self._read(paths)
        if len(paths) > 1:
            known = known.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"))
        return known.where(F.col("n_docs") >= least_docs).select("h1", "h2")

    def anti_join(self, hashes: DataFrame, least_docs: int = 1) -> DataFrame:
        """The rows of a batch whose line is not known, or not from that many documents.

        The known lines are stored first, one row each: a plain table is
        broadcast by its measured size, or else a skewed line is split.
        """
        if not any(self.levels):
            return hashes
        return hashes.join(materialize(self.frequent(least_docs), "known-lines", thin=True), ["h1", "h2"], "left_anti")


def drop_lines(text: Column, hashes: Column) -> Column:
    """A struct (text, n_lines, n_dropped): the text without the lines of the given hashes."""

    @F.arrow_udf("struct<text:string,n_lines:long,n_dropped:long>")
    def run(texts: pa.Array, lists: pa.Array) -> pa.Array:
        names, parts = ["text", "n_lines", "n_dropped"], []
        for pair in slices(pa.RecordBatch.from_arrays([texts, lists], names=["text", "drop"])):
            kept, before, gone = [], [], []
            for value, drop in zip(pair["text"].to_pylist(), pair["drop"], strict=True):
                value = value or b""
                n = value.count(b"\n") + 1
                stay = n
                if drop.is_valid:
                    packed = drop.as_py()
                    unwanted = {packed[i : i + 16] for i in range(0, len(packed), 16)}
                    lines = [x for x in value.split(b"\n") if line_hash(line_key(x)) not in unwanted]
                    stay, value = len(lines), b"\n".join(lines)
                kept.append(value)
                before.append(n)
                gone.append(n - stay)
            columns = [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(before), pa.array(gone)]
            parts.append(pa.StructArray.from_arrays(columns, names=names))
        kind = pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return run(text, hashes)


def dedup_lines(docs: DataFrame, least_docs: int = 10, least_chars: int = 1, batches: int = BATCHES) -> DataFrame:
    """Drop in every document the lines found in at least ``least_docs`` documents.

    Returns all columns with ``text`` shortened, and ``n_lines`` (before),
    ``n_dropped`` (input columns of these names are replaced). A null or empty
    text is one empty line and becomes an empty text; empty lines always stay. A
    row is a document: repeated rows count each. An empty table gives no rows.

    The texts are read twice and shuffled once, by row; lines only as hashes.
    These come in ``batches``: each is anti-joined with the lines that the runs
    know from enough documents, and the rest is added as a run of its own. A
    line in a third of all documents is one row of a run, and its many
    occurrences join as a skewed key that Spark splits, since both sides are
    plain tables.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped")
    text = as_text(quoted("text"))
    key = row_key(quoted("doc_id").cast("long"), text)
    keyed = docs.select(key[0].alias("k1"), key[1].alias("k2"), text.cast("binary").alias("text"))
    path = scratch_path(spark, "line-hashes")
    hashes = line_hashes(keyed, least_chars).withColumn("batch", F.pmod("k1", F.lit(batches)).cast("int"))
    hashes.write.partitionBy("batch").parquet(path)
    stored = spark.read.schema("k1 long, k2 long, h1 long, h2 long, batch int").parquet(path)
    runs = LineRuns(spark, scratch_path(spark, "line-runs"))
    for batch in range(batches):
        # what the runs know from enough documents needs no further counting
        runs.add(runs.anti_join(stored.where(F.col("batch") == batch).select("h1", "h2"), least_docs))
    frequent = materialize(runs.frequent(least_docs), "frequent-lines", thin=True)
    packed = F.array_join(F.sort_array(F.collect_set("h")), "")
    doomed = (
        stored.join(frequent, ["h1", "h2"])
        .select("k1", "k2", F.concat(_little_endian("h1"), _little_endian("h2")).alias("h"))
        .groupBy("k1", "k2")
        .agg(packed.alias("_doomed"))
    )
    doomed = materialize(doomed, "doomed-lines")
    # the row travels as one struct, so that no column of the input can clash with the keys
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), key[0].alias("k1"), key[1].alias("k2"))
    shortened = drop_lines(as_text(F.col("row").getField("text")).cast("binary"), F.unhex("_doomed")).alias("short")
    joined = rows.join(doomed, ["k1", "k2"], "left").select("row", shortened)
    columns = [
        F.col("short.text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns
    ]
    return joined.select(*columns, "short.n_lines", "short.n_dropped")


def _little_endian(name: str) -> Column:
    """16 hex digits of a long, lowest byte first, as the hash function gave them."""
    big = F.lpad(F.hex(F.col(name)), 16, "0")
    return F.concat(*[F.substring(big, 15 - 2 * i, 2) for i in range(8)])

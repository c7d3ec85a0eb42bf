"""The stages of the corpus pipeline: (spark, docs, sf_dir) to a frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm import decontaminate, lines, packing, quality, setsketch
from glyphmill.llm.columns import as_text, row_key
from glyphmill.llm.queries import learnable
from glyphmill.sources.scratch import materialize

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")

# Rows of an Arrow batch between Spark and a Python worker. By Spark's default of 10,000 a batch of long
# texts takes hundreds of MB on either side, and the stages follow each other in the same executors.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

# Below this probability of being good a document goes.
LEAST_QUALITY = 0.3


def bound_batches(spark: SparkSession) -> None:
    """Limit the session's Arrow batches to ``BATCH_ROWS`` rows, unless they are smaller already.

    The setting stays, since a stage's rows are computed when they are asked for.
    """
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects.

    A null text is judged as an empty one, repeated rows share their fate, without
    labels all stay, an empty table stays empty. Columns beyond those of documents
    are dropped.
    """
    bound_batches(spark)
    model = quality.fit_quality(learnable(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.select(*DOCUMENT).where(quality.quality_score(model, F.col("text")) >= LEAST_QUALITY)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the lines found in ten documents or more; the documents stay, if empty.

    A null text becomes an empty one; an empty table stays empty. Columns beyond
    those of documents are dropped.
    """
    bound_batches(spark)
    short = lines.dedup_lines(docs.select(*DOCUMENT), least_docs=10, least_chars=1)
    return short.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays.

    Null or empty texts and null ids are in no group and stay, repeated rows share
    their fate, rows with equal ids and different texts are judged apart, an empty
    table stays empty. Columns beyond those of documents are dropped.
    """
    bound_batches(spark)
    own = docs.select(*DOCUMENT)
    found = setsketch.near_duplicates(own, with_key=True)
    # texts are in the documents only, so the thin list of keys that go is joined to them
    gone = materialize(found.where(~F.col("kept")).select("key").distinct(), "duplicates", thin=True)
    key = setsketch.row_hash(F.col("doc_id").cast("long"), as_text(F.col("text")).cast("binary"))
    return own.join(gone, key == gone["key"], "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item.

    Null and empty texts hold none, repeated rows go together, without items all
    stay, an empty table stays empty. Columns beyond those of documents are dropped.
    """
    own = docs.select(*DOCUMENT)
    found = decontaminate.contaminated(own, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = materialize(found.select("k1", "k2").distinct(), "contaminated", thin=True)
    k1, k2 = row_key(F.col("doc_id").cast("long"), as_text(F.col("text")))
    return own.join(gone, (k1 == gone["k1"]) & (k2 == gone["k2"]), "left_anti")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of fixed length.

    A null text is an empty one, which is its end token alone; repeated rows are
    packed each; an empty table gives no sequence. Other columns are ignored.
    """
    import public_tokenizers

    bound_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("lines", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

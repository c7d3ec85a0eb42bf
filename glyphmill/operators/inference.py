"""Batched model inference over a text column."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Hashable, Iterator
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from glyphmill.functions.arrays import with_fixed
from glyphmill.functions.text import filled
from glyphmill.operators import models
from glyphmill.operators.schemas import prediction_schema

# Applications that have this package on their workers already.
_SHIPPED: set[str] = set()

# Rows a worker has in hand at a time, in calls of ``batch_size``, and rows of an Arrow batch that Spark sends it. By
# Spark's default of 10,000 a worker's memory grows with a task's rows up to that number, and with their lengths.
SORTED_ROWS = 256
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Limit the session's Arrow batches to ``BATCH_ROWS`` rows, unless they are smaller already.

    The setting stays, since rows are computed when they are asked for.
    """
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once per application).

    The model cache lives in a module, and a module is only shared between the
    tasks of a worker when it is imported there by name.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    fd, name = tempfile.mkstemp(prefix="glyphmill-", suffix=".zip")
    with os.fdopen(fd, "wb") as handle, zipfile.ZipFile(handle, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    context.addPyFile(name)
    _SHIPPED.add(context.applicationId)


def infer_batches(
    corpus: DataFrame,
    task: str,
    model_name: str = "",
    batch_size: int = 16,
    max_length: int = 256,
    mode: str | None = None,
    lexicon: Any = None,
    load: Callable[[], models.Model] | None = None,
    model_key: Hashable | None = None,
    setup: Callable[[], None] | None = None,
    deterministic: bool = True,
    by_length: bool = True,
) -> DataFrame:
    """Structure ``text`` with a model, one output row per input row.

    Only the text column travels to Python and only the prediction comes back,
    as Arrow batches; the other columns stay in the JVM. So filters on them run
    before the model does, and filters on the prediction after it, never twice.

    What is sent to the workers is the model's name (and the word list of a
    lexicon model), never weights. ``load`` replaces the named models by any
    function without arguments that workers can unpickle and that returns a
    model. With a ``model_key`` each worker calls it once and keeps the model for
    its later tasks, without one it is called in every task. ``setup`` runs
    right before it, as often. ``deterministic=False`` keeps Spark from moving
    filters across the model.

    A model pads the texts of a call to the longest. With ``by_length``
    ``SORTED_ROWS`` texts at a time (or ``batch_size``, if more) are sorted by
    length before they are cut into calls, and the predictions are put back in
    order, so rows get what they would without it. ``by_length=False`` is for a
    model that depends on the order of its texts. A worker holds the objects of
    these rows only and gives back its memory, and Spark's batches are bounded
    (``bound_batches``), so its memory does not grow with the input.
    """
    schema = prediction_schema(task)
    if load is None and (model_key is not None or setup is not None):
        raise ValueError("model_key and setup belong to load")
    spec = models.model_spec(task, model_name, mode, lexicon) if load is None else None
    ship_package(corpus.sparkSession)
    bound_batches(corpus.sparkSession)
    at_a_time = max(SORTED_ROWS, batch_size)

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # imported by name, so that the loader is the worker's own
        from glyphmill.operators.models import LOADER, Loader

        if spec is not None:
            model = LOADER.of(spec)
        else:
            model = (Loader() if model_key is None else LOADER).get(("load", model_key), load, setup)
        arrow_type = to_arrow_type(schema)
        for batch in batches:
            for start in range(0, len(batch), at_a_time):
                part = batch.slice(start, at_a_time)
                found = [pa.array([], type=arrow_type)]
                order = np.argsort(pc.utf8_length(part), kind="stable") if by_length else np.arange(len(part))
                texts = part.take(pa.array(order)) if by_length else part
                for first in range(0, len(part), batch_size):
                    rows = model(texts.slice(first, batch_size).to_pylist(), batch_size, max_length)
                    if task == "ner":
                        rows = [{**row, "n_entities": len(row["entities"])} for row in rows]
                    found.append(pa.array(rows, type=arrow_type))
                yield pa.concat_arrays(found).take(pa.array(np.argsort(order)))
            pa.default_memory_pool().release_unused()  # the next batch need not come on top of this one

    # PySpark reads the type hints; they are written as strings in this module.
    predict.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    model_column = F.arrow_udf(predict, returnType=schema)
    if not deterministic:
        model_column = model_column.asNondeterministic()
    prepared = corpus.withColumn("text", filled(F.col("text")))
    return with_fixed(prepared, "_prediction", model_column("text")).select(
        *prepared.columns, *[F.col(f"_prediction.{name}").alias(name) for name in schema.fieldNames()]
    )

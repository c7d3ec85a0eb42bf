"""Spark schemas of the structured rows, one per task."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

# Names, types and order of the output fields.
ENTITY = StructType(
    [
        StructField("text", StringType()),
        StructField("type", StringType()),
        StructField("start", IntegerType()),
        StructField("end", IntegerType()),
        StructField("score", DoubleType()),
    ]
)

# The keys of a raw model span an entity field is taken from, in
# order of preference, its type and the default where none is given.
SPAN_FIELDS = {
    "text": (("word",), "string", ""),
    "type": (("entity_group", "entity"), "string", "ENTIDAD"),
    "start": (("start",), "int", 0),
    "end": (("end",), "int", 0),
    "score": (("score",), "double", 0.0),
}

# Fixed values, as above.
SENTIMENT_PREDICTION = StructType(
    [StructField("label", StringType()), StructField("confidence", DoubleType())]
)
NER_PREDICTION = StructType(
    [
        StructField("entities", ArrayType(ENTITY)),
        StructField("n_entities", IntegerType()),
        StructField("confidence", DoubleType()),
    ]
)


def prediction_schema(task: str) -> StructType:
    """Fields a model adds to a row."""
    if task == "sentiment":
        return SENTIMENT_PREDICTION
    if task == "ner":
        return NER_PREDICTION
    raise ValueError(f"unknown task {task!r}")


def output_schema(task: str) -> StructType:
    """Full structured row: ``id``, ``text`` and the prediction fields."""
    keys = [StructField("id", StringType()), StructField("text", StringType())]
    return StructType(keys + prediction_schema(task).fields)

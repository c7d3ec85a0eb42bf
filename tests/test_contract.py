import pytest
from pyspark.sql import functions as F

from glyphmill.operators.contract import (
    ContractViolation,
    broken_names,
    coerce,
    contract_rules,
    failing_values,
    flag_rows,
    split_rows,
    validate,
    violations,
)
from glyphmill.params import ModelParams

SENTIMENT = ModelParams(task="sentiment", model_name="m", labels=("POS", "NEU", "NEG"))
NER = ModelParams(task="ner", model_name="m", entity_types=("FARMACO", "SINTOMA"))
ENTITY = "array<struct<text:string,type:string,start:int,end:int,score:double>>"
S_SCHEMA = "id string, text string, label string, confidence double"
N_SCHEMA = f"id string, text string, entities {ENTITY}, n_entities int, confidence double"


def failed(frame, model):
    return {(r["column"], r["check"]): r["n_failed"] for r in violations(frame, model).collect() if r["n_failed"]}


def test_valid_sentiment_passes(spark):
    frame = spark.createDataFrame([("1", "bueno", "POS", 0.9), ("2", "malo", "NEG", 0.7)], S_SCHEMA)
    assert validate(frame, SENTIMENT).count() == 2


def test_every_failure_is_reported_at_once(spark):
    rows = [
        (None, "x", "POS", 0.5),
        ("2", None, "POS", 0.5),
        ("3", "x", None, 0.5),
        ("4", "x", "FELIZ", 1.5),
        ("5", "x", "POS", float("nan")),
        ("6", "x", "POS", None),
        ("7", "x", "POS", -0.1),
        ("8", "x", "POS", 0.0),
        ("9", "x", "POS", 1.0),
    ]
    frame = spark.createDataFrame(rows, S_SCHEMA)
    assert failed(frame, SENTIMENT) == {
        ("id", "not_null"): 1,
        ("text", "not_null"): 1,
        ("label", "not_null"): 1,
        ("label", "allowed"): 1,
        ("confidence", "not_null"): 2,
        ("confidence", "in_range"): 2,
    }
    with pytest.raises(ContractViolation) as error:
        validate(frame, SENTIMENT)
    assert ("label", "allowed", 1) in error.value.failures and len(error.value.failures) == 6


def test_empty_label_list_rejects_every_row(spark):
    frame = spark.createDataFrame([("1", "x", "POS", 0.5)], S_SCHEMA)
    assert failed(frame, ModelParams(task="sentiment", model_name="m")) == {("label", "allowed"): 1}


def test_types_are_coerced_and_extra_columns_kept(spark):
    frame = spark.createDataFrame([(1, "x", "POS", "0.5", "more")], "id int, text string, label string, confidence string, extra string")
    out = validate(frame, SENTIMENT)
    assert dict(out.dtypes) == {"id": "string", "text": "string", "label": "string", "confidence": "double", "extra": "string"}
    assert out.first()["confidence"] == 0.5


def test_value_that_cannot_be_cast(spark):
    frame = spark.createDataFrame([("1", "x", "POS", "high"), ("2", "x", "POS", None)], "id string, text string, label string, confidence string")
    assert failed(frame, SENTIMENT) == {("confidence", "type"): 1, ("confidence", "not_null"): 1}
    assert coerce(frame, SENTIMENT).first()["confidence"] is None


def test_missing_column(spark):
    frame = spark.createDataFrame([("1", "x", 0.5)], "id string, text string, confidence double")
    assert failed(frame, SENTIMENT) == {("label", "present"): 1}


def test_valid_ner_passes(spark):
    frame = spark.createDataFrame([("1", "tomó ibuprofeno", [("ibuprofeno", "FARMACO", 5, 15, 0.9)], 1, 0.9)], N_SCHEMA)
    assert validate(frame, NER).count() == 1


def test_ner_failures(spark):
    rows = [
        ("1", "x", [("x", "LUGAR", 0, 1, 0.9), ("x", "FARMACO", 0, 1, 0.9)], 2, 0.9),
        ("2", "x", [("x", None, 0, 1, 0.9)], 1, 0.9),
        ("3", "x", [], -1, 0.0),
        ("4", "x", None, 0, 0.0),
    ]
    frame = spark.createDataFrame(rows, N_SCHEMA)
    assert failed(frame, NER) == {
        ("entities", "allowed_type"): 2,
        ("entities", "not_null"): 1,
        ("n_entities", "at_least_0"): 1,
    }
    # Without declared types any type goes.
    assert ("entities", "allowed_type") not in failed(frame, ModelParams(task="ner", model_name="m"))


def test_entities_of_another_type(spark):
    frame = spark.createDataFrame([("1", "x", "tos", 1, 0.5)], "id string, text string, entities string, n_entities int, confidence double")
    assert failed(frame, NER) == {("entities", "type"): 1}


def test_contract_by_task(spark):
    frame = spark.createDataFrame([], S_SCHEMA)
    assert {r["column"] for r in violations(frame, SENTIMENT).collect()} == {"id", "text", "label", "confidence"}
    assert ("entities", "present") in failed(frame, NER)


def test_checks_take_one_pass(spark):
    plan = violations(spark.createDataFrame([], N_SCHEMA), NER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


DAMAGED = [
    (None, "x", "POS", 0.5),
    ("2", None, "FELIZ", 1.5),
    ("3", "x", None, float("nan")),
    ("4", "x", "NEG", 1.0),
    ("4", "x", "NEG", 1.0),
    ("5", "x", "NEG", None),
]


def test_each_row_gets_the_rules_it_breaks(spark):
    frame = spark.createDataFrame(DAMAGED, S_SCHEMA)
    rules = contract_rules(frame, SENTIMENT)
    flagged = flag_rows(frame, SENTIMENT).withColumn("why", broken_names(F.col("broken_rules"), rules))
    assert "Exchange" not in flagged._jdf.queryExecution().executedPlan().toString()
    found = [(r["id"], r["why"]) for r in flagged.collect()]
    assert found == [
        (None, ["id.not_null"]),
        ("2", ["text.not_null", "confidence.in_range", "label.allowed"]),
        ("3", ["label.not_null", "confidence.not_null"]),
        ("4", []),
        ("4", []),
        ("5", ["confidence.not_null"]),
    ]
    # bits and counts agree
    counts = failed(frame, SENTIMENT)
    for i, rule in enumerate(rules):
        bits = flagged.where(F.col("broken_rules").bitwiseAND(F.lit(1 << i)) != 0).count()
        assert bits == counts.get((rule.column, rule.check), 0)


def test_split_loses_no_row(spark):
    kept, apart = split_rows(spark.createDataFrame(DAMAGED, S_SCHEMA).withColumn("extra", F.lit(1)), SENTIMENT)
    assert (kept.count(), apart.count()) == (2, 4) and kept.columns == [*S_SCHEMA.replace(" string", "").replace(" double", "").split(", "), "extra"]
    assert all(r["reasons"] for r in apart.collect())


def test_missing_column_breaks_every_row(spark):
    frame = spark.createDataFrame([("1", "x", "POS")], "id string, text string, label string")
    kept, apart = split_rows(frame, SENTIMENT)
    assert kept.count() == 0 and apart.first()["reasons"] == ["confidence.present"]
    empty = frame.limit(0)
    assert flag_rows(empty, SENTIMENT).count() == 0 and failing_values(empty, SENTIMENT).count() == 0


def test_failing_values_are_bounded_per_rule(spark):
    rows = [(f"{i:04}", "x", "FELIZ" if i % 3 == 0 else "POS", 2.0 if i == 500 else 0.5) for i in range(1000)]
    frame = spark.createDataFrame(rows, S_SCHEMA).repartition(4)
    shown = failing_values(frame, SENTIMENT, per_rule=3)
    found = sorted((r["column"], r["check"], r["rank"], r["id"], r["value"]) for r in shown.collect())
    assert found == [
        ("confidence", "in_range", 1, "0500", "2.0"),
        ("label", "allowed", 1, "0000", "FELIZ"),
        ("label", "allowed", 2, "0003", "FELIZ"),
        ("label", "allowed", 3, "0006", "FELIZ"),
    ]
    # each task drops what can't be among the first before anything is sent
    plan = failing_values(frame, SENTIMENT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_failing_values_of_nested_columns(spark):
    rows = [("1", "x", [("a", "OTRO", 0, 1, 0.5)], 1, 0.5)]
    found = failing_values(spark.createDataFrame(rows, N_SCHEMA), NER).first()
    assert found["check"] == "allowed_type" and '"type":"OTRO"' in found["value"]

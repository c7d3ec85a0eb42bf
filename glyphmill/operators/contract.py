"""The output contract of each task, checked in one aggregation over the rows.

``violations`` counts, ``flag_rows`` gives every row the set of rules it breaks,
``failing_values`` lists some of the values that break a rule.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

from glyphmill.operators.schemas import output_schema
from glyphmill.params import ModelParams


@dataclass(frozen=True)
class Rule:
    """``failed`` is true for each row that breaks the check; None fails the frame as a whole."""

    column: str
    check: str
    failed: Column | None


class ContractViolation(ValueError):
    """Carries every broken check as ``(column, check, n_failed)``."""

    def __init__(self, failures: Iterable[tuple[str, str, int]]):
        self.failures = list(failures)
        listed = "; ".join(f"{column}: {check} failed {n} time(s)" for column, check, n in self.failures)
        super().__init__(f"output contract violated: {listed}")


def _typed(frame: DataFrame, name: str, kind) -> Column | None:
    """The column in its contract type, null where a value cannot be cast; None if no cast exists."""
    have = frame.schema[name].dataType
    if isinstance(kind, ArrayType):
        element = have.elementType if isinstance(have, ArrayType) else None
        usable = isinstance(element, StructType) and "type" in element.fieldNames()
        return F.col(name) if usable else None
    if isinstance(have, (ArrayType, StructType)):
        return F.col(name).cast("string") if isinstance(kind, StringType) else None
    return F.col(name).try_cast(kind)


def contract_rules(frame: DataFrame, model: ModelParams) -> list[Rule]:
    """Every check of the task's contract. Columns beyond the contract are allowed."""
    rules: list[Rule] = []
    typed: dict[str, Column] = {}
    for item in output_schema(model.task).fields:
        if item.name not in frame.columns:
            rules.append(Rule(item.name, "present", None))
            continue
        value = _typed(frame, item.name, item.dataType)
        if value is None:
            rules.append(Rule(item.name, "type", None))
            continue
        raw = F.col(item.name)
        missing = value.isNull()
        if isinstance(item.dataType, DoubleType):
            missing = missing | F.isnan(value)
        uncastable = raw.isNotNull() & value.isNull()
        rules.append(Rule(item.name, "type", uncastable))
        rules.append(Rule(item.name, "not_null", missing & ~uncastable))
        typed[item.name] = F.when(~missing, value)

    if "confidence" in typed:
        rules.append(Rule("confidence", "in_range", ~typed["confidence"].between(0.0, 1.0)))
    if "label" in typed:
        allowed = typed["label"].isin(list(model.labels)) if model.labels else F.lit(False)
        rules.append(Rule("label", "allowed", typed["label"].isNotNull() & ~allowed))
    if "n_entities" in typed:
        rules.append(Rule("n_entities", "at_least_0", typed["n_entities"] < 0))
    if "entities" in typed and model.entity_types:
        kinds = list(model.entity_types)
        unknown = F.exists(typed["entities"], lambda e: ~F.coalesce(e["type"].isin(kinds), F.lit(False)))
        rules.append(Rule("entities", "allowed_type", unknown))
    return rules


def rule_counts(rules: list[Rule]) -> list[Column]:
    """One count per rule, named ``rule_<i>``; may share a pass with other aggregates."""
    return [
        (F.count(F.lit(None)) + 1 if rule.failed is None else F.count_if(rule.failed)).alias(f"rule_{i}")
        for i, rule in enumerate(rules)
    ]


def broken_rules(rules: list[Rule], counts: Row | dict[str, int]) -> list[tuple[str, str, int]]:
    """The failures in collected ``rule_counts``."""
    return [(rule.column, rule.check, counts[f"rule_{i}"]) for i, rule in enumerate(rules) if counts[f"rule_{i}"]]


def violations(frame: DataFrame, model: ModelParams) -> DataFrame:
    """``(column, check, n_failed)`` for every check of the contract, also those that passed."""
    rules = contract_rules(frame, model)
    counted = frame.agg(F.count(F.lit(1)).alias("n"), *rule_counts(rules))
    lines = F.array(
        *[
            F.struct(
                F.lit(rule.column).alias("column"),
                F.lit(rule.check).alias("check"),
                F.col(f"rule_{i}").alias("n_failed"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return counted.select(F.inline(lines))


def broken_mask(rules: list[Rule]) -> Column:
    """The rules a row breaks as bits, rule 0 being the lowest; a rule on the frame as a whole is broken by every row."""

    def bit(i: int, rule: Rule) -> Column:
        value = F.lit(1 << i).cast("bigint")
        return value if rule.failed is None else F.when(rule.failed, value).otherwise(F.lit(0).cast("bigint"))

    mask = F.lit(0).cast("bigint")
    for i, rule in enumerate(rules):
        mask = mask.bitwiseOR(bit(i, rule))
    return mask


def broken_names(mask: Column, rules: list[Rule]) -> Column:
    """``column.check`` of every rule in a mask, in rule order."""
    listed = [
        F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(f"{rule.column}.{rule.check}")) for i, rule in enumerate(rules)
    ]
    return F.array_compact(F.array(*listed).cast("array<string>"))


def flag_rows(frame: DataFrame, model: ModelParams, name: str = "broken_rules") -> DataFrame:
    """All rows with the mask of the rules they break, 0 for a row that keeps the contract; no shuffle."""
    return frame.withColumn(name, broken_mask(contract_rules(frame, model)))


def split_rows(frame: DataFrame, model: ModelParams) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the contract, in contract types, and the others as they are with their ``reasons``."""
    rules = contract_rules(frame, model)
    mask = broken_mask(rules)
    return coerce(frame.where(mask == 0), model), frame.where(mask != 0).withColumn("reasons", broken_names(mask, rules))


def _shown(frame: DataFrame, column: str) -> Column:
    if column not in frame.columns:
        return F.lit(None).cast("string")
    nested = isinstance(frame.schema[column].dataType, (ArrayType, StructType))
    return F.to_json(column) if nested else F.col(column).cast("string")


def failing_values(frame: DataFrame, model: ModelParams, per_rule: int = 10) -> DataFrame:
    """``column, check, rank, id, value`` of at most ``per_rule`` rows of each broken rule.

    Of a rule's rows those with the smallest ids are shown, a null id first.
    Each task keeps ``per_rule`` rows of a rule before the shuffle, so a rule that a
    third of all rows breaks costs no more than another one.
    """
    rules = contract_rules(frame, model)
    row_id = F.col("id").cast("string") if "id" in frame.columns else F.lit(None).cast("string")
    found = [
        F.when(
            F.lit(True) if rule.failed is None else rule.failed,
            F.struct(F.lit(i).alias("rule"), row_id.alias("id"), _shown(frame, rule.column).alias("value")),
        )
        for i, rule in enumerate(rules)
    ]
    listed = frame.select(F.inline(F.array_compact(F.array(*found))))
    first = Window.partitionBy("rule").orderBy(F.col("id").asc_nulls_first(), F.col("value").asc_nulls_first())
    ranked = listed.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= per_rule)
    names = F.array(*[F.struct(F.lit(r.column).alias("column"), F.lit(r.check).alias("check")) for r in rules])
    return ranked.select(F.get(names, F.col("rule")).alias("of"), "rank", "id", "value").select("of.*", "rank", "id", "value")


def coerce(frame: DataFrame, model: ModelParams) -> DataFrame:
    """The frame with those contract columns it has in their contract types."""
    casts = {}
    for item in output_schema(model.task).fields:
        if item.name not in frame.columns:
            continue
        value = _typed(frame, item.name, item.dataType)
        if value is not None:
            casts[item.name] = value
    return frame.withColumns(casts)


def validate(frame: DataFrame, model: ModelParams) -> DataFrame:
    """Check all rules in one pass; raise with all failures, or return the coerced frame."""
    rules = contract_rules(frame, model)
    counts = frame.agg(F.count(F.lit(1)).alias("n"), *rule_counts(rules)).first()
    failures = broken_rules(rules, counts)
    if failures:
        raise ContractViolation(failures)
    return coerce(frame, model)

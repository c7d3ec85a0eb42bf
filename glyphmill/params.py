"""Job parameters for one domain, checked before any data is read."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from typing import Any

TASKS = ("sentiment", "ner")
WRITE_MODES = ("append", "overwrite", "overwrite_partition")


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


def _is_int(value: Any) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


def _is_number(value: Any) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


@dataclass(frozen=True)
class SourceParams:
    """Where the raw text lies. Without ``id_column`` an id is generated per row.

    ``multi_line=False`` tells that no CSV record spans lines, so files split;
    ``partitions`` deals the rows out anew, for files that don't.
    """

    raw_path: str
    text_column: str
    id_column: str | None = None
    multi_line: bool = True
    partitions: int | None = None

    def __post_init__(self) -> None:
        _require(
            self.partitions is None or (isinstance(self.partitions, int) and self.partitions > 0),
            "partitions must be a positive integer",
        )
        _require(isinstance(self.raw_path, str) and bool(self.raw_path), "raw_path must be a non-empty string")
        _require(
            isinstance(self.text_column, str) and bool(self.text_column),
            "text_column must be a non-empty string",
        )


@dataclass(frozen=True)
class ModelParams:
    """Which task to run and how its batches are cut."""

    task: str
    model_name: str
    batch_size: int = 16
    max_length: int = 256
    labels: tuple[str, ...] = ()
    entity_types: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        _require(self.task in TASKS, f"task must be one of {TASKS}, got {self.task!r}")
        for name in ("batch_size", "max_length"):
            value = getattr(self, name)
            _require(_is_int(value) and value > 0, f"{name} must be a positive integer, got {value!r}")
        object.__setattr__(self, "labels", tuple(self.labels))
        object.__setattr__(self, "entity_types", tuple(self.entity_types))


@dataclass(frozen=True)
class TableParams:
    """Target table: path, partition columns and write mode."""

    path: str
    partition_by: tuple[str, ...] = ("domain", "ingest_date")
    mode: str = "append"

    def __post_init__(self) -> None:
        _require(isinstance(self.path, str) and bool(self.path), "path must be a non-empty string")
        _require(self.mode in WRITE_MODES, f"mode must be one of {WRITE_MODES}, got {self.mode!r}")
        object.__setattr__(self, "partition_by", tuple(self.partition_by))


@dataclass(frozen=True)
class QualityParams:
    """Thresholds of the confidence and drift checks."""

    min_confidence: float = 0.5
    psi_threshold: float = 0.2
    ks_pvalue_threshold: float = 0.05

    def __post_init__(self) -> None:
        for item in fields(self):
            _require(_is_number(getattr(self, item.name)), f"{item.name} must be a number")
        _require(0.0 <= self.min_confidence <= 1.0, "min_confidence must lie in [0, 1]")
        _require(self.psi_threshold > 0.0, "psi_threshold must be positive")
        _require(0.0 < self.ks_pvalue_threshold <= 1.0, "ks_pvalue_threshold must lie in (0, 1]")


@dataclass(frozen=True)
class DomainParams:
    """Everything one domain needs; the operators themselves know no domain."""

    domain: str
    data: SourceParams
    model: ModelParams
    lakehouse: TableParams
    quality: QualityParams = field(default_factory=QualityParams)
    description: str = ""

    def __post_init__(self) -> None:
        _require(isinstance(self.domain, str) and bool(self.domain), "domain must be a non-empty string")

    def at(self, raw_path: str | None = None, table_path: str | None = None) -> DomainParams:
        """The same domain reading from / writing to other places."""
        out = self
        if raw_path is not None:
            out = replace(out, data=replace(out.data, raw_path=raw_path))
        if table_path is not None:
            out = replace(out, lakehouse=replace(out.lakehouse, path=table_path))
        return out


_SECTIONS = {"data": SourceParams, "model": ModelParams, "lakehouse": TableParams, "quality": QualityParams}


def params_from_mapping(raw: Mapping[str, Any]) -> DomainParams:
    """Build parameters from nested mappings, e.g. a parsed YAML or JSON file.

    Unknown keys are ignored; a missing or invalid value raises ``ValueError``.
    """

    def build(cls: type, values: Mapping[str, Any], where: str) -> Any:
        _require(isinstance(values, Mapping), f"{where} must be a mapping")
        known = {item.name for item in fields(cls)}
        try:
            return cls(**{key: value for key, value in values.items() if key in known})
        except TypeError as error:
            raise ValueError(f"{where}: {error}") from error

    values = dict(raw)
    for section, cls in _SECTIONS.items():
        if section in values:
            values[section] = build(cls, values[section], section)
    return build(DomainParams, values, "domain parameters")

"""The end-to-end job of one domain, and the same job over several domains."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.operators import models
from glyphmill.operators.confidence import flag_low_confidence, label_counts, summary_aggregates
from glyphmill.operators.contract import ContractViolation, broken_mask, broken_rules, contract_rules, rule_counts
from glyphmill.operators.drift import drift_profile
from glyphmill.operators.entities import lexicon_entities
from glyphmill.operators.inference import infer_batches
from glyphmill.operators.sentiment import lexicon_sentiment
from glyphmill.params import DomainParams
from glyphmill.sources.corpus import read_text
from glyphmill.sources.versioned import commit_write, discard_write, read_staged, save_profile, stage_write


@dataclass(frozen=True)
class RunResult:
    """What a run stored and how good it is."""

    domain: str
    task: str
    path: str
    version: int
    summary: dict[str, Any]
    failures: tuple[tuple[str, str, int], ...] = ()

    def metrics(self) -> dict[str, float]:
        """The summary in long form; labels appear as ``label_counts.<label>``."""
        flat = {name: float(value) for name, value in self.summary.items() if name != "label_counts"}
        counts = self.summary.get("label_counts", {})
        return flat | {f"label_counts.{label}": float(n) for label, n in counts.items()}


def structure(corpus: DataFrame, params: DomainParams, mode: str | None = None, lexicon: Any = None) -> DataFrame:
    """Structure an ``(id, text)`` corpus with the domain's model.

    Lexicon models are column expressions; pre-trained models run in batches.
    """
    settled = models.settle_mode(mode)
    model = params.model
    if settled != "mock":
        return infer_batches(
            corpus, model.task, model.model_name, model.batch_size, model.max_length, mode=settled
        )
    operator = lexicon_sentiment if model.task == "sentiment" else lexicon_entities
    return operator(corpus, lexicon) if lexicon is not None else operator(corpus)


def run_domain(
    spark: SparkSession,
    params: DomainParams,
    mode: str | None = None,
    ingest_date: str | None = None,
    lexicon: Any = None,
    id_strategy: str = "monotonic",
    quarantine: bool = False,
    flag: bool = False,
    profile: bool = False,
) -> RunResult:
    """Read, structure, store, check and summarise one domain.

    The model runs once: its output is written, invisible to readers, while the
    contract and the summary are computed over the same rows. They become a
    version of the table only if the contract holds; otherwise their files are
    removed, ``ContractViolation`` is raised and the table is as before. Nothing is
    cached, so a lost executor costs no second, perhaps different, inference of
    rows that were already checked.

    With ``quarantine`` the rows that break the contract are set apart in the same
    write, with the rules they break; the others become the version, and
    ``failures`` of the result has the counts. The summary is then read from the
    stored rows. A contract that the frame as a whole breaks still raises. With
    ``flag`` the rows are stored with ``low_confidence``. With ``profile`` lengths and
    labels of the stored rows are counted and kept with the version, for
    ``drift_against_profile``.
    """
    corpus = read_text(spark, params.data, id_strategy)
    rows = structure(corpus, params, mode, lexicon)
    rules = contract_rules(rows, params.model)
    if flag:
        rows = flag_low_confidence(rows, params.quality.min_confidence)
    labels = params.model.labels if params.model.task == "sentiment" else ()
    staged = stage_write(
        rows,
        params,
        ingest_date,
        metrics=[
            *summary_aggregates(rows.columns, params.quality.min_confidence),
            *rule_counts(rules),
            *[F.count_if(F.col("label") == label).alias(f"label_{i}") for i, label in enumerate(labels)],
        ],
        mask=broken_mask(rules) if quarantine else None,
    )
    audit = staged.metrics
    failures = broken_rules(rules, audit)
    if failures and (not quarantine or any(rule.failed is None for rule in rules)):
        discard_write(spark, staged)
        raise ContractViolation(failures)

    if failures:
        kept = read_staged(spark, staged)
        audit = kept.agg(*summary_aggregates(rows.columns, params.quality.min_confidence)).first().asDict()
        counted = {r["label"]: r["n"] for r in label_counts(kept).collect()} if labels else {}
        audit |= {f"label_{i}": counted.get(label, 0) for i, label in enumerate(labels)}
    names = ("n", "mean_confidence", "pct_low_confidence", "coverage", "total_entities")
    summary = {name: audit[name] for name in names if name in audit}
    if labels:
        # The contract holds, so the allowed labels are all the labels there are.
        counts = {label: audit[f"label_{i}"] for i, label in enumerate(labels) if audit[f"label_{i}"]}
        summary["label_counts"] = dict(sorted(counts.items(), key=lambda item: -item[1]))
    result = RunResult(params.domain, params.model.task, staged.path, staged.version, summary, tuple(failures))
    if profile:
        save_profile(drift_profile(read_staged(spark, staged)), staged)
    commit_write(spark, staged, result.metrics())
    return result


class DomainsFailed(Exception):
    """Some domains failed: ``failed`` has their errors by name, ``done`` the results that are stored."""

    def __init__(self, done: list[RunResult], failed: dict[str, BaseException]):
        super().__init__("; ".join(f"{domain}: {error}" for domain, error in failed.items()))
        self.done, self.failed = done, failed


def run_domains(
    spark: SparkSession, jobs: Sequence[tuple[DomainParams, Any]], mode: str | None = None,
    ingest_date: str | None = None, at_once: int = 4,
) -> list[RunResult]:
    """``run_domain`` for several ``(params, lexicon)``, a few at a time.

    The jobs share nothing but the code, so the last tasks of one domain and the
    first of the next run side by side. Each needs a table path of its own. All
    run to their end; if any failed, ``DomainsFailed`` has the results of the others.
    """
    paths = [params.lakehouse.path for params, _ in jobs]
    if len(set(paths)) < len(paths):
        raise ValueError("each table has one writer at a time; give every domain its own path")
    with ThreadPoolExecutor(at_once) as pool:
        runs = [
            pool.submit(run_domain, spark, params, mode, ingest_date, lexicon) for params, lexicon in jobs
        ]
    failed = {
        params.domain: run.exception() for (params, _), run in zip(jobs, runs, strict=True) if run.exception()
    }
    done = [run.result() for run in runs if not run.exception()]
    if failed:
        raise DomainsFailed(done, failed)
    return done


def run_report(spark: SparkSession, results: Iterable[RunResult]) -> DataFrame:
    """``(domain, task, metric, value)`` of finished runs; metrics a task lacks are left out."""
    lines = [
        (result.domain, result.task, metric, value)
        for result in results
        for metric, value in result.metrics().items()
    ]
    return spark.createDataFrame(lines, "domain string, task string, metric string, value double")

"""The job of a domain from a CSV file to a version of its table."""

import os
from dataclasses import replace

import pytest

from glyphmill.operators.contract import ContractViolation
from glyphmill.plans.domains import BANKING, EDUCATION, HEALTH
from glyphmill.plans.run import DomainsFailed, run_domain, run_domains, run_report, structure
from glyphmill.params import DomainParams, ModelParams, SourceParams, TableParams
from glyphmill.sources.versioned import read_profile, read_quarantine, read_table, table_history, table_metrics

# (line, label by the default word lists)
OPINIONS = [("Todo ordenado, lo recomiendo", "POS"), ("Cae la ganancia, riesgo", "NEG"), ("Hoy es jueves", "NEU"), ("Baja", "NEG")]
# (line, entities in it)
NOTES = [("aspirina y reposo", 1), ("sin hallazgos", 0), ("prurito, fatiga; toma naproxeno", 3)]


@pytest.fixture
def job(tmp_path):
    """A domain over a CSV file of the given lines, repeated."""

    def make(domain, lines, times=5, name=None):
        source = tmp_path / f"{name or domain.domain}.csv"
        rows = [f'{i},"{line}"' for i, line in enumerate(lines * times)]
        source.write_text("\n".join(["id,texto", *rows, ""]), encoding="utf-8")
        return domain.at(str(source), str(tmp_path / f"{name or domain.domain}-table"))

    return make


def stored_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


@pytest.mark.parametrize("domain", [EDUCATION, BANKING], ids=lambda d: d.domain)
def test_opinions(spark, job, domain):
    result = run_domain(spark, job(domain, [line for line, _ in OPINIONS]), mode="mock", ingest_date="2030-01-02")
    assert result.version == 0 and result.task == "sentiment"
    assert result.summary["label_counts"] == {"NEG": 10, "POS": 5, "NEU": 5}
    stored = {(r["text"], r["label"]) for r in read_table(spark, result.path).collect()}
    assert stored == set(OPINIONS)
    again = run_domain(spark, job(domain, ["Hoy"], times=3), mode="mock", ingest_date="2030-01-03")
    assert again.version == 1 and read_table(spark, again.path).count() == 23


def test_notes(spark, job):
    result = run_domain(spark, job(HEALTH, [line for line, _ in NOTES]), mode="mock", ingest_date="d")
    report = {r["metric"]: r["value"] for r in run_report(spark, [result]).collect()}
    assert report["n"] == 15 and report["total_entities"] == 20 and report["coverage"] == pytest.approx(2 / 3)
    assert set(report) == {"n", "mean_confidence", "pct_low_confidence", "coverage", "total_entities"}
    assert {(r["text"], r["n_entities"]) for r in read_table(spark, result.path).collect()} == set(NOTES)


def test_a_rejected_run_leaves_no_rows_and_no_files(spark, job):
    good = job(EDUCATION, [line for line, _ in OPINIONS])
    run_domain(spark, good, mode="mock", ingest_date="one")
    before = sorted(stored_files(good.lakehouse.path))
    strict = replace(good, model=replace(good.model, labels=("POS", "NEU")))
    with pytest.raises(ContractViolation) as error:
        run_domain(spark, strict, mode="mock", ingest_date="two")
    assert error.value.failures == [("label", "allowed", 10)]
    assert sorted(stored_files(good.lakehouse.path)) == before
    assert table_history(spark, good.lakehouse.path).count() == 1 and read_table(spark, good.lakehouse.path).count() == 20
    assert run_domain(spark, good, mode="mock", ingest_date="three").version == 1


def test_several_domains_and_one_that_fails(spark, job):
    lines = [line for line, _ in OPINIONS]
    jobs = [(job(domain, lines), None) for domain in (EDUCATION, BANKING)]
    assert [r.summary["n"] for r in run_domains(spark, jobs, mode="mock")] == [20, 20]
    with pytest.raises(ValueError, match="own path"):
        run_domains(spark, [jobs[0], jobs[0]], mode="mock")
    broken = job(BANKING, lines, name="broken")
    broken = replace(broken, model=replace(broken.model, labels=("POS",)))
    with pytest.raises(DomainsFailed) as error:
        run_domains(spark, [(broken, None), jobs[0]], mode="mock")
    assert [r.domain for r in error.value.done] == ["education"] and error.value.done[0].version == 1
    assert isinstance(error.value.failed["banking"], ContractViolation)


def test_a_missing_id_breaks_the_contract(spark, tmp_path):
    source = tmp_path / "rows.csv"
    source.write_text("id,texto\n,claro\n5,lento\n", encoding="utf-8")
    with pytest.raises(ContractViolation, match="id: not_null failed 1"):
        run_domain(spark, EDUCATION.at(str(source), str(tmp_path / "table")), mode="mock")


def test_a_file_without_rows(spark, job):
    result = run_domain(spark, job(HEALTH, []), mode="mock", ingest_date="d")
    assert result.summary == dict(n=0, mean_confidence=0.0, pct_low_confidence=0.0, coverage=0.0, total_entities=0)
    assert read_table(spark, result.path).count() == 0


def test_the_mode_decides_where_the_model_runs(corpus):
    for mode, python in (("hf", True), ("mock", False)):
        plan = structure(corpus(["a"]), BANKING, mode=mode)._jdf.queryExecution().executedPlan().toString()
        assert ("ArrowEvalPython" in plan) == python


def test_rows_that_break_the_contract_can_be_set_apart(spark, tmp_path):
    source = tmp_path / "in.parquet"
    spark.createDataFrame([("1", "bueno"), ("2", "malo"), ("3", None)], "id string, text string").coalesce(1).write.parquet(str(source))
    params = DomainParams(
        "bank", SourceParams(str(source), "text", "id"), ModelParams("sentiment", "m", labels=("POS", "NEU")),
        lakehouse=TableParams(str(tmp_path / "t")),
    )
    with pytest.raises(ContractViolation):
        run_domain(spark, params, "mock", "2030-01-01")
    result = run_domain(spark, params, "mock", "2030-01-01", quarantine=True, flag=True, profile=True)
    assert result.failures == (("label", "allowed", 1),) and result.version == 0
    assert result.summary["n"] == 2 and result.summary["label_counts"] == {"POS": 1, "NEU": 1}
    kept = read_table(spark, result.path)
    assert sorted(r["id"] for r in kept.collect()) == ["1", "3"] and "low_confidence" in kept.columns
    assert [(r["id"], r["label"]) for r in read_quarantine(spark, result.path).collect()] == [("2", "NEG")]
    assert read_profile(spark, result.path).agg({"n": "sum"}).first()[0] == 2
    found = {r["metric"]: r["value"] for r in table_metrics(spark, result.path).collect()}
    assert found == result.metrics()
    # without a failure nothing changes
    again = replace(params, model=ModelParams("sentiment", "m", labels=("POS", "NEU", "NEG")))
    second = run_domain(spark, again, "mock", "2030-01-02", quarantine=True, flag=True)
    assert second.failures == () and second.summary["n"] == 3 and read_table(spark, result.path).count() == 5

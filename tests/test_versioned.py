"""Versions of a table: what each shows, what a write may not do, what is left on storage."""

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from glyphmill.params import DomainParams, ModelParams, SourceParams, TableParams
from glyphmill.operators.drift import drift_profile
from glyphmill.sources.versioned import (
    commit_write,
    discard_write,
    expire_versions,
    read_profile,
    read_quarantine,
    read_staged,
    read_table,
    save_profile,
    stage_write,
    table_history,
    table_metrics,
    write_table,
)

SCHEMA = "id string, text string, label string, confidence double"


class Table:
    """A table in a folder of its own; each write is a few letters, one row each."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)

    def params(self, mode="append", domain="river", **table):
        return DomainParams(
            domain, SourceParams("-", "text"), ModelParams("sentiment", "m"), lakehouse=TableParams(self.path, mode=mode, **table)
        )

    def rows(self, letters):
        return self.spark.createDataFrame([(c, f"text {c}", "NEU" if c in "xyz" else "POS", 0.5) for c in letters], SCHEMA)

    def write(self, letters, day="2030-05-05", **how):
        return write_table(self.rows(letters), self.params(**how), day)

    def show(self, version=None):
        return "".join(sorted(r["id"] for r in read_table(self.spark, self.path, version).collect()))

    def files(self):
        return [f"{d}/{f}" for d, _, names in os.walk(self.path) for f in names if f.endswith(".parquet")]


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, tmp_path / "t")


def test_rows_come_back_with_string_partitions(spark, table):
    table.write("kx")
    back = read_table(spark, table.path)
    assert back.dtypes == [
        ("id", "string"), ("text", "string"), ("label", "string"), ("confidence", "double"),
        ("domain", "string"), ("ingest_date", "string"),
    ]
    assert sorted(map(tuple, back.collect())) == [
        ("k", "text k", "POS", 0.5, "river", "2030-05-05"), ("x", "text x", "NEU", 0.5, "river", "2030-05-05"),
    ]
    assert all("/domain=river/ingest_date=2030-05-05/" in f for f in table.files())


def test_versions_are_prefixes_since_the_last_overwrite(spark, table):
    steps = [("ab", "append"), ("c", "append"), ("x", "overwrite"), ("dy", "append"), ("", "append"), ("z", "overwrite")]
    for letters, mode in steps:
        table.write(letters, mode=mode)
    assert [table.show(v) for v in range(6)] == ["ab", "abc", "x", "dxy", "dxy", "z"]
    assert table.show() == "z"
    log = table_history(spark, table.path).collect()
    assert [(r["version"], r["n_rows"], r["mode"]) for r in log] == [(i, len(s), m) for i, (s, m) in enumerate(steps)]
    stamps = [r["committed_at"] for r in log]
    assert stamps == sorted(stamps) and None not in stamps


def test_any_partitioning_after_an_overwrite_keeps_all_versions_readable(spark, table):
    table.write("ax")
    table.write("by", mode="overwrite", partition_by=("label",))
    table.write("cz", partition_by=("label",))
    table.write("d", mode="overwrite", partition_by=("ingest_date",))
    assert [table.show(v) for v in range(4)] == ["ax", "by", "bcyz", "d"]
    assert read_table(spark, table.path, 2).where("label = 'NEU'").count() == 2


def test_an_append_must_fit_and_is_refused_before_anything_is_written(spark, table):
    table.write("a")
    before = sorted(table.files())
    with pytest.raises(ValueError, match="differs"):
        table.write("b", partition_by=("label",))
    with pytest.raises(ValueError, match="differs"):
        write_table(table.rows("b").withColumn("more", F.lit(1)), table.params(), "d")
    with pytest.raises(ValueError, match="planet"):
        table.write("b", partition_by=("planet",))
    assert sorted(table.files()) == before and table.show() == "a"
    write_table(table.rows("b").withColumn("more", F.lit(1)), table.params(mode="overwrite"), "d")
    assert "more" in read_table(spark, table.path).columns and "more" not in read_table(spark, table.path, 0).columns


def test_only_folders_of_visible_writes_are_listed(spark, table):
    table.write("a")
    table.write("b", mode="overwrite")
    table.write("c")
    stage_write(table.rows("lost"), table.params(), "d")  # never committed
    read = read_table(spark, table.path).inputFiles()
    roots = {f.split("write_id=")[1].split("/")[0] for f in read}
    everything = {f.split("write_id=")[1].split("/")[0] for f in table.files()}
    assert len(roots) == 2 and len(everything) == 4 and roots < everything
    plan = read_table(spark, table.path)._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(2 paths)" in plan


def test_staged_rows_show_when_committed_and_go_when_discarded(spark, table):
    table.write("a")
    one = stage_write(table.rows("b"), table.params(), "d")
    two = stage_write(table.rows("c"), table.params(), "d")
    assert table.show() == "a" and one.metrics["n_rows"] == 1
    commit_write(spark, one)
    with pytest.raises(Exception, match="(?i)exists"):
        commit_write(spark, two)  # another write was committed meanwhile
    discard_write(spark, two)
    assert table.show() == "ab" and not any(two.write_id in f for f in table.files())


def test_unknown_versions_and_tables(spark, table):
    with pytest.raises(ValueError, match="no committed version"):
        read_table(spark, table.path)
    table.write("a")
    with pytest.raises(ValueError, match="no version 1"):
        table.show(1)


def test_filters_prune_folders_and_the_date_defaults_to_today(spark, table):
    table.write("a", domain="north")
    write_table(table.rows("b"), table.params(domain="south"))
    found = read_table(spark, table.path).where("domain = 'south' AND ingest_date > '2020'")
    assert [r["id"] for r in found.collect()] == ["b"] and len(found.first()["ingest_date"]) == 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "domain" in pruned and "ingest_date" in pruned


def test_nested_rows(spark, table):
    kind = "id string, entities array<struct<text:string,type:string,start:int,end:int,score:double>>, n_entities int"
    frame = spark.createDataFrame([("n", [("mareo", "S", 2, 7, 0.75)], 1), ("m", [], 0)], kind)
    rows = {r["id"]: r["entities"] for r in read_table(spark, write_table(frame, table.params(), "d")).collect()}
    assert rows["m"] == [] and rows["n"][0].asDict() == {"text": "mareo", "type": "S", "start": 2, "end": 7, "score": 0.75}


def test_a_day_can_be_replaced(spark, table):
    one, two = "2030-05-05", "2030-05-06"
    table.write("ab", one)
    table.write("c", two)
    table.write("d", one)  # a second write of the same day
    table.write("xy", one, mode="overwrite_partition")
    table.write("k", one, mode="overwrite_partition", domain="lake")  # the same day of another domain
    table.write("z", two, mode="overwrite_partition")
    table.write("e", one)
    assert [table.show(v) for v in range(7)] == ["ab", "abc", "abcd", "cxy", "ckxy", "kxyz", "ekxyz"]
    days = {(r["domain"], r["ingest_date"], r["id"]) for r in read_table(spark, table.path).collect()}
    assert days == {("river", one, "x"), ("river", one, "y"), ("lake", one, "k"), ("river", two, "z"), ("river", one, "e")}
    assert [r["mode"] for r in table_history(spark, table.path).collect()].count("overwrite_partition") == 3


def test_a_day_can_be_replaced_whatever_the_partitioning(spark, table):
    table.write("ab", "2030-05-05", partition_by=())
    table.write("c", "2030-05-06", partition_by=())
    table.write("x", "2030-05-05", partition_by=(), mode="overwrite_partition")
    assert [table.show(v) for v in range(3)] == ["ab", "abc", "cx"]
    with pytest.raises(ValueError, match="schema"):
        write_table(table.rows("q").withColumn("more", F.lit(1)), table.params("overwrite_partition"), "2030-05-05")


def test_only_data_of_kept_versions_stays(spark, table):
    for letters, mode in (("ab", "append"), ("c", "append"), ("x", "overwrite"), ("d", "append"), ("e", "append")):
        table.write(letters, mode=mode)
    unfinished = stage_write(table.rows("q"), table.params(), "2030-05-05")
    reader = read_table(spark, table.path, 3)
    assert len(expire_versions(spark, table.path, keep_last=2)) == 2  # the unfinished write may still be going on
    assert (table.show(3), table.show(4), table.show(2)) == ("dx", "dex", "x") and reader.count() == 2
    for version in (0, 1):
        with pytest.raises(ValueError, match="removed"):
            table.show(version)
    assert table_history(spark, table.path).count() == 5
    assert expire_versions(spark, table.path, 2, unfinished_after=timedelta(0)) == [unfinished.write_id]
    assert expire_versions(spark, table.path, 2, unfinished_after=timedelta(0)) == []
    table.write("f")
    assert table.show() == "defx"
    with pytest.raises(ValueError, match="keep_last"):
        expire_versions(spark, table.path, 0)
    assert expire_versions(spark, table.path + "-none", 1) == []


def test_replaced_days_can_be_removed(spark, table):
    table.write("ab", "2030-05-05")
    table.write("c", "2030-05-06")
    table.write("x", "2030-05-05", mode="overwrite_partition")
    assert len(expire_versions(spark, table.path, keep_last=1)) == 1
    assert table.show() == "cx" and not any("/ab" in f for f in table.files())


def quarantined(table, letters, bad, day="2030-05-05"):
    mask = F.when(F.col("id").isin(list(bad)), F.lit(5)).otherwise(F.lit(0)).cast("bigint")
    staged = stage_write(table.rows(letters), table.params(), day, mask=mask)
    return staged, commit_write(table.spark, staged)


def test_rows_set_apart_are_not_read(spark, table):
    table.write("k")
    staged, version = quarantined(table, "abc", "b")
    assert (staged.metrics["n_rows"], staged.metrics["n_quarantined"], version) == (2, 1, 1)
    assert table.show() == "ack" and "broken_rules" not in read_table(spark, table.path).columns
    apart = read_quarantine(spark, table.path)
    assert [(r["id"], r["broken_rules"], r["ingest_date"]) for r in apart.collect()] == [("b", 5, "2030-05-05")]
    assert read_quarantine(spark, table.path, 0).count() == 0
    quarantined(table, "de", "de")
    quarantined(table, "f", "")
    assert table.show() == "acfk" and read_staged(spark, staged).count() == 2
    assert sorted(r["id"] for r in read_quarantine(spark, table.path).collect()) == ["b", "d", "e"]
    with pytest.raises(ValueError, match="quarantine"):
        stage_write(table.rows("a").withColumn("broken_rules", F.lit(1)), table.params(), mask=F.lit(0))


def test_all_rows_set_apart(spark, table):
    quarantined(table, "ab", "ab")
    assert table.show() == "" and read_quarantine(spark, table.path).count() == 2
    assert read_table(spark, table.path).columns == read_quarantine(spark, table.path).drop("broken_rules").columns


def test_metrics_and_profiles_of_versions(spark, table):
    for letters, day in (("ab", "2030-05-05"), ("xyz", "2030-05-06")):
        staged = stage_write(table.rows(letters), table.params(), day)
        save_profile(drift_profile(read_staged(spark, staged)), staged)
        commit_write(spark, staged, {"n": len(letters), "odd": float("nan")})
    found = {(r["version"], r["metric"]): r["value"] for r in table_metrics(spark, table.path).collect()}
    assert found[0, "n"] == 2.0 and found[1, "n"] == 3.0 and found[1, "odd"] != found[1, "odd"]
    counts = {(r["length"], r["label"]): r["n"] for r in read_profile(spark, table.path).collect()}
    assert counts == {(6, "POS"): 2, (6, "NEU"): 3}
    assert read_profile(spark, table.path, 0).count() == 1
    table.write("q")
    with pytest.raises(ValueError, match="no profile"):
        read_profile(spark, table.path)
    assert read_profile(spark, table.path, 1).count() == 2
    assert table_metrics(spark, table.path).where("version = 2").count() == 0

import hashlib

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from glyphmill.operators.inference import infer_batches
from glyphmill.params import SourceParams
from glyphmill.plans.catalog import QUERIES
from glyphmill.plans.oracle import ORACLE
from glyphmill.sources.corpus import normalize, read_raw, read_text


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def pairs(frame):
    return {row["id"]: row["text"] for row in frame.collect()}


def test_csv_is_normalised(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,texto,etiqueta_real\n1,Excelente curso,POS\n2,Muy desorganizado,NEG\n")
    frame = read_text(spark, SourceParams(path, "texto", "id"))
    assert frame.dtypes == [("id", "string"), ("text", "string")]
    assert pairs(frame) == {"1": "Excelente curso", "2": "Muy desorganizado"}


def test_csv_quoting(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        'id,texto\n1,"dijo ""hola"" y, salió"\n2,"dos\nlíneas"\n3,"fin \\"\n4,""\n5,\n006,007\n',
    )
    assert pairs(read_text(spark, SourceParams(path, "texto", "id"))) == {
        "1": 'dijo "hola" y, salió',
        "2": "dos\nlíneas",
        "3": "fin \\",
        "4": None,
        "5": None,
        "006": "007",
    }


def test_parquet_by_suffix(spark, tmp_path):
    path = str(tmp_path / "a.parquet")
    spark.createDataFrame([(7, "x", 1.5)], "k bigint, body string, other double").write.parquet(path)
    frame = read_text(spark, SourceParams(path, "body", "k"))
    assert pairs(frame) == {"7": "x"}
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:bigint,body:string>" in plan


@pytest.mark.parametrize("id_column", [None, "absent"])
def test_generated_ids(spark, tmp_path, id_column):
    path = write(tmp_path / "a.csv", "texto\nhola\nchao\nhola\n")
    rows = read_text(spark, SourceParams(path, "texto", id_column)).collect()
    assert len({row["id"] for row in rows}) == 3 and all(row["id"] is not None for row in rows)


def test_content_ids(spark, tmp_path):
    path = write(tmp_path / "a.csv", "texto,n\nhola,1\nhola,2\n,3\n")
    rows = read_text(spark, SourceParams(path, "texto"), id_strategy="content").collect()
    assert [r["id"] for r in rows] == [hashlib.sha256(t.encode()).hexdigest() for t in ("hola", "hola", "")]


def test_missing_text_column(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,cuerpo\n1,x\n")
    with pytest.raises(ValueError, match="texto.*a.csv.*id, cuerpo"):
        read_text(spark, SourceParams(path, "texto", "id"))
    with pytest.raises(ValueError, match="id_strategy"):
        read_text(spark, SourceParams(path, "cuerpo"), id_strategy="random")


def test_column_names_with_dots(spark):
    frame = spark.createDataFrame([(1, "x")], "`a.id` int, `a.text` string")
    assert pairs(normalize(frame, SourceParams("-", "a.text", "a.id"))) == {"1": "x"}


def test_reading_shuffles_only_on_request(spark, tmp_path):
    spark.range(400).selectExpr("id", "string(id) as text").write.parquet(str(tmp_path / "x.parquet"))
    for partitions in (None, 7):
        source = SourceParams(str(tmp_path / "x.parquet"), "text", "id", partitions=partitions)
        frame = infer_batches(read_text(spark, source), "sentiment", mode="mock")
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange" in plan) == (partitions is not None)
        assert frame.count() == 400
    with pytest.raises(ValueError, match="partitions"):
        SourceParams("x", "text", partitions=0)


def test_csv_without_line_breaks_is_split(spark, tmp_path):
    path = write(tmp_path / "large.csv", "id,text\n" + "".join(f'{i},"a, ""b"" {i}"\n' for i in range(30_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        whole, split = (read_raw(spark, path, multi_line=m) for m in (True, False))
        assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 3
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, split.collect()))
        assert whole.count() == 30_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_position_ids_are_stable_and_unique(spark, tmp_path):
    path = str(tmp_path / "day" / "raw.parquet")
    frame = spark.range(1000).selectExpr("CAST(id % 7 AS STRING) AS texto", "id % 2 AS part", "id AS n")
    frame.repartition(3).write.partitionBy("part").parquet(path)
    source = SourceParams(path, "texto")
    first = pairs(read_text(spark, source, id_strategy="position"))
    assert len(first) == 1000 and all(i.startswith("raw.parquet/part=") for i in first)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
        assert pairs(read_text(spark, source, id_strategy="position")) == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    dealt = SourceParams(path, "texto", partitions=5)
    assert pairs(read_text(spark, dealt, id_strategy="position")) == first


def test_position_ids_of_one_file_and_of_none(spark, tmp_path):
    path = str(tmp_path / "a.parquet")
    spark.createDataFrame([("x",), (None,), ("x",)], "texto string").coalesce(1).write.parquet(path)
    one = str(next((tmp_path / "a.parquet").glob("part-*.parquet")))
    ids = pairs(read_text(spark, SourceParams(one, "texto"), id_strategy="position"))
    name = one.rpartition("/")[2]
    assert ids == {f"{name}:0": "x", f"{name}:1": None, f"{name}:2": "x"}
    csv = write(tmp_path / "a.csv", "texto\nhola\n")
    with pytest.raises(ValueError, match="Parquet"):
        read_text(spark, SourceParams(csv, "texto"), id_strategy="position")


def test_table_positions_run_through_all_files(spark, tmp_path):
    path = tmp_path / "conversations.parquet"
    path.mkdir()
    for name, low, high in (("part-0001", 0, 900), ("part-0000", 900, 905), ("part-0010", 905, 905), ("part-0002", 905, 960)):
        pq.write_table(pa.table({"text": [f"t{i % 7}" for i in range(low, high)]}), path / f"{name}.parquet", row_group_size=100)
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
        wanted = dict(connection.execute(ORACLE["ingest_position_ids"]).fetchall())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in (before, "500b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            assert pairs(QUERIES["ingest_position_ids"](spark, str(tmp_path))) == wanted
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    dealt = SourceParams(str(path), "text", partitions=5)
    assert pairs(read_text(spark, dealt, id_strategy="table_position")) == wanted
    assert len(wanted) == 960
    csv = write(tmp_path / "a.csv", "texto\nhola\n")
    with pytest.raises(ValueError, match="Parquet"):
        read_text(spark, SourceParams(csv, "texto"), id_strategy="table_position")

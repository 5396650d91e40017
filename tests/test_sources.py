import datetime

import pyarrow as pa
import pyarrow.feather
import pytest
from pyspark.sql import functions as F

from millrace.operators import rows
from millrace.sources import feather, files

ROWS = [(1, "a", True), (2, "b", False), (3, "c", True)]


def test_csv_and_json_give_the_same_table(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,a,True\n2,b,False\n3,c,True\n")
    (tmp_path / "x.json").write_text('[[1, "a", true],\n [2, "b", false],\n [3, "c", true]]')
    csv = files.read_csv(spark, str(tmp_path / "x.csv"))
    json = files.read_json_rows(spark, str(tmp_path / "x.json"), ["int", "string", "boolean"])
    assert [tuple(r) for r in csv.orderBy("_c0").collect()] == ROWS == [tuple(r) for r in json.orderBy("_c0").collect()]
    assert [f.dataType.simpleString() for f in csv.schema] == ["int", "string", "boolean"]


def test_declared_csv_types_fail_fast(spark, tmp_path):
    (tmp_path / "x.csv").write_text("user_id,age\n1,25\n2,\n")
    (tmp_path / "bad.csv").write_text("user_id,age\n1,abc\n")
    schema = "user_id bigint, age tinyint"
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "x.csv"), schema, header=True).orderBy("user_id").collect()] == [(1, 25), (2, None)]
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "bad.csv"), schema, header=True).collect()


def test_dayfirst_dates(spark, tmp_path):
    (tmp_path / "x.csv").write_text("date,station_id,RR\n03-02-2020,96741,1.5\n")
    got = files.read_csv_dayfirst(spark, str(tmp_path / "x.csv"), "date date, station_id int, RR double").first()
    assert got["date"] == datetime.date(2020, 2, 3)


def test_feather_files_split_by_batch(spark, tmp_path, monkeypatch):
    for i in range(3):
        table = pa.table({"id": list(range(i * 100, i * 100 + 100)), "name": [f"n{j}" for j in range(100)]})
        pyarrow.feather.write_feather(table, str(tmp_path / f"part{i}.feather"), chunksize=10)
    monkeypatch.setattr(feather, "BATCHES_PER_TASK", 5)
    assert len(feather.FeatherReader(str(tmp_path), feather.FeatherSource({"path": str(tmp_path)}).schema()).partitions()) == 6
    df = feather.read_feather(spark, str(tmp_path))
    assert df.count() == 300 and df.agg(F.sum("id")).first()[0] == sum(range(300))
    assert df.schema.simpleString() == "struct<id:bigint,name:string>"


def test_parquet_and_csv_sinks_pass_the_table_on(spark, tmp_path):
    table = spark.createDataFrame(ROWS, "id int, name string, flag boolean")
    back = table.transform(files.save_parquet(str(tmp_path / "p"), partition_by=["flag"]))
    assert sorted(tuple(r) for r in back.select("id", "name", "flag").collect()) == ROWS
    assert table.transform(files.save_csv(str(tmp_path / "c"), drop=["flag"])).count() == 3
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["id", "name"]
    with pytest.raises(Exception, match="s3a|S3AFileSystem|No FileSystem"):
        table.transform(files.save_parquet("s3a://bucket/x"))


def test_declared_parquet_types(spark, tmp_path):
    spark.createDataFrame([(1.0, 5)], "a double, b bigint").write.parquet(str(tmp_path / "p"))
    assert files.read_parquet(spark, str(tmp_path / "p"), {"a": "bigint", "b": "tinyint"}).schema.simpleString() == "struct<a:bigint,b:tinyint>"


def test_chunks_are_bounded(spark):
    sizes = files.run_in_chunks(spark.range(0, 1000, 1, 2), lambda pdf: pdf.assign(n=len(pdf))[["n"]], "n bigint", rows=64)
    assert sizes.agg(F.max("n"), F.count("n")).first()[0] <= 64 and sizes.count() == 1000


def test_lenient_selection(spark):
    assert spark.range(1).transform(rows.select_existing(["id", "zzz"])).columns == ["id"]

import pytest
from pyspark.sql import types as T

from ledgerline.sources import csv_ingest as ci
from ledgerline.sources.engine import Engine
from ledgerline.sources.tables import read_text, write_text


def convert(spark, tmp_path):
    return ci.CsvToParquet(spark, str(tmp_path / "raw"), str(tmp_path / "out")).convert_all()


def test_nested_files(spark, tmp_path):
    (tmp_path / "raw/nested").mkdir(parents=True)
    (tmp_path / "raw/a.csv").write_text("id,v\n1,x\n")
    (tmp_path / "raw/nested/b.csv").write_text("id,v\n2,y\n")
    (tmp_path / "raw/ignore.txt").write_text("no")
    done = convert(spark, tmp_path)
    assert [x.split("/out/")[1] for x in done] == ["a.parquet", "nested/b.parquet"]
    assert spark.read.parquet(done[1]).collect()[0].v == "y"


def test_types_come_from_the_whole_file(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.csv").write_text("id,amt,day,flag\n" + "".join(f"{i},,2020-01-01,true\n" for i in range(300)) + "300,1234.5,2020-01-02,false\n")
    df = spark.read.parquet(convert(spark, tmp_path)[0])
    assert [f.dataType for f in df.schema] == [T.LongType(), T.DoubleType(), T.StringType(), T.StringType()]
    assert df.where("amt is null").count() == 300 and df.where("day = '2020-01-02'").count() == 1


def test_latin_1_and_bad_files(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.csv").write_bytes(b"id,name\n1,caf\xe9\n")
    (tmp_path / "raw/empty.csv").write_bytes(b"")
    (tmp_path / "raw/good.csv").write_text("id\n1\n")
    done = convert(spark, tmp_path)
    assert [x.split("/")[-1] for x in done] == ["a.parquet", "good.parquet"]
    assert spark.read.parquet(done[0]).first().name == "café"


def test_folders(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ci.discover(spark, str(tmp_path / "none"))
    (tmp_path / "raw").mkdir()
    assert convert(spark, tmp_path) == []


def test_schema_given(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a\n1\n")
    schema = T.StructType([T.StructField("a", T.StringType())])
    assert ci.read_csv(spark, str(tmp_path / "a.csv"), schema).first().a == "1"


def test_sizes_and_text(spark, tmp_path):
    assert [ci.human_size(n) for n in (1, 2048, 3 * 1024**2, 5 * 1024**4)] == ["1.00 B", "2.00 KB", "3.00 MB", "5120.00 GB"]
    write_text(spark, "a\nb é", f"{tmp_path}/x.txt")
    assert read_text(spark, f"{tmp_path}/x.txt") == "a\nb é"


def test_engine(spark, tmp_path):
    with Engine(spark=spark) as one:
        one.save("numbers", spark.range(3))
        assert one.query("select sum(id) as s from numbers").first().s == 3
        assert one.query("select count(*) as n from {t}", t=spark.range(4)).first().n == 4
    kept = Engine(str(tmp_path / "w"), spark)
    kept.save("numbers", spark.range(5))
    assert Engine(str(tmp_path / "w"), spark).table("numbers").count() == 5

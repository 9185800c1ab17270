"""A report load loses nothing untold: long records, open quotes, columns of later reports."""

import pytest
from pyspark.sql import functions as F

from revflow.plans.load import FurtherColumns, load_reports, read_reports
from revflow.sinks import versions as v

from test_sources import put, rows


@pytest.fixture
def delivered(tmp_path):
    put(tmp_path / "in/a/sheet.csv", "A,B\n1,2\n3,4,EXTRA\n5\n")
    put(tmp_path / "in/b/sheet.csv", 'C,A\n"two\nlines",7\n')
    put(tmp_path / "in/c/other.csv", 'X\n"open\n1\n')
    return str(tmp_path / "in")


def test_faulty_records_refuse_or_are_set_aside(spark, tmp_path, delivered):
    with pytest.raises(Exception, match="record longer than its header|quote not closed"):
        load_reports(spark, delivered, str(tmp_path / "s"), versioned=True)
    assert v.versions(spark, str(tmp_path / "s")) == []
    done = load_reports(spark, delivered, str(tmp_path / "s"), versioned=True, quarantine=str(tmp_path / "q"))
    aside = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "q"))
    assert {(r.table_name, r.reason, tuple(r.header), r.text) for r in aside.collect()} == {
        ("sheet", "record longer than its header", ("A", "B"), "3,4,EXTRA"), ("other", "quote not closed", ("X",), '"open\n1'),
    }
    assert done.set_aside == 2 and done.rows == {"sheet": 3, "other": 0} and done.version == 1
    told = {(d.table, d.report.split("/")[-2], d.missing, d.further) for d in done.columns}
    assert told == {("sheet", "b", ("b",), ("c",))}


def test_columns_of_later_reports(spark, tmp_path, delivered):
    options = {"quarantine": str(tmp_path / "q")}
    with pytest.raises(FurtherColumns, match="sheet has no place for c of "):
        read_reports(spark, delivered, further="refuse", **options)
    kept = read_reports(spark, delivered, further="keep", **options)
    table = kept.tables["sheet"].select("a", "b", "c")
    assert {tuple(str(x or "") for x in r) for r in rows(table)} == {("1", "2", ""), ("5", "", ""), ("7", "", "two\nlines")}
    assert {(d.report.split("/")[-2], d.missing, d.further) for d in kept.columns} == {("a", ("c",), ()), ("b", ("b",), ())}
    dropped = read_reports(spark, delivered, **options).tables["sheet"]
    assert dropped.columns == ["a", "b"]


def test_versioned_loads_check_columns_and_publish_one_version(spark, tmp_path):
    put(tmp_path / "one/sheet.csv", "A,B\n1,2\n")
    put(tmp_path / "two/sheet.csv", "A,B\n3,4\n5,6\n")
    put(tmp_path / "three/sheet.csv", "A\n3\n")
    store = str(tmp_path / "store")
    load_reports(spark, str(tmp_path / "one"), store, versioned=True)
    load_reports(spark, str(tmp_path / "two"), store, versioned=True)
    assert spark.table("sheet").agg(F.sum("a")).first()[0] == 8
    with pytest.raises(Exception, match="column"):
        load_reports(spark, str(tmp_path / "three"), store, versioned=True)
    assert v.open_version(spark, store).number == 2
    with pytest.raises(ValueError, match="versioned"):
        load_reports(spark, str(tmp_path / "one"), store, database="x", versioned=True)
    spark.catalog.dropTempView("sheet")

"""Histories of rows over extracts, and lookups that repeat or miss."""

import pytest
from pyspark.sql import functions as F

from revflow.operators.crosswalk import lookup_faults, payer_code_join
from revflow.operators.history import row_history, snapshot_changes


def test_states_of_rows(spark):
    rows = [
        ("t1", 1, "a"), ("t2", 1, "a"), ("t3", 1, "b"),  # changed
        ("t1", 2, None), ("t2", 2, None), ("t3", 2, None),  # never
        ("t1", 3, "x"), ("t3", 3, "x"),  # gone and back
        ("t2", 4, "n"),  # inserted and deleted
        ("t1", 5, None), ("t2", 5, ""), ("t3", 5, None),
    ]
    found = row_history(spark.createDataFrame(rows, "extracted_at string, id long, value string"), ["id"])
    assert found.columns == ["id", "value", "valid_from", "valid_to", "change"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted([
        (1, "a", "t1", "t3", "inserted"), (1, "b", "t3", None, "changed"), (2, None, "t1", None, "inserted"),
        (3, "x", "t1", "t2", "inserted"), (3, "x", "t3", None, "inserted"), (4, "n", "t2", "t3", "inserted"),
        (5, None, "t1", "t2", "inserted"), (5, "", "t2", "t3", "changed"), (5, None, "t3", None, "changed"),
    ], key=str)


def test_changes(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, v string")
    new = spark.createDataFrame([("a", 1), ("b", 2), ("d", 4)], "v string, id long")
    assert sorted(map(tuple, snapshot_changes(old, new, ["id"]).collect())) == [(2, "changed"), (3, "deleted"), (4, "inserted")]
    with pytest.raises(ValueError):
        snapshot_changes(old, new.withColumn("x", F.lit(1)), ["id"])


def test_lookups(spark):
    rows = spark.createDataFrame([(x,) for x in ("a", "a", "b", "c", None)], "payer string")
    codes = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("z", 9), ("z", 8)], "payer_name string, payer_code int")
    found = {tuple(r) for r in lookup_faults(rows, "payer", codes, "payer_name").collect()}
    assert found == {("a", "repeated", 2, 2, 2), ("c", "unmatched", 1, 0, 0), (None, "unmatched", 1, 0, 0)}
    with pytest.raises(Exception, match="the crosswalk lists a 2 times"):
        payer_code_join(rows, codes, "payer", repeated="refuse").collect()
    fine = payer_code_join(rows.filter("payer <> 'a'"), codes, "payer", repeated="refuse")
    assert sorted(map(tuple, fine.collect())) == [("b", 3), ("c", None)]
    assert payer_code_join(rows, codes, "payer").count() == 7


def test_rows_of_an_extract_are_not_dealt_to_one_task(spark):
    rows = spark.range(10).selectExpr("id", "'t' || id % 3 AS extracted_at", "'v' AS value")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the extracts are large
    try:
        plan = row_history(rows, ["id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan

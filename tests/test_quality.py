import pytest

from revflow.operators.quality import (
    RuleViolation,
    SchemaMismatch,
    differences,
    duplicate_keys,
    enforce,
    load_audit,
    audit_totals,
    quality_gate,
    registry_errors,
    require_schema,
    schema_check,
)

A, B, C = ("a", "bigint"), ("b", "text"), ("c", "date")


def kinds(expected, actual):
    return [(d[1], d[2], d[3]) for d in differences("t", expected, actual)]


def test_differences():
    assert kinds(None, [A]) == []
    assert kinds([A, B], [A, B]) == []
    assert kinds([A, B], [B, A]) == [("name_mismatch", 0, "a"), ("name_mismatch", 1, "b")]
    assert kinds([A, ("b", "date")], [A, B]) == [("type_mismatch", 1, "b")]
    assert kinds([A, B, C], [A, B]) == [("column_count", None, None), ("missing_column", None, "c")]
    assert kinds([A], [A, B]) == [("column_count", None, None), ("extra_column", None, "b")]


def test_schema_check_collects_all_tables(spark):
    df = spark.createDataFrame([(1, "x")], "a bigint, b string")
    found = schema_check(spark, {"t": df, "u": df, "absent": df}, {"t": [A], "u": [B, A]})
    assert {r.table_name for r in found.collect()} == {"t", "u"}


def test_require_schema(spark):
    df = spark.createDataFrame([(1,)], "a bigint")
    df.write.mode("overwrite").saveAsTable("strict_one")
    require_schema(spark, {"strict_one": df, "no_such_table": df})
    with pytest.raises(SchemaMismatch, match="type_mismatch"):
        require_schema(spark, {"strict_one": df.selectExpr("cast(a as string) as a")})


def test_quality_gate(spark):
    df = spark.createDataFrame(
        [(1, "abc", "12.30"), (1, "abcd", "1234567"), (2, None, "x"), (None, "", None)],
        "k int, t string, m string",
    )
    gate = quality_gate(
        df, key=["k"], not_null=["k", "t"], max_length={"t": 3}, decimals={"m": "decimal(5,2)"}
    )
    assert {(r.rule, r.column_name): r.violations for r in gate.collect()} == {
        ("not_null", "k"): 1,
        ("not_null", "t"): 1,
        ("max_length", "t"): 1,
        ("precision", "m"): 2,
        ("unique", "k"): 1,
    }
    with pytest.raises(RuleViolation):
        enforce(gate)
    assert [tuple(r) for r in duplicate_keys(df, ["k"]).collect()] == [(1, 2)]


def test_registry_errors(spark):
    instances = spark.createDataFrame(
        [
            ("ok", True, True, True, ["1"]),
            ("bad", None, False, True, []),
            ("none", True, True, False, None),
        ],
        "instance_key string, has_url boolean, has_user boolean, has_password boolean, "
        "accounts array<string>",
    )
    reports = spark.createDataFrame(
        [("ok", 1), ("ok", 2), ("bad", 1), ("bad", 1), ("bad", 1), ("none", None)],
        "instance_key string, report_id int",
    )
    found = {(r.instance_key, r.rule, r.detail, r.faults) for r in registry_errors(instances, reports).collect()}
    assert found == {
        ("bad", "missing_url", None, 1),
        ("bad", "missing_user", None, 1),
        ("bad", "missing_accounts", None, 1),
        ("none", "missing_password", None, 1),
        ("none", "missing_accounts", None, 1),
        ("bad", "duplicate_report_id", "1", 2),
        ("none", "missing_report_id", None, 1),
    }


def test_load_audit(spark):
    lines = spark.createDataFrame(
        [("a", "1|2"), ("a", "1"), ("a", " 1|2|3 "), ("a", ""), ("other", "1")],
        "table_name string, line string",
    )
    audit = load_audit(spark, lines, {"a": 2, "empty": 2, "gone": 2}, ["a", "empty"])
    assert {tuple(r) for r in audit.collect()} == {
        ("a", "loaded", 4, 3),
        ("empty", "empty", 0, 0),
        ("gone", "failed", 0, 0),
    }
    assert tuple(audit_totals(audit).first()) == (4, 3, 2, 1)

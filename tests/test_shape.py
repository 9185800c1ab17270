from revflow.functions.names import snake_name
from revflow.operators.shape import (
    LAYOUTS,
    Layout,
    blank_null_columns,
    conform_report,
    insert_column,
    reorder,
    tenant_columns,
    union_accounts,
    union_conform,
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_tenant_columns(spark):
    df = spark.createDataFrame([("x", "I1")], "v string, instance_key string")
    out = tenant_columns(df, "A1", df["instance_key"])
    assert out.columns == ["customer_account", "instance_key", "v"]
    assert rows(out) == [("A1", "I1", "x")]
    assert tenant_columns(df.select("v"), "A1").columns == ["customer_account", "v"]


def test_insert_needs_its_anchor(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert insert_column(df, "n", "a").columns == ["a", "n", "b"]
    assert insert_column(df, "b", "a").columns == ["a", "b"]
    assert insert_column(df, "n", "z").columns == ["a", "b"]


def test_reorder_keeps_rest_and_doubles(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    out = reorder(df, ["b", "zz", "c", "b"])
    assert out.columns == ["b", "c", "b_1", "a"]
    assert rows(out) == [(2, 3, 2, 1)]


def test_layouts(spark):
    assert {n: len(x.order) for n, x in LAYOUTS.items()} == {
        "payment_trend": 32,
        "user_time_spread": 10,
        "write_off_trend": 24,
    }
    df = spark.createDataFrame([("1", "2")], "`Payment Applied Amount` string, `Charge ID` string")
    assert conform_report(df, "payment_trend").columns == ["Charge ID"]
    assert conform_report(df, "ar_aging").columns == df.columns
    assert conform_report(df, Layout(drop=("Charge ID", "absent"))).columns == [
        "Payment Applied Amount"
    ]
    assert snake_name(LAYOUTS["write_off_trend"].order[17]) == "credit_source_w_o_payer"


def test_blank_null_columns(spark):
    df = spark.createDataFrame(
        [(1, None, None), (None, None, None)], "a int, b double, instance_key string"
    )
    out = blank_null_columns(df, keep=["instance_key"])
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "string", "string"]
    assert [(r.a, r.b, r.instance_key) for r in out.collect()] == [(1, "", None), (None, "", None)]


def test_union_accounts(spark):
    first = spark.createDataFrame([("1", "2")], "a string, b string")
    second = spark.createDataFrame([("3", "4", "5")], "b string, c string, a string")
    third = spark.createDataFrame([("6",)], "a string")
    assert set(rows(union_accounts([first, second]))) == {("1", "2"), ("5", "3")}
    by_position = union_accounts([first, second, third], by_position=True)
    assert set(map(tuple, by_position.collect())) == {("1", "2"), ("3", "4"), ("6", None)}


def test_union_conform(spark):
    first = spark.createDataFrame([(1, 2, "x")], "a bigint, b bigint, c string")
    second = spark.createDataFrame([(1.5, 9)], "b double, d int")
    out = union_conform([first, second])
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        ("a", "string"),
        ("b", "double"),
        ("c", "string"),
    ]
    assert rows(out) == [("", 1.5, ""), ("1", 2.0, "x")]

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from revflow import functions as fn


def values(spark, rows, kind, expression):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    out = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in out]


def test_money(spark):
    raw = ["$1,234.50", "0", "", None, "(5.00)", "$-3.10", "1e2"]
    assert values(spark, raw, "string", fn.money) == [
        Decimal("1234.50"), Decimal("0.00"), None, None, None, Decimal("-3.10"), Decimal("100.00"),
    ]
    assert values(spark, raw, "string", fn.money_rejected) == [
        False, False, True, False, True, False, False,
    ]


@pytest.mark.parametrize("bad", ["", "(5.00)"])
def test_strict_money_raises(spark, bad):
    with pytest.raises(Exception, match="not a number"):
        values(spark, [bad], "string", lambda c: fn.money(c, strict=True))
    assert values(spark, [None, "$1"], "string", lambda c: fn.money(c, strict=True)) == [
        None,
        Decimal("1.00"),
    ]


def test_strip_trailing_id(spark):
    raw = ["Doe, J (123)", "Doe (12) J", "Doe(1)", "(9)", "Doe (1a)", None]
    assert values(spark, raw, "string", fn.strip_trailing_id) == [
        "Doe, J", "Doe (12) J", "Doe", "", "Doe (1a)", None,
    ]


def test_trim_strips_all_white_space_and_blank_is_null(spark):
    raw = [" x ", "\t", "", " a b \n", None]
    assert values(spark, raw, "string", fn.trim_to_null) == ["x", None, None, "a b", None]


def test_na_words(spark):
    raw = ["", "NA", "N/A", "null", "None", "nan", "#N/A", "none", "x", None]
    assert values(spark, raw, "string", fn.na_to_null) == [None] * 7 + ["none", "x", None]


def test_date_labels(spark):
    days = [date(2024, 12, 30), date(2021, 1, 3), None]
    kind = "date"
    assert values(spark, days, kind, fn.iso_week_label) == ["Week01", "Week53", None]
    assert values(spark, days, kind, fn.year_text) == ["2024", "2021", None]
    assert values(spark, days, kind, fn.weekday_name) == ["monday   ", "sunday   ", None]
    assert values(spark, days, kind, lambda c: fn.weekday_name(c, True, True)) == [
        "Monday",
        "Sunday",
        None,
    ]
    assert values(spark, days, kind, fn.month_name) == ["December ", "January  ", None]
    assert values(spark, days, kind, fn.week_start) == [date(2024, 12, 29), date(2021, 1, 3), None]
    label = lambda c: fn.month_year_label(fn.month_name(c), fn.year_text(c))
    assert values(spark, days, kind, label) == ["December 2024", "January  2021", ""]


def test_labels_of_every_weekday_and_month(spark):
    days = [date(2024, m, d) for m in range(1, 13) for d in range(1, 8)]
    assert values(spark, days, "date", lambda c: fn.weekday_name(c, True)) == [
        d.strftime("%A").ljust(9) for d in days
    ]
    assert values(spark, days, "date", fn.month_name) == [d.strftime("%B").ljust(9) for d in days]
    assert values(spark, days, "date", fn.iso_week_label) == [
        f"Week{d.isocalendar().week:02d}" for d in days
    ]


def test_parse_date(spark):
    raw = ["1/5/2024", "01/05/2024", "2024-01-05", "02/30/2024", "", "x", None]
    day = date(2024, 1, 5)
    assert values(spark, raw, "string", fn.parse_date) == [day, day, day, None, None, None, None]
    with pytest.raises(Exception, match="not a date"):
        values(spark, ["02/30/2024"], "string", lambda c: fn.parse_date(c, strict=True))


def test_day_counts(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 10), date(2024, 1, 3)), (date(2024, 1, 1), None)], "a date, b date"
    )
    got = df.select(
        fn.days_on_hold(F.col("b"), F.lit("2024-01-04").cast("date")).alias("hold"),
        fn.charge_lag(F.col("a"), F.col("b")).alias("lag"),
        fn.posting_turnaround(F.col("b"), F.col("a")).alias("tat"),
    ).collect()
    assert [tuple(r) for r in got] == [(1, 7, -7), (None, None, None)]


def test_hold_age_bucket(spark):
    days = [-1, 5, 6, 10, 11, 14, 15, 21, 22, 30, 31, 45, 46, 60, 61, 90, 91, None]
    assert values(spark, days, "int", fn.hold_age_bucket) == [
        "0-5 days", "0-5 days", "6-10 days", "6-10 days", "11-14 days", "11-14 days",
        "15-21 days", "15-21 days", "22-30 days", "22-30 days", "31-45 days", "31-45 days",
        "46-60 days", "46-60 days", "61-90 days", "61-90 days", "over 90 days", None,
    ]


def test_statement_bucket(spark):
    few, mid, many, most = (
        "less than 3 statements", "3-4 statements", "5-6 statements", "over 6 statements",
    )
    counts = [0.0, 2.0, 3.0, 4.0, 4.5, 5.0, 6.0, 7.0, None]
    assert values(spark, counts, "double", fn.statement_bucket) == [
        few, few, mid, mid, None, many, many, most, None,
    ]


amounts = st.decimals(min_value=-(10**12), max_value=10**12, places=2)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(amounts, min_size=20, max_size=60))
def test_money_reads_back_what_was_printed(spark, numbers):
    printed = [f"${n:,.2f}" if i % 2 else f"{n:.2f}" for i, n in enumerate(numbers)]
    assert values(spark, printed, "string", fn.money) == numbers

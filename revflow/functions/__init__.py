"""Column-to-column functions; all of them stay inside JVM expressions."""

from revflow.functions.buckets import hold_age_bucket, statement_bucket
from revflow.functions.dates import (
    charge_lag,
    date_value,
    days_on_hold,
    iso_week_label,
    month_name,
    month_year_label,
    parse_date,
    posting_turnaround,
    week_start,
    weekday_name,
    year_text,
)
from revflow.functions.money import money, money_rejected, number
from revflow.functions.text import (
    blank_to_null,
    na_to_null,
    null_to_blank,
    strip_trailing_id,
    trim_all,
    trim_to_null,
)

__all__ = [
    "blank_to_null",
    "charge_lag",
    "date_value",
    "days_on_hold",
    "hold_age_bucket",
    "iso_week_label",
    "money",
    "money_rejected",
    "month_name",
    "month_year_label",
    "na_to_null",
    "null_to_blank",
    "number",
    "parse_date",
    "posting_turnaround",
    "statement_bucket",
    "strip_trailing_id",
    "trim_all",
    "trim_to_null",
    "week_start",
    "weekday_name",
    "year_text",
]

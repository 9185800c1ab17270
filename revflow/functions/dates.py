"""Date parsing, date labels and day counts.

Labels keep the trailing blanks of a nine-character field unless ``trim`` is
set. Names are looked up in a constant array, which costs far less per row
than a date formatter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

_DAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
_MONTHS = (
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
)
_WIDTH = 9
US_DATE = "M/d/yyyy"
# a whole day; a year or month alone, which a cast would take for its first day, is no date
_ISO_DAY = r"^\s*\d{4}-\d{1,2}-\d{1,2}([T ].*)?\s*$"


def _pick(names: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), index)


def parse_date(raw: Column, strict: bool = False) -> Column:
    """Text date, month first or ISO; unreadable text is NULL, or an error when strict.

    The form is told by its slashes: trying one form after the other would
    cost an exception per row.
    """
    parsed = F.when(raw.contains("/"), F.try_to_date(raw, US_DATE)).when(
        raw.rlike(_ISO_DAY), raw.try_cast("date")
    )
    if not strict:
        return parsed
    complaint = F.raise_error(F.concat(F.lit("not a date: "), raw))
    return F.when(raw.isNotNull() & parsed.isNull(), complaint).otherwise(parsed)


def date_value(df: DataFrame, name: str, strict: bool = False) -> Column:
    """The named column as a date, parsed only when it is text."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_date(F.col(name), strict)
    return F.col(name).cast("date")


def weekday_name(d: Column, capital: bool = False, trim: bool = False) -> Column:
    names = _DAYS if capital else [n.lower() for n in _DAYS]
    return _pick([n if trim else n.ljust(_WIDTH) for n in names], F.dayofweek(d) - 1)


def month_name(d: Column, trim: bool = False) -> Column:
    return _pick([n if trim else n.ljust(_WIDTH) for n in _MONTHS], F.month(d) - 1)


def iso_week_label(d: Column) -> Column:
    return _pick([f"Week{n:02d}" for n in range(1, 54)], F.weekofyear(d) - 1)


def year_text(d: Column) -> Column:
    """Calendar year, also beside an ISO week of the next or previous year."""
    return F.lpad(F.year(d).cast("string"), 4, "0")


def month_year_label(month: Column, year: Column) -> Column:
    """Both labels joined; an empty string when both are missing."""
    return F.concat_ws("", month, year)


def week_start(d: Column) -> Column:
    """The Sunday on or before the date."""
    return F.date_sub(d, F.dayofweek(d) - 1)


def days_on_hold(entered: Column, as_of: Column | None = None) -> Column:
    return F.datediff(F.current_date() if as_of is None else as_of, entered)


def charge_lag(first_billed: Column, entered: Column) -> Column:
    return F.datediff(first_billed, entered)


def posting_turnaround(received: Column, entered: Column) -> Column:
    return F.datediff(received, entered)

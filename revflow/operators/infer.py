"""Types of text columns, decided over all rows in one aggregate.

Every value is put into one class (missing, whole number, number, date,
text) as a bit, and a ``bit_or`` per column collects the classes seen. The
result is one small row per column, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from revflow.functions.dates import US_DATE
from revflow.operators.shape import ref

MISSING, WHOLE, NUMBER, DATE, TEXT = 1, 2, 4, 8, 16

# What counts as a number and as a date, and the reach of a
# nanosecond time stamp, beyond which a date stays text.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"
_DATE = r"^\d{1,2}/\d{1,2}/\d{4}\z"
_FIRST_DATE, _LAST_DATE = "1677-09-22", "2262-04-11"

TYPE_NAMES = {
    T.LongType(): "bigint",
    T.DoubleType(): "double precision",
    T.DateType(): "date",
}


def _class_of(c: Column) -> Column:
    """Class of a value. Cheap tests go first: plain text is told by its first
    character, a date by its slash, and only very long numbers are cast."""
    day = F.try_to_date(c, US_DATE)
    fraction = c.contains(".") | c.contains("e") | c.contains("E")
    whole = (F.length(c) < 19) | c.try_cast("bigint").isNotNull()
    return (
        F.when(c.isNull() | (c == ""), MISSING)
        .when(~F.ascii(c).between(ord("+"), ord("9")), TEXT)
        .when(
            c.contains("/"),
            F.when(
                c.rlike(_DATE) & day.between(F.lit(_FIRST_DATE), F.lit(_LAST_DATE)), DATE
            ).otherwise(TEXT),
        )
        .when(c.rlike(_NUMBER), F.when(~fraction & whole, WHOLE).otherwise(NUMBER))
        .otherwise(TEXT)
    )


def _column_masks(df: DataFrame, text: list[int]) -> DataFrame:
    """(position, mask) of every column; columns without rows or text have mask 0.

    The values of a row are taken one after the other, so that the work is
    one short loop however wide the frame is, and only one bit set per column
    and task is shuffled.
    """
    masks = df.sparkSession.range(len(df.columns)).select(
        F.col("id").cast("int").alias("position"), F.lit(0).alias("mask")
    )
    if text:
        values = F.array(*[ref(df.columns[i]) for i in text])
        cells = df.select(F.posexplode(values).alias("nth", "value"))
        position = F.get(F.array(*[F.lit(i) for i in text]), F.col("nth"))
        masks = masks.unionAll(cells.select(position, _class_of(F.col("value"))))
    return masks.groupBy("position").agg(F.bit_or("mask").alias("mask"))


def infer_structure(
    df: DataFrame,
    pinned: Sequence[str] = (),
    skip_date_names: bool = False,
    blank_double: bool = False,
) -> DataFrame:
    """(position, column_name, data_type, all_missing) of a frame, lazily.

    Columns that are not text keep their type (and have a NULL ``all_missing``).
    ``pinned`` columns stay text, so that codes keep their leading zeros. The
    CSV reader types plain numbers whatever their column is called;
    ``skip_date_names`` gives the later promotion step by itself, which passes
    over names with ``date``. ``blank_double`` makes whole numbers with
    missing values double.
    """
    fields = list(df.schema)
    text = [i for i, f in enumerate(fields) if isinstance(f.dataType, T.StringType)]
    return _decided(_column_masks(df, text), fields, text, pinned, skip_date_names, blank_double)


def infer_structure_by(
    df: DataFrame,
    by: str,
    pinned: Sequence[str] = (),
    skip_date_names: bool = False,
    blank_double: bool = False,
) -> DataFrame:
    """(by, position, column_name, data_type, all_missing) of the other columns, all text, for each value of ``by``."""
    rest = df.drop(by)
    fields, text = list(rest.schema), list(range(len(rest.columns)))
    values = F.array(*[ref(f.name) for f in fields])
    cells = df.select(by, F.posexplode(values).alias("position", "value"))
    masks = cells.select(by, "position", _class_of(F.col("value")).alias("mask"))
    masks = masks.groupBy(by, "position").agg(F.bit_or("mask").alias("mask"))
    return _decided(masks, fields, text, pinned, skip_date_names, blank_double, by)


def _decided(
    masks: DataFrame,
    fields: list[T.StructField],
    text: list[int],
    pinned: Sequence[str],
    skip_date_names: bool,
    blank_double: bool,
    *keep: str,
) -> DataFrame:
    """Type of every column from its mask."""
    position, mask = F.col("position"), F.col("mask")

    def of(values: list) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), position)

    fixed = [
        TYPE_NAMES.get(f.dataType, "text") if i not in text else "text" if f.name in pinned else None
        for i, f in enumerate(fields)
    ]
    numeric = of([not (skip_date_names and "date" in f.name.lower()) for f in fields])
    seen = mask.bitwiseAND(WHOLE | NUMBER | DATE | TEXT)
    whole = F.lit("bigint")
    if blank_double:
        whole = F.when(mask.bitwiseAND(MISSING) != 0, "double precision").otherwise(whole)
    inferred = (
        F.when(numeric & (seen == WHOLE), whole)
        .when(numeric & seen.isin(NUMBER, WHOLE | NUMBER), "double precision")
        .when(seen == DATE, "date")
        .otherwise("text")
    )
    return masks.select(
        *keep,
        "position",
        of([f.name for f in fields]).alias("column_name"),
        F.coalesce(of(fixed).cast("string"), inferred).alias("data_type"),
        F.when(of([i in text for i in range(len(fields))]), mask.isin(0, MISSING)).alias(
            "all_missing"
        ),
    )


def structure(df: DataFrame) -> list[tuple[str, str]]:
    """(name, type) pairs of an already typed frame."""
    return [(f.name, TYPE_NAMES.get(f.dataType, "text")) for f in df.schema]


def typed_column(c: Column, kind: str) -> Column:
    filled = F.nullif(c, F.lit(""))
    if kind == "bigint":
        return filled.try_cast("bigint")
    if kind == "double precision":
        return filled.try_cast("double")
    if kind == "date":
        return F.try_to_date(filled, US_DATE)
    return c


def promote(
    df: DataFrame,
    types: dict[str, str] | None = None,
    blank_missing: bool = False,
    **options,
) -> DataFrame:
    """The frame with its text columns typed.

    Without given types they are inferred first: one pass over the text and
    one fetched row per column, so at scale the text is read twice. The same
    pass tells columns without any value; ``blank_missing`` fills these with
    empty strings.
    """
    empty: set[str] = set()
    if types is None:
        found = infer_structure(df, **options).collect()
        types = {r.column_name: r.data_type for r in found}
        empty = {r.column_name for r in found if r.all_missing and blank_missing}

    def column(f: T.StructField) -> Column:
        if f.name in empty:
            return F.lit("").alias(f.name)
        if isinstance(f.dataType, T.StringType) and f.name in types:
            return typed_column(ref(f.name), types[f.name]).alias(f.name)
        return ref(f.name)

    return df.select(*[column(f) for f in df.schema])

"""Column clean-up, tenant columns, conforming to a target layout, unions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from revflow.functions.names import distinct_names
from revflow.functions.text import trim_to_null


def ref(name: str) -> Column:
    """Column by its literal name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def trim_blank_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text values without outer white space, blanks as NULL."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(
        *[
            trim_to_null(ref(f.name)).alias(f.name)
            if f.name in chosen and isinstance(f.dataType, T.StringType)
            else ref(f.name)
            for f in df.schema
        ]
    )


def tenant_columns(
    df: DataFrame, account: Column | str, instance: Column | str | None = None
) -> DataFrame:
    """Put ``customer_account`` and, if there are instances, ``instance_key`` in front."""

    def value(v: Column | str) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    front = [value(account).alias("customer_account")]
    if instance is not None:
        front.append(value(instance).alias("instance_key"))
    names = {"customer_account", "instance_key"}
    return df.select(*front, *[ref(c) for c in df.columns if c not in names])


def blank_null_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Columns without any value become text columns of empty strings.

    One aggregate over all columns decides; only its one row is fetched.
    """
    names = [c for c in df.columns if c not in keep]
    counts = df.agg(*[F.count(ref(c)).alias(str(i)) for i, c in enumerate(names)]).first()
    empty = {c for i, c in enumerate(names) if counts[i] == 0}
    return df.select(*[F.lit("").alias(c) if c in empty else ref(c) for c in df.columns])


# ---- conforming ---------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """How one delivered report is brought to the target layout."""

    order: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    # name -> (name of the column to follow, default)
    insert: dict[str, tuple[str, str]] = field(default_factory=dict)


# Target layouts of the reports that arrive in another shape.
LAYOUTS = {
    "payment_trend": Layout(
        drop=("Payment Applied Amount",),
        order=(
            "customer_account", "instance_key", "Practice Name", "Office Name",
            "Facility Name", "Charge Entered Date", "Charge First Bill Date",
            "Charge From Date", "Charge To Date", "Patient Full Name",
            "Payment Source", "Payment Allowed Amount", "Charge Patient ID",
            "Charge ID", "Claim ID", "Charge Rev Code", "Charge CPT Code",
            "Type of Bill", "Charge Primary Payer Name", "Primary Payer Member ID",
            "Charge Amount", "Insurance Paid Amount", "Payment Total Paid",
            "Payment Total Applied", "Charge Insurance Adjustments",
            "Charge Patient Adjustments", "Charge Total Adjustments",
            "Payment Received", "Payment Entered", "Insurance Applied Amount",
            "Patient Applied Amount", "Payment Unapplied Amount",
        ),
    ),
    "user_time_spread": Layout(
        drop=("Facility Name", "Office Name", "Audit ID"),
        order=(
            "customer_account", "instance_key", "Practice Name", "Audit Username",
            "Audit Action", "Audit Type", "Audit Entered Date", "Audit Entity ID",
            "Audit Patient ID", "Patient Full Name",
        ),
    ),
    "write_off_trend": Layout(
        insert={"Patient Credits": ("Patient Ins Credits", "")},
        order=(
            "customer_account", "instance_key", "Practice Name", "Facility Name",
            "Office Name", "Charge Entered Date", "Claim First Billed Date",
            "Charge From Date", "Charge To Date", "Patient Total Credits",
            "Payment Username", "Patient ID", "Charge ID", "Charge Claim ID",
            "Payment Received", "Payment Total Applied", "Patient Full Name",
            "Credit Source(w/o Payer)", "Adjustment Code(s)", "Patient Ins Credits",
            "Patient Credits", "Patient Total Credits", "Credit Payer Name",
            "Payment Payer ID",
        ),
    ),
}


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without the listed columns; absent ones do not matter."""
    return df.select(*[ref(c) for c in df.columns if c not in set(names)])


def insert_column(df: DataFrame, name: str, after: str, default: str = "") -> DataFrame:
    """Add a constant column behind ``after`` unless it exists or the anchor does not."""
    if name in df.columns or after not in df.columns:
        return df
    out = []
    for c in df.columns:
        out.append(ref(c))
        if c == after:
            out.append(F.lit(default).alias(name))
    return df.select(*out)


def reorder(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Listed columns first, the others after them in their own order.

    A name listed twice gives the column twice, the second one as ``name_1``.
    """
    listed = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in listed]
    names = distinct_names(listed + rest, joiner="_")
    return df.select(*[ref(c).alias(n) for c, n in zip(listed + rest, names)])


def conform_report(df: DataFrame, layout: Layout | str) -> DataFrame:
    """Drop, insert, reorder. A report without a layout stays as it is."""
    if isinstance(layout, str):
        layout = LAYOUTS.get(layout, Layout())
    df = drop_columns(df, layout.drop)
    for name, (after, default) in layout.insert.items():
        df = insert_column(df, name, after, default)
    return reorder(df, layout.order) if layout.order else df


# ---- unions -------------------------------------------------------------


def union_accounts(frames: Sequence[DataFrame], by_position: bool = False) -> DataFrame:
    """One report from several accounts under the first one's header.

    Aligned by name: a column some account lacks is NULL there, a column only
    later accounts have is dropped. By position: rows are cut or padded with
    NULL to the first one's width. Frames without columns do not count.
    """
    frames = [df for df in frames if df.columns]
    head = frames[0].columns

    def fit(df: DataFrame) -> DataFrame:
        if by_position:
            source = {name: df.columns[i] for i, name in enumerate(head) if i < len(df.columns)}
        else:
            source = {name: name for name in head if name in df.columns}
        return df.select(
            *[(ref(source[n]) if n in source else F.lit(None)).alias(n) for n in head]
        )

    return reduce(DataFrame.unionAll, [frames[0], *map(fit, frames[1:])])


def common_type_name(a: str, b: str) -> str:
    """The type in which two inferred types meet."""
    if a == b:
        return a
    return "double precision" if {a, b} == {"bigint", "double precision"} else "text"


def _common(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if {a, b} == {T.LongType(), T.DoubleType()}:
        return T.DoubleType()
    return T.StringType()


def union_conform(frames: Sequence[DataFrame]) -> DataFrame:
    """One table from several instances, as the first one shapes it.

    A column some instance lacks is an empty string there, further columns
    are dropped. Types meet: bigint and double as double, others as text.
    """
    schemas = [{f.name: f.dataType for f in df.schema} for df in frames]
    types = {
        name: reduce(_common, [s.get(name, T.StringType()) for s in schemas])
        for name in frames[0].columns
    }

    def fit(df: DataFrame, present: dict) -> DataFrame:
        return df.select(
            *[
                (ref(n).cast(kind) if n in present else F.lit("")).alias(n)
                for n, kind in types.items()
            ]
        )

    return reduce(DataFrame.unionAll, [fit(df, s) for df, s in zip(frames, schemas)])

"""Publishing: marts as views over loaded tables, and SQL scripts of the user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from revflow.operators.crosswalk import loc_crosswalk
from revflow.plans import marts


def register_marts(
    spark: SparkSession, as_of: Column | None = None, prefix: str = "", strict: bool = False
) -> list[str]:
    """Register a temporary view per mart whose tables exist; returns the names.

    Report tables are found by name. ``loc_crosswalk`` and
    ``payer_name_crosswalk`` are used where they exist; without the former
    the built-in one serves.
    """

    def table(name: str) -> DataFrame | None:
        full = prefix + name
        return spark.table(full) if spark.catalog.tableExists(full) else None

    codes, payers = table("loc_crosswalk"), table("payer_name_crosswalk")
    reports = {
        n: table(n) for n in ("ar_aging", "gross_billing", "payment_trend", "charges_on_hold")
    }
    views: dict[str, DataFrame] = {}
    if reports["ar_aging"] is not None and payers is not None:
        views["ar_aging_view"] = marts.ar_aging(reports["ar_aging"], payers, strict)
    if reports["gross_billing"] is not None:
        views["gross_billing_view"] = marts.gross_billing(
            reports["gross_billing"], codes, as_of, strict
        )
    if reports["payment_trend"] is not None:
        views["payment_trends_view"] = marts.payment_trends(
            reports["payment_trend"], codes, strict
        )
    if reports["charges_on_hold"] is not None:
        held = marts.charges_on_hold(reports["charges_on_hold"], strict)
        # Both names are in use, one of them misspelt.
        views["chage_on_hold"] = held
        views["v_charges_on_hold"] = held
    if codes is None:
        loc_crosswalk(spark).createOrReplaceTempView("loc_crosswalk")
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def statements(script: str) -> list[str]:
    """Statements of a script, split at ``;``; parts with nothing but comments go."""

    def has_code(part: str) -> bool:
        lines = (line.strip() for line in part.splitlines())
        return any(line and not line.startswith("--") for line in lines)

    return [part.strip() for part in script.split(";") if has_code(part)]


def run_sql_scripts(
    spark: SparkSession, folder: str, pattern: str = "*.sql", recursive: bool = False
) -> list[str]:
    """Run all matching files of a folder in the order of their names.

    With ``recursive`` also those of folders below it, in the order of their
    paths. The first failing statement ends the run. Returns the file names.
    """
    scripts = (
        spark.read.text(folder, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=recursive)
        .select(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_path").alias("path"), "value")
        .orderBy("path" if recursive else "name")
        .collect()
    )
    for script in scripts:
        for statement in statements(script["value"]):
            spark.sql(statement)
    return [script["name"] for script in scripts]

"""The flat-file load: one headerless ``|`` file per report table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from revflow.operators.quality import declared_lengths, load_audit
from revflow.plans.report_layouts import REPORT_KEYS, REPORT_LAYOUTS
from revflow.sinks.tables import full_refresh
from revflow.sources.reports import repair_ragged


def _lines(spark: SparkSession, path: str) -> DataFrame | None:
    """Lines of a file, or of all files of a folder of that name; None without one."""
    try:
        return spark.read.option("recursiveFileLookup", True).text(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def flat_report_tables(
    spark: SparkSession, folder: str, layouts: Mapping[str, T.StructType] = REPORT_LAYOUTS
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Frames of the tables whose file exists, and the audit of all tables.

    The file of a table is ``{table}.dat``. The audit is lazy and counts all
    tables in one pass over the lines.
    """
    found = {table: _lines(spark, f"{folder}/{table}.dat") for table in layouts}
    lines = {table: df for table, df in found.items() if df is not None}
    frames = {
        table: repair_ragged(df, layouts[table].fieldNames()).select(
            *[F.col(f.name).alias(f.name, metadata=f.metadata) for f in layouts[table]]
        )
        for table, df in lines.items()
    }
    marked = [
        df.select(F.lit(table).alias("table_name"), F.col("value").alias("line"))
        for table, df in lines.items()
    ]
    none = spark.createDataFrame([], "table_name string, line string")
    widths = {table: len(schema) for table, schema in layouts.items()}
    audit = load_audit(spark, reduce(DataFrame.unionAll, marked, none), widths, list(lines))
    return frames, audit


def load_flat_reports(
    spark: SparkSession,
    folder: str,
    store: str,
    layouts: Mapping[str, T.StructType] = REPORT_LAYOUTS,
    keys: Mapping[str, list[str]] = REPORT_KEYS,
    prefix: str = "",
    keep_absent: bool = False,
) -> DataFrame:
    """Replace the report tables by the files of a folder; returns the audit, counted while they are written.

    Text longer than declared or a repeated key refuses the whole load. Tables whose
    file is absent are emptied, unless ``keep_absent`` leaves them as they are.
    """
    found = {table: _lines(spark, f"{folder}/{table}.dat") for table in layouts}
    repairs = {table: Observation() for table, df in found.items() if df is not None}
    frames = {
        table: repair_ragged(found[table], layouts[table].fieldNames())
        .observe(seen, F.count_if("_adjusted").alias("adjusted"))
        .select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in layouts[table]])
        for table, seen in repairs.items()
    }
    if not keep_absent:
        frames |= {t: spark.createDataFrame([], layouts[t]) for t in layouts if t not in frames}
    rows = full_refresh(
        spark,
        {prefix + t: df for t, df in frames.items()},
        store,
        keys={prefix + t: k for t, k in keys.items()},
        rules={
            prefix + t: {"max_length": lengths}
            for t, df in frames.items()
            if (lengths := declared_lengths(df.schema))
        },
    )
    status = {t: "failed" if t not in repairs else "loaded" if rows[prefix + t] else "empty" for t in layouts}
    counted = [
        (t, status[t], rows.get(prefix + t, 0) if t in repairs else 0, repairs[t].get["adjusted"] if t in repairs else 0)
        for t in layouts
    ]
    return spark.createDataFrame(
        counted, "table_name string, status string, rows_loaded bigint, rows_adjusted bigint"
    )

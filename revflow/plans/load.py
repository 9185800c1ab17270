"""The report load: files below a root become typed, checked, published tables.

Whatever the number of files, the load runs one job that looks at all headers
and quotes, one that infers the types of all reports, and one write per
table. Files of one table with one header are read by one scan.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from revflow.functions.names import column_names, distinct_names, snake_name
from revflow.operators.infer import infer_structure_by, typed_column
from revflow.operators.shape import LAYOUTS, common_type_name, conform_report, ref
from revflow.plans.publish import register_marts
from revflow.sinks.tables import full_refresh, write_counted
from revflow.sinks.versions import publish, refresh_all
from revflow.sources.csv_records import FAULT, faults_of, is_refused, refusing, scan_with_faults
from revflow.sources.reports import csv_header, delivered_files, report_rows

_PATH = "_report_path"


class Loaded(NamedTuple):
    """What a load has done: the views it published, the rows of each table, what reports lacked or had beyond
    their table's columns, the records set aside, and the version of the store that it made, if it keeps versions."""

    views: list[str]
    rows: dict[str, int]
    columns: list[ReportColumns] = []
    set_aside: int = 0
    version: int | None = None


class ReportColumns(NamedTuple):
    """A report whose columns are not its table's: those it lacks, and those the table has no place for."""

    table: str
    report: str
    missing: tuple[str, ...]
    further: tuple[str, ...]


class FurtherColumns(RuntimeError):
    """Reports have columns that their tables would drop."""


def _cells(spark: SparkSession, line: str, path: str) -> tuple[str, ...]:
    """Header cells of a file; a header with a line break in it is read as a record."""
    if line.count('"') % 2:
        return tuple(csv_header(spark, path))
    return tuple(next(csv.reader([line]), ()))


def _layout_frames(
    spark: SparkSession, root: str, quarantine: str | None = None, pattern: str = "*.csv"
) -> tuple[dict[str, list[DataFrame]], int]:
    """Text frames per table, one per header (and way of reading), each row with its report's path.

    With a ``quarantine`` folder, records that do not fit their header are written there and counted.
    """
    groups: dict[tuple, list[str]] = {}
    for row in delivered_files(spark, root, pattern).orderBy("table_name", "report_path", "file_path").collect():
        path = unquote(row.file_path)
        key = (row.table_name, _cells(spark, row.header_line, path), row.open_quotes)
        groups.setdefault(key, []).append(path)
    frames: dict[str, list[DataFrame]] = {}
    faults: list[DataFrame] = []
    for (table, header, line_breaks), paths in groups.items():
        found = scan_with_faults(spark, paths, distinct_names(header), line_breaks)
        if quarantine is None:
            found = refusing(found, keep_path=True)
        else:
            own = faults_of(found)
            faults.append(own.select(F.lit(table).alias("table_name"), F.lit(list(header)).alias("header"), *own.columns))
            found = found.filter(~is_refused(F.col(FAULT)))
        df = report_rows(found, path_column=_PATH)
        if table in LAYOUTS:
            df = conform_report(df, table)
        names = [c for c in df.columns if c != _PATH]
        df = df.select(*[ref(c).alias(n) for c, n in zip(names, column_names(names))], _PATH)
        if "instance_key" in df.columns:  # stays text and comes second
            rest = [c for c in df.columns if c != "instance_key"]
            df = df.select(rest[0], "instance_key", *rest[1:])
        frames.setdefault(table, []).append(df)
    return frames, _set_aside(faults, quarantine) if faults else 0


def _set_aside(faults: list[DataFrame], quarantine: str) -> int:
    """Write the faulty records of all reports, each with its reason, header and fields; returns how many."""
    folder = f"{quarantine}/records-{uuid.uuid4().hex[:12]}"
    return write_counted(reduce(DataFrame.unionAll, faults), folder)


def _columns(found: dict[str, dict[str, tuple[str, bool]]], keep_further: bool) -> list[str]:
    """The columns of a table, from its reports in the order of their paths."""
    reports = sorted(found)
    return list(dict.fromkeys(c for report in (reports if keep_further else reports[:1]) for c in found[report]))


def _differing(table: str, found: dict[str, dict[str, tuple[str, bool]]], names: list[str]) -> list[ReportColumns]:
    out = []
    for report, columns in sorted(found.items()):
        missing, further = tuple(c for c in names if c not in columns), tuple(c for c in columns if c not in names)
        if missing or further:
            out.append(ReportColumns(table, report, missing, further))
    return out


def _conformed(
    frames: list[DataFrame], found: dict[str, dict[str, tuple[str, bool]]], keep_further: bool = False
) -> DataFrame:
    """One table from its frames. ``found`` has (type, all missing) per report and column.

    The report whose path comes first gives the columns: what others lack is an
    empty string there, what only they have is dropped, or with ``keep_further`` follows in the
    order of the reports. A column has the type on which all
    reports agree. As text it shows what was delivered, and an empty string for
    reports in which it has no value at all.
    """
    names = _columns(found, keep_further)
    kinds = {
        name: reduce(common_type_name, [report[name][0] if name in report else "text" for report in found.values()])
        for name in names
    }
    blank = {
        name: sorted(path for path, report in found.items() if name not in report or report[name][1]) for name in names
    }
    parts = []
    for df in frames:
        columns = []
        for name, kind in kinds.items():
            if name not in df.columns:
                value = F.lit("")
            elif kind != "text":
                value = typed_column(ref(name), kind)
            elif len(blank[name]) == len(found):
                value = F.lit("")
            elif blank[name]:
                value = F.when(F.col(_PATH).isin(blank[name]), "").otherwise(ref(name))
            else:
                value = ref(name)
            columns.append(value.alias(name))
        parts.append(df.select(*columns))
    return reduce(DataFrame.unionAll, parts)


class Reports(NamedTuple):
    """Typed frames per table, and what the reports lacked, had beyond them, or had set aside."""

    tables: dict[str, DataFrame]
    columns: list[ReportColumns]
    set_aside: int


def report_tables(
    spark: SparkSession, root: str, pinned: Sequence[str] = (), **options
) -> dict[str, DataFrame]:
    """All report files below a root, one frame per table; see ``read_reports``."""
    return read_reports(spark, root, pinned, **options).tables


def read_reports(
    spark: SparkSession,
    root: str,
    pinned: Sequence[str] = (),
    quarantine: str | None = None,
    further: str = "drop",
    pattern: str = "*.csv",
    **options,
) -> Reports:
    """All report files below a root, one frame per table.

    Records longer than their header, or whose quote is never closed, end the job that meets them, or go to the
    ``quarantine`` folder. ``further`` says what becomes of columns that only later reports have: "drop", "keep" or
    "refuse"; they are told in any case. ``pattern`` is that of the file names. The driver sees the list of files and one row per report and column.
    """
    frames, aside = _layout_frames(spark, root, quarantine, pattern)
    masks = [
        infer_structure_by(df, _PATH, pinned=(*pinned, "instance_key"), **options).select(F.lit(table).alias("table_name"), "*")
        for table, parts in frames.items()
        for df in parts
    ]
    found: dict[str, dict[str, dict[str, tuple[str, bool]]]] = {t: {} for t in frames}
    if masks:
        rows = reduce(DataFrame.unionAll, masks).orderBy("table_name", _PATH, "position").collect()
        for r in rows:
            report = found[r.table_name].setdefault(r[_PATH], {})
            kind, missing = r.data_type, bool(r.all_missing)
            if r.column_name in report:  # files of one report may differ in how they are read
                kind = common_type_name(report[r.column_name][0], kind) if not missing else report[r.column_name][0]
                missing = missing and report[r.column_name][1]
            report[r.column_name] = (kind, missing)
    out, differing = {}, []
    for table, parts in frames.items():
        if found[table]:
            out[table] = _conformed(parts, found[table], further == "keep")
            differing += _differing(table, found[table], out[table].columns)
        else:  # headers only
            names = [c for c in parts[0].columns if c != _PATH]
            out[table] = parts[0].select(*[F.lit("").alias(c) for c in names])
    dropped = [d for d in differing if d.further]
    if further == "refuse" and dropped:
        raise FurtherColumns("; ".join(f"{d.table} has no place for {', '.join(d.further)} of {d.report}" for d in dropped))
    return Reports(out, differing, aside)


def load_reports(
    spark: SparkSession,
    root: str,
    store: str,
    database: str | None = None,
    pinned: Sequence[str] = (),
    as_of: Column | None = None,
    partition_by: str | None = None,
    versioned: bool = False,
    **options,
) -> Loaded:
    """Read, type, conform, check, refresh and publish.

    Either all tables are replaced or none. ``partition_by`` names a column,
    such as the instance, by which tables that have it are stored. ``quarantine`` and ``further`` are those
    of ``read_reports``. With ``versioned`` the store is one of versions: all tables change by one
    commit, and the views, temporary ones of their tables included, show that version.
    """
    if versioned and database:
        raise ValueError("a versioned store has no database: its tables are found through its versions")
    prefix = f"{snake_name(database)}." if database else ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {snake_name(database)}")
    found = read_reports(spark, root, pinned, **options)
    if versioned:
        version = refresh_all(spark, store, found.tables, partition_by=partition_by, check_schema=True)
        publish(spark, version)
        rows = {t: version.tables[t].rows for t in found.tables}
        return Loaded(register_marts(spark, as_of), rows, found.columns, found.set_aside, version.number)
    rows = full_refresh(spark, {prefix + t: df for t, df in found.tables.items()}, store, partition_by=partition_by)
    return Loaded(register_marts(spark, as_of, prefix), rows, found.columns, found.set_aside)

"""The snapshot load: tab-delimited vendor tables into typed tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from revflow.operators.quality import declared_lengths
from revflow.sinks.tables import checked_rows, create_if_absent, insert, row_counts
from revflow.sinks.versions import Version, append_all
from revflow.sources.snapshots import SnapshotTable, scan_snapshot, snapshot_files


def snapshot_tables(
    spark: SparkSession, folder: str, catalogue: Mapping[str, SnapshotTable]
) -> dict[str, DataFrame]:
    """Typed frames of the catalogue's tables that have a file in the folder."""
    paths: dict[str, list[str]] = {}
    for row in snapshot_files(spark, folder).orderBy("table_name", "data_path").collect():
        paths.setdefault(row.table_name, []).append(row.data_path)
    return {
        name: scan_snapshot(spark, paths[name], table)
        for name, table in catalogue.items()
        if name in paths
    }


def load_snapshot(
    spark: SparkSession,
    folder: str,
    catalogue: Mapping[str, SnapshotTable],
    store: str,
    prefix: str = "",
) -> DataFrame:
    """Append a snapshot to its tables, creating absent ones; returns row counts.

    Every table is parsed once, into a staging folder, and checked there. A key
    that is there already, or text longer than declared, refuses the whole
    snapshot: no table gets rows before all have passed.
    """
    passed = {}
    for name, df in snapshot_tables(spark, folder, catalogue).items():
        table, key = prefix + name.lower(), catalogue[name].key
        create_if_absent(spark, table, df, store)
        lengths = declared_lengths(catalogue[name].schema)
        rules = {"max_length": lengths} if lengths else {}
        passed[table] = checked_rows(spark, table, df, [key] if key else [], staging=store, **rules)
    for table, df in passed.items():
        insert(spark, table, df)
    return row_counts(spark, list(passed))


def append_snapshot(
    spark: SparkSession, folder: str, catalogue: Mapping[str, SnapshotTable], store: str
) -> Version:
    """Append a snapshot to the tables of a versioned store: all of them by one commit, or none.

    The rules are those of ``load_snapshot``.
    """
    frames = {name.lower(): df for name, df in snapshot_tables(spark, folder, catalogue).items()}
    tables = {name.lower(): table for name, table in catalogue.items()}
    keys = {t: [tables[t].key] for t in frames if tables[t].key}
    lengths = {t: declared_lengths(tables[t].schema) for t in frames}
    return append_all(spark, store, frames, keys, {t: {"max_length": n} for t, n in lengths.items() if n})

"""Stored tables: full refresh, guarded append, create if absent, drop.

A table is a catalogue entry over a Parquet folder. A refresh writes every
table to a new folder, checks all of them, and only then points the entries
to the new folders; readers see the old data or the new, and a failed load
changes nothing. Nothing is overwritten while a plan may read it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from revflow.operators.quality import enforce, quality_gate, require_schema
from revflow.operators.shape import ref


def _columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _location(root: str, table: str, load: str) -> str:
    return f"{root}/{table.replace('.', '/')}/{load}"


def create_if_absent(spark: SparkSession, table: str, df: DataFrame, root: str) -> None:
    """Create an empty table with the frame's columns unless it exists."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({_columns_ddl(df.schema)}) USING parquet "
        f"LOCATION '{_location(root, table, 'empty-' + uuid.uuid4().hex[:8])}'"
    )


def write_counted(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Write and return the number of rows, counted on their way."""
    seen = Observation()
    writer = df
    if partition_by is not None:
        writer = df.hint("rebalance", partition_by)
    writer = writer.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def full_refresh(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    root: str,
    keys: Mapping[str, Sequence[str]] | None = None,
    rules: Mapping[str, Mapping] | None = None,
    check_schema: bool = True,
    partition_by: str | None = None,
) -> dict[str, int]:
    """Replace the contents of all tables, or of none. Returns rows per table.

    ``keys`` names primary keys, ``rules`` further arguments of the quality
    gate per table. Both are checked on the staged data, so that a frame is
    computed once and a check reads only its columns. Tables that are not in
    ``frames`` are not touched. A partition column comes last, in the table too.
    If pointing the entries fails midway, those already moved are pointed back.
    """
    if partition_by is not None:
        frames = {
            table: df.select(*[ref(c) for c in df.columns if c != partition_by], ref(partition_by))
            if partition_by in df.columns
            else df
            for table, df in frames.items()
        }
    if check_schema:
        require_schema(spark, frames)
    load = f"load-{uuid.uuid4().hex[:12]}"
    staged, rows = {}, {}
    for table, df in frames.items():
        part = partition_by if partition_by in df.columns else None
        staged[table] = _location(root, table, load)
        rows[table] = write_counted(df, staged[table], part)
        gate = dict((rules or {}).get(table, {}))
        key = (keys or {}).get(table)
        if key:
            gate |= {"key": key, "not_null": [*key, *gate.get("not_null", [])]}
        if gate:
            enforce(quality_gate(spark.read.parquet(staged[table]), **gate))
    before = {table: _place(spark, table) for table in frames}
    moved = []
    try:
        for table, df in frames.items():
            moved.append(table)
            _point(spark, table, df.schema, staged[table], partition_by if partition_by in df.columns else None)
    except Exception:
        for table in moved:
            if before[table] is None:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            else:
                _point(spark, table, *before[table])
        raise
    return rows


def superseded_folders(spark: SparkSession, root: str, tables: Sequence[str]) -> DataFrame:
    """(table_name, folder, files, bytes) of earlier loads below ``root`` that no entry of the tables points to.

    Loads leave these for readers that have begun; a clean-up may remove them
    once such readers have ended. Only the file listing is used.
    """
    current = [place[1].rstrip("/") for t in tables if (place := _place(spark, t)) is not None]
    folder = F.regexp_extract("path", r"^(.*/load-[0-9a-f]{12})/", 1)
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load([_location(root, t, "") for t in tables])
        .select(folder.alias("folder"), "length")
    )
    return (
        found.filter((F.col("folder") != "") & ~F.col("folder").isin(current))
        .groupBy("folder")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        .select(F.regexp_extract("folder", r"([^/]+)/[^/]+$", 1).alias("table_name"), "folder", "files", "bytes")
    )


def _place(spark: SparkSession, table: str) -> tuple[T.StructType, str, str | None] | None:
    """Schema, folder and partition column of a stored table; None without one."""
    if not spark.catalog.tableExists(table):
        return None
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    return spark.table(table).schema, described["Location"], parts[0] if parts else None


def _point(
    spark: SparkSession, table: str, schema: T.StructType, path: str, partition_by: str | None
) -> None:
    same = spark.catalog.tableExists(table) and [
        (f.name, f.dataType) for f in spark.table(table).schema
    ] == [(f.name, f.dataType) for f in schema]
    if same and partition_by is None:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        parts = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
        spark.sql(
            f"CREATE TABLE {table} ({_columns_ddl(schema)}) USING parquet {parts} LOCATION '{path}'"
        )
        if partition_by:
            spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)


def append_unique(
    spark: SparkSession,
    table: str,
    df: DataFrame,
    key: Sequence[str],
    staging: str | None = None,
    **rules,
) -> None:
    """Append rows to an existing table; a repeated key refuses the load.

    The key must be new to the table and occur once in the frame. Both are
    checked before a row reaches the table. With a staging folder the frame
    is computed once, into that folder, and the checks read only their
    columns there. ``rules`` are further arguments of the quality gate.
    """
    insert(spark, table, checked_rows(spark, table, df, key, staging, **rules))


def checked_rows(
    spark: SparkSession, table: str, df: DataFrame, key: Sequence[str], staging: str | None = None, **rules
) -> DataFrame:
    """The rows to append, staged if there is a folder for it; raises if the table must not take them."""
    if staging is not None:
        path = f"{staging}/append-{uuid.uuid4().hex[:12]}"
        write_counted(df, path)
        df = spark.read.schema(df.schema).parquet(path)
    if key:
        rules |= {"key": key, "not_null": [*key, *rules.get("not_null", [])]}
    if rules:
        enforce(quality_gate(df, **rules))
    if key:
        known = spark.table(table).select(*[ref(c) for c in key])
        clash = df.select(*[ref(c) for c in key]).join(known, list(key), "left_semi")
        counted = clash.agg(F.count("*").alias("violations")).select(
            F.lit("unique").alias("rule"), F.lit(",".join(key)).alias("column_name"), "violations"
        )
        enforce(counted)
    return df


def insert(spark: SparkSession, table: str, df: DataFrame) -> None:
    df.select(*[ref(c) for c in spark.table(table).columns]).write.insertInto(table)


def new_rows(df: DataFrame, table: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key the table does not hold, for a load that may be repeated."""
    return df.join(table.select(*[ref(c) for c in key]), list(key), "left_anti")


def drop_tables(spark: SparkSession, tables: Iterable[str]) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def row_counts(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """(table_name, rows) of stored tables."""
    counts = [
        spark.table(t).agg(F.lit(t).alias("table_name"), F.count("*").alias("rows"))
        for t in tables
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionAll(c)
    return out

"""Stores of many tables that change by one commit.

A version of a store is a manifest: for each table its columns and the folders
that hold its rows. A load writes its rows to new folders, checks all of
them, writes the manifest of the next version beside the others, and gives it
its number by renaming its folder, which the file system does as a whole or not at
all. So a load that fails anywhere leaves every reader on the version before it, and a
reader that has opened a version keeps it while later ones are made.

Of two loads that began on one version the one that renames first wins; the
other is refused and may be repeated. A store without a version has no tables.
The file system must refuse to rename onto an existing folder, as HDFS and
local ones do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from revflow.operators.quality import SchemaMismatch, differences, enforce, quality_gate, structure
from revflow.operators.shape import ref
from revflow.sinks.tables import write_counted

_MANIFEST = "table_name string, columns string, partition_by string, position int, folder string, rows long"


class ConcurrentCommit(RuntimeError):
    """Another load has made the next version first."""


class Entry(NamedTuple):
    """A table of a version: its columns, partition column, and folders with their rows."""

    columns: T.StructType
    partition_by: str | None
    folders: tuple[tuple[str, int], ...]

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.folders)


class Version(NamedTuple):
    number: int
    tables: dict[str, Entry]


# ---- manifests ----------------------------------------------------------


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder as a whole; raises if the target is there."""
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    place = fs.Path(source)
    uri = place.getFileSystem(conf).makeQualified(place).toUri()
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)  # none: no overwriting
    fs.FileContext.getFileContext(uri, conf).rename(place, fs.Path(target), options)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all versions of a store, rising."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/versions")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    names = [s.getPath().getName() for s in system.listStatus(place)]
    return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())


def open_version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest version of a store, or the one of a number. Reads one manifest: a row per table and folder."""
    if number is None:
        number = max(versions(spark, root), default=0)
    if number == 0:
        return Version(0, {})
    rows = spark.read.schema(_MANIFEST).json(f"{root}/versions/v{number:012d}").orderBy("table_name", "position").collect()
    tables: dict[str, Entry] = {}
    for r in rows:
        entry = tables.get(r.table_name) or Entry(T.StructType.fromJson(json.loads(r.columns)), r.partition_by, ())
        tables[r.table_name] = entry._replace(folders=(*entry.folders, *([(r.folder, r.rows)] if r.folder else [])))
    return Version(number, tables)


def commit(
    spark: SparkSession, root: str, base: Version, changes: Mapping[str, Entry], dropped: Iterable[str] = ()
) -> Version:
    """Make the next version: ``base`` with some tables replaced, added or dropped."""
    gone = set(dropped)
    tables = {t: e for t, e in base.tables.items() if t not in gone} | dict(changes)
    number = base.number + 1
    rows = [
        (table, entry.columns.json(), entry.partition_by, i, folder, n)
        for table, entry in tables.items()
        for i, (folder, n) in enumerate(entry.folders or ((None, 0),))
    ]
    waiting = f"{root}/versions/_waiting-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.json(waiting)
    try:
        _rename(spark, waiting, f"{root}/versions/v{number:012d}")
    except Exception as error:
        if number in versions(spark, root):
            raise ConcurrentCommit(f"version {number} of {root} has been made by another load") from error
        raise
    return Version(number, tables)


def history(spark: SparkSession, root: str) -> DataFrame:
    """(version, table_name, folders, rows) of all versions of a store."""
    numbers = versions(spark, root)
    if not numbers:
        return spark.createDataFrame([], "version long, table_name string, folders long, rows long")
    found = spark.read.schema(_MANIFEST).json([f"{root}/versions/v{n:012d}" for n in numbers])
    version = F.regexp_extract(F.col("_metadata.file_path"), r"/v(\d{12})/", 1).cast("long")
    return (
        found.select(version.alias("version"), "table_name", "folder", "rows")
        .groupBy("version", "table_name")
        .agg(F.count("folder").alias("folders"), F.sum("rows").alias("rows"))
    )


# ---- readers ------------------------------------------------------------


def table_of_version(spark: SparkSession, entry: Entry) -> DataFrame:
    """The rows of a table as one version has them, whatever has been loaded since."""
    if not entry.folders:
        return spark.createDataFrame([], entry.columns)
    names = [ref(f.name) for f in entry.columns]
    reader = spark.read.schema(entry.columns)
    if entry.partition_by is None:
        return reader.parquet(*[folder for folder, _ in entry.folders]).select(*names)
    return reduce(DataFrame.unionAll, [reader.parquet(folder).select(*names) for folder, _ in entry.folders])


def publish(spark: SparkSession, version: Version, prefix: str = "") -> list[str]:
    """Temporary views of all tables of one version, under their names."""
    for table, entry in version.tables.items():
        table_of_version(spark, entry).createOrReplaceTempView(prefix + table)
    return sorted(prefix + t for t in version.tables)


# ---- loads --------------------------------------------------------------


def _staged(
    spark: SparkSession,
    root: str,
    frames: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    rules: Mapping[str, Mapping],
    partition_by: str | None,
) -> dict[str, Entry]:
    """Write all frames to new folders and check each there; nothing refers to them yet."""
    load = f"load-{uuid.uuid4().hex[:12]}"
    staged = {}
    for table, df in frames.items():
        part = partition_by if partition_by in df.columns else None
        if part is not None:
            df = df.select(*[ref(c) for c in df.columns if c != part], ref(part))
        folder = f"{root}/{table.replace('.', '/')}/{load}"
        entry = Entry(df.schema, part, ((folder, write_counted(df, folder, part)),))
        key, gate = list(keys.get(table, ())), dict(rules.get(table, {}))
        if key:
            gate |= {"key": key, "not_null": [*key, *gate.get("not_null", [])]}
        if gate:
            enforce(quality_gate(table_of_version(spark, entry), **gate))
        staged[table] = entry
    return staged


def refresh_all(
    spark: SparkSession,
    root: str,
    frames: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]] | None = None,
    rules: Mapping[str, Mapping] | None = None,
    partition_by: str | None = None,
    check_schema: bool = False,
) -> Version:
    """Replace the tables by the frames, all in one version; other tables stay. Frames may read the store itself.

    With ``check_schema`` a frame whose columns differ from those its table has in the version before refuses all.
    """
    base = open_version(spark, root)
    if check_schema:
        rows = []
        for table, df in frames.items():
            if table in base.tables:
                last = [c for c in df.columns if c == partition_by]
                df = df.select(*[ref(c) for c in df.columns if c not in last], *[ref(c) for c in last])
                rows += differences(table, [(f.name, f.dataType.simpleString()) for f in base.tables[table].columns], structure(df))
        if rows:
            raise SchemaMismatch("\n".join(str(r) for r in rows))
    return commit(spark, root, base, _staged(spark, root, frames, keys or {}, rules or {}, partition_by))


def append_all(
    spark: SparkSession,
    root: str,
    frames: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]] | None = None,
    rules: Mapping[str, Mapping] | None = None,
) -> Version:
    """Add the rows of all frames to their tables, in one version; absent tables are made.

    A key that its table has already, or has twice in the frame, refuses all of them, and so
    do columns other than the table's.
    """
    keys, base = keys or {}, open_version(spark, root)
    for table, df in frames.items():
        known = base.tables.get(table)
        if known and {f.name: f.dataType for f in known.columns} != {f.name: f.dataType for f in df.schema}:
            raise ValueError(f"{table}: the rows have other columns than the table")
    aligned = {
        t: df.select(*[ref(f.name) for f in base.tables[t].columns]) if t in base.tables else df for t, df in frames.items()
    }
    parts = {base.tables[t].partition_by for t in frames if t in base.tables}
    if len(parts) > 1:
        raise ValueError("tables that are appended together are partitioned in one way")
    staged = _staged(spark, root, aligned, keys, rules or {}, next(iter(parts), None))
    changes = {}
    for table, entry in staged.items():
        known = base.tables.get(table)
        if known is None:
            changes[table] = entry
            continue
        key = list(keys.get(table, ()))
        if key:
            fresh = table_of_version(spark, entry).select(*[ref(c) for c in key])
            old = table_of_version(spark, known).select(*[ref(c) for c in key])
            clash = fresh.join(old, key, "left_semi").agg(F.count("*").alias("violations"))
            enforce(clash.select(F.lit("unique").alias("rule"), F.lit(",".join(key)).alias("column_name"), "violations"))
        changes[table] = known._replace(folders=(*known.folders, *entry.folders))
    return commit(spark, root, base, changes)


def unused_folders(spark: SparkSession, root: str, since: int) -> DataFrame:
    """(folder, files, bytes) below a store that no version from ``since`` on refers to.

    They belong to older versions or to loads that were refused; a clean-up may remove them once no load
    and no reader of an older version is at work. Only the file listing is used.
    """
    folder = F.regexp_extract("path", r"^(.*/load-[0-9a-f]{12})/", 1)
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(root)
        .select(folder.alias("folder"), "length").filter("folder <> ''")
        .groupBy("folder").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )
    numbers = [n for n in versions(spark, root) if n >= since]
    used = spark.createDataFrame([], "folder string")
    if numbers:
        used = spark.read.schema(_MANIFEST).json([f"{root}/versions/v{n:012d}" for n in numbers]).select("folder").distinct()
    # listed paths begin with the scheme, given ones may not
    bare = F.regexp_replace("folder", r"^[a-z0-9]+:(//[^/]*)?", "")
    return listed.withColumn("bare", bare).join(used.select(bare.alias("bare")), "bare", "left_anti").drop("bare")

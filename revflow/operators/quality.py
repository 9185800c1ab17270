"""Schema checks, data rules, registry rules, profiles and load audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from revflow.functions.text import trim_all
from revflow.operators.infer import structure
from revflow.operators.shape import ref

Structure = list[tuple[str, str]]

_DIFFERENCE = (
    "table_name string, kind string, position int, "
    "column_name string, expected string, actual string"
)


# ---- strict schema check ------------------------------------------------


def table_structure(spark: SparkSession, table: str) -> Structure | None:
    """(name, type) pairs of a stored table in order; None when it is absent."""
    if not spark.catalog.tableExists(table):
        return None
    return structure(spark.table(table))


def differences(table: str, expected: Structure | None, actual: Structure) -> list[tuple]:
    """All ways in which two structures differ; an absent table differs in none."""
    if expected is None or expected == actual:
        return []
    found = []
    if len(expected) != len(actual):
        found.append((table, "column_count", None, None, str(len(expected)), str(len(actual))))
    wanted, given = dict(expected), dict(actual)
    for name in sorted(wanted.keys() - given.keys()):
        found.append((table, "missing_column", None, name, wanted[name], None))
    for name in sorted(given.keys() - wanted.keys()):
        found.append((table, "extra_column", None, name, None, given[name]))
    for i, ((want, want_type), (got, got_type)) in enumerate(zip(expected, actual)):
        if want != got:
            found.append((table, "name_mismatch", i, want, f"{want} {want_type}", f"{got} {got_type}"))
        elif want_type != got_type:
            found.append((table, "type_mismatch", i, want, want_type, got_type))
    return found


def schema_check(
    spark: SparkSession,
    frames: Mapping[str, DataFrame | Structure],
    targets: Mapping[str, Structure | None] | None = None,
) -> DataFrame:
    """Differences between frames and the stored tables of the same names.

    Only schemas are looked at. ``targets`` replaces the catalogue.
    """
    rows = []
    for table, frame in frames.items():
        actual = structure(frame) if isinstance(frame, DataFrame) else list(frame)
        expected = table_structure(spark, table) if targets is None else targets.get(table)
        rows += differences(table, expected, actual)
    return spark.createDataFrame(rows, _DIFFERENCE)


class SchemaMismatch(RuntimeError):
    """Stored tables and new frames do not have the same columns."""


def require_schema(spark: SparkSession, frames: Mapping[str, DataFrame]) -> None:
    """Stop before any load if one table differs, naming all differences."""
    rows = []
    for table, frame in frames.items():
        rows += differences(table, table_structure(spark, table), structure(frame))
    if rows:
        raise SchemaMismatch("\n".join(str(r) for r in rows))


# ---- data rules ---------------------------------------------------------


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).filter("rows > 1")


def too_long(c: Column, length: int) -> Column:
    return F.char_length(c) > length


def does_not_fit(c: Column, decimal_type: str) -> Column:
    """True for a present value that overflows the type or is no number."""
    return c.isNotNull() & c.try_cast(decimal_type).isNull()


def declared_lengths(schema: T.StructType) -> dict[str, int]:
    return {f.name: f.metadata["max_length"] for f in schema if "max_length" in f.metadata}


def quality_gate(
    df: DataFrame,
    key: Sequence[str] = (),
    not_null: Sequence[str] = (),
    max_length: Mapping[str, int] | None = None,
    decimals: Mapping[str, str] | None = None,
) -> DataFrame:
    """(rule, column_name, violations), one row per rule, zeros included.

    All row rules are counted in one pass. The uniqueness rule counts the
    surplus rows per key with partial sums before its shuffle, and null keys
    are left to the NOT NULL rule.
    """
    rules: list[tuple[str, str, Column]] = []
    rules += [("not_null", c, ref(c).isNull()) for c in not_null]
    rules += [("max_length", c, too_long(ref(c), n)) for c, n in (max_length or {}).items()]
    rules += [("precision", c, does_not_fit(ref(c), t)) for c, t in (decimals or {}).items()]
    parts = []
    if rules:
        counts = df.agg(*[F.count_if(bad).alias(f"r{i}") for i, (_, _, bad) in enumerate(rules)])
        parts.append(
            counts.select(
                F.inline(
                    F.array(
                        *[
                            F.struct(
                                F.lit(rule).alias("rule"),
                                F.lit(column).alias("column_name"),
                                F.col(f"r{i}").alias("violations"),
                            )
                            for i, (rule, column, _) in enumerate(rules)
                        ]
                    )
                )
            )
        )
    if key:
        repeated = duplicate_keys(df.select(*[ref(c) for c in key]).dropna(), key)
        parts.append(
            repeated.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("violations")).select(
                F.lit("unique").alias("rule"),
                F.lit(",".join(key)).alias("column_name"),
                "violations",
            )
        )
    return reduce(DataFrame.unionByName, parts)


class RuleViolation(RuntimeError):
    """Data that a load must refuse."""


def enforce(gate: DataFrame) -> None:
    """Raise if any rule has violations; fetches one row per rule."""
    broken = gate.filter("violations > 0").collect()
    if broken:
        raise RuleViolation("; ".join(f"{r.rule}({r.column_name}): {r.violations}" for r in broken))


# ---- registry rules -----------------------------------------------------


def registry_errors(instances: DataFrame, reports: DataFrame) -> DataFrame:
    """(instance_key, rule, detail) for each fault of the registry.

    ``instances`` tells by booleans whether address, user and password are
    there; no secret is ever a column. ``reports`` holds one row per
    configured report. A report id used n times gives n - 1 faults, counted.
    """
    faults = F.array_compact(
        F.array(
            F.when(~F.coalesce("has_url", F.lit(False)), F.lit("missing_url")),
            F.when(~F.coalesce("has_user", F.lit(False)), F.lit("missing_user")),
            F.when(~F.coalesce("has_password", F.lit(False)), F.lit("missing_password")),
            F.when(F.coalesce(F.size("accounts"), F.lit(0)) <= 0, F.lit("missing_accounts")),
        )
    )
    of_instance = instances.select(
        "instance_key",
        F.explode(faults).alias("rule"),
        F.lit(None).cast("string").alias("detail"),
        F.lit(1).cast("bigint").alias("faults"),
    )
    per_id = reports.groupBy("instance_key", "report_id").agg(F.count("*").alias("n"))
    of_reports = per_id.select(
        "instance_key",
        F.when(F.col("report_id").isNull(), "missing_report_id")
        .when(F.col("n") > 1, "duplicate_report_id")
        .alias("rule"),
        F.col("report_id").cast("string").alias("detail"),
        F.when(F.col("report_id").isNull(), F.col("n")).otherwise(F.col("n") - 1).alias("faults"),
    ).filter(F.col("rule").isNotNull())
    return of_instance.unionByName(of_reports)


# ---- profiles and audits ------------------------------------------------

_REPEAT_MARK = r"\.\d+$"


def profile_source(df: DataFrame, source: str, header: Sequence[str]) -> DataFrame:
    """(source, column_count, repeat_markers, first_columns, row_count) of one report."""
    names = F.array(*[F.lit(h) for h in header])
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(source).alias("source"),
        F.size(names).cast("bigint").alias("column_count"),
        F.array_join(F.filter(names, lambda n: n.rlike(_REPEAT_MARK)), ", ").alias(
            "repeat_markers"
        ),
        F.array_join(F.slice(names, 1, 5), ", ").alias("first_columns"),
        "row_count",
    )


def load_audit(
    spark: SparkSession, lines: DataFrame, widths: Mapping[str, int], present: Sequence[str]
) -> DataFrame:
    """(table_name, status, rows_loaded, rows_adjusted) of a flat-file load.

    ``lines`` holds (table_name, line) of all files in one frame; ``widths``
    the tables to load and their number of columns; ``present`` the tables
    whose file exists. A missing file has failed, an empty one has not. One
    aggregate serves all tables.
    """
    plan = spark.createDataFrame(
        [(t, w, t in set(present)) for t, w in widths.items()],
        "table_name string, width int, present boolean",
    )
    shaped = lines.join(F.broadcast(plan.select("table_name", "width")), "table_name")
    counts = shaped.groupBy("table_name").agg(
        F.count("*").alias("rows_loaded"),
        F.count_if(
            F.size(F.split(trim_all(F.col("line")), r"\|")) != F.col("width")
        ).alias("rows_adjusted"),
    )
    loaded = F.coalesce("rows_loaded", F.lit(0))
    return plan.join(counts, "table_name", "left").select(
        "table_name",
        F.when(~F.col("present"), "failed")
        .when(loaded == 0, "empty")
        .otherwise("loaded")
        .alias("status"),
        loaded.alias("rows_loaded"),
        F.coalesce("rows_adjusted", F.lit(0)).alias("rows_adjusted"),
    )


def audit_totals(audit: DataFrame) -> DataFrame:
    """One row: rows loaded, rows adjusted, tables processed and failed."""
    return audit.agg(
        F.sum("rows_loaded").alias("rows_loaded"),
        F.sum("rows_adjusted").alias("rows_adjusted"),
        F.count_if(F.col("status") != "failed").alias("tables_processed"),
        F.count_if(F.col("status") == "failed").alias("tables_failed"),
    )

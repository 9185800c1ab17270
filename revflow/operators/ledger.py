"""The ledger of report runs: run plan, responses, upsert, active reports.

All folds are aggregates with partial sums before the shuffle. The joins that
carry the result back use keys that are unique on one side and spread the
other side evenly, so neither an account with a third of all runs nor an
identifier that is sent over and over ends up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from revflow.functions.xml import elements, is_broken

GROUP = ("customer_account", "report_name", "instance_key")
SEQUENCE = "sequence"

# Texts by which the report service tells the state of a run.
STILL_RUNNING = "still running"
ACCEPTED = ("SUCCESS", "REPORT RUNNING")


def with_instance(df: DataFrame) -> DataFrame:
    """The frame with an instance in every row; none at all is the empty one.

    The other key columns are never NULL in a ledger, so that the joins below
    can use plain equality and keep the partitioning of the aggregates.
    """
    known = F.col("instance_key") if "instance_key" in df.columns else F.lit(None)
    return df.withColumn("instance_key", F.coalesce(known.cast("string"), F.lit("")))


def _marks(df: DataFrame, columns: Sequence[str], flag: str) -> DataFrame:
    """The columns under other names with a constant flag, for a marking join."""
    return df.select(*[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias(flag))


def _mark(df: DataFrame, marks: DataFrame, columns: Sequence[str], how: str = "left") -> DataFrame:
    same = reduce(Column.__and__, [df[c] == marks[f"_{c}"] for c in columns])
    joined = df.join(marks, same, how)
    return joined.drop(*[f"_{c}" for c in columns])


# ---- run plan and coverage ----------------------------------------------


def account_rows(instances: DataFrame) -> DataFrame:
    """(instance_key, customer_account) of instances that list their accounts."""
    return instances.select("instance_key", F.explode("accounts").alias("customer_account"))


def run_plan(accounts: DataFrame, reports: DataFrame) -> DataFrame:
    """Every report of an instance for every account of that instance.

    An equi-join: the list of reports is broadcast while it is small, and
    otherwise hot instances are split by the adaptive skew join.
    """
    return accounts.join(reports, "instance_key")


def _registry_keys(registry: DataFrame, matrix: DataFrame) -> list[str]:
    """A registry that names instances is covered per instance; one that does not, by any."""
    return [c for c in GROUP if c != "instance_key" or c in registry.columns and c in matrix.columns]


def registry_coverage(registry: DataFrame, matrix: DataFrame) -> DataFrame:
    """Configured (account, report, instance) with their active identifier, if any.

    Without instances in the registry, the greatest identifier of any instance is shown.
    """
    keys = _registry_keys(registry, matrix)
    active = matrix.groupBy(*keys).agg(F.max("identifier").alias("identifier"))
    return registry.join(active, keys, "left").withColumn("covered", F.col("identifier").isNotNull())


def registry_gaps(registry: DataFrame, matrix: DataFrame) -> DataFrame:
    """Configured (account, report, instance) without an active run."""
    keys = _registry_keys(registry, matrix)
    return registry.join(matrix.select(*keys), keys, "left_anti")


def report_names(active: DataFrame) -> DataFrame:
    """Report names in use, sorted."""
    return active.select("report_name").distinct().orderBy("report_name")


# ---- responses ----------------------------------------------------------


def parse_responses(responses: DataFrame, xml: str = "response") -> DataFrame:
    """Add status, identifier, status_message and what the texts alone decide.

    ``outcome`` is ERROR, RUNNING or FAILED, or NULL for a run to register.
    The first rule that holds decides.
    """
    parsed = responses.withColumn(
        "_r", elements(F.col(xml), "Status", "Identifier", "StatusMessage")
    )
    status, identifier = F.col("_r.Status"), F.col("_r.Identifier")
    message = F.col("_r.StatusMessage")
    unreadable = (
        is_broken(F.col("_r"))
        | status.isNull()
        | identifier.isNull()
        | message.isNull()
        | (message == "")
    )
    unnamed = F.col("customer_account").isNull() | F.col("report_name").isNull()
    outcome = (
        F.when(unreadable, "ERROR")
        .when(message.contains(STILL_RUNNING), "RUNNING")
        .when(~status.isin(*ACCEPTED), "FAILED")
        .when((identifier == "") | unnamed, "ERROR")
    )
    return parsed.select(
        *responses.columns,
        status.alias("status"),
        identifier.alias("identifier"),
        message.alias("status_message"),
        outcome.alias("outcome"),
    )


def first_sightings(runs: DataFrame, accepted: Column | None = None) -> DataFrame:
    """Each run once, with the lowest sequence number it was (acceptably) seen at.

    A run without account, report or identifier cannot be in a ledger. Keys
    are made non-null and the condition is part of the aggregate: filters on
    either would be pushed down and would parse every response once more, or
    keep the two uses of this aggregate from sharing one shuffle.
    """
    key = [*GROUP, "identifier"]
    seen = F.col(SEQUENCE) if accepted is None else F.when(accepted, F.col(SEQUENCE))
    keyed = with_instance(runs).select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in key], seen.alias(SEQUENCE)
    )
    firsts = keyed.groupBy(*key).agg(F.min(SEQUENCE).alias(SEQUENCE))
    if accepted is None:
        named = [F.col(c) != "" for c in key if c != "instance_key"]
        firsts = firsts.filter(reduce(Column.__and__, named))
    return firsts.filter(F.col(SEQUENCE).isNotNull())


def unknown_runs(firsts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Runs the ledger does not hold yet, whatever their status there."""
    key = [*GROUP, "identifier"]
    return _mark(firsts, _marks(with_instance(ledger), key, "_known"), key, "left_anti")


def unseen_runs(firsts: DataFrame, stored: DataFrame) -> DataFrame:
    """Runs that are not stored, or only with a later sighting."""
    key = [*GROUP, "identifier"]
    known = stored.select(*[F.col(c).alias(f"_{c}") for c in (*key, SEQUENCE)])
    same = reduce(Column.__and__, [firsts[c] == known[f"_{c}"] for c in key])
    return firsts.join(known, same & (known[f"_{SEQUENCE}"] <= firsts[SEQUENCE]), "left_anti")


def classify_responses(
    responses: DataFrame, ledger: DataFrame | None = None, xml: str = "response"
) -> DataFrame:
    """Responses with their outcome: ERROR, RUNNING, FAILED, REGISTERED or DUPLICATE.

    ``sequence`` must tell responses of one run apart. The first acceptable
    response of a run that the ledger does not know registers it. It is found
    by an aggregate and marked by a join on the run *and* the sequence, so
    that many copies of one response are not gathered in one task.
    """
    parsed = parse_responses(with_instance(responses), xml)
    firsts = first_sightings(parsed, F.col("outcome").isNull())
    if ledger is not None:
        firsts = unknown_runs(firsts, ledger)
    key = [*GROUP, "identifier", SEQUENCE]
    marked = _mark(parsed, _marks(firsts, key, "_first"), key)
    return marked.withColumn(
        "outcome",
        F.coalesce("outcome", F.when(F.col("_first"), "REGISTERED").otherwise("DUPLICATE")),
    ).drop("_first")


# ---- ledger -------------------------------------------------------------


def newest_active(firsts: DataFrame) -> DataFrame:
    """First sightings with status 1 for the newest run of each group, else 0.

    The newest run is found per group and marked by a join on the whole run
    key, which the first aggregate has already partitioned by.
    """
    newest = (
        firsts.groupBy(*GROUP)
        .agg(F.max(F.struct(SEQUENCE, "identifier")).alias("_top"))
        .select(*GROUP, F.col("_top.identifier").alias("identifier"))
    )
    key = [*GROUP, "identifier"]
    marked = _mark(firsts, _marks(newest, key, "_newest"), key)
    return marked.withColumn("status", F.when(F.col("_newest"), 1).otherwise(0)).drop("_newest")


def report_ledger(runs: DataFrame) -> DataFrame:
    """Ledger of all runs seen: each once, the newest of its group active."""
    return newest_active(first_sightings(runs))


def upsert_ledger(ledger: DataFrame, runs: DataFrame) -> DataFrame:
    """The ledger after further runs.

    Known runs change nothing. A group that gets a new run has its older rows
    set to 0; other groups keep their status, also one set by hand. Only
    active rows take part in the join, so a group with a long history does
    not move.
    """
    fresh = newest_active(unknown_runs(first_sightings(runs), ledger))
    touched = _marks(fresh.select(*GROUP).distinct(), GROUP, "_touched")
    before = with_instance(ledger)
    retired = _mark(before.filter(F.col("status") == 1), touched, GROUP).withColumn(
        "status", F.when(F.col("_touched"), 0).otherwise(1)
    )
    names = ledger.columns
    return (
        before.filter(~F.col("status").eqNullSafe(1))  # a row without a status stays as it is
        .select(*names)
        .unionByName(retired.select(*names))
        .unionByName(fresh.select(*names))
    )


def active_reports(
    ledger: DataFrame, instance_key: str | None = None, per_instance: bool = False
) -> DataFrame:
    """(customer_account, report_name, identifier) of active rows, the last one winning.

    With ``per_instance`` each instance of an account has its own active run,
    and the instance is a column of the result.
    """
    active = ledger.filter(F.col("status") == 1)
    if instance_key is not None and "instance_key" in ledger.columns:
        active = active.filter(F.col("instance_key") == instance_key)
    if per_instance:
        active = with_instance(active)
    groups = GROUP if per_instance else [c for c in GROUP if c != "instance_key"]
    return active.groupBy(*groups).agg(
        F.max_by("identifier", F.struct(SEQUENCE, "identifier")).alias("identifier")
    )


def report_matrix(ledger: DataFrame, instance_key: str | None = None) -> DataFrame:
    """(customer_account, reports map): a map as long as the list of report kinds."""
    return (
        active_reports(ledger, instance_key)
        .groupBy("customer_account")
        .agg(
            F.map_from_entries(
                F.array_sort(F.collect_list(F.struct("report_name", "identifier")))
            ).alias("reports")
        )
    )


def report_matrix_wide(
    ledger: DataFrame, reports: Sequence[str], instance_key: str | None = None
) -> DataFrame:
    """The matrix with one column per listed report."""
    return (
        active_reports(ledger, instance_key)
        .groupBy("customer_account")
        .pivot("report_name", list(reports))
        .agg(F.first("identifier"))
    )

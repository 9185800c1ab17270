"""The report ledger: runs are derived from events, one run per response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from revflow.operators.ledger import (
    classify_responses,
    registry_coverage,
    registry_gaps,
    report_ledger,
    report_matrix,
    report_matrix_wide,
    report_names,
    run_plan,
    upsert_ledger,
    active_reports,
)
from revflow.session import run_folder
from revflow.streaming.ledger_stream import compact_runs, start_ledger_stream, stream_ledger
from revflow.streaming.report_stream import ledger_of, start_report_stream, told_rows, waiting_retries
from revflow.workload.carrier import accounts
from revflow.workload.registry import Tables, query

REPORTS = ("click", "error", "purchase", "signup", "view")
_LATER = 1_000_000_000_000


def runs(t: Tables) -> DataFrame:
    """Ten identifiers per account and report at most, so that runs repeat."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    return t.events.select(
        F.col("user_id").cast("string").alias("customer_account"),
        F.col("event_type").alias("report_name"),
        F.concat(F.lit("I"), (F.col("user_id") % 2).cast("string")).alias("instance_key"),
        F.concat(F.lit("R"), (k % 10).cast("string")).alias("identifier"),
        F.col("event_id").alias("sequence"),
    )


RUNS_SQL = """
runs AS (
  SELECT CAST(user_id AS VARCHAR) AS customer_account, event_type AS report_name,
    'I' || user_id % 2 AS instance_key,
    'R' || CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) % 10 AS identifier,
    event_id AS sequence FROM events)"""


def ledger_sql(source: str, name: str = "ledger") -> str:
    """Ledger of the runs in ``source``, by windows."""
    return f"""
{name} AS (
  SELECT customer_account, report_name, instance_key, identifier, sequence,
    CASE WHEN row_number() OVER (PARTITION BY customer_account, report_name, instance_key
      ORDER BY sequence DESC, identifier DESC) = 1 THEN 1 ELSE 0 END AS status
  FROM (SELECT customer_account, report_name, instance_key, identifier, min(sequence) AS sequence
    FROM {source} GROUP BY ALL))"""


@query("report_ledger", f"WITH {RUNS_SQL}, {ledger_sql('runs')} SELECT * FROM ledger")
def ledger(t: Tables) -> DataFrame:
    """Each run once, the newest of its group active."""
    return report_ledger(runs(t))


def _new_runs(t: Tables) -> DataFrame:
    """Later runs of clicks and views; clicks repeat known runs, views are new."""
    new = F.when(F.col("report_name") == "view", F.concat(F.lit("N"), "identifier"))
    return runs(t).select(
        "customer_account",
        F.when(F.col("report_name") == "view", "view").otherwise("click").alias("report_name"),
        "instance_key",
        F.coalesce(new, F.col("identifier")).alias("identifier"),
        (F.col("sequence") + _LATER).alias("sequence"),
    )


_NEW_SQL = f"""
new_runs AS (
  SELECT customer_account, CASE WHEN report_name = 'view' THEN 'view' ELSE 'click' END AS report_name,
    instance_key, CASE WHEN report_name = 'view' THEN 'N' || identifier ELSE identifier END
      AS identifier, sequence + {_LATER} AS sequence FROM runs)"""

_BOTH_SQL = "(SELECT * FROM runs UNION ALL SELECT * FROM new_runs)"


@query(
    "ledger_upsert",
    f"""WITH {RUNS_SQL}, {_NEW_SQL}, {ledger_sql(_BOTH_SQL)}
SELECT * REPLACE (CASE report_name WHEN 'error' THEN NULL WHEN 'signup' THEN 1 ELSE status END AS status)
FROM ledger""",
)
def ledger_upsert(t: Tables) -> DataFrame:
    """A stored ledger after further runs equals the ledger of all runs.

    Reports without new runs keep what was set by hand: no status at all, or several active rows.
    """
    stored = run_folder(t.spark, "ledger")
    by_hand = F.when(F.col("report_name") == "signup", 1).when(F.col("report_name") != "error", F.col("status"))
    report_ledger(runs(t)).withColumn("status", by_hand).write.parquet(stored)
    return upsert_ledger(t.spark.read.parquet(stored), _new_runs(t))


_ACTIVE_SQL = """
active AS (SELECT customer_account, report_name, arg_max(identifier, sequence) AS identifier
  FROM ledger WHERE status = 1 GROUP BY ALL)"""


@query(
    "report_matrix",
    f"""WITH {RUNS_SQL}, {ledger_sql("runs")}, {_ACTIVE_SQL}
SELECT customer_account, {", ".join(f"max(identifier) FILTER (report_name = '{r}') AS {r}"
  for r in REPORTS)} FROM active GROUP BY customer_account""",
)
def matrix(t: Tables) -> DataFrame:
    return report_matrix_wide(report_ledger(runs(t)), REPORTS)


@query(
    "report_matrix_of_instance",
    f"""WITH {RUNS_SQL}, {ledger_sql("runs")}, {_ACTIVE_SQL}
SELECT customer_account,
  string_agg(report_name || '=' || identifier, ',' ORDER BY report_name) AS reports
FROM active WHERE CAST(customer_account AS BIGINT) % 2 = 1 GROUP BY customer_account""",
)
def matrix_of_instance(t: Tables) -> DataFrame:
    """The map of one instance's accounts, printed."""
    mapped = report_matrix(report_ledger(runs(t)), instance_key="I1")
    pairs = F.transform(
        F.array_sort(F.map_entries("reports")), lambda e: F.concat_ws("=", e["key"], e["value"])
    )
    return mapped.select("customer_account", F.array_join(pairs, ",").alias("reports"))


def _registry(t: Tables) -> DataFrame:
    """Every customer is configured for every report in two instances; runs exist in one of them."""
    names = F.explode(F.array(*[F.lit(r) for r in REPORTS]))
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("customer_account"), names.alias("report_name")
    ).select("*", F.explode(F.array(F.lit("I0"), F.lit("I1"))).alias("instance_key"))


_REGISTRY_SQL = """
registry AS (SELECT customer_account, report_name, unnest(['I0', 'I1']) AS instance_key FROM
  (SELECT CAST(c_custkey AS VARCHAR) AS customer_account,
    unnest(['click', 'error', 'purchase', 'signup', 'view']) AS report_name FROM customer))"""


@query(
    "registry_coverage",
    f"""WITH {RUNS_SQL}, {ledger_sql("runs")}, {_REGISTRY_SQL}
SELECT customer_account, report_name, instance_key, identifier, identifier IS NOT NULL AS covered
FROM registry LEFT JOIN (SELECT * FROM ledger WHERE status = 1) USING (customer_account, report_name, instance_key)""",
)
def coverage(t: Tables) -> DataFrame:
    """A run in one instance does not cover the other."""
    return registry_coverage(_registry(t), active_reports(report_ledger(runs(t)), per_instance=True))


@query(
    "registry_gaps",
    f"""WITH {RUNS_SQL}, {_REGISTRY_SQL}
SELECT customer_account, report_name, instance_key FROM registry
WHERE (customer_account, report_name, instance_key) NOT IN
  (SELECT (customer_account, report_name, instance_key) FROM runs)""",
)
def gaps(t: Tables) -> DataFrame:
    return registry_gaps(_registry(t), active_reports(report_ledger(runs(t)), per_instance=True))


@query("report_names", "SELECT DISTINCT event_type AS report_name FROM events")
def names(t: Tables) -> DataFrame:
    return report_names(active_reports(report_ledger(runs(t))))


@query(
    "run_plan",
    """SELECT r_name AS instance_key, CAST(c_custkey AS VARCHAR) AS customer_account,
  n.n_nationkey AS report_id, n.n_nationkey + 100 AS filter_id, lower(n.n_name) AS report_name
FROM customer JOIN nation h ON c_nationkey = h.n_nationkey
JOIN region ON h.n_regionkey = r_regionkey JOIN nation n ON n.n_regionkey = r_regionkey""",
)
def plan(t: Tables) -> DataFrame:
    """Regions as instances, customers as accounts, a report per nation of the region."""
    reports = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("instance_key"),
        F.col("n_nationkey").alias("report_id"),
        (F.col("n_nationkey") + 100).alias("filter_id"),
        F.lower("n_name").alias("report_name"),
    )
    of_instance = accounts(t).select(
        F.col("r_name").alias("instance_key"),
        F.col("c_custkey").cast("string").alias("customer_account"),
    )
    return run_plan(of_instance, reports)


# ---- responses ----------------------------------------------------------


def _element(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"<n:{name}>"), value, F.lit(f"</n:{name}>"))


def response(kind: Column, identifier: Column) -> Column:
    """XML of a response; the kind decides what is wrong with it."""
    status = F.when(kind == 2, "FAIL").when(kind == 6, "REPORT RUNNING").otherwise("SUCCESS")
    message = (
        F.when(kind == 1, "the report is still running").when(kind == 4, "").otherwise("started")
    )
    body = F.concat(
        F.lit('<n:Response xmlns:n="urn:x">'),
        _element("Status", status),
        F.when(kind == 0, "").otherwise(_element("Identifier", identifier)),
        _element("StatusMessage", message),
    )
    return F.when(kind == 3, body).otherwise(F.concat(body, F.lit("</n:Response>")))


def responses(df: DataFrame, kind: Column) -> DataFrame:
    return df.select(
        "customer_account",
        "report_name",
        "instance_key",
        "sequence",
        response(kind, F.col("identifier")).alias("response"),
    )


def _known(t: Tables) -> DataFrame:
    """A ledger that already knows run R3 of each customer's clicks."""
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("customer_account"),
        F.lit("click").alias("report_name"),
        F.concat(F.lit("I"), (F.col("c_custkey") % 2).cast("string")).alias("instance_key"),
        F.lit("R3").alias("identifier"),
    )


@query(
    "classify_response",
    f"""WITH {RUNS_SQL}, kinds AS (SELECT *, sequence % 8 AS kind FROM runs),
firsts AS (SELECT customer_account, report_name, instance_key, identifier, min(sequence) AS first
  FROM kinds WHERE kind NOT IN (0, 1, 2, 3, 4) AND NOT (report_name = 'click'
    AND identifier = 'R3' AND CAST(customer_account AS BIGINT) IN (SELECT c_custkey FROM customer))
  GROUP BY ALL)
SELECT customer_account, report_name, instance_key, sequence,
  CASE WHEN kind NOT IN (0, 3) THEN identifier END AS identifier,
  CASE WHEN kind IN (0, 3, 4) THEN 'ERROR' WHEN kind = 1 THEN 'RUNNING' WHEN kind = 2 THEN 'FAILED'
    WHEN first = sequence THEN 'REGISTERED' ELSE 'DUPLICATE' END AS outcome
FROM kinds LEFT JOIN firsts USING (customer_account, report_name, instance_key, identifier)""",
)
def classify(t: Tables) -> DataFrame:
    """All kinds of responses against a ledger that knows some of the runs."""
    found = classify_responses(responses(runs(t), F.col("sequence") % 8), _known(t))
    return found.select(
        "customer_account", "report_name", "instance_key", "sequence", "identifier", "outcome"
    )


_ACCEPTED_SQL = """
seen AS (SELECT * FROM runs WHERE sequence % 8 NOT IN (0, 1, 2, 3, 4)
  UNION ALL SELECT * FROM new_runs)"""


@query(
    "ledger_stream",
    f"WITH {RUNS_SQL}, {_NEW_SQL}, {_ACCEPTED_SQL}, {ledger_sql('seen')} SELECT * FROM ledger",
)
def streamed(t: Tables) -> DataFrame:
    """Two landings taken in one after the other by a stream that resumes, then all by a new one over the same store."""
    root = run_folder(t.spark, "stream")
    landing, store, checkpoint = (f"{root}/{d}" for d in ("landing", "store", "checkpoint"))
    waves = (
        responses(runs(t), F.col("sequence") % 8),
        responses(_new_runs(t), F.lit(5)),
    )
    for wave in waves:
        wave.write.mode("append").json(landing)
        start_ledger_stream(t.spark, landing, store, checkpoint).awaitTermination()
    start_ledger_stream(t.spark, landing, store, f"{checkpoint}-2").awaitTermination()
    compact_runs(t.spark, store, f"{root}/compacted")
    return stream_ledger(t.spark, f"{root}/compacted")


def _two_waves(t: Tables) -> str:
    """A stream over two landings, the later responses first; it stops in between and resumes."""
    root = run_folder(t.spark, "stream")
    landing, store, checkpoint = (f"{root}/{d}" for d in ("landing", "store", "checkpoint"))
    told = responses(runs(t), F.col("sequence") % 8)
    stamped = told.withColumn("received", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("sequence")))
    late = F.col("sequence") % 3 != 0
    for wave in (stamped.filter(late), stamped.filter(~late)):
        wave.write.mode("append").json(landing)
        start_report_stream(t.spark, landing, store, checkpoint).awaitTermination()
    return store


@query(
    "report_stream",
    f"WITH {RUNS_SQL}, seen AS (SELECT * FROM runs WHERE sequence % 8 NOT IN (0, 1, 2, 3, 4)), {ledger_sql('seen')} SELECT * FROM ledger",
)
def report_stream(t: Tables) -> DataFrame:
    """The ledger from states per group, landed out of order, after a restart: that of all responses."""
    return ledger_of(told_rows(t.spark, _two_waves(t)))


@query(
    "retries_waiting",
    f"""WITH {RUNS_SQL}, firsts AS (SELECT customer_account, report_name, instance_key, identifier, min(sequence) AS first
  FROM runs WHERE sequence % 8 NOT IN (0, 1, 2, 3, 4) GROUP BY ALL),
last AS (SELECT customer_account, report_name, instance_key, arg_max(identifier, sequence) AS identifier, max(sequence) AS sequence
  FROM runs GROUP BY ALL)
SELECT customer_account, report_name, instance_key, sequence, strftime(make_timestamp((1700000060 + sequence) * 1000000), '%Y-%m-%d %H:%M:%S') AS due_at
FROM last LEFT JOIN firsts USING (customer_account, report_name, instance_key, identifier)
WHERE sequence % 8 = 1 OR (sequence % 8 NOT IN (0, 1, 2, 3, 4) AND first < sequence)""",
)
def retries_waiting(t: Tables) -> DataFrame:
    """Groups whose last response is of a run that goes on or is known: to be tried again a minute after it."""
    return waiting_retries(told_rows(t.spark, _two_waves(t)))

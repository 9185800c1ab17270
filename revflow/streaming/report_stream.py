"""Responses of running reports as a stream with a state per account, report and instance.

The state of a group has the lowest sequence number of each of its runs, its last response, and the
retry that waits. A response changes the state alone: no store is read again. A group whose last response says that
the report is still running, or names a run that is known, is to be tried again a minute after it was received; the
timer of that retry gives a row when its time has come, unless a later response has come first.

The stream appends rows to a store, of three kinds: "run" when a run is seen for the first time or with a
lower number than before, "wait" when the retry of a group changes, and "due" when its timer runs out. The ledger is the fold over
the runs, the waiting retries are the last ones told. Both are those of all responses
that have landed, in whatever order, also after a restart from the checkpoint.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from revflow.operators.ledger import GROUP, SEQUENCE, parse_responses, report_ledger, with_instance
from revflow.streaming.ledger_stream import LANDING_SCHEMA

# The processor travels to the executors, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TIMED_SCHEMA = LANDING_SCHEMA + ", received timestamp"
RETRY_MS = 60_000  # a fixed value: the wait between two tries
_ROWS = (
    "kind string, customer_account string, report_name string, instance_key string, "
    "identifier string, sequence bigint, due_ms bigint, changes bigint"
)
_row = Row(*[c.split()[0] for c in _ROWS.split(", ")])
# The last response, the retry after it, and the runs with their lowest numbers; ``more`` tells that further runs are in a map.
_STATE = (
    "sequence bigint, identifier string, outcome string, received_ms bigint, wait_sequence bigint, due_ms bigint, changes bigint, "
    "runs map<string, bigint>, more boolean"
)
_NEW = (None, None, None, None, None, None, None, {}, False)
_INLINE = 64  # runs of a group that are kept beside its other state: some 2 KB
# The store that keeps maps and timers; and a run ends when all that has landed is taken in, timers or not.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


class ReportState(StatefulProcessor):
    """One group: its runs, its last response, the retry that waits.

    All of it is one value, read once and written once for the responses of a batch. Runs beyond the first ``_INLINE`` go to a
    map, so that a group of many runs neither rewrites nor reads those that a batch does not name.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.group = handle.getValueState("group", _STATE)
        self.runs = handle.getMapState("runs", "identifier string", "sequence bigint")

    def _known(self, identifier: str, inline: dict[str, int], more: bool) -> int | None:
        """The lowest sequence number that a run was seen at."""
        if identifier in inline or not more:
            return inline.get(identifier)
        found = self.runs.getValue((identifier,))
        return None if found is None else int(found[0])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        out: list[Row] = []
        sequence, named, outcome, received, *wait, inline, more = self.group.get() or _NEW
        inline, more = dict(inline), bool(more)
        best = None if sequence is None else (int(sequence), named or "")
        lowest: dict[str, int] = {}
        for row in rows:
            place = (int(row.sequence), row.identifier or "")
            if row.outcome is None:  # a run that may be registered
                lowest[place[1]] = min(lowest.get(place[1], place[0]), place[0])
            if best is None or place > best:
                best, outcome, received = place, row.outcome, row.received_ms
        for identifier, at in lowest.items():
            known = self._known(identifier, inline, more)
            if known is not None and known <= at:
                continue
            if known is not None and identifier not in inline:
                self.runs.updateValue((identifier,), (at,))
            else:
                inline[identifier] = at
            out.append(_row("run", *key, identifier, at, None, None))
        again = outcome == "RUNNING"
        if outcome is None:  # seen before: by a lower number
            again = self._known(best[1], inline, more) < best[0]
        due = int(received) + RETRY_MS if again and received is not None else None
        changed = self._retry(wait, best[0], due)
        if changed is not None:
            wait = changed
            out.append(_row("wait", *key, None, *wait))
        if len(inline) > _INLINE:
            for identifier, at in inline.items():
                self.runs.updateValue((identifier,), (at,))
            inline, more = {}, True
        self.group.update((*best, outcome, received, *wait, inline, more))
        return iter(out)

    def _retry(self, wait: list, sequence: int, due: int | None) -> tuple[int, int | None, int] | None:
        """What the last response makes of the retry (sequence, due_ms, changes), if that changes."""
        at, before, changes = wait
        if (at, before) == (sequence, due) or (at is None and due is None):
            return None
        if before is not None:
            self.handle.deleteTimer(int(before))
        if due is not None:
            self.handle.registerTimer(due)
        return sequence, due, (changes or 0) + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.group.get()
        if state is None:
            return iter([])
        sequence, due, changes = state[4:7]
        return iter([_row("due", *key, None, sequence, due, changes)] if due == expiredTimerInfo.getExpiryTimeInMs() else [])

    def close(self) -> None:
        pass


def start_report_stream(
    spark: SparkSession, landing: str, store: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Take in all responses that have landed since the last run, then stop. ``store`` gets the rows."""
    responses = spark.readStream.schema(TIMED_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(landing)
    parsed = parse_responses(with_instance(responses))
    named = " AND ".join(f"{c} IS NOT NULL" for c in GROUP)
    rows = parsed.filter(named).select(*GROUP, "identifier", SEQUENCE, "outcome", F.unix_millis("received").alias("received_ms"))
    before = {key: spark.conf.get(key) for key in _SETTINGS}
    for key, value in _SETTINGS.items():  # a query holds on to the settings it began with
        spark.conf.set(key, value)
    try:
        told = rows.groupBy(*GROUP).transformWithState(
            statefulProcessor=ReportState(), outputStructType=_ROWS, outputMode="Append", timeMode="ProcessingTime"
        )
        return (
            told.writeStream.format("parquet").outputMode("append")
            .option("path", store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def told_rows(spark: SparkSession, store: str) -> DataFrame:
    """All rows that the stream has told."""
    return spark.read.schema(_ROWS).parquet(store)


def ledger_of(told: DataFrame) -> DataFrame:
    """The ledger of all runs: each once, with its first sighting, the newest of its group active."""
    return report_ledger(told.filter("kind = 'run'").select(*GROUP, "identifier", SEQUENCE))


def waiting_retries(told: DataFrame) -> DataFrame:
    """(group, sequence, due_at) of the groups that are to be tried again, and after which response."""
    last = told.filter("kind = 'wait'").groupBy(*GROUP).agg(F.max_by(F.struct(SEQUENCE, "due_ms"), "changes").alias("w"))
    return last.filter("w.due_ms IS NOT NULL").select(*GROUP, f"w.{SEQUENCE}", F.timestamp_millis("w.due_ms").alias("due_at"))


def due_retries(told: DataFrame, as_of) -> DataFrame:
    """The waiting retries whose time has come."""
    return waiting_retries(told).filter(F.col("due_at") <= as_of)

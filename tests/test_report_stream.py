"""States per group: the batch ledger for any landing order, restarts, retries that wait and come due."""

import itertools

import pytest
from pyspark.sql import Row, functions as F

from revflow.operators.ledger import classify_responses, report_ledger
from revflow.streaming.report_stream import ReportState, due_retries, ledger_of, start_report_stream, told_rows, waiting_retries

from test_ledger import xml

COLUMNS = "customer_account string, report_name string, instance_key string, sequence bigint, response string, received timestamp"
RUNNING = xml("REPORT RUNNING", "x", "is still running")
RESPONSES = [
    ("1", "open", "i", 1, xml("SUCCESS", "A", "ok")),
    ("1", "open", "i", 2, xml("SUCCESS", "A", "ok")),  # known: to be tried again
    ("1", "open", "i", 3, RUNNING),
    ("1", "open", "i", 4, xml("SUCCESS", "B", "ok")),  # ends it
    ("2", "open", "i", 5, xml("SUCCESS", "A", "ok")),
    ("2", "open", "i", 6, RUNNING),  # waits
    ("2", "paid", "i", 7, "<broken"),
    ("3", "open", "i", 8, RUNNING),
    ("3", "open", "i", 9, "<broken"),  # an error is not tried again
    ("4", "open", "j", 10, xml("SUCCESS", "A", "ok")),
    ("4", "open", "j", 11, xml("SUCCESS", "A", "ok")),  # waits
    (None, "open", "j", 12, xml("SUCCESS", "A", "ok")),
]


def frame(spark, rows):
    df = spark.createDataFrame([(*r, None) for r in rows], COLUMNS)
    return df.withColumn("received", F.timestamp_seconds(1_700_000_000 + F.col("sequence")))


def take(spark, folder, waves):
    for wave in waves:
        frame(spark, wave).coalesce(1).write.mode("append").json(f"{folder}/landing")
        start_report_stream(spark, f"{folder}/landing", f"{folder}/store", f"{folder}/checkpoint").awaitTermination()
    return told_rows(spark, f"{folder}/store")


@pytest.mark.parametrize("order", [0, 1, 2])
def test_same_ledger_and_retries_for_any_order(spark, tmp_path, order):
    parts = [RESPONSES[:4:2] + RESPONSES[4:8], RESPONSES[1:4:2], RESPONSES[8:]]
    told = take(spark, str(tmp_path), list(itertools.permutations(parts))[order * 2]).persist()
    found = frame(spark, RESPONSES)
    registered = classify_responses(found).filter("outcome = 'REGISTERED'")
    wanted = sorted(map(tuple, report_ledger(registered).select(*ledger_of(told).columns).collect()))
    assert sorted(map(tuple, ledger_of(told).collect())) == wanted
    waiting = {tuple(r)[:4] for r in waiting_retries(told).collect()}
    assert waiting == {("2", "open", "i", 6), ("4", "open", "j", 11)}
    due = F.timestamp_seconds(F.lit(1_700_000_066))
    assert [r.sequence for r in due_retries(told, due).collect()] == [6]
    # the timers of these retries, long past, have run out
    assert {("2", 6), ("4", 11)} <= {(r.customer_account, r.sequence) for r in told.filter("kind = 'due'").collect()}


def test_nothing_lands(spark, tmp_path):
    told = take(spark, str(tmp_path), [RESPONSES[-1:]])
    assert told.count() == 0 and ledger_of(told).collect() == [] and waiting_retries(told).collect() == []


class Held:
    """State as a handle gives it, with a count of the calls that reach the store."""

    def __init__(self):
        self.value, self.map, self.calls, self.timers = None, {}, 0, set()

    def getValueState(self, *_):  # noqa: N802
        return self

    getMapState = getValueState

    def _call(self, result=None):
        self.calls += 1
        return result

    def get(self):
        return self._call(self.value)

    def update(self, value):
        self.value = self._call(value)

    def getValue(self, key):  # noqa: N802
        return self._call(self.map.get(key))

    def containsKey(self, key):  # noqa: N802
        return self._call(key in self.map)

    def updateValue(self, key, value):  # noqa: N802
        self.map[key] = self._call(value)

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(self._call(at))

    def deleteTimer(self, at):  # noqa: N802
        self.timers.discard(self._call(at))


def told_by(state, rows):
    seen = [Row(identifier=i, sequence=s, outcome=o, received_ms=s * 1000) for i, s, o in rows]
    return [(r.kind, r.identifier, r.sequence) for r in state.handleInputRows(("1", "open", "i"), iter(seen), None)]


def test_a_batch_of_a_group_reads_and_writes_its_state_once():
    held, state = Held(), ReportState()
    state.init(held)
    for wave in range(3):
        held.calls = 0
        told = told_by(state, [(f"R{k}", 100 * wave + k, None) for k in range(10)])
        assert len([r for r in told if r[0] == "run"]) == (10 if wave == 0 else 0)
        assert held.calls <= 4  # the value twice, and its timer


def test_a_group_of_many_runs_keeps_a_small_value():
    held, state = Held(), ReportState()
    state.init(held)
    lowest: dict[str, int] = {}
    for wave in range(40):  # higher and lower numbers, known and new runs
        rows = [(f"R{(wave * 7 + k) % 300}", 10_000 + (wave * 37 + k * 11) % 900, None) for k in range(20)]
        for i, s, _ in rows:
            lowest[i] = min(lowest.get(i, s), s)
        held.calls = 0
        for kind, i, s in told_by(state, rows):
            assert kind == "wait" or s == lowest[i]
        assert len(held.value[-2]) <= 64 and held.calls <= 2 + 2 + 20 + 1 + 64 + 20
    inline = held.value[-2]
    assert len(held.map) > 64 and {(i,): (s,) for i, s in inline.items()} | held.map == {(i,): (s,) for i, s in lowest.items()}

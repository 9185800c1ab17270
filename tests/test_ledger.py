import random

from revflow.operators.ledger import (
    account_rows,
    active_reports,
    classify_responses,
    newest_active,
    report_ledger,
    report_matrix,
    run_plan,
    upsert_ledger,
)

RUNS = (
    "customer_account string, report_name string, instance_key string, "
    "identifier string, sequence bigint"
)
LEDGER = RUNS + ", status int"


def fold(runs, known=()):
    """The ledger rule taken literally: one run after the other."""
    ledger = {tuple(k[:4]): (k[4], k[5]) for k in known}
    for account, report, instance, identifier, sequence in sorted(runs, key=lambda r: r[4]):
        key = (account, report, instance, identifier)
        if key in ledger:
            continue
        for other, (seq, _) in list(ledger.items()):
            if other[:3] == key[:3]:
                ledger[other] = (seq, 0)
        ledger[key] = (sequence, 1)
    return {(*k, *v) for k, v in ledger.items()}


def some_runs(n, seed, start=0):
    rnd = random.Random(seed)
    return [
        (
            "hot" if rnd.random() < 0.5 else f"a{rnd.randrange(5)}",
            f"r{rnd.randrange(2)}",
            f"i{rnd.randrange(2)}",
            f"x{rnd.randrange(6)}",
            start + i,
        )
        for i in range(n)
    ]


def table(df):
    return {
        (r.customer_account, r.report_name, r.instance_key, r.identifier, r.sequence, r.status)
        for r in df.collect()
    }


def test_ledger_equals_one_by_one_fold(spark):
    runs = some_runs(300, 1)
    assert table(report_ledger(spark.createDataFrame(runs, RUNS))) == fold(runs)


def test_upsert_equals_one_by_one_fold(spark):
    first, later = some_runs(60, 2), some_runs(60, 3, start=1000)
    ledger = report_ledger(spark.createDataFrame(first, RUNS))
    assert table(upsert_ledger(ledger, spark.createDataFrame(later, RUNS))) == fold(first + later)


def test_upsert_leaves_untouched_groups(spark):
    """A group set to 0 by hand stays so until a new run comes; a known run is ignored."""
    known = [("a", "r", "i", "x1", 1, 0), ("b", "r", "i", "x1", 1, 0), ("c", "r", "i", "x1", 1, 1)]
    later = [("a", "r", "i", "x1", 9), ("b", "r", "i", "x2", 9)]
    got = upsert_ledger(spark.createDataFrame(known, LEDGER), spark.createDataFrame(later, RUNS))
    assert table(got) == {
        ("a", "r", "i", "x1", 1, 0),
        ("b", "r", "i", "x1", 1, 0),
        ("b", "r", "i", "x2", 9, 1),
        ("c", "r", "i", "x1", 1, 1),
    }


def test_missing_instance_is_the_empty_one(spark):
    runs = spark.createDataFrame(
        [("a", "r", None, "x1", 1), ("a", "r", None, "x2", 2), (None, "r", None, "x", 3)], RUNS
    )
    assert table(report_ledger(runs)) == {("a", "r", "", "x1", 1, 0), ("a", "r", "", "x2", 2, 1)}


def test_tie_goes_to_the_greater_identifier(spark):
    firsts = spark.createDataFrame([("a", "r", "i", "x1", 1), ("a", "r", "i", "x2", 1)], RUNS)
    assert table(newest_active(firsts)) == {
        ("a", "r", "i", "x1", 1, 0),
        ("a", "r", "i", "x2", 1, 1),
    }


def test_matrix(spark):
    ledger = spark.createDataFrame(
        [
            ("a", "r", "i1", "x1", 1, 1),
            ("a", "r", "i2", "x2", 2, 1),
            ("a", "s", "i1", "x3", 3, 1),
            ("a", "s", "i1", "x4", 4, 0),
            ("b", "r", "i2", "x5", 5, 1),
        ],
        LEDGER,
    )
    whole = {r.customer_account: r.reports for r in report_matrix(ledger).collect()}
    assert whole == {"a": {"r": "x2", "s": "x3"}, "b": {"r": "x5"}}
    one = {r.customer_account: r.reports for r in report_matrix(ledger, "i1").collect()}
    assert one == {"a": {"r": "x1", "s": "x3"}}
    bare = ledger.drop("instance_key")
    assert active_reports(bare, "i1").count() == 3


def test_run_plan(spark):
    instances = spark.createDataFrame(
        [("i1", ["a", "b"]), ("i2", ["c"]), ("i3", [])], "instance_key string, accounts array<string>"
    )
    reports = spark.createDataFrame(
        [("i1", 1), ("i1", 2), ("i2", 1), ("i3", 1)], "instance_key string, report_id int"
    )
    plan = run_plan(account_rows(instances), reports)
    assert {(r.instance_key, r.customer_account, r.report_id) for r in plan.collect()} == {
        ("i1", "a", 1), ("i1", "a", 2), ("i1", "b", 1), ("i1", "b", 2), ("i2", "c", 1),
    }


def xml(status="SUCCESS", identifier="x1", message="ok", prefix="n:"):
    def element(name, text):
        return "" if text is None else f"<{prefix}{name}>{text}</{prefix}{name}>"

    space = ' xmlns:n="urn:x"' if prefix else ""
    return (
        f"<{prefix}R{space}>{element('Status', status)}{element('Identifier', identifier)}"
        f"{element('StatusMessage', message)}</{prefix}R>"
    )


def test_classify(spark):
    cases = [
        (xml(identifier=None), "ERROR"),
        (xml(message=None), "ERROR"),
        (xml(status=None), "ERROR"),
        (xml(message=""), "ERROR"),
        (xml(identifier=""), "ERROR"),
        (xml()[:-4], "ERROR"),
        ("", "ERROR"),
        (None, "ERROR"),
        (xml(message="it is still running", status="FAIL"), "RUNNING"),
        (xml(status="FAIL"), "FAILED"),
        (xml(identifier="known"), "DUPLICATE"),
        (xml(identifier="new"), "REGISTERED"),
        (xml(identifier="new", prefix=""), "DUPLICATE"),
        (xml(identifier="other", status="REPORT RUNNING"), "REGISTERED"),
    ]
    rows = [("a", "r", None, i, text) for i, (text, _) in enumerate(cases)]
    responses = spark.createDataFrame(
        rows,
        "customer_account string, report_name string, instance_key string, sequence bigint, "
        "response string",
    )
    ledger = spark.createDataFrame([("a", "r", None, "known", 1, 0)], LEDGER)
    got = {r.sequence: r.outcome for r in classify_responses(responses, ledger).collect()}
    assert [got[i] for i in range(len(cases))] == [outcome for _, outcome in cases]


def test_many_copies_are_not_gathered(spark):
    """Neither the fold nor the classification uses a window or collects a group."""
    runs = spark.createDataFrame(some_runs(50, 4), RUNS)
    for df in (report_ledger(runs), upsert_ledger(report_ledger(runs), runs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "collect_list" not in plan and "Cartesian" not in plan

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from revflow.operators.infer import infer_structure, promote, structure


def types(spark, columns, **options):
    names = list(columns)
    rows = list(zip(*columns.values()))
    schema = ", ".join(f"`{n}` string" for n in names)
    found = infer_structure(spark.createDataFrame(rows, schema), **options).collect()
    return {r.column_name: r.data_type for r in sorted(found, key=lambda r: r.position)}


def test_types_of_columns(spark):
    columns = {
        "short_date": ["1/5/2024", "12/31/2024", None],
        "impossible": ["1/5/2024", "02/30/2024", None],
        "sentinel": ["1/5/2024", "12/31/9999", None],
        "suffix": ["1f", "1", "2"],
        "infinite": ["inf", "1", "2"],
        "zeros": ["0126", "0906", None],
        "pinned": ["0126", "0906", None],
        "blanks": ["1", "", None],
        "real": ["1", "2.5", ".5e3"],
        "huge": ["1", "92233720368547758070", None],
        "money": ["$1,234.00", "$1.00", None],
        "due date": ["20240101", "20240102", None],
        "nothing": [None, "", None],
    }
    expected = {
        "short_date": "date",
        "impossible": "text",
        "sentinel": "text",
        "suffix": "text",
        "infinite": "text",
        "zeros": "bigint",
        "pinned": "text",
        "blanks": "bigint",
        "real": "double precision",
        "huge": "double precision",
        "money": "text",
        "due date": "bigint",
        "nothing": "text",
    }
    assert types(spark, columns, pinned=["pinned"]) == expected
    changed = {"due date": "text"}
    assert types(spark, columns, pinned=["pinned"], skip_date_names=True) == expected | changed
    changed = dict.fromkeys(["zeros", "blanks", "due date"], "double precision")
    doubled = types(spark, columns, pinned=["pinned"], blank_double=True)
    assert doubled == expected | changed


def test_promote(spark):
    df = spark.createDataFrame(
        [("1", "1/5/2024", "", "x", 3), ("", "", None, "y", 4)],
        "a string, b string, c string, d string, e bigint",
    )
    typed = promote(df, blank_missing=True)
    assert structure(typed) == [
        ("a", "bigint"),
        ("b", "date"),
        ("c", "text"),
        ("d", "text"),
        ("e", "bigint"),
    ]
    assert [tuple(r) for r in typed.collect()] == [
        (1, date(2024, 1, 5), "", "x", 3),
        (None, None, "", "y", 4),
    ]


def test_empty_frame(spark):
    df = spark.createDataFrame([], "a string, b double")
    found = {r.column_name: (r.data_type, r.all_missing) for r in infer_structure(df).collect()}
    assert found == {"a": ("text", True), "b": ("double precision", None)}


def _expected(values):
    present = [v for v in values if v not in (None, "")]
    if not present:
        return "text"

    def number(kind):
        def check(v):
            try:
                kind(v)
            except ValueError:
                return False
            return v == v.strip() and "_" not in v and not any(c in v.lower() for c in "nf")

        return check

    def day(v):
        try:
            return 1678 <= datetime.strptime(v, "%m/%d/%Y").year <= 2261
        except ValueError:
            return False

    if all(map(number(int), present)):
        return "bigint"
    if all(map(number(float), present)):
        return "double precision"
    return "date" if all(map(day, present)) else "text"


cells = st.one_of(
    st.none(),
    st.sampled_from(["", "0", "-7", "+3", "1.5", "1.", ".5", "1e3", "-", "1e", "1f", "1_0", "1/1"]),
    st.integers(-(10**17), 10**17).map(str),
    st.dates(date(1700, 1, 1), date(2200, 1, 1)).map(lambda d: d.strftime("%m/%d/%Y")),
    st.sampled_from(["2/30/2024", "13/1/2024", "1/5/24", "abc", "$5", "5 "]),
)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(cells, min_size=3, max_size=3), min_size=4, max_size=12))
def test_types_against_python(spark, columns):
    named = {f"c{i}": values for i, values in enumerate(columns)}
    assert types(spark, named) == {name: _expected(v) for name, v in named.items()}


@pytest.mark.parametrize("width", [300])
def test_wide_frame_is_one_pass(spark, width):
    df = spark.range(5).selectExpr(*[f"cast(id + {i} as string) as c{i}" for i in range(width)])
    found = infer_structure(df).collect()
    assert len(found) == width and {r.data_type for r in found} == {"bigint"}

import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from revflow.functions.names import (
    column_names,
    distinct_names,
    last_positions,
    snake_column,
    snake_name,
)


def test_snake_name():
    assert snake_name("Credit Source(w/o Payer)") == "credit_source_w_o_payer"
    assert snake_name("Practice Name/ID") == "practice_name_id"
    assert snake_name("***") == "unnamed_column"
    assert snake_name("A  B") == "a_b"
    assert snake_name("__a__b__") == "a_b"


@given(st.text(max_size=30))
def test_snake_name_rules(name):
    """The rule, step by step: blanks for signs, single blanks, lower case, single marks."""
    text = re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", name))
    text = re.sub(r"_+", "_", text.lower().replace(" ", "_")).strip("_")
    assert snake_name(name) == (text or "unnamed_column")
    assert snake_name(snake_name(name)) == snake_name(name)


def test_snake_column_equals_snake_name(spark):
    names = ["Credit Source(w/o Payer)", "***", "A  B", "été Übung/9", "x.1", "a__b", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select("n", snake_column(F.col("n")).alias("s")).collect()
    assert {r.n: r.s for r in got} == {n: snake_name(n) for n in names}


def test_repeats():
    assert distinct_names(["X", "Y", "X", "X"]) == ["X", "Y", "X.1", "X.2"]
    assert distinct_names(["X", "X.1", "X"]) == ["X", "X.1", "X.2"]
    assert column_names(["Charge Claim ID", "Charge Claim ID"]) == [
        "charge_claim_id",
        "charge_claim_id_1",
    ]
    assert column_names([" a ", "", "A", "a"]) == ["a", "unnamed_1", "a_2", "a_1"]
    assert last_positions(["A", "B", "A"]) == [2, 1, 2]


@settings(max_examples=200)
@given(st.lists(st.sampled_from(["a", "A", "a.1", "a_1", "b", "", " "]), max_size=8))
def test_column_names_are_unique(header):
    names = column_names(header)
    assert len(names) == len(set(names)) == len(header)

"""What changed between snapshots of a table, and when each state of a row held.

A snapshot is a whole extract, known by its time. Rows are told apart by their key and compared by a digest of
their other columns, so that a comparison moves keys and digests only. A key must be unique within an extract
(``duplicate_keys`` tells). A key has one row per extract at most, so no window grows beyond the number of extracts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from revflow.operators.shape import ref


def digest(columns: Sequence[str]) -> Column:
    """SHA-256 of the values of some columns; NULL differs from every value."""
    return F.sha2(F.to_json(F.struct(*[ref(c) for c in columns])), 256)


def snapshot_changes(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys whose rows differ, with ``change``: inserted, changed or deleted."""
    others = [c for c in before.columns if c not in key]
    if set(before.columns) != set(after.columns):
        raise ValueError("snapshots of one table have the same columns")
    old = before.select(*[ref(c) for c in key], digest(others).alias("_old"))
    new = after.select(*[ref(c) for c in key], digest(others).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "deleted").when(F.col("_old") != F.col("_new"), "changed")
    )
    both = old.join(new, list(key), "full").withColumn("change", change)
    return both.filter("change IS NOT NULL").select(*[ref(c) for c in key], "change")


def row_history(snapshots: DataFrame, key: Sequence[str], extracted_at: str = "extracted_at") -> DataFrame:
    """Each state of each row with ``valid_from`` and ``valid_to``.

    A state begins with the extract that shows it first and ends with the first later extract that does not;
    ``valid_to`` is NULL while the newest extract shows it. A row that is gone and comes back has a
    state of its own for each time. ``change`` tells how a state began: "inserted" or "changed".
    """
    others = [c for c in snapshots.columns if c not in (*key, extracted_at)]
    at = ref(extracted_at)
    times = snapshots.select(at.alias("_at")).distinct()
    in_time = Window.orderBy("_at")  # one row per extract
    times = times.select("_at", F.lag("_at").over(in_time).alias("_before"), F.lead("_at").over(in_time).alias("_next"))
    of_key = Window.partitionBy(*[ref(c) for c in key]).orderBy(at)
    # one row per extract: broadcast, so that the rows of an extract are never dealt to one task by its time
    seen = snapshots.withColumn("_digest", digest(others)).join(F.broadcast(times), at == F.col("_at"))
    seen = seen.withColumn("_known", F.lag(at).over(of_key)).withColumn("_last", F.lag("_digest").over(of_key))
    gone = F.col("_known").isNull() | (F.col("_known") != F.col("_before"))
    begins = F.when(gone, "inserted").when(F.col("_last") != F.col("_digest"), "changed")
    states = seen.withColumn("_begins", begins).withColumn("_state", F.count("_begins").over(of_key))
    grouped = states.groupBy(*[ref(c) for c in key], "_state").agg(
        *[F.min_by(ref(c), at).alias(c) for c in others],
        F.min(at).alias("valid_from"),
        F.max_by("_next", at).alias("valid_to"),
        F.min_by("_begins", at).alias("change"),
    )
    return grouped.drop("_state")

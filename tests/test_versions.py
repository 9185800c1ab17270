"""Many tables, one commit: readers see a version whole, whatever fails."""

import pytest
from pyspark.sql import functions as F

from revflow.operators.quality import RuleViolation
from revflow.sinks import versions as v

TABLES = ("a", "b", "c")


def frame(spark, n, add=0, fail=False):
    df = spark.range(n).select("id", (F.col("id") + add).alias("amount"))
    return df.withColumn("amount", F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.col("amount"))) if fail else df


def sums(spark, version):
    return {t: v.table_of_version(spark, e).agg(F.sum("amount"), F.count("*")).first()[:] for t, e in version.tables.items()}


def loaded(spark, root):
    v.refresh_all(spark, root, {t: frame(spark, 10) for t in TABLES}, keys={t: ["id"] for t in TABLES})
    return sums(spark, v.open_version(spark, root))


@pytest.mark.parametrize("n", range(3))
def test_a_fault_in_any_table_changes_nothing(spark, tmp_path, n):
    root = str(tmp_path)
    before = loaded(spark, root)
    frames = {t: frame(spark, 10, 5, fail=i == n) for i, t in enumerate(TABLES)}
    with pytest.raises(Exception, match="lost"):
        v.refresh_all(spark, root, frames)
    with pytest.raises(Exception, match="lost"):
        v.append_all(spark, root, {t: f.withColumn("id", F.col("id") + 100) for t, f in frames.items()}, keys={t: ["id"] for t in TABLES})
    assert v.versions(spark, root) == [1] and sums(spark, v.open_version(spark, root)) == before


def test_a_broken_rule_or_key_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    before = loaded(spark, root)
    twice = frame(spark, 3).unionAll(frame(spark, 3))
    with pytest.raises(RuleViolation):
        v.refresh_all(spark, root, {"a": frame(spark, 4), "b": twice}, keys={"a": ["id"], "b": ["id"]})
    new = frame(spark, 4).withColumn("id", F.col("id") + 50)
    with pytest.raises(RuleViolation):
        v.append_all(spark, root, {"a": new, "b": frame(spark, 4)}, keys={"a": ["id"], "b": ["id"]})
    with pytest.raises(ValueError, match="other columns"):
        v.append_all(spark, root, {"a": new, "b": new.withColumnRenamed("amount", "x")})
    assert sums(spark, v.open_version(spark, root)) == before


def test_a_fault_in_the_commit_itself(spark, tmp_path, monkeypatch):
    """Everything is written and checked, but the rename does not happen."""
    root = str(tmp_path)
    before = loaded(spark, root)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(v, "_rename", lost)
        with pytest.raises(OSError):
            v.refresh_all(spark, root, {t: frame(spark, 10, 5) for t in TABLES})
    assert sums(spark, v.open_version(spark, root)) == before
    unused = v.unused_folders(spark, root, since=1).collect()
    assert len(unused) == 3  # what that load has written


def test_readers_keep_their_version(spark, tmp_path):
    root = str(tmp_path)
    loaded(spark, root)
    first = v.open_version(spark, root)
    views = v.publish(spark, first, "kept_")
    v.refresh_all(spark, root, {"a": v.table_of_version(spark, first.tables["a"]).withColumn("amount", F.col("amount") + 1)})
    v.append_all(spark, root, {"a": frame(spark, 2).withColumn("id", F.col("id") - 9), "d": frame(spark, 1)}, keys={"a": ["id"]})
    assert views == ["kept_a", "kept_b", "kept_c"] and spark.table("kept_a").agg(F.sum("amount")).first()[0] == 45
    now = v.open_version(spark, root)
    assert now.number == 3 and {t: e.rows for t, e in now.tables.items()} == {"a": 12, "b": 10, "c": 10, "d": 1}
    assert sums(spark, now)["a"] == (56, 12) and sums(spark, v.open_version(spark, root, 2))["a"] == (55, 10)
    assert sorted(map(tuple, v.history(spark, root).filter("table_name IN ('a', 'd')").collect())) == [
        (1, "a", 1, 10), (2, "a", 1, 10), (3, "a", 2, 12), (3, "d", 1, 1),
    ]
    assert len(v.unused_folders(spark, root, since=3).collect()) == 1
    assert v.commit(spark, root, now, {}, dropped=["b"]).tables.keys() == {"a", "c", "d"}


def test_of_two_loads_on_one_version_one_wins(spark, tmp_path):
    root = str(tmp_path)
    loaded(spark, root)
    base = v.open_version(spark, root)
    v.commit(spark, root, base, {}, dropped=["a"])
    with pytest.raises(v.ConcurrentCommit):
        v.commit(spark, root, base, {}, dropped=["b"])
    assert v.open_version(spark, root).tables.keys() == {"b", "c"} and v.versions(spark, root) == [1, 2]


def test_partitioned_tables_and_empty_stores(spark, tmp_path):
    root = str(tmp_path)
    assert v.open_version(spark, root) == v.Version(0, {}) and v.history(spark, root).collect() == []
    by = lambda n: frame(spark, n).select((F.col("id") % 2).cast("string").alias("tenant"), "id", "amount")
    v.refresh_all(spark, root, {"a": by(4), "b": frame(spark, 0)}, partition_by="tenant")
    v.append_all(spark, root, {"a": by(6).filter("id > 3")}, keys={"a": ["id"]})
    now = v.open_version(spark, root)
    a = v.table_of_version(spark, now.tables["a"])
    assert a.columns == ["id", "amount", "tenant"] and sorted(map(tuple, a.collect())) == [(i, i, str(i % 2)) for i in range(6)]
    assert v.table_of_version(spark, now.tables["b"]).collect() == []

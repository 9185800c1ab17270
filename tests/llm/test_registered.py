import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry_points
from compare import difference
from revflow.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_katz": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op2_repeats": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op3_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op4_quality": ["doc_id", "held_out", "score", "predicted"],
    "op5_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op6_secrets": ["doc_id", "place"],
    "op7_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op10_minhash": ["doc_id", "n_shingles", "component_id", "kept"],
    "op12_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op13_genetic_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op11_ranked_search": ["item_id", "rank", "doc_id", "score"],
}
TYPES = {
    "doc_id": "bigint", "held_out": "boolean", "score": "double", "base_score": "double", "predicted": "int", "over_limit": "boolean",
    "kept": "boolean", "contaminated": "boolean", "kept_sha256": "string", "items_sha256": "string", "text_sha256": "string", "groups_sha256": "string",
}
OWN = {"op11_ranked_search": {"rank": "int", "score": "bigint"}, "op13_genetic_packing": {"piece": "int"}}


def test_all_operators_are_registered():
    assert set(QUERIES) == set(COLUMNS) and set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), ORACLE[name], FOLDER) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    kinds = dict(QUERIES[name](spark, FOLDER).dtypes)
    assert list(kinds)[: len(COLUMNS[name])] == COLUMNS[name]
    types = TYPES | OWN.get(name, {})
    assert {c: kinds[c] for c in COLUMNS[name]} == {c: types.get(c, "bigint") for c in COLUMNS[name]}


@pytest.mark.parametrize("name, modulus, held", [("op1_katz", 7, 2), ("op4_quality", 5, 0), ("op8_toxicity", 3, 1)])
def test_folds(spark, name, modulus, held):
    rows = QUERIES[name](spark, FOLDER).collect()
    ids = Counter(r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    assert Counter(r["doc_id"] for r in rows) == ids
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == held) for r in rows)


def test_labels_and_places_are_no_inputs(spark, tmp_path):
    """Scores stay the same when languages, sources and the labels of held-out rows change, and ids do not matter for scoring."""
    from pyspark.sql import functions as F

    for table in ("documents", "labels"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").write.parquet(f"{tmp_path}/a/{table}.parquet")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).write.parquet(f"{tmp_path}/b/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    for name, label, modulus, held in (("op4_quality", "quality", 5, 0), ("op8_toxicity", "toxic", 3, 1)):
        held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == held
        turned = F.when(held_out, 1 - F.col(label)).otherwise(F.col(label)).cast(labels.schema[label].dataType)
        labels.withColumn(label, turned).write.mode("overwrite").parquet(f"{tmp_path}/b/labels.parquet")
        a, b = ({r["doc_id"]: round(r["score"], 9) for r in QUERIES[name](spark, f"{tmp_path}/{x}").collect()} for x in "ab")
        assert a == b

import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from documents import frame
from revflow.llm.tables import vocabulary
from test_decontamination import brute as brute_hits
from test_minhash import brute as brute_near

FOLDER = "/root/testdata/sf0.01"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def rows_of(df):
    return {(r["doc_id"], r["text"]) for r in df.collect()}


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def without_copies(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t))
    return {min(g, key=lambda m: (-len(m[1] or ""), m[0])) for g in groups.values()}


def test_each_stage_against_a_plain_version(spark):
    """Every stage on what the one before kept, and the whole run as their chain."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    good = stage("quality")(spark, docs, FOLDER).persist()
    assert good.columns == docs.columns and good.schema == docs.schema
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    right = [(i in kept) == bool(q) for i, q in labels.items()]
    assert sum(right) / len(right) > 0.97

    single = stage("exact_dedup")(spark, good, FOLDER).persist()
    assert single.columns == docs.columns and rows_of(single) == without_copies(rows_of(good))

    far = stage("near_dedup")(spark, single, FOLDER).persist()
    near = brute_near(sorted(rows_of(single)), k=5)
    assert far.columns == docs.columns and {i for i, _ in rows_of(far)} == {i for i, _, _, keep in near if keep}

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = stage("decontamination")(spark, far, FOLDER).persist()
    sample = sorted(rows_of(far))
    wanted = {i for i, _, hits, _, _ in brute_hits(sample, items, 10) if not hits}
    assert clean.columns == docs.columns and {i for i, _ in rows_of(clean)} == wanted

    packed = stage("packing")(spark, clean, FOLDER).collect()
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    texts = dict(rows_of(clean))
    by_doc = {}
    for r in packed:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert by_doc.keys() == texts.keys() and len({r["sequence_id"] for r in packed}) == len(packed)
    for i, own in by_doc.items():
        ids = [x for r in sorted(own, key=lambda r: r["start"]) for x in r["ids"]]
        assert ids == [*library.encode(texts[i] or "", add_special_tokens=False).ids, 0]

    run = corpus_pipeline.run(spark, FOLDER).collect()
    digest = lambda rows: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert digest(run) == digest(packed)
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in run[:200])


def test_stages_on_odd_rows(spark, odd_rows, tmp_path):
    """NULLs, repeated rows and ids, further columns with clashing names."""
    docs = frame(spark, odd_rows)
    for name in ("exact_dedup", "near_dedup", "decontamination"):
        out = stage(name)(spark, docs, FOLDER)
        assert out.columns == docs.columns
        got = [(r["doc_id"], r["text"]) for r in out.collect()]
        assert {(i, t) for i, t in odd_rows if i is None} <= set(got)  # rows without an id are never dropped as copies
        assert set(got) <= set(odd_rows) and len(got) >= 8
        assert stage(name)(spark, docs.limit(0), FOLDER).collect() == []
    copies = [i for i, t in odd_rows if t and i is not None]
    single = {r["doc_id"] for r in stage("exact_dedup")(spark, docs, FOLDER).collect()}
    assert {8, 9} & set(copies) and 8 in single and 6 not in single
    good = stage("quality")(spark, docs, FOLDER)
    assert good.schema == docs.schema and set(map(tuple, good.select("doc_id", "text").collect())) <= set(odd_rows)
    assert len(stage("packing")(spark, docs, FOLDER).filter("start = 0").collect()) == len(odd_rows)


@pytest.mark.parametrize("size", [0, 1])
def test_tiny_tables(spark, tmp_path, size):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").limit(size).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).filter("start = 0").count() <= size


def test_different_texts_under_one_id_are_different_documents(spark):
    """A near copy goes; another text under its id stays, and neither links the other's group."""
    words = [f"w{i}" for i in range(60)]
    a, b, c = " ".join(words), " ".join(f"x{i}" for i in range(60)), " ".join(f"y{i}" for i in range(60))
    rows = [(1, a), (2, a + " tail"), (2, b), (3, b + " end"), (4, c), (4, a + " more"), (None, a)]
    docs = frame(spark, rows, "doc_id long, text string, gone long, id long, key long, component_id long, kept boolean")
    out = stage("near_dedup")(spark, docs, FOLDER)
    assert out.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted([(1, a), (2, b), (4, c), (None, a)], key=str)


def test_quality_stage_with_a_clashing_name(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    clash = docs.withColumnRenamed("source", "SIZE")
    out = stage("quality")(spark, clash, FOLDER)
    assert out.columns == clash.columns
    assert out.count() == stage("quality")(spark, docs, FOLDER).count()

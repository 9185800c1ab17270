import itertools
import re

import numpy as np
import pyarrow as pa
import pytest

from documents import frame
from revflow.llm import quality
from revflow.llm.logistic import sigmoid
from revflow.llm.queries import QUERIES
from revflow.llm.words import string_buffers

FOLDER = "/root/testdata/sf0.01"


def test_margin_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(1)
    bits, rank = 6, 3
    n = (1 << bits) + quality.STATISTICS
    m = quality.Machine(bits, 0.3, rng.normal(size=n), rng.normal(size=(n, rank)))
    places, first = np.array([1, 5, 9, 2, 63, 5], np.int32), np.array([0, 3, 3, 6])
    stats = rng.random((3, quality.STATISTICS))
    for d, margin in enumerate(m.margin(places, first, stats)):
        own = places[first[d] : first[d + 1]]
        x = {int(p): 1 / np.sqrt(len(own)) for p in own} | {(1 << bits) + i: v for i, v in enumerate(stats[d])}
        pairs = sum(m.vector[i] @ m.vector[j] * x[i] * x[j] for i, j in itertools.combinations(x, 2))
        assert margin == pytest.approx(0.3 + sum(m.weight[i] * v for i, v in x.items()) + pairs)


def test_statistics_of_single_documents_equal_those_of_batches(odd_rows):
    texts = [t for _, t in odd_rows]
    whole = quality.inputs(pa.array([len(t or "") for t in texts]), *string_buffers(pa.array(texts)), 10)
    for i, t in enumerate(texts):
        one = quality.inputs(pa.array([len(t or "")]), *string_buffers(pa.array([t], pa.string())), 10)
        assert np.allclose(one[2][0], whole[2][i]) and one[0].tolist() == whole[0][whole[1][i] : whole[1][i + 1]].tolist()
        assert (whole[2][i] >= 0).all() and (whole[2][i] <= 1).all()
        assert len(one[0]) <= len(set(re.findall(r"[^\x20\x09-\x0D]+", t or "")))


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = QUERIES["op4_quality"](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held)
    assert len(held) > 50 and right / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_edge_cases(spark, odd_rows):
    docs = frame(spark, odd_rows)
    labels = spark.createDataFrame(
        [(4, 1), (5, 0), (6, 1), (8, 0), (7, None), (None, 1), (6, 0), (777, 1)], "doc_id long, label int"
    )
    machine = quality.fit(docs, labels, bits=8, epochs=2)
    scores = quality.score_quality(docs, machine).collect()
    assert len(scores) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in scores)
    kept = quality.keep_good(docs, machine, 0.5)
    assert kept.schema == docs.schema and kept.count() == sum(r["score"] >= 0.5 for r in scores)
    assert quality.score_quality(docs.limit(0), machine).collect() == []
    one_class = quality.fit(docs, labels.filter("label = 1"), bits=8)
    assert {round(r["score"], 5) for r in quality.score_quality(docs, one_class).collect()} == {1.0}
    none = quality.fit(docs, labels.limit(0), bits=8)
    assert {r["score"] for r in quality.score_quality(docs, none).collect()} == {0.5}


def test_sigmoid_is_safe():
    assert sigmoid(np.array([-1e9, 0.0, 1e9])).tolist() == pytest.approx([0, 0.5, 1])

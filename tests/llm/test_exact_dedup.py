import hashlib
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from documents import frame
from revflow.llm import exact_dedup


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(i, best, len(members), i == best, hashlib.sha256(norm.encode()).hexdigest()) for i, _ in members]
    return sorted(out, key=str)


def test_groups(spark, odd_rows):
    docs = frame(spark, odd_rows).repartition(4)
    assert sorted(map(tuple, exact_dedup.exact_groups(docs).collect()), key=str) == brute(odd_rows)
    empty = exact_dedup.exact_groups(docs.limit(0))
    assert empty.collect() == []


def test_texts_that_only_share_a_fingerprint_stay_apart(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(["a b", "ab", "c", "d d", "dd ", "e"])]
    fake = lambda offsets, data: np.full(len(offsets) - 1, 5, np.uint64)  # noqa: E731  every text collides
    monkeypatch.setattr(exact_dedup, "_fingerprints", fake)
    from pyspark import cloudpickle as cp

    cp.register_pickle_by_value(exact_dedup)
    try:
        got = sorted(map(tuple, exact_dedup.exact_groups(frame(spark, rows)).collect()), key=str)
    finally:
        cp.unregister_pickle_by_value(exact_dedup)
    assert got == brute(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=200), st.integers(0, 6))
def test_filter_round_trip(values, bits):
    """Nothing is lost on the way through a filter, also in crowded runs and ranges."""
    width = 64 - bits
    place = values[0] >> width
    same = [(v & ((1 << width) - 1)) | (place << width) for v in values] + [(place << width) + i for i in range(40)]
    keys, counts = np.unique(np.array(same * 2 + same[:5], np.uint64), return_counts=True)
    got = exact_dedup.read_filter(exact_dedup.build_filter(keys, counts, place << width, width))
    assert (got[0] == keys).all() and (got[1] == counts).all()


def test_merge_adds_counts():
    a = (np.array([1, 5, 9], np.uint64), np.array([1, 2, 1]))
    b = (np.array([5, 9, 2**64 - 1], np.uint64), np.array([1, 1, 7]))
    keys, counts = exact_dedup.merge([a, b])
    assert keys.tolist() == [1, 5, 9, 2**64 - 1] and counts.tolist() == [1, 3, 2, 7]

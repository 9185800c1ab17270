import random
import re

import numpy as np

from documents import frame
from revflow.llm import minhash
from revflow.llm.components import components


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, k=2, percent=80):
    """Components over all pairs of distinct documents."""
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t, k))
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            near = any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b])
            if near and find(a) != find(b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted(
        ((i, len(shingles(t, k)), None if i is None else find(i), i is None or find(i) == i) for i, t in rows), key=str
    )


def found(spark, rows, k=2, percent=80, parts=4):
    docs = frame(spark, rows).repartition(parts)
    return sorted(map(tuple, minhash.near_duplicates(docs, k, percent).collect()), key=str)


def families(seed, size, count=4, edits=(0.0, 0.16), passage=0):
    """Groups of texts that differ from their base in some words, so that similarities spread around 0.8."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randint(0, 10**6)
    rows, common = [], [word() for _ in range(passage)]
    for _ in range(count):
        base = [word() for _ in range(rng.randint(40, 90))]
        for _ in range(size):
            share = rng.uniform(*edits)
            rows.append(" ".join([w if rng.random() > share / 2 else word() for w in base] + common))
    rows += [" ".join([word() for _ in range(60)] + common) for _ in range(30)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_edge_cases(spark, odd_rows):
    assert found(spark, odd_rows) == brute(odd_rows)
    assert found(spark, odd_rows, k=5) == brute(odd_rows, k=5)
    assert found(spark, []) == []


def test_dense_families(spark):
    rows = families(1, 45)
    assert found(spark, rows) == brute(rows)


def test_families_at_the_threshold(spark):
    rows = families(2, 40, edits=(0.05, 0.22))
    assert found(spark, rows) == brute(rows)


def test_common_passage_links_nothing(spark):
    rows = families(3, 12, passage=45, edits=(0.0, 0.3))
    assert found(spark, rows) == brute(rows)


def test_what_one_centre_leaves_is_found_by_differences(spark):
    """Links among texts that are all too far from the centre of their key."""
    rows = families(4, 60, count=2, edits=(0.10, 0.24))
    expected = brute(rows)
    assert found(spark, rows) == expected
    assert 2 < len({c for _, _, c, _ in expected})


def test_pigeonhole_guarantee():
    """Signatures that differ in up to 19 components share a key, wherever they differ."""
    rng = np.random.default_rng(3)

    def keys(s):
        w = minhash.WIDTH
        return {(c, out, *(s[c * w + i] for i in range(w) if i != out)) for c in range(minhash.CHUNKS) for out in range(w)}

    for _ in range(300):
        a = rng.integers(0, 2**16, 60).tolist()
        b = list(a)
        for at in rng.choice(60, 19, replace=False):
            b[at] += 1
        assert keys(a) & keys(b)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(500, 500)]
    edges += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    assert got == {i: find(i) for i in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []

import math
import re
from collections import Counter

import numpy as np
import pytest

from documents import frame
from revflow.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k):
    """Every document against every item, by the formula."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    total, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for doc, c, n in held:
            m = 100 - 50 + (50 * n * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) & c.keys()
            )
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def corpus(odd_rows):
    import random

    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    odds = [1 / (i + 1) for i in range(60)]
    more = [(1000 + i, " ".join(rng.choices(words, odds, k=rng.randint(0, 40)))) for i in range(400)]
    copies = [(3000 + i, "Same w1 W2 w3-w4, w59") for i in range(30)]
    return odd_rows + more + copies


ITEMS = [(1, "w1 w2 w3 w59"), (2, "the OF alpha é"), (3, "É 日本 🙂 x1"), (4, "nowhere"), (5, None), (6, ""), (None, "w58 same"), (7, "w1 w1 w1"), (7, "w40"), (1, "w1 w2 w3 w59")]


@pytest.mark.parametrize("owners, docs, k", [(4, 8192, 50), (1, 50, 7), (3, 16, 5), (6, 7, 1)])
def test_against_brute_force(spark, corpus, monkeypatch, owners, docs, k):
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", docs)
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in ITEMS], "item_id long, text string, term string, doc_id long")
    found = ranked_search.ranked_search(frame(spark, corpus).repartition(3), items, k=k, owners=owners)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == brute(corpus, ITEMS, k)


def test_blocks_of_items(spark, corpus, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 5)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(ranked_search.ranked_search(frame(spark, corpus), items, k=3)) == brute(corpus, ITEMS, 3)


def test_empty_tables(spark, corpus):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(ranked_search.ranked_search(frame(spark, []), items)) == []
    assert rows(ranked_search.ranked_search(frame(spark, [(1, None), (2, " -")]), items)) == []
    assert rows(ranked_search.ranked_search(frame(spark, corpus), items.limit(0))) == []


def test_terms_of_bytes():
    texts = ["", "A-b c_d", "é É1", "  ", "日本x", "zZ"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    found, sizes = ranked_search.terms_of(offsets, np.frombuffer(data, np.uint8))
    assert [t.decode() for t in found.to_pylist()] == [x for t in texts for x in terms(t)]
    assert sizes.tolist() == [len(terms(t)) for t in texts]


def test_owners_take_rare_terms_first():
    df = np.array([100, 1, 50, 3, 0])
    owner = ranked_search._owners(df, 4)
    assert owner[0] == 3 and owner[1] <= owner[3] <= owner[2] <= owner[0] and owner[4] == 0

import random
import re

import pytest

from documents import frame
from revflow.llm import repeats


def brute(rows, length):
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    place = lambda i, p: (i is None, i or 0, p)
    first = {}
    for i, ws in texts:
        for p in range(len(ws) - length + 1):
            key = tuple(ws[p : p + length])
            first[key] = min(first.get(key, place(i, p)), place(i, p))
    out = []
    for i, ws in texts:
        gone = set()
        for p in range(len(ws) - length + 1):
            if place(i, p) > first[tuple(ws[p : p + length])]:
                gone |= set(range(p, p + length))
        runs = []
        for p in sorted(gone):
            if runs and runs[-1][1] == p:
                runs[-1][1] = p + 1
            else:
                runs.append([p, p + 1])
        out.append((i, len(ws), " ".join(w for p, w in enumerate(ws) if p not in gone), [tuple(r) for r in runs]))
    return sorted(out, key=str)


def found(spark, rows, length=20, k=8, parts=4):
    got = repeats.remove_repeats(frame(spark, rows).repartition(parts), length, k).collect()
    return sorted(((r["doc_id"], r["n_words"], r["kept"], [tuple(x) for x in r["removed"]]) for r in got), key=str)


def case(seed, documents=60):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randint(0, 400)
    passages = [[word() for _ in range(rng.randint(15, 70))] for _ in range(6)] + [["of", "the"] * 30, ["x"] * 45]
    rows = []
    for i in range(documents):
        ws = [word() for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            ws[(at := rng.randint(0, len(ws))) : at] = p[a : rng.randint(a + 1, len(p))]
        rows.append((rng.choice([i, i, -i]), rng.choice([" ", "\n", "  "]).join(ws)))
    return rows


@pytest.mark.parametrize("seed, length, k", [(1, 20, 8), (2, 20, 8), (3, 5, 5), (4, 12, 1)])
def test_agrees_with_all_windows(spark, seed, length, k):
    rows = case(seed)
    assert found(spark, rows, length, k) == brute(rows, length)


def test_edge_cases(spark, odd_rows):
    assert found(spark, odd_rows) == brute(odd_rows, 20)
    assert found(spark, []) == []
    same = [(i, "one two three " * 10) for i in range(30)]
    assert found(spark, same, parts=7) == brute(same, 20)


def test_many_blocks(spark, monkeypatch):
    """Blocks of a few hundred bytes: what one block holds first, another one removes."""
    monkeypatch.setattr(repeats.Blocks.__init__, "__defaults__", (400,))
    rows = case(9, 120)
    assert found(spark, rows) == brute(rows, 20)

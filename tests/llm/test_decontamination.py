import random
import re

from documents import frame
from revflow.llm import decontamination


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, length):
    out = []
    for i, t in docs:
        ws, hit, met = words(t), set(), set()
        for item, text in items:
            iw = words(text)
            n = min(length, len(iw))
            grams = {tuple(iw[j : j + n]) for j in range(len(iw) - n + 1)} if iw else set()
            for p in range(len(ws) - n + 1) if grams else ():
                if tuple(ws[p : p + n]) in grams:
                    hit |= set(range(p, p + n))
                    met.add("" if item is None else str(item))
        out.append((i, len(ws), len(hit), sorted(met), sorted(hit)))
    return sorted(out, key=str)


def found(spark, docs, items, length=10, k=5):
    frames = frame(spark, docs).repartition(3), frame(spark, items, "item_id string, text string, doc_id long, print long, item long, runs string")
    rows = decontamination.contaminated(*frames, words=length, k=k).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["spots"]) for r in rows), key=str)


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "é", "日本", "a-b", "don't"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(f"i{n}", text(rng.randint(8, 40))) for n in range(12)] + [("long", text(300)), ("rep", "of the " * 20)]
    items += [("short", "w1 w2"), ("one", "É"), ("none", " -- "), (None, text(15)), ("null", None), ("i3", text(12)), items[0]]
    docs = []
    for i in range(60):
        parts = [text(rng.randint(0, 25))]
        for _ in range(rng.randint(0, 2)):
            w = words(rng.choice(items)[1])
            if w:
                a = rng.randint(0, len(w) - 1)
                parts += [" ".join(w[a : a + rng.randint(5, 30)]).upper(), text(rng.randint(0, 4))]
        docs.append((i, ", ".join(parts)))
    return docs + [(99, docs[0][1]), (99, docs[1][1]), (5, docs[5][1]), (200, "the of " * 4000), (201, text(6000))], items


def test_agrees_with_all_windows(spark, odd_rows):
    docs, items = case(1)
    docs = docs + odd_rows
    assert found(spark, docs, items) == brute(docs, items, 10)


def test_other_lengths(spark):
    docs, items = case(2)
    assert found(spark, docs, items, 6, 6) == brute(docs, items, 6)
    assert found(spark, docs, items, 14, 3) == brute(docs, items, 14)


def test_long_items_only(spark):
    docs, items = case(3)
    items = [x for x in items if len(words(x[1])) >= 10]
    assert found(spark, docs, items) == brute(docs, items, 10)


def test_empty_tables(spark):
    docs, items = case(4)
    assert found(spark, [], items) == []
    assert found(spark, docs[:3], []) == brute(docs[:3], [], 10)
    assert found(spark, docs[:3], [("x", None)]) == brute(docs[:3], [], 10)


def test_no_python_on_the_way(spark):
    docs, items = case(5)
    frames = frame(spark, docs), frame(spark, items, "item_id string, text string")
    plan = decontamination.contaminated(*frames)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan

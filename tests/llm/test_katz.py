import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from revflow.llm import katz
from revflow.llm.blocks import Blocks, unpack
from revflow.llm.tables import crc_of_id


def brute(texts, train, order, least):
    """Katz scores by dictionaries; one (n_tokens, n_known, N, base, score) per text, and P(w | c) for checks of the norm."""
    docs = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["</s>"] for t in texts]
    counts = [None] + [
        Counter(tuple(d[i : i + n]) for d, t in zip(docs, train, strict=True) if t for i in range(len(d) - n + 1))
        for n in range(1, order + 1)
    ]
    total, types = sum(counts[1].values()), len(counts[1])
    discounts = [None]
    for n in range(1, order + 1):
        of = Counter(counts[n].values())
        discounts.append(katz.good_turing([of[r] for r in range(1, 7)], 1 if n == 1 else least).factor)

    def factor(n, c):
        return discounts[n][c] if c <= 5 else 1.0

    taken = sum((1 - factor(1, c)) * c for c in counts[1].values())
    scale, unknown = (total, taken / total) if taken > 0 else (total + 1, 1 / (total + 1))
    follow = {}
    for n in range(2, order + 1):
        for g, c in counts[n].items():
            if c >= least:
                follow.setdefault(g[:-1], []).append((g[-1], c))

    def p(word, context):
        n = len(context) + 1
        if n == 1:
            c = counts[1][(word,)]
            return factor(1, c) * c / scale if c else unknown
        kept = follow.get(context)
        if not kept:
            return p(word, context[1:])
        own = counts[n - 1][context]
        above = sum(factor(n, c) * c for _, c in kept)
        tight = above >= own * (1 - 1e-9)
        for w, c in kept:
            if w == word:
                return factor(n, c) * c / (own + tight)
        below = sum(p(w, context[1:]) for w, _ in kept)
        return (1 - above / (own + tight)) / (1 - below) * p(word, context[1:])

    rows = []
    for d in docs:
        base = sum(math.log10((counts[1][(w,)] + 1) / (total + types + 1)) for w in d)
        score = sum(math.log10(p(w, tuple(d[max(0, i - order + 1) : i]))) for i, w in enumerate(d))
        rows.append((len(d), sum(counts[1][(w,)] > 0 for w in d), total, base, score))
    return rows, p, counts


def corpus(n=120, seed=5):
    rng = random.Random(seed)
    words = ["the", "of", "a", "The", "cat", "dog", "é", "É", "runs", "x1", "and"] + [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.randint(0, 40))) for _ in range(n)]
    texts += [None, "", "   \n", "the\tof\x0bthe\x0c the\r\n of"] + [texts[0]] * 5 + ["the of " * 3000]
    return texts


@pytest.mark.parametrize("order, least", [(1, 2), (2, 2), (3, 2), (3, 1), (2, 3)])
def test_scores_agree_with_dictionaries(spark, order, least):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, train string").repartition(5)
    got = {r["doc_id"]: r for r in katz.katz_scores(docs, crc_of_id(7) != 2, order, least).collect()}
    train = [r[1] for r in docs.select("doc_id", (crc_of_id(7) != 2).alias("t")).orderBy("doc_id").collect()]
    wanted, p, counts = brute(texts, train, order, least)
    assert not all(train)
    for i, (n, known, total, base, score) in enumerate(wanted):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["train"]) == (n, known, total, train[i])
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(score, rel=1e-9)
    # every context's probabilities add up to one, the unknown word included
    vocabulary = [w for (w,) in counts[1]] + ["never seen"]
    for context in [(), ("the",), ("of",), ("w5",), ("never seen",)] + ([("the", "of"), ("of", "a")] if order == 3 else []):
        if len(context) < order:
            assert sum(p(w, context) for w in vocabulary) == pytest.approx(1, abs=1e-9)


def test_empty_table_and_no_training_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert katz.katz_scores(docs, F.lit(True)).collect() == []
    docs = spark.createDataFrame([(None, "a b"), (1, None)], "doc_id long, text string")
    got = katz.katz_scores(docs, F.lit(False)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in got} == {(None, 3, 0, 0, 0.0), (1, 1, 0, 0, 0.0)}


def test_held_out_text_is_likelier_than_under_single_words(spark):
    from revflow.llm.queries import QUERIES

    rows = QUERIES["op1_katz"](spark, "/root/testdata/sf0.001").filter("held_out").collect()
    assert rows and sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_query_is_a_model_of_all_triples(spark):
    """The registered query keeps every pair and triple of the training documents, those that occur once included."""
    from revflow.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", (crc_of_id(7) != 2).alias("t")).collect()
    wanted = brute([r["text"] for r in docs], [r["t"] for r in docs], 3, 1)[0]
    got = {r["doc_id"]: r for r in QUERIES["op1_katz"](spark, folder).collect()}
    for r, (n, known, total, base, score) in zip(docs, wanted, strict=True):
        g = got[r["doc_id"]]
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (n, known, total)
        assert g["base_score"] == pytest.approx(base, rel=1e-9) and g["score"] == pytest.approx(score, rel=1e-9)


def long_corpus():
    """Words of which a few are frequent and most are rare, so that nearly all triples occur once."""
    rng = np.random.default_rng(11)
    rows = [" ".join(f"w{x}" for x in rng.zipf(1.3, 400) % 20_000) for _ in range(600)]
    return [(i, t) for i, t in enumerate(rows)]


def test_bytes_stored_for_each_token(spark, tmp_path, monkeypatch):
    """Documents and answers together."""
    docs = spark.createDataFrame(long_corpus(), "doc_id long, text string").repartition(3)
    monkeypatch.setattr("revflow.llm.blocks.run_folder", lambda spark, name: f"{tmp_path}/{name}")
    rows = katz.katz_scores(docs, crc_of_id(7) != 2, 3, 1).collect()
    stored = sum(p.stat().st_size for p in tmp_path.rglob("*.parquet"))
    assert 0 < stored / sum(r["n_tokens"] for r in rows) < 5


def test_shuffle_files_are_removed_once_answers_are_stored(spark):
    docs = spark.createDataFrame(long_corpus()[:50], "doc_id long, text string").repartition(3)
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {p for f in manager.localDirs() for p in Path(f.getPath()).rglob("shuffle_*.data")}

    blocks = Blocks(docs.withColumn("train", F.lit(True)), encode=katz._tokens)
    before = files()
    katz.fit(blocks, 3, 1)
    assert not files() - before


@pytest.mark.parametrize("least", [1, 2])
def test_tables_have_every_kept_count_and_weight(spark, monkeypatch, least):
    texts = corpus()
    monkeypatch.setattr(Blocks.__init__, "__defaults__", (2000,))  # many blocks, of which one speaks for each n-gram
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (crc_of_id(7) != 2).alias("train"))
    model, tables = katz.fit(Blocks(docs, encode=katz._tokens), 3, least)
    train = [r[0] for r in docs.orderBy("doc_id").select("train").collect()]
    _, p, counts = brute(texts, train, 3, least)
    values = []
    for table in tables:
        parts = [unpack(r["body"]) for r in table.collect()]
        keys = np.concatenate([k for k, _ in parts])
        assert len(np.unique(keys)) == len(keys)
        values.append(sorted(np.concatenate([v for _, v in parts]).tolist()))
    for n, got in ((1, values[0]), (2, values[1]), (3, values[3])):
        assert got == sorted(c for c in counts[n].values() if n == 1 or c >= least)
    for n, got in ((2, values[2]), (3, values[4])):
        follow = defaultdict(list)
        for gram, c in counts[n].items():
            if c >= least:
                follow[gram[:-1]].append((gram[-1], c))
        factor = model.discounts[n].factor
        wanted = []
        for context, kept in follow.items():
            above, own = sum((factor[c] if c <= 5 else 1.0) * c for _, c in kept), counts[n - 1][context]
            tight = above >= own * (1 - 1e-9)
            wanted.append((-1 if tight else 1) * (1 - above / (own + tight)) / (1 - sum(p(w, context[1:]) for w, _ in kept)))
        assert got == pytest.approx(sorted(wanted), rel=1e-9)


def test_distinct_hashes_that_differ_in_their_lowest_bits_only():
    rng = np.random.default_rng(3)
    high = rng.integers(0, 2**63, 50, dtype=np.uint64) << np.uint64(8)
    for keys in (rng.choice(high, 500), rng.choice(high, 500) + rng.integers(0, 4, 500).astype(np.uint64), high[:1], high[:0]):
        for got, wanted in zip(katz._distinct(keys), np.unique(keys, return_inverse=True), strict=True):
            assert (got == wanted).all()
        assert (katz._keys(katz._near(np.unique(keys))) == np.unique(keys)).all()

import random

import numpy as np
import pyarrow as pa
import sentencepiece

from documents import frame
from revflow.llm import token_counts
from revflow.llm.tables import vocabulary
from revflow.llm.words import string_buffers

PATH = vocabulary("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_totals_agree_with_the_library(spark, odd_rows):
    docs = frame(spark, odd_rows).repartition(3)
    got = token_counts.count_tokens(docs, PATH, budget=20).collect()
    wanted = sorted((str(i), len((t or "").encode()), len(LIBRARY.encode(t or ""))) for i, t in odd_rows)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == wanted
    texts = {i: t or "" for i, t in odd_rows if i not in (None, 7, 11, 12)}
    for r in got:
        if r["doc_id"] in texts:
            text = texts[r["doc_id"]]
            counts = token_counts.unpack_counts(r["counts"])
            assert counts.tolist() == [len(LIBRARY.encode(text[:n])) for n in range(1, len(text) + 1)]
            fits = [n for n in range(len(text) + 1) if len(LIBRARY.encode(text[:n])) <= 20]
            assert r["fit_points"] == fits[-1] == token_counts.longest_prefix(r["counts"], 20)
            assert token_counts.tokens_of_prefix(r["counts"], 7) == len(LIBRARY.encode(text[:7]))
    assert token_counts.count_tokens(docs.limit(0), PATH).collect() == []


def test_random_texts():
    rng = random.Random(5)
    alphabet = "abcdethisnor  \n\t.,éß漢字▁🙂\x00<>0x41/=A"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 50))) for _ in range(4000)]
    texts += ["ab" * 3000, " " * 999, "x" + " " * 30 + "y", "漢" * 500]
    model = token_counts.pieces(PATH)
    counts, first = token_counts.prefix_counts(model, *string_buffers(pa.array(texts)))
    totals = [int(counts[b - 1]) if b > a else 0 for a, b in zip(first[:-1], first[1:], strict=True)]
    assert totals == [len(x) for x in LIBRARY.encode(texts)]
    for at in rng.sample(range(4000), 60):
        own = counts[first[at] : first[at + 1]].tolist()
        assert own == [len(LIBRARY.encode(texts[at][:n])) for n in range(1, len(texts[at]) + 1)]


def test_packed_counts():
    for counts in ([], [1], [1, 2, 1, 3, 3], [5, 900, 1]):
        assert token_counts.unpack_counts(token_counts.pack_counts(np.array(counts, np.int64))).tolist() == counts

import hashlib
import json
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from documents import frame
from revflow.llm import alignment
from revflow.llm.encoding import by_ranks, encoder
from revflow.llm.tables import vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def bytes_of_a():
    """The usual table of byte-level BPE, built from its rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    table |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return {i: bytes(table[c] for c in entry) for entry, i in json.load(open(A))["model"]["vocab"].items() if i != 50256}


def brute(docs):
    a_bytes = bytes_of_a()
    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True

    def ends(parts):
        out, at = [], 0
        for p in parts:
            at += len(p)
            out.append(at)
        return out

    found = []
    for doc, text in docs:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        parts_a = [a_bytes[i] for i in a]
        parts_b = []
        for i in b:
            piece = second.id_to_piece(i)
            parts_b.append(bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode())
        given = b" " + (text or "").encode()
        if not text or b"".join(parts_a) != given or b"".join(parts_b) != given:
            found.append((doc, [], [], [], ""))
            continue
        ends_a, ends_b = ends(parts_a), ends(parts_b)
        common = sorted(set(ends_a) & set(ends_b))
        groups, low = [], 0
        for end in common:
            groups.append(
                ",".join(str(i) for i, e in zip(a, ends_a, strict=True) if low < e <= end)
                + "|"
                + ",".join(str(i) for i, e in zip(b, ends_b, strict=True) if low < e <= end)
            )
            low = end
        at_a, at_b = dict(zip(ends_a, a, strict=True)), dict(zip(ends_b, b, strict=True))
        links = [(at_a[e], at_b[e]) for e in common]
        found.append((doc, a, b, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(link for _, _, _, links, _ in found for link in links)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return count, [
        (doc, len(a), len(b), len(links), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), digest)
        for doc, a, b, links, digest in found
    ]


@pytest.fixture
def corpus(odd_rows):
    short = [(i, t if t is None or len(t) < 5000 else t[:3000]) for i, t in odd_rows]
    return [*short, (90, "▁ mark"), (91, "ﬁ ligature ½"), (92, "á b​"), (93, " lead  and trail "), (94, "tab\tnew\nline"), (95, "the the the the")]


@pytest.mark.parametrize("limits", [(8192, 1 << 21), (300, 50)])
def test_against_brute_force(spark, corpus, monkeypatch, limits):
    monkeypatch.setattr(alignment, "BLOCK_DOCS", limits[0])
    monkeypatch.setattr(alignment, "BLOCK_POSTINGS", limits[1])
    count, wanted = brute(corpus)
    found = alignment.align(frame(spark, corpus).repartition(3), A, B)
    rows = [tuple(r) for r in alignment.document_scores(found).collect()]
    assert sorted(rows, key=str) == sorted(wanted, key=str)
    assert {(r["a"], r["b"]): r["links"] for r in found.counts.collect()} == count


def test_documents_of_pairs(spark):
    """The OR of the planes counts documents, the planes count links."""
    docs = [(i, " ".join(["alpha"] * (i % 5) + ["beta"])) for i in range(700)]
    found = alignment.align(frame(spark, docs).repartition(2), A, B)
    counts = {(r["a"], r["b"]): (r["documents"], r["links"]) for r in found.counts.collect()}
    held = Counter()
    per_pair = Counter()
    for doc in docs:
        own, _ = brute([doc])
        held.update(own.keys())
        per_pair.update(own)
    assert counts == {pair: (held[pair], per_pair[pair]) for pair in held}


def test_empty_tables(spark):
    assert alignment.document_scores(alignment.align(frame(spark, []), A, B)).collect() == []
    rows = alignment.document_scores(alignment.align(frame(spark, [(None, None), (1, "")]), A, B)).collect()
    assert sorted(map(tuple, rows), key=str) == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 8191), st.integers(1, 70_000)), min_size=1, max_size=60, unique_by=lambda x: x[:2]))
def test_containers(rows):
    rows.sort()
    pair, doc, times = (np.array(x) for x in zip(*rows, strict=True))
    starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    for own, a, b in zip(alignment.containers(starts, doc, times), starts, [*starts[1:], len(doc)], strict=True):
        assert alignment.popcounts(own) == (b - a, times[a:b].sum())
        back = Counter()
        for plane, kind, body in alignment.planes(own):
            back.update({int(d): 1 << plane for d in alignment.members(kind, body)})
        assert back == dict(zip(doc[a:b].tolist(), times[a:b].tolist(), strict=True))


def test_wide_planes_are_bits():
    docs = np.arange(3, 8000, 2)
    (own,) = alignment.containers(np.array([0]), docs, np.full(len(docs), 3))
    found = list(alignment.planes(own))
    assert [(p, k) for p, k, _ in found] == [(0, 1), (1, 1)] and alignment.popcounts(own) == (len(docs), 3 * len(docs))
    assert alignment.members(*found[0][1:]).tolist() == docs.tolist() and len(own) < 2 * len(docs)


def test_special_strings_are_ordinary_text():
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    texts = [" <|endoftext|> x", "<|endoftext|>", " " * 1_000_100]
    assert encoder(A, special=False)(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_other_files_go_to_their_library(tmp_path):
    """A file that normalises, splits or merges in another way is encoded by its own library."""
    spec = json.load(open(A))
    assert by_ranks(spec)
    other = dict(spec, normalizer={"type": "Lowercase"})
    prefix = dict(spec, pre_tokenizer=dict(spec["pre_tokenizer"], add_prefix_space=True))
    merges = dict(spec, model=dict(spec["model"], merges=spec["model"]["merges"][::-1]))
    for i, changed in enumerate((other, prefix, merges)):
        assert not by_ranks(changed)
        path = tmp_path / f"{i}.json"
        path.write_text(json.dumps(changed))
        texts = ["Hello World", "ABC <|endoftext|> x"]
        wanted = [e.ids for e in Tokenizer.from_file(str(path)).encode_batch(texts, add_special_tokens=False)]
        assert encoder(str(path))(texts) == wanted

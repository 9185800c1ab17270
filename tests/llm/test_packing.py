import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from documents import frame
from revflow.llm import packing
from revflow.llm.encoding import encoder
from revflow.llm.tables import vocabulary

PATH = vocabulary("byte_bpe_50k.json")


def test_round_trip(spark, odd_rows):
    docs = frame(spark, odd_rows).repartition(3)
    rows = packing.pack(docs, PATH, longest=64).collect()
    library = Tokenizer.from_file(PATH)
    wanted = sorted(([*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t in odd_rows), key=str)
    assert len({r["sequence_id"] for r in rows}) == len(rows)  # a sequence never holds two documents
    assert all(r["length"] & (r["length"] - 1) == 0 and r["length"] <= 64 and r["offset"] == 0 for r in rows)
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)
    assert all(r["sequence_id"] >> 58 == r["bucket"] == r["length"].bit_length() - 1 for r in rows)
    # pieces of a document follow each other; ids in order of sequences rebuild every text
    docs_found, pieces = [], sorted(rows, key=lambda r: (str(r["doc_id"]), r["doc_tokens"], r["start"]))
    by_doc = {}
    for r in pieces:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"], r["start"]), []).append(r)
    for r in rows:
        if r["start"] == 0:
            docs_found.append(r)
    assert len(docs_found) == len(odd_rows) and sum(r["length"] for r in rows) == sum(map(len, wanted))
    once = [i for i, _ in odd_rows if i is not None and [x for x, _ in odd_rows].count(i) == 1]
    for i in once:
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        ids = [x for r in own for x in r["ids"]]
        assert [r["start"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
        assert ids == [*library.encode(dict(odd_rows)[i] or "", add_special_tokens=False).ids, 0]


def test_cut_is_binary():
    assert packing.cut(1, 8) == [(0, 1)]
    assert packing.cut(29, 8) == [(0, 8), (8, 8), (16, 8), (24, 4), (28, 1)]
    with pytest.raises(ValueError):
        packing.pack(None, PATH, longest=100)


def test_empty_table(spark):
    assert packing.pack(frame(spark, []), PATH).collect() == []


def test_encoder_agrees_on_every_character():
    """The two libraries know different editions of Unicode; with these releases no character differs."""
    library, fast = Tokenizer.from_file(PATH), encoder(PATH)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 8192):
        texts = [f"a{c}1 {c}a!{c}  {c}{c} " for c in map(chr, points[at : at + 8192])]
        assert fast(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_long_runs_of_blanks():
    library = Tokenizer.from_file(PATH)
    texts = [" " * 1_100_000, "\n " * 300_000 + "x", "é!" * 20_000]
    assert encoder(PATH)(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]

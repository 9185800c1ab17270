import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from revflow.llm.words import find_words, slices, string_buffers, windows

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZé 日\t\n\x0b\x0c\r\x1c 🙂", max_size=30)), max_size=12)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.booleans())
def test_words_agree_with_a_pattern(texts, lower):
    words = find_words(*string_buffers(pa.array(texts, pa.string())), lower)
    fold = (lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)) if lower else (lambda t: t)
    wanted = [re.findall(r"[^\x20\x09-\x0D]+", fold(t or "")) for t in texts]
    assert np.diff(words.first).tolist() == [len(w) for w in wanted]
    flat = [w for ws in wanted for w in ws]
    found = [fold(words.data[a:b].tobytes().decode()) for a, b in zip(words.start, words.end, strict=True)]
    assert found == flat
    assert len({(w, h) for w, h in zip(flat, words.hash.tolist(), strict=True)}) == len(set(flat)) == len(set(words.hash.tolist()))


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_slices_hold_all_rows(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    ids, out = [], []
    for piece, offsets, data in slices(batch, limit=7):
        ids += piece.column("doc_id").to_pylist()
        out += [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert ids == list(range(len(texts))) and out == [t or "" for t in texts]


def test_windows_depend_on_content_only():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (50, 30))
    joined = np.concatenate([b, a, b])
    h = windows(joined, 5)
    assert (h[:26] == windows(b, 5)).all() and (h[30:76] == windows(a, 5)).all() and (h[80:] == windows(b, 5)).all()
    assert len(set(h[:80].tolist())) == 80

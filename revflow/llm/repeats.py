"""Removal of repeated substrings: seed with winnowed anchors, extend, keep maximal repeats.

Each window of ``length`` words has an anchor, the smallest hash among its
k-grams. Equal windows have equal anchors, so a window whose anchor occurs once
in the corpus occurs once, and is settled by the anchors alone. Around anchors
that recur, the matches are extended to both sides: all windows that hold the
anchor are compared by 96-bit hashes, and the place (document, word) where each
distinct window starts first is found. A window that starts anywhere else is
a repeat; overlapping repeats of a document join into maximal runs, whose words are removed.

Windows are asked for once per block of documents, however many copies a block
holds, and an answer is one bit: whether the block has the first place.

Edge cases: NULL and empty texts have no words. Texts of fewer words than a
window keep them all. Of windows in one document the earliest stays. Rows with equal
ids count as one document, so windows that start at the same word of them are
the same place; NULL ids count as one document behind all others. An empty table gives
an empty result; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revflow.llm.blocks import Blocks, cut, gather, grouped, joined, pack, unpack
from revflow.llm.words import Words, find_words, string_buffers, windows

_Q2 = 0xC2B2AE3D27D4EB4F
_ANCHORS, _WINDOWS = 1, 2


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def _starts(words: Words, length: int) -> np.ndarray:
    """First words of the windows that lie within one document."""
    size = np.diff(words.first)
    left = np.repeat(words.first[1:], size) - np.arange(len(words.hash))
    return np.flatnonzero(left >= length)


class _View:
    """The windows of a block."""

    def __init__(self, docs: pa.RecordBatch, length: int, k: int):
        offsets, data = string_buffers(docs.column("text"))
        self.words = find_words(offsets, data, lower=False)
        self.at = _starts(self.words, length)
        self.grams = windows(self.words.hash, k)
        least = _sliding_min(self.grams, length - k + 1)
        self.anchor = least[self.at] if len(self.at) else np.empty(0, np.uint64)
        self.length = length
        ids = docs.column("doc_id")
        self.missing = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = np.where(self.missing, np.iinfo(np.int64).max, ids.fill_null(0).to_numpy(zero_copy_only=False))
        self.doc = self.words.doc()

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors, sorted, and of each window the number of its anchor."""
        return np.unique(self.anchor, return_inverse=True)

    def recurring(self, answers: dict, ranges: int) -> np.ndarray:
        """The windows whose anchor occurs more than once in the corpus."""
        keys, number = self.anchors()
        if not len(keys):
            return np.empty(0, np.int64)
        many = np.concatenate([a[0] for a in gather(answers[_ANCHORS], keys, ranges)])
        return self.at[many[number]]

    def places(self, at: np.ndarray):
        """Distinct windows among those starting at ``at``: keys, checks and first places; and the number of each window."""
        key = windows(self.words.hash, self.length)[at]
        check = (windows(self.words.hash, self.length, _Q2)[at] >> np.uint64(32)).astype(np.uint32)
        doc, start = self.ids[self.doc[at]], at - self.words.first[self.doc[at]]
        order = np.lexsort((start, doc, check, key))
        new = np.ones(len(order), bool)
        k, c = key[order], check[order]
        new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        first = order[new]
        return key[first], check[first], doc[first], start[first], number, (doc, start)


def _anchor_question(length: int, k: int, ranges: int):
    def question(docs: pa.RecordBatch, answers: dict) -> dict[int, bytes]:
        view = _View(docs, length, k)
        keys = np.unique(view.anchor)
        # an anchor recurs within the block if its gram does
        order = np.sort(view.grams)
        twice = np.unique(order[1:][order[1:] == order[:-1]]) if len(order) > 1 else order[:0]
        many = np.isin(keys, twice, assume_unique=True)
        return {place: pack(keys[a:b], many[a:b]) for place, a, b in cut(keys, ranges)}

    return question


def _anchor_answer(bodies: list[bytes]):
    messages = [unpack(b) for b in bodies]
    keys, many = joined(messages, 0), joined(messages, 1)
    order, first = grouped(keys)
    size = np.diff(np.append(first, len(keys)))
    again = (size > 1) | np.logical_or.reduceat(many[order], first)
    out = np.empty(len(keys), bool)
    out[order] = np.repeat(again, size)
    ends = np.cumsum([len(m[0]) for m in messages])[:-1]
    return [pack(x) for x in np.split(out, ends)], [len(first), int(again.sum())]


def _window_question(length: int, k: int, ranges: int):
    def question(docs: pa.RecordBatch, answers: dict) -> dict[int, bytes]:
        view = _View(docs, length, k)
        key, check, doc, start, _, _ = view.places(view.recurring(answers, ranges))
        return {
            place: pack(key[a:b], check[a:b], doc[a:b], start[a:b].astype(np.uint32)) for place, a, b in cut(key, ranges)
        }

    return question


def _window_answer(bodies: list[bytes]):
    messages = [unpack(b) for b in bodies]
    key, check, doc, start = (joined(messages, i) for i in range(4))
    order = np.lexsort((start, doc, check, key))
    k, c, d, s = key[order], check[order], doc[order], start[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(order)))
    mine = (d == np.repeat(d[first], size)) & (s == np.repeat(s[first], size))
    out = np.empty(len(order), bool)
    out[order] = mine
    ends = np.cumsum([len(m[0]) for m in messages])[:-1]
    return [pack(x) for x in np.split(out, ends)], [len(first), int((size > 1).sum())]


def _kept(length: int, k: int, ranges: int):
    def use(block: int, docs: pa.RecordBatch, answers: dict) -> Iterator[pa.RecordBatch]:
        view = _View(docs, length, k)
        words = view.words
        at = view.recurring(answers, ranges)
        covered = np.zeros(len(words.hash) + 1, np.int64)
        if len(at):
            key, _, doc, start, number, (own_doc, own_start) = view.places(at)
            mine = np.concatenate([a[0] for a in gather(answers[_WINDOWS], key, ranges)])
            first = mine[number] & (own_doc == doc[number]) & (own_start == start[number])
            again = at[~first]
            np.add.at(covered, again, 1)
            np.add.at(covered, again + length, -1)
        gone = np.cumsum(covered[:-1]) > 0
        texts, spans = [], []
        stay = ~gone
        # bytes of the kept words, each followed by one space
        size = (words.end - words.start + 1)[stay]
        to = np.cumsum(size)
        source = np.repeat(words.start[stay] - (to - size), size) + np.arange(to[-1] if len(to) else 0)
        out = np.append(words.data, np.uint8(32))[np.minimum(source, len(words.data))]
        if len(to):
            out[to - 1] = 32
        bound = np.append(0, np.cumsum(stay))[words.first]  # kept words before each document
        place = np.append(0, to)
        for i in range(words.docs):
            a, b = bound[i], bound[i + 1]
            texts.append(out[place[a] : place[b] - 1].tobytes().decode("utf-8") if b > a else "")
            lo, hi = words.first[i], words.first[i + 1]
            mine = gone[lo:hi]
            if mine.any():
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]])))
                spans.append([{"start": int(x), "end": int(y)} for x, y in edges.reshape(-1, 2)])
            else:
                spans.append([])
        yield pa.RecordBatch.from_arrays(
            [
                docs.column("doc_id"),
                pa.array(np.diff(words.first).astype(np.int64)),
                pa.array(texts, pa.string()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ],
            ["doc_id", "n_words", "kept", "removed"],
        )

    return use


def remove_repeats(
    docs: DataFrame, length: int = 20, k: int = 8, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_words, kept (the words that stay, joined by spaces) and removed (runs of words, from and to).

    A word goes when it lies in a window of ``length`` words whose sequence also
    starts earlier, in a document with a smaller id or before in the same one.
    """
    if not 1 <= k <= length:
        raise ValueError("k must lie between 1 and the length")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    blocks = Blocks(rows)
    blocks.ask(_ANCHORS, _anchor_question(length, k, blocks.ranges), _anchor_answer)
    blocks.ask(_WINDOWS, _window_question(length, k, blocks.ranges), _window_answer)
    schema = "doc_id long, n_words long, kept string, removed array<struct<start:long,end:long>>"
    return blocks.each(_kept(length, k, blocks.ranges), schema)

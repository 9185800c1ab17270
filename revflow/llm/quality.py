"""Quality scores by a factorisation machine.

The inputs of a document are its distinct words, hashed to ``2**bits`` places
and scaled to unit length, and statistics of its structure and metadata: shares
of kinds of characters and words, repetition, line lengths, size. Every input has a weight and a
vector of ``rank`` numbers; two inputs interact by the product of their vectors. All
pairs together cost time linear in the inputs, as

    sum over pairs <v_i, v_j> x_i x_j = ((sum v_i x_i)^2 - sum (v_i x_i)^2) / 2

summed over the vector's places. Learning uses at most ``per_class`` labelled documents of each
class, those with the smallest hashes of their ids; scoring covers all documents and
whole texts. Neither reads labels, languages, sources or ids as inputs.

Edge cases: texts without words (empty or NULL) are scored by their statistics, which are
then zero. A NULL size is counted from the text. Without labelled documents of both
classes every score is the share of label 1 (0.5 without labels). NULL labels are not
learned from. Equal rows are scored each on its own, NULL ids stay NULL, an empty
table gives an empty result; columns beside id, text, size and the label are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revflow.llm.logistic import sigmoid
from revflow.llm.tables import frugal
from revflow.llm.words import find_words, slices

_KINDS = np.full(256, 6, np.uint8)  # other ASCII signs
_KINDS[65:91], _KINDS[97:123], _KINDS[48:58] = 0, 1, 2
_KINDS[[9, 11, 12, 13, 32]], _KINDS[10] = 3, 4
_KINDS[np.frombuffer(b".,;:'\"-?()", np.uint8)] = 5
_KINDS[128:] = 7
STATISTICS = 16
_BATCH, _LEAST_STEPS = 64, 1000


def statistics(offsets: np.ndarray, data: np.ndarray, words, sizes: np.ndarray) -> np.ndarray:
    """Numbers between 0 and 1 that describe each document's make-up; no text, no statistics."""
    docs = len(offsets) - 1
    out = np.zeros((docs, STATISTICS), np.float32)
    length = np.maximum(np.diff(offsets), 1)
    kinds = _KINDS[data]
    upto = np.zeros(len(data) + 1, np.int64)
    for kind in range(8):
        np.cumsum(kinds == kind, out=upto[1:])
        out[:, kind] = (upto[offsets[1:]] - upto[offsets[:-1]]) / length
    lines = out[:, 4] * length
    out[:, 4] = np.minimum(1, 20 * out[:, 4])  # line breaks are few
    n = np.diff(words.first)
    if len(words.hash):
        doc, many = words.doc(), np.maximum(n, 1)
        wide = words.end - words.start
        out[:, 8] = np.minimum(1, np.bincount(doc, wide, docs) / many / 20)
        signs = (kinds[words.end - 1] == 6).astype(float)  # words that end in a sign
        out[:, 9] = np.bincount(doc, signs, docs) / many
        bare = (_upto(kinds < 3, words.end) - _upto(kinds < 3, words.start) + _upto(kinds == 7, words.end) - _upto(kinds == 7, words.start)) == 0
        out[:, 10] = np.bincount(doc, bare.astype(float), docs) / many  # words without letters and digits
        same = np.zeros(len(doc))
        same[1:] = (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])
        out[:, 11] = np.bincount(doc, same, docs) / many
        order = np.lexsort((words.hash, doc))
        h, d = words.hash[order], doc[order]
        new = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]))
        times = np.diff(np.append(np.flatnonzero(new), len(h)))
        out[:, 12] = np.bincount(d[new], minlength=docs) / many  # distinct words
        top = np.zeros(docs)
        np.maximum.at(top, d[new], times)
        out[:, 13] = top / many * (n >= 5)
    out[:, 14] = np.minimum(1, np.log1p(sizes) / 15)
    out[:, 15] = np.minimum(1, np.log1p(n / (1 + lines)) / 8)  # words of a line
    return out


def _upto(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(flags))[at]


def inputs(sizes: pa.Array, offsets: np.ndarray, data: np.ndarray, bits: int):
    """Places of the distinct words of all documents, where each document's begin, and the statistics."""
    words = find_words(offsets, data, lower=False)
    place = (words.hash >> np.uint64(64 - bits)).astype(np.int64)
    pair = np.unique(words.doc() * (1 << bits) + place)
    first = np.searchsorted(pair, np.arange(words.docs + 1) << bits)
    sizes = sizes.to_numpy(zero_copy_only=False).astype(float)
    return (pair & ((1 << bits) - 1)).astype(np.int32), first, statistics(offsets, data, words, np.maximum(sizes, 0))


@dataclass
class Machine:
    bits: int
    constant: float
    weight: np.ndarray  # of words, then of statistics
    vector: np.ndarray  # a row for each

    def margin(self, places: np.ndarray, first: np.ndarray, stats: np.ndarray) -> np.ndarray:
        words = 1 << self.bits
        n = np.diff(first)
        x = 1 / np.sqrt(np.maximum(n, 1))
        full = np.flatnonzero(n > 0)
        linear, both, squares = np.zeros(len(n)), np.zeros((len(n), self.vector.shape[1])), np.zeros(len(n))
        if len(full):
            at = first[:-1][full]
            linear[full] = np.add.reduceat(self.weight[places], at) * x[full]
            v = self.vector[places]
            both[full] = np.add.reduceat(v, at, axis=0) * x[full, None]
            squares[full] = np.add.reduceat((v * v).sum(axis=1), at) * x[full] ** 2
        linear += stats @ self.weight[words:]
        both += stats @ self.vector[words:]
        squares += (stats**2) @ (self.vector[words:] ** 2).sum(axis=1)
        return self.constant + linear + 0.5 * ((both**2).sum(axis=1) - squares)


def learn(
    places: np.ndarray, first: np.ndarray, stats: np.ndarray, y: np.ndarray, bits: int, rank: int, epochs: int, seed: int = 1
) -> Machine:
    """Stochastic gradient descent with one adaptive rate per parameter, on logistic loss."""
    rng = np.random.default_rng(seed)
    words = 1 << bits
    size = words + stats.shape[1]
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    m = Machine(bits, float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.05, (size, rank)))
    sum_w, sum_v, sum_c = np.full(size, 1e-2), np.full((size, rank), 1e-2), 1e-2
    n = np.diff(first)
    x = 1 / np.sqrt(np.maximum(n, 1))
    rate, decay = 0.1, 1e-4
    epochs = max(epochs, -(-_LEAST_STEPS * _BATCH // max(1, len(y))))  # few documents are seen more often
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(y)), max(1, len(y) // _BATCH)):
            cells = np.concatenate([places[first[d] : first[d + 1]] for d in batch]) if len(batch) else places[:0]
            bounds = np.append(0, np.cumsum(n[batch]))
            error = (sigmoid(m.margin(cells, bounds, stats[batch])) - y[batch]) / len(batch)
            row = np.repeat(np.arange(len(batch)), n[batch])
            value, s = x[batch][row], stats[batch]
            both = s @ m.vector[words:]
            np.add.at(both, row, m.vector[cells] * value[:, None])
            # word parameters that the batch touches
            hit, number = np.unique(cells, return_inverse=True)
            g_w = np.bincount(number, error[row] * value, len(hit)) + decay * m.weight[hit]
            each = (error[row] * value)[:, None] * (both[row] - m.vector[cells] * value[:, None])
            g_v = np.zeros((len(hit), rank))
            np.add.at(g_v, number, each)
            g_v += decay * m.vector[hit]
            sum_w[hit] += g_w**2
            sum_v[hit] += g_v**2
            m.weight[hit] -= rate * g_w / np.sqrt(sum_w[hit])
            m.vector[hit] -= rate * g_v / np.sqrt(sum_v[hit])
            own = slice(words, None)
            g_w = s.T @ error + decay * m.weight[own]
            g_v = s.T @ (error[:, None] * both) - (s**2).T @ error[:, None] * m.vector[own] + decay * m.vector[own]
            sum_w[own] += g_w**2
            sum_v[own] += g_v**2
            m.weight[own] -= rate * g_w / np.sqrt(sum_w[own])
            m.vector[own] -= rate * g_v / np.sqrt(sum_v[own])
            g_c = error.sum()
            sum_c += g_c**2
            m.constant -= rate * g_c / np.sqrt(sum_c)
    return m


# --- documents ----------------------------------------------------------------------------------


def _rows(docs: DataFrame, doc_id: str, text: str, size: str | None):
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), _size(text, size).alias("size"))


def _size(text: str, size: str | None) -> Column:
    counted = F.char_length(F.coalesce(F.col(text), F.lit("")))
    return (F.coalesce(F.col(size), counted) if size else counted).cast("long")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 4000,
    bits: int = 18,
    rank: int = 8,
    epochs: int = 12,
    doc_id: str = "doc_id",
    text: str = "text",
    size: str | None = "n_chars",
) -> Machine:
    """Learn from ``labels`` (doc_id, label 0/1) of ``docs``."""
    frugal(docs.sparkSession)
    known = labels.filter("label IN (0, 1) AND doc_id IS NOT NULL")
    spread = F.xxhash64(F.col("doc_id"), F.lit(4))
    parts = [known.filter(F.col("label") == v).orderBy(spread, "doc_id").limit(per_class) for v in (0, 1)]
    sample = parts[0].union(parts[1])

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, offsets, data in slices(batch):
                places, first, stats = inputs(piece.column("size"), offsets, data, bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("label"),
                        pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(places)),
                        pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), STATISTICS).cast(pa.list_(pa.float32())),
                    ],
                    ["doc_id", "label", "places", "stats"],
                )

    schema = "doc_id long, label int, places array<int>, stats array<float>"
    chosen = _rows(docs, doc_id, text, size).join(F.broadcast(sample), "doc_id")  # at most 2 * per_class ids
    got = chosen.select("doc_id", "text", "size", F.col("label").cast("int").alias("label")).mapInArrow(described, schema)
    got = got.orderBy("doc_id", "label", F.xxhash64("places")).toArrow()
    y = got.column("label").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        share = known.select(F.avg("label")).first()[0]
        share = 0.5 if share is None else min(max(share, 1e-6), 1 - 1e-6)
        total = (1 << bits) + STATISTICS
        return Machine(bits, float(np.log(share / (1 - share))), np.zeros(total), np.zeros((total, rank)))
    places = got.column("places").combine_chunks()
    places = places.chunk(0) if isinstance(places, pa.ChunkedArray) else places
    stats = got.column("stats").combine_chunks()
    stats = stats.chunk(0) if isinstance(stats, pa.ChunkedArray) else stats
    first = places.offsets.to_numpy().astype(np.int64)
    cells = places.values.to_numpy()[first[0] : first[-1]]
    return learn(cells, first - first[0], stats.flatten().to_numpy().reshape(-1, STATISTICS).astype(float), y, bits, rank, epochs)


def score_quality(
    docs: DataFrame, machine: Machine, doc_id: str = "doc_id", text: str = "text", size: str | None = "n_chars"
) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # 2**bits rows of rank + 1 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for piece, offsets, data in slices(batch):
                score = sigmoid(own.margin(*inputs(piece.column("size"), offsets, data, own.bits)))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return _rows(docs, doc_id, text, size).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, machine: Machine, least: float, text: str = "text", size: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is at least ``least``."""
    helper = "size"
    while helper in {c.lower() for c in docs.columns}:  # names are compared as Spark compares them
        helper += "_"
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for piece, offsets, data in slices(batch, text):
                good = sigmoid(own.margin(*inputs(piece.column(helper), offsets, data, own.bits))) >= least
                yield piece.drop_columns([helper]).filter(pa.array(good))

    return docs.withColumn(helper, _size(text, size)).mapInArrow(run, docs.schema)

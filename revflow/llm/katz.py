"""Katz back-off scores of documents under a model of the corpus.

Counts of each order are gathered over all training documents by hash range, with
the back-off weights of their contexts, and stored in the answers to the blocks that hold
them. Each kept n-gram has one block that speaks for it; the tables that ``fit`` returns are
made from blocks and answers when they are read. An n-gram of two or
more words is kept if it occurs ``least`` times; counts up to five are
discounted by Good-Turing, and the mass that discounts and dropped n-grams leave in a
context goes to the next lower order, with a weight that makes the
probabilities of each context add up to one:

    P(w | c) = d * n(c w) / n(c)        where c w is kept
             = weight(c) * P(w | c')    elsewhere, c' without the first word

Single words end the recursion: discounted counts, and for all unknown words
together what these leave. Every document ends with one end token. Documents
have no token before the first word, whose context is empty.

An n-gram can only be kept if the two (n-1)-grams inside it occur as often, so
only such candidates are counted at all; all others occur once, and their
number enters the Good-Turing estimate.

Documents are stored as numbers of their block's distinct words. Blocks name an n-gram by its
hash once, when its count is asked; the answer tells its place among the keys of the range, by
which its weight is asked then. All weights are made, and go to the blocks that back off in the context;
the others learn only whether its counts are divided by one more.

If discounts leave a context no mass, its counts are divided by n(c) + 1, which
leaves some. If the counts of counts give no valid discounts, half a count is taken off each.

Edge cases: NULL and empty texts have the end token only. Without any training
documents every token is unknown, with probability 1. Equal rows count as often as
they occur, NULL ids stay NULL, an empty table gives an empty result; only the
id, text and training columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revflow.llm.blocks import Blocks, cut, gather, grouped, joined, pack, unpack
from revflow.llm.words import find_words, mix, span, string_buffers, sums

_END = np.uint64(0x51ED270B7A1F3C95)  # stands for the end of a document
_Q = 0xD6E8FEB86659FD93
_BLOCK = 6 << 20  # bytes of text: larger blocks repeat fewer n-grams
_TOP = 5  # counts above are not discounted


@dataclass
class Discounts:
    """Factors of counts 1 to 5 (index 0 is not used); higher counts keep their value."""

    factor: np.ndarray

    def of(self, counts: np.ndarray) -> np.ndarray:
        return np.append(self.factor, 1.0)[np.minimum(counts, _TOP + 1)]


def good_turing(of_counts: list[int], least: int) -> Discounts:
    """From the number of types that occur once, twice, ... six times; counts below ``least`` get nothing."""
    n = [0, *of_counts]
    factor = np.ones(_TOP + 1)
    common = (_TOP + 1) * n[_TOP + 1] / n[1] if n[1] else 1.0
    valid = common < 1 and all(n[1 : _TOP + 2])
    if valid:
        for r in range(1, _TOP + 1):
            factor[r] = ((r + 1) * n[r + 1] / (n[r] * r) - common) / (1 - common)
    if not valid or (factor[least:] <= 0).any() or (factor[least:] > 1).any():
        factor[1:] = [(r - 0.5) / r for r in range(1, _TOP + 1)]
    factor[:least] = 0.0
    return Discounts(factor)


@dataclass
class Model:
    """What blocks need to know beside the answers to their questions."""

    order: int
    least: int
    ranges: int
    tokens: int = 0
    types: int = 0
    unknown: float = 1.0  # probability of all unknown words
    scale: int = 1  # divides the counts of single words
    discounts: list[Discounts] | None = None


def _count_step(order: int) -> int:
    return 2 * order


def _weight_step(order: int) -> int:
    return 2 * order + 1


# --- short arrays -------------------------------------------------------------------------------


def _small(a: np.ndarray) -> np.ndarray:
    """Numbers from 0 in the smallest type that has them."""
    return a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a.astype(np.uint8)


def _steps(places: np.ndarray) -> np.ndarray:
    """Rising numbers as their differences, of which ``_rising`` makes them again."""
    return _small(np.diff(places, prepend=0))


def _rising(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.int64)


def _near(keys: np.ndarray) -> np.ndarray:
    """Sorted hashes as their differences, which are shorter; ``_keys`` makes them again."""
    return np.diff(keys, prepend=np.uint64(0))


def _keys(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and the number of each one, as ``np.unique`` has them.

    Sorts the upper bits with the place below them, several times as fast; where hashes differ in the lower bits
    alone, ``np.unique`` takes over.
    """
    n = len(keys)
    low = np.uint64(max(1, n - 1).bit_length())
    places = np.arange(n, dtype=np.uint64)
    order = (keys >> low << low) | places
    order.sort()
    order = (order & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    inn = keys[order]
    if (inn[1:] < inn[:-1]).any():
        return np.unique(keys, return_inverse=True)
    new = np.append(True, inn[1:] != inn[:-1])[:n]
    number = np.empty(n, np.int64)
    number[order] = np.cumsum(new) - 1
    return inn[new], number


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct doubles, and the number of each one: of few counts come few different probabilities."""
    distinct, number = np.unique(values, return_inverse=True)
    return distinct, _small(number)


# --- blocks -------------------------------------------------------------------------------------


def _tokens(docs: pa.RecordBatch) -> pa.RecordBatch:
    """Ids, folds and sizes of a block's documents; the first row also has the distinct words and the tokens' numbers."""
    offsets, data = string_buffers(docs.column("text"))
    words = find_words(offsets, data, lower=True)
    tokens = np.insert(words.hash, words.first[1:], _END)
    keys, number = _distinct(mix(tokens + np.uint64(1)))
    size = np.diff(words.first) + 1
    return pa.RecordBatch.from_arrays(
        [
            docs.column("doc_id"),
            docs.column("train").fill_null(False),
            pa.array(size.astype(np.int64)),
            pa.array([pack(_near(keys), _small(number)), *[None] * (len(size) - 1)], pa.large_binary()),
        ],
        ["doc_id", "train", "size", "tokens"],
    )


class _View:
    """The tokens of a block, and what is known about the n-grams that end at each."""

    def __init__(self, docs: pa.RecordBatch, model: Model):
        words, number = unpack(docs.column("tokens")[0].as_py())
        self.words = _keys(words)
        self.number = number.astype(np.int64)
        self.tokens = self.words[self.number]
        size = docs.column("size").to_numpy()
        self.first = np.append(0, np.cumsum(size))
        self.doc = np.repeat(np.arange(len(size)), size)
        self.depth = np.arange(len(self.tokens)) - np.repeat(self.first[:-1], size)  # tokens before, in the document
        train = docs.column("train").to_numpy(zero_copy_only=False).astype(bool)
        self.train = train[self.doc]
        self.docs = len(size)
        self.prefix = sums(self.tokens, _Q)
        self.model = model
        self._sorted: dict[int, tuple] = {}
        self._asked: dict[int, np.ndarray] = {}
        self._counts: dict[int, np.ndarray] = {}
        self._shares: dict[int, tuple] = {}
        self._contexts: dict[int, tuple] = {}
        self._weights: dict[int, np.ndarray] = {}

    def grams(self, order: int, ends: np.ndarray) -> np.ndarray:
        """Hashes of the n-grams that end at the given tokens."""
        return mix(span(self.prefix, ends - order + 1, ends + 1, _Q) + np.uint64(order))

    def distinct(self, order: int, answers: dict):
        """Distinct candidates of an order: keys in order, training counts, and the number of each candidate."""
        if order not in self._sorted:
            at = self.candidates(order, answers)
            keys, number = (self.words, self.number) if order == 1 else _distinct(self.grams(order, at))
            self._sorted[order] = keys, np.bincount(number, self.train[at], len(keys)).astype(np.uint32), number
        return self._sorted[order]

    def candidates(self, order: int, answers: dict) -> np.ndarray:
        """Tokens at which an n-gram may be kept: both n-grams of the lower order inside it are."""
        if order not in self._asked:
            if order == 1:
                out = np.arange(len(self.tokens))
            else:
                good = self.counts(order - 1, answers) >= self.model.least
                out = np.flatnonzero(good[1:] & good[:-1] & (self.depth[1:] >= order - 1)) + 1
            self._asked[order] = out
        return self._asked[order]

    def _answered(self, order: int, answers: dict) -> np.ndarray:
        keys = self.distinct(order, answers)[0]
        if not len(keys):
            return np.empty(0, np.int64)
        return np.concatenate([a[0] for a in gather(answers[_count_step(order)], keys, self.model.ranges)]).astype(np.int64)

    def places(self, order: int, answers: dict) -> np.ndarray:
        """Place of each distinct candidate among the keys of its range."""
        keys = self.distinct(order, answers)[0]
        if not len(keys):
            return np.empty(0, np.int64)
        return np.concatenate([_rising(a[1]) for a in gather(answers[_count_step(order)], keys, self.model.ranges)])

    def counts(self, order: int, answers: dict) -> np.ndarray:
        """Training count of the n-gram that ends at each token; 0 if it was no candidate."""
        if order not in self._counts:
            out = np.zeros(len(self.tokens), np.int64)
            got = self._answered(order, answers)
            out[self.candidates(order, answers)] = (got >> 1)[self.distinct(order, answers)[2]]
            self._counts[order] = out
        return self._counts[order]

    def spoken(self, order: int, answers: dict) -> np.ndarray:
        """Whether this block speaks for the n-gram that ends at each token; true at one end of each such n-gram."""
        at, (keys, _, number) = self.candidates(order, answers), self.distinct(order, answers)
        first = np.empty(len(keys), np.int64)
        first[number[::-1]] = np.arange(len(number))[::-1]
        out = np.zeros(len(self.tokens), bool)
        out[at[first]] = (self._answered(order, answers) & 1).astype(bool)
        return out

    def contexts(self, order: int, answers: dict):
        """Tokens whose context may have kept n-grams, the distinct contexts (numbers of the lower order), and each token's context."""
        if order not in self._contexts:
            good = self.counts(order - 1, answers) >= self.model.least
            at = np.flatnonzero(good[:-1] & (self.depth[1:] >= order - 1)) + 1
            # contexts are candidates of the lower order, whose numbers follow the order of their keys
            keys, _, number = self.distinct(order - 1, answers)
            place = np.empty(len(self.tokens), np.int64)
            place[self.candidates(order - 1, answers)] = number
            place = place[at - 1]
            used = np.zeros(len(keys), bool)
            used[place] = True
            self._contexts[order] = at, np.flatnonzero(used), (np.cumsum(used) - 1)[place]
        return self._contexts[order]

    def weights(self, order: int, answers: dict) -> np.ndarray:
        """Weight of each distinct context, negative where counts are divided by one more.

        Where no token of this block backs off in the context, the size of the weight is one.
        """
        if order not in self._weights:
            keys = self.distinct(order - 1, answers)[0][self.contexts(order, answers)[1]]
            messages = gather(answers[_weight_step(order)], keys, self.model.ranges)
            tight, given = joined(messages, 0), joined(messages, 1)
            out = np.ones(len(keys))
            out[given] = np.concatenate([m[2][m[3]] for m in messages])
            self._weights[order] = np.where(tight, -out, out)
        return self._weights[order]

    def probabilities(self, order: int, answers: dict) -> np.ndarray:
        """P(token | up to order - 1 tokens before it), evaluated from the lower orders up."""
        m = self.model
        count = self.counts(1, answers)
        p = np.where(count > 0, m.discounts[1].of(count) * count / m.scale, m.unknown) if m.tokens else np.ones(len(count))
        for n in range(2, order + 1):
            p = self.backed_off(n, p, answers)
        return p

    def backed_off(self, n: int, lower: np.ndarray, answers: dict) -> np.ndarray:
        """Probabilities of order n from those of the order below; contexts without kept n-grams have weight one."""
        m = self.model
        at, _, number = self.contexts(n, answers)
        if not len(at):
            return lower
        out = lower.copy()
        out[at] *= np.abs(self.weights(n, answers))[number]
        kept = at[self.counts(n, answers)[at] >= m.least]
        above, own = self.share(n, answers)
        out[kept] = above[kept] / own[kept]
        return out

    def share(self, n: int, answers: dict) -> tuple[np.ndarray, np.ndarray]:
        """Discounted count of the n-gram that ends at each token, and the count of its context; of use where it is kept."""
        if n not in self._shares:
            m, count = self.model, self.counts(n, answers)
            own = np.full(len(count), m.scale, np.int64)
            if n > 1:
                at, _, number = self.contexts(n, answers)
                if len(at):
                    own[at] = self.counts(n - 1, answers)[at - 1] + (self.weights(n, answers) < 0)[number]
            self._shares[n] = m.discounts[n].of(count) * count, own
        return self._shares[n]


# --- questions ----------------------------------------------------------------------------------


def _questions(model: Model, **of_orders: int):
    """Questions about the counts and the weights of the given orders, put by a block at once."""

    def questions(docs: pa.RecordBatch, answers: dict) -> dict[int, dict[int, bytes]]:
        view, out = _View(docs, model), {}
        if "counts" in of_orders:
            out[_count_step(of_orders["counts"])] = _count_messages(of_orders["counts"], view, answers)
        if "weights" in of_orders:
            found = _weight_messages(of_orders["weights"], view, answers)
            out[_weight_step(of_orders["weights"])] = {place: body for place, (body, _) in found.items()}
        return out

    return questions


def _count_messages(order: int, view: _View, answers: dict) -> dict[int, bytes]:
    at = view.candidates(order, answers)
    keys, counts, _ = view.distinct(order, answers)
    # occurrences in training that cannot be kept are n-grams that occur once
    others = int(((view.depth >= order - 1) & view.train).sum() - view.train[at].sum())
    out = {}
    for place, a, b in cut(keys, view.model.ranges):
        out[place] = pack(_near(keys[a:b]), _small(counts[a:b]), np.array([0 if out else others], np.int64))
    return out or ({0: pack(keys, counts, np.array([others], np.int64))} if others else {})


def _count_answer(bodies: list[bytes]):
    messages = [unpack(b) for b in bodies]
    keys, counts = np.concatenate([_keys(m[0]) for m in messages]), joined(messages, 1).astype(np.int64)
    once = sum(int(m[2][0]) for m in messages)
    if not len(keys):
        return [pack(np.empty(0, np.uint8), np.empty(0, np.uint8)) for _ in messages], [0, 0, once, 0, 0, 0, 0, 0]
    order, first = grouped(keys)
    total = np.add.reduceat(counts[order], first)
    size = np.diff(np.append(first, len(keys)))
    speaks = np.zeros(len(keys), np.int64)
    speaks[first] = 1  # of equal keys the first block's message leads
    out, place = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
    out[order] = (np.repeat(total, size) << 1) | speaks
    place[order] = np.repeat(np.arange(len(first)), size)
    ends = np.cumsum([len(m[0]) for m in messages])[:-1]
    of_counts = [int((total == r).sum()) for r in range(1, _TOP + 2)]
    of_counts[0] += once
    figures = [int(total.sum()) + once, int((total > 0).sum()), *of_counts]
    return [pack(_small(x), _steps(p)) for x, p in zip(np.split(out, ends), np.split(place, ends), strict=True)], figures


def _weight_messages(order: int, view: _View, answers: dict) -> dict[int, tuple[bytes, np.ndarray]]:
    """By range: the message, and the keys of the contexts in it."""
    at, used, number = view.contexts(order, answers)
    if not len(at):
        return {}
    model = view.model
    keys, places = view.distinct(order - 1, answers)[0][used], view.places(order - 1, answers)[used]
    own = (view._answered(order - 1, answers) >> 1)[used]
    count = view.counts(order, answers)[at]
    kept = count >= model.least
    need = np.zeros(len(keys), bool)
    need[number[~kept]] = True  # some token backs off in this context
    mine = np.flatnonzero(view.spoken(order, answers)[at] & kept)
    ends, count, number = at[mine], count[mine], number[mine]
    above = np.bincount(number, model.discounts[order].of(count) * count, len(keys))
    # what is kept here is kept in the lower order, whose probabilities of these words have one denominator in a context
    parts, divisor = view.share(order - 1, answers)
    below = np.bincount(number, parts[ends], len(keys))
    under = np.ones(len(keys), np.int64)
    under[number] = divisor[ends]
    some = above > 0
    out = {}
    for place, a, b in cut(keys, model.ranges):
        s = some[a:b]
        told = [_small(own[a:b][s]), *_coded(above[a:b][s]), *_coded(below[a:b][s]), _small(under[a:b][s])]
        out[place] = pack(_steps(places[a:b]), need[a:b], s, *told), keys[a:b]
    return out


def _weights_of_range(messages: list[list[np.ndarray]]):
    """Places that each message asks about; by place: the weight, whether there is one, and whether counts are divided by one more."""
    asked = [_rising(m[0]) for m in messages]
    place = np.concatenate(asked)
    n, at = int(place.max()) + 1, place[joined(messages, 2)]
    total, under = np.zeros(n), np.ones(n)
    total[at], under[at] = joined(messages, 3), joined(messages, 8)
    above = np.bincount(at, np.concatenate([m[4][m[5]] for m in messages]), n)
    below = np.bincount(at, np.concatenate([m[6][m[7]] for m in messages]), n) / under
    has = above > 0
    tight = has & (above >= total * (1 - 1e-9))
    rest = 1 - above / np.maximum(total + tight, 1)
    return asked, np.where(has, rest / np.maximum(1 - below, 1e-300), 1.0), has, tight


def _weight_answer(bodies: list[bytes]):
    messages = [unpack(b) for b in bodies]
    asked, weight, has, tight = _weights_of_range(messages)
    out = []
    for p, m in zip(asked, messages, strict=True):
        given = has[p] & m[1]
        out.append(pack(tight[p], given, *_coded(weight[p[given]])))
    return out, [int(has.sum())]


# --- tables -------------------------------------------------------------------------------------


def _count_table(blocks: Blocks, order: int, model: Model) -> DataFrame:
    """Kept n-grams and their counts by range, from the blocks that speak for them."""

    def use(block: int, docs: pa.RecordBatch, answers: dict) -> Iterator[pa.RecordBatch]:
        view = _View(docs, model)
        keys, got = view.distinct(order, answers)[0], view._answered(order, answers)
        mine = (got & 1 > 0) & (got >> 1 >= (1 if order == 1 else model.least))
        keys, counts = keys[mine], got[mine] >> 1
        parts = cut(keys, model.ranges)
        bodies = [pack(keys[a:b], counts[a:b]) for _, a, b in parts]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _, _ in parts], pa.int32()), pa.array(bodies, pa.binary())], ["place", "body"])

    def of_range(table: pa.Table) -> pa.Table:
        messages = [unpack(b) for b in table.column("body").to_pylist()]
        keys, counts = joined(messages, 0), joined(messages, 1)
        order = np.argsort(keys, kind="stable")
        return _part(table, keys[order], counts[order])

    return blocks.each(use, "place int, body binary").groupBy("place").applyInArrow(of_range, "place int, body binary")


def _weight_table(blocks: Blocks, order: int, model: Model) -> DataFrame:
    """Contexts and their weights by range, negative where counts are divided by one more."""
    def use(block: int, docs: pa.RecordBatch, answers: dict) -> Iterator[pa.RecordBatch]:
        found = _weight_messages(order, _View(docs, model), answers)
        keys = [pack(k) for _, k in found.values()]
        columns = [pa.array(list(found), pa.int32()), pa.array([m for m, _ in found.values()], pa.binary()), pa.array(keys, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["place", "body", "keys"])

    def of_range(table: pa.Table) -> pa.Table:
        asked, weight, has, tight = _weights_of_range([unpack(b) for b in table.column("body").to_pylist()])
        keys = np.zeros(len(weight), np.uint64)
        for places, blob in zip(asked, table.column("keys").to_pylist(), strict=True):
            keys[places] = unpack(blob)[0]
        return _part(table, keys[has], np.where(tight, -weight, weight)[has])

    messages = blocks.each(use, "place int, body binary, keys binary")
    return messages.groupBy("place").applyInArrow(of_range, "place int, body binary")


def _part(table: pa.Table, keys: np.ndarray, values: np.ndarray) -> pa.Table:
    return pa.table({"place": table.column("place").slice(0, 1), "body": pa.array([pack(keys, values)], pa.binary())})


def _score(model: Model):
    def use(block: int, docs: pa.RecordBatch, answers: dict) -> Iterator[pa.RecordBatch]:
        view = _View(docs, model)
        count = view.counts(1, answers)
        base = np.log10((count + 1) / (model.tokens + model.types + 1))
        p = np.log10(view.probabilities(model.order, answers))
        starts = view.first[:-1]
        yield pa.RecordBatch.from_arrays(
            [
                docs.column("doc_id"),
                docs.column("train"),
                pa.array(np.diff(view.first).astype(np.int64)),
                pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                pa.array(np.full(view.docs, model.tokens, np.int64)),
                pa.array(np.add.reduceat(base, starts)),
                pa.array(np.add.reduceat(p, starts)),
            ],
            ["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return use


def fit(blocks: Blocks, order: int, least: int) -> tuple[Model, list[DataFrame]]:
    """Gather counts and weights of all orders of blocks of ``_tokens``; also returns their tables (packed keys and values
    by range), made when they are read."""
    model, tables = Model(order, least, blocks.ranges, discounts=[None] * (order + 1)), []
    step = _count_step(1)
    sums = blocks.ask_together(_questions(model, counts=1), {step: _count_answer})[step]
    tables.append(_count_table(blocks, 1, model))
    model.tokens, model.types, *of_counts = sums or [0] * 8
    model.discounts[1] = good_turing(of_counts, 1)
    model.scale = model.tokens
    if model.tokens:
        f = model.discounts[1].factor
        taken = sum((1 - f[r]) * r * of_counts[r - 1] for r in range(1, _TOP + 1))
        model.unknown = taken / model.tokens
        if taken <= 0:
            model.scale, model.unknown = model.tokens + 1, 1 / (model.tokens + 1)
    for n in range(2, order + 2):  # the weights of an order are asked together with the counts of the next one
        ask, answers = {}, {}
        if n <= order:
            ask["counts"], answers[_count_step(n)] = n, _count_answer
        if n > 2:
            ask["weights"], answers[_weight_step(n - 1)] = n - 1, _weight_answer
        if not ask:
            break
        sums = blocks.ask_together(_questions(model, **ask), answers)
        if n > 2:
            tables.append(_weight_table(blocks, n - 1, model))
        if n <= order:
            tables.append(_count_table(blocks, n, model))
            model.discounts[n] = good_turing((sums[_count_step(n)] or [0] * 8)[2:], least)
    return model, tables


def katz_scores(
    docs: DataFrame, train: Column, order: int = 2, least: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score and score for each row of ``docs``.

    ``train`` says from which rows to learn. ``score`` is the log10 probability of
    the text; ``base_score`` that of add-one single words.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), train.alias("train")
    )
    blocks = Blocks(rows, _BLOCK, encode=_tokens)
    model, _ = fit(blocks, order, least)
    schema = (
        "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return blocks.each(_score(model), schema)

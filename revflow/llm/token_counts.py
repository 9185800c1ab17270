"""Exact token counts at every prefix of a text, by dynamic programming.

The vocabulary is a sentence-piece BPE model. The encoding of a text ends in
exactly one token that may follow the encoding of what precedes it: two tokens
may be neighbours when encoding their two strings together gives these two
again. So the last token of each prefix follows from the last tokens of shorter
prefixes, and the count at a prefix is the count before its last token plus one.

The recursion runs over words (a run of spaces and what follows it), since no
piece of the model goes on across a space, and over all distinct words of a
batch at once, position by position. Counts at word ends are summed along the
document. The stored counts answer how many tokens any prefix has and how much
text fits a budget, without encoding again.

Edge cases: NULL and empty texts have no bytes and no tokens. Characters
outside the vocabulary count one token per byte. Texts without spaces are one
word, however long. Equal rows are counted each on its own, NULL ids stay NULL,
an empty table gives an empty result, and only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revflow.llm.lookup import Lookup
from revflow.llm.tables import frugal
from revflow.llm.words import mix, slices, span, sums

_MARK = 0x2581  # stands for a space inside pieces
_P = 0x9E3779B97F4A7C15
_TALL = 96  # longer words are counted one by one


class Pieces:
    """The merges of a model, and which of its pieces may be neighbours."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = (model.is_unknown, model.is_control, model.is_unused, model.is_byte)
        text = {i: model.id_to_piece(i) for i in range(size) if not any(f(i) for f in special)}
        order = {p: -model.get_score(i) for i, p in text.items()}  # merges with a higher score come first
        rank = {p: r for r, p in enumerate(sorted(order, key=order.get))}
        split = {}
        for piece in text.values():
            parts, last = list(piece), None
            while len(parts) > 1:
                merges = [(rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in rank]
                if not merges:
                    break
                i = min(merges)[1]
                last = (parts[i], parts[i + 1])
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            if len(parts) == 1:  # other pieces are never reached
                split[piece] = last
        names = sorted(split)
        number = {p: i for i, p in enumerate(names)}
        n = len(names)
        self.other = n  # stands for a character outside the vocabulary
        self.rank = np.array([-1 if split[p] is None else rank[p] for p in names] + [-1], np.int64)
        self.left = np.array([i if split[p] is None else number[split[p][0]] for i, p in enumerate(names)] + [n], np.int32)
        self.right = np.array([i if split[p] is None else number[split[p][1]] for i, p in enumerate(names)] + [n], np.int32)
        joined = [
            (number[p[:i]] * (n + 1) + number[p[i:]], rank[p])
            for p in rank
            for i in range(1, len(p))
            if p[:i] in number and p[i:] in number
        ]
        self.merged = Lookup(np.array([k for k, _ in joined] or [0], np.int64), np.array([r for _, r in joined] or [-1], np.int32))
        chars = sorted({ord(c) for p in names for c in p})
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[chars] = np.arange(1, len(chars) + 1)
        self.letters = len(chars) + 1
        # a tree of the pieces: node 0 is the root
        nodes, piece_at = {"": 0}, {}
        for p in names:
            for i in range(1, len(p) + 1):
                nodes.setdefault(p[:i], len(nodes))
            piece_at[nodes[p]] = number[p]
        step = [(nodes[p[:-1]] * self.letters + int(self.letter[ord(p[-1])]), i) for p, i in nodes.items() if p]
        self.steps = Lookup(np.array([k for k, _ in step], np.int64), np.array([v for _, v in step], np.int32))
        self.piece = np.full(len(nodes), -1, np.int32)
        self.piece[list(piece_at)] = list(piece_at.values())
        self.longest = max(map(len, names))
        # pairs answered before, one per slot
        self.seen = np.full(1 << 20, -1, np.int64)
        self.fine = np.zeros(1 << 20, bool)

    def neighbours(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether b may follow a."""
        key = a.astype(np.int64) * (self.other + 1) + b
        slot = self._slot(key)
        out = self.fine[slot]
        new = np.flatnonzero(self.seen[slot] != key)
        if len(new):
            fresh, back = np.unique(key[new], return_inverse=True)
            answer = self._decide((fresh // (self.other + 1)).astype(np.int32), (fresh % (self.other + 1)).astype(np.int32))
            out[new] = answer[back]
            slot = self._slot(fresh)
            self.seen[slot], self.fine[slot] = fresh, answer  # of keys on one slot the last stays, in both
        return out

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def _decide(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undo merges on either side of the boundary, latest first, and look for one across it that came before."""
        out = np.ones(len(a), bool)
        live = np.arange(len(a))
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            across = self.merged.get(a.astype(np.int64) * (self.other + 1) + b)
            bad = (across >= 0) & (across < limit)
            out[live[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            of_a = ra > rb  # of equal ranks the left one was merged first
            limit = np.where(of_a, ra, rb + 1)[go]
            a, b = np.where(of_a, self.right[a], a)[go], np.where(of_a, b, self.left[b])[go]
            live = live[go]
        return out

    def counts(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Tokens at each prefix of each word; words are runs of code points, cut at ``first`` (one more than words).

        The result has the count behind each code point.
        """
        n = len(points)
        letter = self.letter[points]
        size = np.where(points < 0x80, 1, np.where(points < 0x800, 2, np.where(points < 0x10000, 3, 4)))
        word_end = np.repeat(first[1:], np.diff(first))
        starts, pieces, lengths = [], [], []
        at, node = np.flatnonzero(letter > 0), np.zeros(int((letter > 0).sum()), np.int64)
        for length in range(1, self.longest + 1):
            inside = at + length <= word_end[at]
            at, node = at[inside], node[inside]
            node = self.steps.get(node * self.letters + letter[at + length - 1]).astype(np.int64)
            alive = node >= 0
            at, node = at[alive], node[alive]
            if not len(at):
                break
            piece = self.piece[node]
            whole = piece >= 0
            starts.append(at[whole])
            pieces.append(piece[whole])
            lengths.append(np.full(int(whole.sum()), length, np.int64))
        unknown = np.flatnonzero(letter == 0)
        # a letter that only occurs inside longer pieces is none by itself
        lone = np.flatnonzero((letter > 0) & (self.piece[np.maximum(self.steps.get(letter.astype(np.int64)), 0)] < 0))
        unknown = np.concatenate([unknown, lone])
        start = np.concatenate([*starts, unknown])
        piece = np.concatenate([*pieces, np.full(len(unknown), self.other, np.int32)])
        length = np.concatenate([*lengths, np.ones(len(unknown), np.int64)])
        cost = np.where(piece == self.other, size[start], 1)
        end = start + length
        word_start = np.repeat(first[:-1], np.diff(first))
        depth = end - word_start[start]  # position in the word; shorter prefixes are done first
        order = np.argsort(depth.astype(np.uint16) if len(depth) and depth.max() < 65536 else depth, kind="stable")
        start, piece, cost, end, depth = start[order], piece[order], cost[order], end[order], depth[order]
        last = np.full(n, -1, np.int32)
        count = np.zeros(n, np.int64)
        bounds = np.flatnonzero(np.append(True, depth[1:] != depth[:-1])) if len(depth) else np.empty(0, np.int64)
        for lo, hi in zip(bounds, np.append(bounds[1:], len(depth)), strict=True):
            s, p, e = start[lo:hi], piece[lo:hi], end[lo:hi] - 1
            opens = s == word_start[s]
            before = np.where(opens, self.other, last[s - 1])
            good = opens | (before == self.other) | (p == self.other)
            ask = np.flatnonzero(~good & (before >= 0))
            good[ask] = self.neighbours(before[ask], p[ask])
            good &= opens | (before >= 0)
            last[e[good]] = p[good]
            count[e[good]] = np.where(opens, 0, count[s - 1])[good] + cost[lo:hi][good]
        return count


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _points(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 documents, and how many lie before each document."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return points, lead[offsets]


def prefix_counts(model: Pieces, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts behind every code point of consecutive documents, and the code points before each document.

    The space that the model puts before a text belongs to its first character.
    """
    points, first = _points(offsets, data)
    if not len(points):
        return np.empty(0, np.int64), first
    # put a mark before each document that has text
    has = np.diff(first) > 0
    heads = first[:-1][has]
    marks = np.where(points == 0x20, _MARK, points)
    marks = np.insert(marks, heads, _MARK)
    head = heads + np.arange(len(heads))  # of each document with text, in the new numbering
    is_mark = marks == _MARK
    opens = is_mark & ~np.append(False, is_mark[:-1])
    opens[head] = True
    word = np.flatnonzero(opens)
    size = np.diff(np.append(word, len(marks)))
    total = np.zeros(len(marks), np.int64)  # within words
    prefix = sums(mix(marks.astype(np.uint64) + np.uint64(1)), _P)
    key = span(prefix, word, word + size, _P) + size.astype(np.uint64)
    _, one, back = np.unique(key, return_index=True, return_inverse=True)
    low = size[one] <= _TALL
    for group in (np.flatnonzero(low), *([i] for i in np.flatnonzero(~low))):
        if not len(group):
            continue
        begin, length = word[one[group]], size[one[group]]
        bounds = np.append(0, np.cumsum(length))
        flat = np.repeat(begin - bounds[:-1], length) + np.arange(bounds[-1])
        # long words are cut where no piece crosses, so that few positions follow each other
        inner = model.counts(marks[flat], bounds) if len(group) > 1 or length[0] <= _TALL else _tall(model, marks[flat])
        # write the counts to all words of the same kind
        place = np.full(len(one), -1, np.int64)
        place[group] = np.arange(len(group))
        mine = np.flatnonzero(place[back] >= 0)
        of = place[back[mine]]
        target = np.repeat(word[mine] - np.append(0, np.cumsum(size[mine]))[:-1], size[mine]) + np.arange(size[mine].sum())
        source = np.repeat(bounds[of] - np.append(0, np.cumsum(size[mine]))[:-1], size[mine]) + np.arange(size[mine].sum())
        total[target] = inner[source]
    ends = total[word + size - 1]
    before = np.cumsum(ends) - ends  # over all documents
    total += np.repeat(before, size)
    # counts start anew with each document
    base = np.append(0, np.cumsum(ends))[np.searchsorted(word, head)]
    docs_size = np.diff(np.append(head, len(marks)))
    total -= np.repeat(base, docs_size)
    return np.delete(total, head), first


def _tall(model: Pieces, points: np.ndarray) -> np.ndarray:
    """A long word, cut at neighbouring letters that no piece holds together."""
    a, b = model.letter[points[:-1]].astype(np.int64), model.letter[points[1:]].astype(np.int64)
    if not hasattr(model, "pairs"):
        root = model.steps
        node, key = root.values[root.keys >= 0], root.keys[root.keys >= 0]
        letter_of = np.zeros(len(model.piece), np.int64)
        letter_of[node] = key % model.letters
        parent = key // model.letters
        deep = parent > 0
        pair = np.unique(letter_of[parent[deep]] * model.letters + key[deep] % model.letters)
        model.pairs = Lookup(pair, np.ones(len(pair), np.int32))
    cut = model.pairs.get(a * model.letters + b) < 0
    bounds = np.concatenate([[0], np.flatnonzero(cut) + 1, [len(points)]])
    inner = model.counts(points, bounds)
    ends = inner[bounds[1:] - 1]
    return inner + np.repeat(np.cumsum(ends) - ends, np.diff(bounds))


# --- stored counts ------------------------------------------------------------------------------


def pack_counts(counts: np.ndarray) -> bytes:
    """The steps between neighbouring prefixes, compressed; a step is a small number."""
    steps = np.diff(counts, prepend=0)
    body = steps.astype(np.int8) if len(steps) == 0 or (abs(steps) < 128).all() else steps.astype("<i4")
    return bytes([body.itemsize]) + zstandard.ZstdCompressor(3).compress(body.tobytes())


def unpack_counts(blob: bytes) -> np.ndarray:
    body = zstandard.ZstdDecompressor().decompress(blob[1:], max_output_size=1 << 31)
    return np.cumsum(np.frombuffer(body, np.int8 if blob[0] == 1 else np.dtype("<i4")), dtype=np.int64)


def tokens_of_prefix(blob: bytes, characters: int) -> int:
    """Tokens of the first ``characters`` code points."""
    counts = unpack_counts(blob)
    return int(counts[min(characters, len(counts)) - 1]) if characters > 0 and len(counts) else 0


def longest_prefix(blob: bytes, budget: int) -> int:
    """Code points of the longest prefix with at most ``budget`` tokens."""
    fits = np.flatnonzero(unpack_counts(blob) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def _counter(path: str, budget: int, store: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for piece, offsets, data in slices(batch, limit=1 << 20):
                counts, first = prefix_counts(model, offsets, data)
                n = np.diff(first)
                total = np.zeros(len(n), np.int64)
                total[n > 0] = counts[first[1:][n > 0] - 1]
                # the longest prefix within the budget: the last position that fits, of each document
                fits = np.where(counts <= budget, np.arange(1, len(counts) + 1), 0)
                fit = np.zeros(len(n), np.int64)
                if len(counts):
                    fit[n > 0] = np.maximum.reduceat(fits, first[:-1][n > 0]) - first[:-1][n > 0]
                columns = [piece.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n), pa.array(total), pa.array(np.maximum(fit, 0))]
                names = ["doc_id", "n_bytes", "n_points", "n_tokens", "fit_points"]
                if store:
                    columns.append(pa.array([pack_counts(counts[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()))
                    names.append("counts")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def count_tokens(
    docs: DataFrame, model: str, budget: int = 4096, store: bool = True, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_points, n_tokens, fit_points and, with ``store``, the packed counts at every prefix.

    ``model`` is the path of a sentence-piece model on every machine;
    ``fit_points`` is the length of the longest prefix with at most ``budget`` tokens.
    """
    frugal(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_bytes long, n_points long, n_tokens long, fit_points long" + ", counts binary" * store
    return rows.mapInArrow(_counter(model, budget, store), schema)

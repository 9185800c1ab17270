"""Alignment of two tokenizers by inverted pair bitmaps.

Both encodings of a text cut the same bytes. Where a token of A and one of B end at the
same byte they are linked, and these places cut both encodings into groups. The
postings of a pair of ids, one from each vocabulary, are bitmaps of documents:
documents are numbered within blocks, and the pair has one container for each block in which it
occurs. How often a document holds the pair is kept in multiplicity planes, plane i
with the documents whose number has bit i set; a plane is stored as a list of numbers or
as bits, whichever is shorter. The OR of the planes has as many bits as documents hold
the pair, and the bits of plane i count 2**i links each. Summed over the containers this
gives the documents and the links of a pair in the whole corpus, and the most links any pair of
a B id has. These go back along the postings: each container adds its pair's figures to its documents.

A pair has at most one row for each block, so a pair that nearly every document holds is spread evenly, and
a block has a bounded number of documents and postings (or one longer document). No list of pairs or documents reaches the driver.

Edge cases: NULL and empty texts have no tokens, nor have texts whose tokens, joined, do
not give a blank and the text again (a model that changes characters); their figures are
zero and their digest is ''. Very long texts are encoded whole. Equal rows count each on its own, NULL
ids stay NULL, an empty table gives an empty result. Only the id and text
columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revflow.llm.encoding import _byte_of, encoder
from revflow.llm.tables import frugal, stored
from revflow.llm.words import release

BLOCK_DOCS = 8192
BLOCK_POSTINGS = 1 << 21
_TEXT = 1 << 19  # bytes of text encoded at a time
_LIST, _BITS = 0, 1


# --- containers ---------------------------------------------------------------------------------


def containers(starts: np.ndarray, docs: np.ndarray, times: np.ndarray) -> list[bytes]:
    """The planes of each pair: documents ``docs`` (rising within a pair, below 65536) hold it ``times`` times; pairs begin at ``starts``."""
    out: list[list[bytes]] = [[] for _ in starts]
    pair = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(docs))))
    width = BLOCK_DOCS // 8
    for plane in range(int(times.max(initial=0)).bit_length()):
        has = np.flatnonzero((times >> plane) & 1)
        if not len(has):
            continue
        body, of = docs[has].astype("<u2"), pair[has]
        cut = np.flatnonzero(np.append(True, of[1:] != of[:-1])[: len(of)])
        raw, head = body.tobytes(), plane.to_bytes(1, "little")
        for p, a, b in zip(of[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(of)], strict=True):
            if 2 * (b - a) <= width:
                own = head + bytes([_LIST]) + (2 * (b - a)).to_bytes(4, "little") + raw[2 * a : 2 * b]
            else:
                bits = np.zeros(-(-(int(body[b - 1]) + 1) // 8) * 8, np.uint8)
                bits[body[a:b]] = 1
                bits = np.packbits(bits, bitorder="little").tobytes()
                own = head + bytes([_BITS]) + len(bits).to_bytes(4, "little") + bits
            out[p].append(own)
    return [b"".join(x) for x in out]


def planes(container: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(plane, kind, body) of a container."""
    at = 0
    while at < len(container):
        size = int.from_bytes(container[at + 2 : at + 6], "little")
        yield container[at], container[at + 1], container[at + 6 : at + 6 + size]
        at += 6 + size


def members(kind: int, body: bytes) -> np.ndarray:
    """The documents of one plane."""
    if kind == _LIST:
        return np.frombuffer(body, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(body, np.uint8), bitorder="little"))


def popcounts(container: bytes) -> tuple[int, int]:
    """(documents, links) of a container: bits of the OR of its planes, and of the planes by their weights."""
    found = list(planes(container))
    links = sum((len(b) // 2 if kind == _LIST else int.from_bytes(b, "little").bit_count()) << plane for plane, kind, b in found)
    if len(found) == 1:
        return links >> found[0][0], links
    every = 0
    for _, kind, body in found:
        if kind == _LIST:
            bits = np.zeros(BLOCK_DOCS, np.uint8)
            bits[members(kind, body)] = 1
            body = np.packbits(bits, bitorder="little").tobytes()
        every |= int.from_bytes(body, "little")
    return every.bit_count(), links


# --- encodings ----------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def _bytes_of_a(path: str) -> tuple[list[bytes], np.ndarray]:
    """Bytes and their number of each id of a byte-level BPE file."""
    byte_of = _byte_of()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = {x["id"] for x in spec["added_tokens"]}
    entries = {**spec["model"]["vocab"], **{x["content"]: x["id"] for x in spec["added_tokens"]}}
    out = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        out[i] = entry.encode() if i in added else bytes(byte_of[c] for c in entry)
    return out, np.array([len(x) for x in out])


@lru_cache(maxsize=2)
def _model_b(path: str):
    """A sentence-piece model, and the bytes and their number of each of its ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return model, out, np.array([len(x) for x in out])


def linked(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of the tokens that end at the same byte."""
    end_a, end_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    at = np.searchsorted(end_b, end_a)
    same = np.flatnonzero(end_b[np.minimum(at, len(end_b) - 1)] == end_a) if len(end_b) else np.empty(0, np.int64)
    return same, at[same]


@lru_cache(maxsize=1)
def _digits(ids: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of all ids, and how many."""
    names = [str(i).encode() for i in range(ids)]
    width = len(names[-1]) + 1
    return np.frombuffer(b"".join(n.ljust(width) for n in names), np.uint8).reshape(ids, width), np.array([len(n) for n in names])


def written_groups(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, ids: int) -> tuple[np.ndarray, np.ndarray]:
    """All groups as ``a1,a2|b1;a3|b2,b3;`` and the bytes written up to and with each link."""
    ends_a, ends_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    ends_a[at_a] = ends_b[at_b] = True
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    place_a = np.arange(len(a)) + np.append(0, at_b + 1)[group_a]
    place_b = np.arange(len(b)) + (at_a + 1)[group_b]
    every, sign = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    every[place_a], every[place_b] = a, b
    sign[place_a[at_a]], sign[place_b[at_b]] = ord("|"), ord(";")
    digits, sizes = _digits(ids)
    size = sizes[every]
    table = digits[every]
    table[np.arange(len(every)), size] = sign
    flat = table[np.arange(table.shape[1]) <= size[:, None]]
    return flat, np.cumsum(size + 1)[place_b[at_b]]


def _aligner(vocabulary_a: str, model_b: str):
    """Batches of documents to rows of documents (kind 0) and of pairs (kind 1), block by block."""
    names = ["kind", "block", "place", "doc_id", "n_a", "n_b", "n_links", "groups_sha256", "a", "b", "planes"]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary()]

    def rows(**columns) -> pa.RecordBatch:
        n = len(columns["block"])
        arrays = [pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary_a, special=False)
        bytes_a, size_a = _bytes_of_a(vocabulary_a)
        model, bytes_b, size_b = _model_b(model_b)
        ids = max(len(size_a), len(size_b))
        task, number, docs, held, postings = TaskContext.get().partitionId(), 0, 0, [], 0

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal number, docs, postings
            key, doc, times = (np.concatenate([h[c] for h in held]) for c in range(3))
            order = np.lexsort((doc, key))
            key, doc, times = key[order], doc[order], times[order]
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
            own = containers(starts, doc, times)
            pair, name = key[starts], (task << 32) | number
            for at in range(0, len(own), 8192):
                part = slice(at, at + 8192)
                n = len(own[part])
                yield rows(kind=[1] * n, block=[name] * n, a=(pair[part] >> 32).astype(np.int32), b=(pair[part] & 0xFFFFFFFF).astype(np.int32), planes=own[part])
            held.clear()
            number, docs, postings = number + 1, 0, 0
            release()

        for batch in batches:
            for doc_ids, texts in _portions(batch):
                given = [b" " + t.encode() for t in texts]
                all_a = encode([" " + t for t in texts])
                all_b = model.encode(texts, num_threads=1)
                whole = [
                    bool(t) and b"".join(map(bytes_a.__getitem__, x)) == g and b"".join(map(bytes_b.__getitem__, y)) == g
                    for t, g, x, y in zip(texts, given, all_a, all_b, strict=True)
                ]
                n_a = np.array([len(x) if w else 0 for x, w in zip(all_a, whole, strict=True)])
                n_b = np.array([len(y) if w else 0 for y, w in zip(all_b, whole, strict=True)])
                a = np.array([i for x, w in zip(all_a, whole, strict=True) if w for i in x], np.int64)
                b = np.array([i for y, w in zip(all_b, whole, strict=True) if w for i in y], np.int64)
                at_a, at_b = linked(a, b, size_a, size_b)
                links = np.diff(np.searchsorted(at_a, np.append(0, np.cumsum(n_a))))
                flat, upto = written_groups(a, b, at_a, at_b, ids)
                last = np.cumsum(links)
                digests = []
                for w, first, end in zip(whole, (last - links).tolist(), last.tolist(), strict=True):
                    begin = int(upto[first - 1]) if w and first else 0
                    digests.append(hashlib.sha256(flat[begin : int(upto[end - 1]) - 1].tobytes()).hexdigest() if w else "")
                place = np.arange(docs, docs + len(texts))
                name = (task << 32) | number
                yield rows(
                    kind=[0] * len(texts), block=[name] * len(texts), place=place.astype(np.int32), doc_id=doc_ids,
                    n_a=n_a, n_b=n_b, n_links=links, groups_sha256=digests,
                )
                # how often each document holds each pair
                pairs, which = np.unique(a[at_a] << 32 | b[at_b], return_inverse=True)
                both, times = np.unique(which * len(texts) + np.repeat(np.arange(len(texts)), links), return_counts=True)
                held.append((pairs[both // len(texts)], place[both % len(texts)], times))
                docs, postings = docs + len(texts), postings + len(both)
                if docs > BLOCK_DOCS - 256 or postings >= BLOCK_POSTINGS:
                    yield from block()
        if held:
            yield from block()

    return run


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of up to 256 documents, with about ``_TEXT`` bytes or one longer text."""
    doc_ids, texts, size = [], [], 0
    for i in range(batch.num_rows):
        text = batch.column("text")[i].as_py() or ""
        if texts and (len(texts) == 256 or size + len(text) > _TEXT):
            yield doc_ids, texts
            doc_ids, texts, size = [], [], 0
        doc_ids.append(batch.column("doc_id")[i].as_py())
        texts.append(text)
        size += len(text)
    if texts:
        yield doc_ids, texts


# --- the corpus ---------------------------------------------------------------------------------


class Alignment(NamedTuple):
    """Stored results: ``documents`` by (own_block, place), ``postings`` (block, a, b, planes), and ``counts`` of pairs (a, b, documents, links)."""

    documents: DataFrame
    postings: DataFrame
    counts: DataFrame


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [popcounts(c) for c in batch.column("planes").to_pylist()]
        columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(2)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *columns], ["a", "b", "documents", "links"])


def align(docs: DataFrame, vocabulary_a: str, model_b: str, doc_id: str = "doc_id", text: str = "text") -> Alignment:
    """Align the byte-level BPE file ``vocabulary_a`` (given a blank and the text) with the sentence-piece model ``model_b`` on all texts.

    Both are paths of files on every machine.
    """
    frugal(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = (
        "kind int, block long, place int, doc_id long, n_a long, n_b long, n_links long, groups_sha256 string, a int, b int, planes binary"
    )
    both = stored(rows.mapInArrow(_aligner(vocabulary_a, model_b), schema), "aligned")
    postings = both.filter("kind = 1").select("block", "a", "b", "planes")
    counted = postings.select("a", "b", "planes").mapInArrow(_counter, "a int, b int, documents long, links long")
    counts = counted.groupBy("a", "b").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
    documents = both.filter("kind = 0").select(F.col("block").alias("own_block"), "place", "doc_id", "n_a", "n_b", "n_links", "groups_sha256")
    return Alignment(documents, postings, stored(counts, "pair-counts"))


_SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _returned(documents: pa.Table, postings: pa.Table) -> pa.Table:
    """The documents of a block with what its containers bring back."""
    n = documents.num_rows
    order = np.argsort(documents.column("place").to_numpy())
    documents = documents.take(pa.array(order))  # places count from 0 without gaps
    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    links, is_best = postings.column("links").to_numpy(), postings.column("is_best").to_numpy(zero_copy_only=False)
    bodies: list[bytes] = []
    sizes: list[int] = []
    rows: list[int] = []
    weights: list[int] = []
    for row, container in enumerate(postings.column("planes").to_pylist()):
        for plane, kind, body in planes(container):
            if kind == _LIST:
                bodies.append(body)
                sizes.append(len(body) // 2)
                rows.append(row)
                weights.append(1 << plane)
            else:
                found = members(kind, body)
                total[found] += int(links[row]) << plane
                best[found] += int(is_best[row]) << plane
    at = np.frombuffer(b"".join(bodies), "<u2")
    row, weight = np.repeat(rows, sizes).astype(np.int64), np.repeat(weights, sizes).astype(np.int64)
    np.add.at(total, at, links[row] * weight)
    np.add.at(best, at, is_best[row] * weight)
    release()
    columns = {c: documents.column(c) for c in ("doc_id", "n_a", "n_b")}
    columns |= {"n_groups": documents.column("n_links"), "n_links": documents.column("n_links")}
    columns |= {"n_best": pa.array(best), "count_sum": pa.array(total), "groups_sha256": documents.column("groups_sha256")}
    return pa.table(columns)


def document_scores(found: Alignment) -> DataFrame:
    """Per document: tokens, groups, links, links whose pair is its B id's most frequent one, the sum of their counts, and the digest of the groups."""
    most = found.counts.groupBy("b").agg(F.max("links").alias("most"))
    scored = found.counts.join(most, "b").select("a", "b", "links", (F.col("links") == F.col("most")).alias("is_best"))
    scored = stored(scored, "pair-scores")
    sent = found.postings.join(scored, ["a", "b"]).select("block", "planes", "links", "is_best")
    return found.documents.groupBy("own_block").cogroup(sent.groupBy("block")).applyInArrow(_returned, _SCORED)

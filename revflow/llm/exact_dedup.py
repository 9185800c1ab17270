"""Exact duplicates found by counting quotient filters.

Each task puts the 64-bit fingerprints of its documents into one counting
quotient filter per range of fingerprints. Filters of a range are merged by
their sorted remainders; no fingerprint is lost, since quotient and remainder
together are the fingerprint. Fingerprints counted more than once send their
documents to byte verification, where the normalised texts themselves are the
grouping keys. All other documents are known to be alone.

A task sends each fingerprint once whatever its count, and texts are grouped
with map-side partial aggregates, so large groups of copies shrink before any shuffle.

Edge cases: a NULL text is an empty text, and all empty texts are equal.
Rows that agree in text and id are ordinary equal texts of a group. A NULL id
loses ties to every other id; a group with only NULL ids has keep_id NULL and
keeps all of its rows. An empty table gives an empty result. Only the id and
text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revflow.llm.tables import buckets, frugal, small_side, stored
from revflow.llm.words import _BYTE, _SPACE, mix, slices, span, sums

_P = 0x9E3779B97F4A7C15
_BLANKS = " \t\n\x0b\x0c\r"


# --- the filter ---------------------------------------------------------------------------------


def build_filter(fingerprints: np.ndarray, counts: np.ndarray, low: int, width: int) -> bytes:
    """A counting quotient filter of sorted distinct 64-bit values in ``[low, low + 2**width)``.

    Slots hold remainders in order, each run shifted right of its quotient as
    far as needed; a count above one takes the slot behind its remainder. The
    three bit vectors say which quotients occur, which slots end a run, and
    which slots hold counts.
    """
    n = len(fingerprints)
    q = min(width, max(1, int(n * 1.25).bit_length()))
    r = np.uint64(width - q)
    value = fingerprints - np.uint64(low)
    quotient = (value >> r).astype(np.int64)
    remainder = value & ((np.uint64(1) << r) - np.uint64(1))
    more = counts > 1
    size = 1 + more  # slots that each value takes
    before = np.cumsum(size) - size
    slot = before + np.maximum.accumulate(quotient - before)
    slots = int(max(1 << q, slot[-1] + size[-1]))
    last = np.append(quotient[1:] != quotient[:-1], True)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    run_end, counter, used = (np.zeros(slots, bool) for _ in range(3))
    run_end[slot[last]] = True
    used[slot] = True
    counter[slot[more] + 1] = True
    body = np.zeros(slots, np.uint64)
    body[slot] = remainder
    body[slot[more] + 1] = counts[more].astype(np.uint64)
    keep = used | counter
    head = struct.pack("<QBBI", low, width, q, slots)
    bits = b"".join(np.packbits(x).tobytes() for x in (occupied, run_end, counter, used))
    # empty slots are not sent; the remainders go by byte planes, of which the upper ones are short
    planes = np.ascontiguousarray(body[keep].view(np.uint8).reshape(-1, 8).T)
    return head + bits + planes.tobytes()


def read_filter(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sorted fingerprints of a filter and their counts."""
    low, width, q, slots = struct.unpack_from("<QBBI", blob)
    at = struct.calcsize("<QBBI")

    def bits(n: int) -> np.ndarray:
        nonlocal at
        size = (n + 7) // 8
        out = np.unpackbits(np.frombuffer(blob, np.uint8, size, at), count=n).astype(bool)
        at += size
        return out

    occupied, run_end, counter, used = bits(1 << q), bits(slots), bits(slots), bits(slots)
    keep = used | counter
    n = int(keep.sum())
    body = np.ascontiguousarray(np.frombuffer(blob, np.uint8, 8 * n, at).reshape(8, n).T).view(np.uint64).ravel()
    full = np.zeros(slots, np.uint64)
    full[keep] = body
    place = np.flatnonzero(used)
    # the runs follow each other in the order of the occupied quotients
    run = np.cumsum(run_end[place]) - run_end[place]
    quotient = np.flatnonzero(occupied)[run].astype(np.uint64)
    r = np.uint64(width - q)
    counts = np.ones(len(place), np.int64)
    follows = np.append(counter, False)[place + 1]
    counts[follows] = full[place[follows] + 1].astype(np.int64)
    return (quotient << r) + full[place] + np.uint64(low), counts


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted fingerprints and add up their counts."""
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


# --- the job ------------------------------------------------------------------------------------


def _fingerprints(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Of each text without its white space."""
    keep = ~_SPACE[data]
    at = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    bounds = at[offsets]
    prefix = sums(_BYTE[data[keep]], _P)
    return mix(span(prefix, bounds[:-1], bounds[1:], _P) + np.diff(bounds).astype(np.uint64))


def _filters(ranges: int):
    width = max(1, 64 - (ranges - 1).bit_length())  # ranges are cut at powers of two

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for _, offsets, data in slices(batch):
                keys, counts = np.unique(_fingerprints(offsets, data), return_counts=True)
                parts.append((keys, counts))
            if len(parts) > 64:
                parts = [merge(parts)]
        if not parts:
            return
        keys, counts = merge(parts)
        place = (keys >> np.uint64(width)).astype(np.int64) if width < 64 else np.zeros(len(keys), np.int64)
        cut = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        for a, b in zip(cut, np.append(cut[1:], len(keys)), strict=True):
            low = int(place[a]) << width if width < 64 else 0
            blob = build_filter(keys[a:b], counts[a:b], low, width)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(place[a])], pa.int64()), pa.array([blob], pa.binary())], ["part", "filter"]
            )

    return run


def _merged(table: pa.Table) -> pa.Table:
    keys, counts = merge([read_filter(x) for x in table.column("filter").to_pylist()])
    many = counts > 1
    return pa.table({"fp": keys[many].view(np.int64), "n": counts[many]})


def repeated_fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``fp, n``: fingerprints that occur more than once in the whole table, and how often."""
    filters = docs.select(F.col(text).alias("text")).mapInArrow(
        _filters(buckets(docs.sparkSession)), "part long, filter binary"
    )
    return filters.groupBy("part").applyInArrow(_merged, "fp long, n long")


def _tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece, offsets, data in slices(batch):
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(_fingerprints(offsets, data).view(np.int64))], [*piece.schema.names, "fp"]
            )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece, offsets, data in slices(batch):
            keep = ~_SPACE[data]
            digests = [
                hashlib.sha256(data[a:b][keep[a:b]].tobytes()).hexdigest()
                for a, b in zip(offsets[:-1], offsets[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(_fingerprints(offsets, data).view(np.int64)), pa.array(digests, pa.string())],
                ["doc_id", "fp", "text_sha256"],
            )


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _BLANKS, "")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space. The longest original
    text stays, then the smallest id.
    """
    frugal(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    norm = normalised(F.col("text"))
    repeated = stored(repeated_fingerprints(rows).select("fp"), "fingerprints")
    repeated = small_side(repeated, 16)
    slim = rows.mapInArrow(_digest, "doc_id long, fp long, text_sha256 string")
    alone = slim.join(repeated, "fp", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    members = stored(
        rows.mapInArrow(_tag, "doc_id long, text string, fp long")
        .join(repeated, "fp", "left_semi")
        .select("doc_id", "fp", norm.alias("norm"), F.char_length("text").alias("n")),
        "candidates",
    )
    # the bytes decide: texts that only share a fingerprint fall into different groups
    digest = F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")
    groups = (
        members.groupBy("fp", "norm")
        .agg(F.count("*").alias("group_size"), F.max(F.struct("n", F.bitwise_not("doc_id").alias("id"))).alias("best"))
        .select("fp", digest, "group_size", F.bitwise_not("best.id").alias("keep_id"))
    )
    found = members.select("doc_id", "fp", digest).join(groups, ["fp", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
    return alone.unionByName(found)

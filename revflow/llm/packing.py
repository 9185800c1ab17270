"""Packing by powers of two: every document is cut into pieces whose lengths
are binary, the digits of its token count, and pieces of equal length share a bucket.

A piece is a sequence of its own, so no sequence crosses documents and none
needs padding. Pieces of the full length come first, then the rest from the
highest digit down. A document ends with one separator token.

Sequence ids hold the bucket in their top bits, then the task, then a counter
within the task, so they are unique without any shuffle and sort by length;
each task numbers the pieces of its own input, and a repeated task gives the same ids.

Edge cases: a NULL or empty text is one piece, the separator. Very long texts
are encoded whole. Equal rows are packed each on its own, and NULL ids stay
NULL. An empty table gives an empty result. Only the id and text columns are
read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revflow.llm.encoding import encoder
from revflow.llm.tables import frugal

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, bucket int, ids array<int>"
)


def cut(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    out = [(at, longest) for at in range(0, n - n % longest, longest)]
    at, rest = n - n % longest, n % longest
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, size))
        at, rest = at + size, rest - size
    return out


def _packer(encode_with: Callable[[], Callable[[list[str]], list[list[int]]]], longest: int, end: int, ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encode_with()
        task = TaskContext.get().partitionId()
        taken = [0] * longest.bit_length()  # sequences of each bucket so far
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column("text").to_pylist()
                rows: list[list] = [[] for _ in range(9 if ids else 8)]
                for doc, tokens in zip(part.column("doc_id").to_pylist(), encode([t or "" for t in texts]), strict=True):
                    values = np.append(np.asarray(tokens, np.uint32), np.uint32(end))
                    for start, length in cut(len(values), longest):
                        piece = values[start : start + length]
                        bucket = length.bit_length() - 1
                        number = (bucket << 58) | (task << 32) | taken[bucket]
                        taken[bucket] += 1
                        row = (doc, start, length, zlib.crc32(piece.astype("<u4").tobytes()), len(values), number, 0, bucket)
                        for column, value in zip(rows, row, strict=False):
                            column.append(value)
                        if ids:
                            rows[8].append(piece.astype(np.int32))
                kinds = [pa.int64()] * 7 + [pa.int32()] + ([pa.list_(pa.int32())] if ids else [])
                names = [x.split()[0] for x in SCHEMA.split(", ")][: len(rows)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names)

    return run


def pack(
    docs: DataFrame,
    vocabulary: str,
    longest: int = 1024,
    end: int = 0,
    ids: bool = True,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: its document, place, length, checksum, sequence and token ids.

    ``vocabulary`` is the path of a tokenizer file on every machine;
    ``longest`` must be a power of two of at most 1024 * 1024. With
    ``ids=False`` the token ids are left out.
    """
    if longest < 1 or longest & (longest - 1) or longest > 1 << 20:
        raise ValueError("longest must be a power of two up to 2**20")
    frugal(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = SCHEMA if ids else SCHEMA.removesuffix(", ids array<int>")
    return rows.mapInArrow(_packer(lambda: encoder(vocabulary), longest, end, ids), schema)

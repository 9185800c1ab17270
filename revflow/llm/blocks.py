"""Questions of document blocks to tables that are spread over hash ranges.

Documents are stored once in blocks of a few megabytes, in a table bucketed by
block. A block asks by its sorted distinct keys: one message per hash range. The
range's task sums up what all blocks say about a key and answers each message
in the order of its keys, so answers hold no keys. A key appears once in a message
however often it occurs in the block: frequent words, passages and copies
shrink before the shuffle, and no range holds a hot key's occurrences. Ranges cut
the 64-bit hashes evenly; their number is that of the shuffle partitions.

Answers are stored below the shared folder, bucketed by block as the documents are,
and come back to the blocks by a grouping on the block, where neither side is shuffled
again. Once the answers of a step are stored, the files of its shuffles are removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from revflow.llm.tables import buckets, frugal, swept
from revflow.llm.words import release
from revflow.session import run_folder

BLOCK_BYTES = 4 << 20


# --- packed arrays ------------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays by byte planes, so that slowly changing upper bytes compress away."""
    parts = []
    for a in arrays:
        if a.dtype == bool:
            body, kind = np.packbits(a).tobytes(), "b1"
        else:
            a = np.ascontiguousarray(a)
            body = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() if len(a) else b""
            kind = a.dtype.str[1:]
        parts.append(kind.encode().ljust(4) + len(a).to_bytes(8, "little") + body)
    return zstandard.ZstdCompressor(1).compress(b"".join(len(p).to_bytes(8, "little") + p for p in parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    out, at = [], 0
    while at < len(raw):
        size = int.from_bytes(raw[at : at + 8], "little")
        kind = raw[at + 8 : at + 12].decode().strip()
        n = int.from_bytes(raw[at + 12 : at + 20], "little")
        body = np.frombuffer(raw, np.uint8, size - 12, at + 20)
        at += 8 + size
        if kind == "b1":
            out.append(np.unpackbits(body, count=n).astype(bool))
        else:
            dtype = np.dtype(kind)
            out.append(np.ascontiguousarray(body.reshape(dtype.itemsize, n).T).view(dtype).ravel())
    return out


# --- blocks -------------------------------------------------------------------------------------


def _blocker(limit: int, encode: Callable[[pa.RecordBatch], pa.RecordBatch] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, waiting, size = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            nonlocal number, waiting, size
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(waiting).combine_chunks()
            if encode is not None:
                table = pa.Table.from_batches([encode(table.to_batches()[0])])
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            body = zstandard.ZstdCompressor(3).compress(sink.getvalue())
            name = (task << 32) | number
            number, waiting, size = number + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([body], pa.binary())], ["block", "docs"])

        for batch in batches:
            for row in _pieces(batch, limit):
                if size and size + row.nbytes > limit:
                    yield block()
                # a copy, so that a few waiting rows do not hold their whole batch
                waiting.append(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in row.columns], row.schema.names))
                size += row.nbytes
        if waiting:
            yield block()

    return run


def _pieces(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    step = max(1, batch.num_rows * limit // max(1, batch.nbytes) // 8)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def open_block(table: pa.Table) -> pa.RecordBatch:
    body = zstandard.ZstdDecompressor().decompress(table.column("docs")[0].as_py(), max_output_size=1 << 31)
    return pa.ipc.open_stream(body).read_all().combine_chunks().to_batches()[0]


class Blocks:
    """Stored blocks of documents, and the answers that they got so far.

    ``encode`` makes what is stored of a block from its documents, one row for each;
    without it they are stored as they are.
    """

    def __init__(
        self, docs: DataFrame, limit: int = BLOCK_BYTES, *, encode: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None
    ):
        self.spark: SparkSession = docs.sparkSession
        frugal(self.spark)
        self.ranges = buckets(self.spark)
        self.name = f"llm_blocks_{uuid.uuid4().hex[:12]}"
        self.answered = f"{self.name}_answers"  # one table with a partition per pass, so that it is read by bucket as a whole
        self.answers: DataFrame | None = None
        self.passes = 0
        self.folder = run_folder(self.spark, "llm-answers")
        folder = run_folder(self.spark, "llm-blocks")
        (
            docs.mapInArrow(_blocker(limit, encode), "block long, docs binary")
            .write.bucketBy(self.ranges, "block")
            .option("path", folder)
            .option("compression", "none")
            .format("parquet")
            .saveAsTable(self.name)
        )
        self.table = self.spark.table(self.name)

    def drop(self) -> None:
        """Take the blocks out of the catalogue; frames made from them must have been stored before."""
        for name in (self.name, self.answered):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def each(self, use: Callable[[int, pa.RecordBatch, dict], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        """Rows of ``use(block, documents, answers)``; answers are messages by step and range."""
        names = to_arrow_schema(_parse_datatype_string(schema))

        def run(row: pa.Table, got: pa.Table | None) -> pa.Table:
            if not row.num_rows:
                return names.empty_table()
            answers: dict[int, dict[int, bytes]] = {}
            if got is not None:
                for step, place, body in zip(*(got.column(c).to_pylist() for c in ("step", "place", "body")), strict=True):
                    answers.setdefault(step, {})[place] = body
            out = list(use(row.column("block")[0].as_py(), open_block(row), answers))
            release()
            return pa.Table.from_batches(out).cast(names) if out else names.empty_table()

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield from run(pa.Table.from_batches([batch.slice(i, 1)]), None).to_batches()

        if self.answers is None:
            return self.table.mapInArrow(alone, schema)
        return self.table.groupBy("block").cogroup(self.answers.groupBy("block")).applyInArrow(run, schema)

    def ask(
        self,
        step: int,
        question: Callable[[pa.RecordBatch, dict], dict[int, bytes]],
        answer: Callable[[list[bytes]], tuple[list[bytes], list[int]]],
    ) -> list[int]:
        """Ask all ranges and keep their answers for later steps.

        ``question`` gives a message per range; ``answer`` takes the messages of
        one range and gives an answer to each, and figures to be added up over all
        ranges. Returns the sums.
        """
        return self.ask_together(lambda docs, answers: {step: question(docs, answers)}, {step: answer})[step]

    def ask_together(
        self,
        questions: Callable[[pa.RecordBatch, dict], dict[int, dict[int, bytes]]],
        answerers: dict[int, Callable[[list[bytes]], tuple[list[bytes], list[int]]]],
    ) -> dict[int, list[int]]:
        """``ask`` for several steps that do not wait for each other: messages, answers and sums are by step."""

        def ask_block(block: int, docs: pa.RecordBatch, answers: dict) -> Iterator[pa.RecordBatch]:
            for step, messages in questions(docs, answers).items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block] * len(messages), pa.int64()),
                        pa.array([step] * len(messages), pa.int32()),
                        pa.array(list(messages), pa.int32()),
                        pa.array(list(messages.values()), pa.binary()),
                    ],
                    ["block", "step", "place", "body"],
                )

        messages = self.each(ask_block, "block long, step int, place int, body binary")

        def of_range(table: pa.Table) -> pa.Table:
            order = np.argsort(table.column("block").to_numpy(), kind="stable")
            table = table.take(pa.array(order))
            step, place = (table.column(c)[0].as_py() for c in ("step", "place"))
            answers, figures = answerers[step](table.column("body").to_pylist())
            release()
            n = len(answers)
            return pa.table(
                {
                    "block": pa.array([*table.column("block").to_pylist(), -1], pa.int64()),
                    "step": pa.array([step] * (n + 1), pa.int32()),
                    "place": pa.array([place] * (n + 1), pa.int32()),
                    "body": pa.array([*answers, b""], pa.binary()),
                    "figures": pa.array([None] * n + [figures], pa.list_(pa.int64())),
                }
            )

        asked = self.passes = self.passes + 1
        schema = "block long, step int, place int, body binary, figures array<long>"
        with swept(self.spark):
            (
                messages.groupBy("step", "place")
                .applyInArrow(of_range, schema)
                .repartition(self.ranges, "block")
                .withColumn("asked", F.lit(asked))
                .write.partitionBy("asked")
                .bucketBy(self.ranges, "block")
                .option("path", self.folder)
                .option("compression", "none")
                .format("parquet")
                .mode("append")
                .saveAsTable(self.answered)
            )
            read = self.spark.table(self.answered)
            figures = read.filter(F.col("figures").isNotNull() & (F.col("asked") == asked)).selectExpr("step", "posexplode(figures) AS (i, x)")
            sums: dict[int, list[int]] = {step: [] for step in answerers}
            for r in figures.groupBy("step", "i").sum("x").orderBy("step", "i").collect():
                sums[r[0]].append(int(r[2]))
        # passes up to this one: frames made now do not read what later passes add
        self.answers = read.filter(F.col("figures").isNull() & (F.col("asked") <= asked)).select("block", "step", "place", "body")
        return sums


# --- messages -----------------------------------------------------------------------------------


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each key: hashes cut evenly, in the order of the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def cut(keys: np.ndarray, ranges: int) -> list[tuple[int, int, int]]:
    """(range, from, to) of sorted keys; empty ranges are left out."""
    if not len(keys):
        return []
    place = range_of(keys, ranges)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    return [(int(place[a]), int(a), int(b)) for a, b in zip(first, np.append(first[1:], len(keys)), strict=True)]


def gather(answers: dict[int, bytes], keys: np.ndarray, ranges: int) -> list[list[np.ndarray]]:
    """The unpacked answers to sorted keys, range by range in the order of the keys."""
    return [unpack(answers[place]) for place, _, _ in cut(keys, ranges)]


def joined(messages: list[list[np.ndarray]], i: int) -> np.ndarray:
    return np.concatenate([m[i] for m in messages])


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts keys, and where each distinct key begins in it."""
    order = np.argsort(keys, kind="stable")
    inn = keys[order]
    return order, np.flatnonzero(np.append(True, inn[1:] != inn[:-1]))[: len(inn)]

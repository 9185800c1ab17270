"""Records of quoted CSV files: found in splits, and told apart from their header's width.

A quoted field may run over line ends, so a line need not be a record. Whether a
line begins one depends on all lines before it in the file. But each line has only two
ways to act: what it makes of an open quoted field, and of none. A quote counts
where a field begins or a quoted one ends; others are text. One pass composes the lines
of every split into the split's own two ways; a scan over the splits of a file, one row each, tells
which of them begin inside a quoted field. A second pass then cuts the lines of each split into records on its own.
A record that crosses a split's end leaves fragments, which are joined at the seams. No file is
read by one task, however large it is, and lines are never shuffled.

A record with more fields than its header, or whose last quote is never closed, is a fault: it is refused, or
kept apart with its reason, text and fields. One with fewer fields ends in NULLs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

# The functions below travel to the executors, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAULT, FILE = "_fault", "_file_path"
LONG, OPEN, SHORT = "record longer than its header", "quote not closed", "record shorter than its header"
_WHOLE, _HEAD, _TAIL = 0, 1, 2
_SMALL = 100_000  # splits that begin in a quoted field and are still broadcast: some 20 MB
_PIECES = "file_path string, block long, number long, kind int, closed boolean, text string"


# A field between quotes without its last one, doubled quotes included; what closes it may be followed by text.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:{_QUOTED}"[^,]*+|[^",][^,]*+|)'
_OPENS = rf"(?:{_FIELD},)*+{_QUOTED}"


def leaves_open(line: Column, inside: bool) -> Column:
    """Whether a quoted field is open at the end of a line, given whether one is at its beginning."""
    pattern = rf'\A(?s:[^"]*+(?:""[^"]*+)*+(?:"[^,]*+,{_OPENS})?+)\z' if inside else rf"\A(?s:{_OPENS})\z"
    return F.when(F.contains(line, F.lit('"')), line.rlike(pattern)).otherwise(F.lit(inside))


def _lines(spark: SparkSession, paths: str | list[str], recursive: bool) -> DataFrame:
    """Lines with file, split and their two ways to act; only LF ends a line, so a CR stays in its field."""
    return (
        spark.read.option("recursiveFileLookup", recursive)
        .option("lineSep", "\n")
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            leaves_open(F.col("value"), False).alias("opens"),
            leaves_open(F.col("value"), True).alias("stays"),
            "value",
        )
    )


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of splits, in order, to (file_path, block, opens, stays) of each split."""
    ways: dict[tuple, tuple[bool, bool]] = {}
    for batch in batches:
        opens, stays = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("opens", "stays"))
        blocks, files = batch.column("block").to_pylist(), batch.column("file_path").to_pylist()
        for own in set(zip(files, blocks, strict=True)):
            ways.setdefault(own, (False, True))
        for k in np.flatnonzero(opens | ~stays).tolist():  # other lines change nothing
            own = (files[k], blocks[k])
            ways[own] = tuple(bool(stays[k]) if inside else bool(opens[k]) for inside in ways[own])
    columns = [[f for f, _ in ways], [b for _, b in ways], [w[0] for w in ways.values()], [w[1] for w in ways.values()]]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    yield pa.RecordBatch.from_arrays(arrays, ["file_path", "block", "opens", "stays"])


def split_edges(lines: DataFrame) -> DataFrame:
    """(file_path, block, starts_open, ends_open) of each split: whether a quoted field is open at its edges."""
    acts = lines.select("file_path", "block", "opens", "stays").mapInArrow(_composed, "file_path string, block long, opens boolean, stays boolean")
    # a split either sets the state, whatever it was, or turns it, or leaves it
    sets, change = F.col("opens") == F.col("stays"), F.col("opens").cast("int")
    upto = Window.partitionBy("file_path").orderBy("block")
    since = Window.partitionBy("file_path", "setting").orderBy("block")
    ends = (
        acts.withColumn("setting", F.sum(sets.cast("int")).over(upto.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("ends_open", F.sum(change).over(since.rowsBetween(Window.unboundedPreceding, 0)) % 2 == 1)
    )
    return ends.select("file_path", "block", F.coalesce(F.lag("ends_open").over(upto), F.lit(False)).alias("starts_open"), "ends_open")


def _cutter(fragments: bool):
    """Lines of splits, in order, to whole records or, with ``fragments``, to what crosses a split's edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, number, waiting, first = None, False, 0, [], False
        out: list[tuple] = []

        def give(kind: int, closed: bool, text: str) -> None:
            if (kind != _WHOLE) == fragments:
                out.append((*split, number, kind, closed, text))

        def end_of_split() -> None:
            nonlocal waiting
            if waiting:
                give(_TAIL if first else _HEAD, False, "\n".join(waiting))
            waiting = []

        def batch_of() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[]] * 6
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
            names = ["file_path", "block", "number", "kind", "closed", "text"]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
            out.clear()
            return made

        for batch in batches:
            files, blocks = batch.column("file_path"), batch.column("block").to_numpy()
            opens, stays, opened = (batch.column(c).to_pylist() for c in ("opens", "stays", "starts_open"))
            codes = files.dictionary_encode().indices.to_numpy()
            edges = np.flatnonzero(np.append(True, (blocks[1:] != blocks[:-1]) | (codes[1:] != codes[:-1]))[: len(blocks)])
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(blocks)], strict=True):
                own = (files[a].as_py(), int(blocks[a]))
                if own != split:
                    if split is not None:
                        end_of_split()
                    split, inside, number, first = own, opened[a], 0, opened[a]
                for k, text in enumerate(batch.column("value").slice(a, b - a).to_pylist(), a):
                    still = stays[k] if inside else opens[k]
                    if still:
                        waiting.append(text)
                    elif waiting or inside:
                        waiting.append(text)
                        give(_TAIL if first else _WHOLE, True, "\n".join(waiting))
                        waiting, first, number = [], False, number + 1
                    elif text.rstrip("\r"):
                        give(_WHOLE, True, text)
                        number += 1
                    inside = still
                if len(out) >= 8192:
                    yield batch_of()
        if split is not None:
            end_of_split()
        yield batch_of()

    return run


def _located(lines: DataFrame, edges: DataFrame, marked: DataFrame) -> DataFrame:
    """Lines with ``starts_open``, each split's in order. ``marked`` holds the splits that begin open."""
    if marked.limit(_SMALL + 1).count() <= _SMALL:
        found = lines.join(F.broadcast(marked.select("file_path", "block", F.lit(True).alias("starts_open"))), ["file_path", "block"], "left")
    else:
        found = lines.join(edges.select("file_path", "block", "starts_open"), ["file_path", "block"])
        found = found.sortWithinPartitions("file_path", "block", "line")
    columns = ["file_path", "block", "opens", "stays", F.coalesce("starts_open", F.lit(False)).alias("starts_open"), "value"]
    return found.select(*columns)


def scan_records(spark: SparkSession, paths: str | list[str], recursive: bool = False) -> DataFrame:
    """(file_path, block, number, closed, text) of the records of all files, headers included.

    ``number`` counts the records of a split from 0; a record belongs to the split in which it begins, and the
    one at block 0, number 0 is its file's header. ``closed`` is false for a record whose quote the file never closes.
    """
    lines = _lines(spark, paths, recursive)
    edges = split_edges(lines)
    marked = edges.filter("starts_open")
    records = _located(lines, edges, marked).mapInArrow(_cutter(False), _PIECES).select("file_path", "block", "number", "closed", "text")
    # only splits with an open edge are read again for their fragments
    crossing = edges.filter("starts_open OR ends_open").select("file_path", "block")
    if crossing.isEmpty():
        return records
    near = _located(lines.join(_sized(crossing), ["file_path", "block"], "left_semi"), edges, marked)
    pieces = near.mapInArrow(_cutter(True), _PIECES)
    order = Window.partitionBy("file_path").orderBy("block", "number")
    owned = pieces.withColumn("owner", F.sum((F.col("kind") == _HEAD).cast("long")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "number", "text", "closed")))
    seams = owned.groupBy("file_path", "owner").agg(parts.alias("parts")).select(
        "file_path",
        F.get("parts", F.lit(0))["block"].alias("block"),
        F.get("parts", F.lit(0))["number"].alias("number"),
        F.element_at("parts", -1)["closed"].alias("closed"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"),
    )
    return records.unionAll(seams)


def _sized(splits: DataFrame) -> DataFrame:
    return F.broadcast(splits) if splits.limit(_SMALL + 1).count() <= _SMALL else splits


# ---- fields and faults --------------------------------------------------


def fields_of(text: Column) -> Column:
    """Fields of a CSV record as they stand in it, quotes included."""
    return F.regexp_extract_all(text, F.lit(r'(?:^|,)("[^"]*+(?:""[^"]*+)*+"[^,]*|[^,]*)'), F.lit(1))


def _fault(corrupt: Column, width: int, closed: Column) -> Column:
    """(reason, text, fields) of a record that does not fit its header; NULL for those that do."""
    fields = fields_of(corrupt)
    reason = F.when(~closed, F.lit(OPEN)).when(F.size(fields) > width, F.lit(LONG)).otherwise(F.lit(SHORT))
    return F.when(corrupt.isNotNull(), F.struct(reason.alias("reason"), corrupt.alias("text"), fields.alias("fields")))


def scan_with_faults(
    spark: SparkSession, paths: str | list[str], names: Sequence[str], line_breaks: bool, recursive: bool = False
) -> DataFrame:
    """Text columns of header CSV, each record's file (``_file_path``) and fault (``_fault``).

    ``line_breaks`` tells that some quoted field runs over a line end.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, FAULT)])
    options = {"escape": '"', "nullValue": "", "columnNameOfCorruptRecord": FAULT, "mode": "PERMISSIVE"}
    columns = [F.col(f"`{n}`") for n in names]
    if not line_breaks:
        found = (
            spark.read.options(**options).option("header", True).option("enforceSchema", True)
            .option("columnPruning", False)  # the number of a record's fields is told only if all are read
            .option("recursiveFileLookup", recursive).schema(schema).csv(paths)
        )
        path = F.col("_metadata.file_path").alias(FILE)
        # every line is a whole record here
        text = F.col(f"`{FAULT}`")
        closed = ~F.coalesce(leaves_open(text, False), F.lit(False))
        # Spark does not read the text of a record alone: a further column is named, which decides nothing
        closed = closed | (F.length(F.coalesce(columns[0], F.lit(""))) < 0)
        return found.select(*columns, path, _fault(text, len(names), closed).alias(FAULT))
    text = F.regexp_replace("text", r"\r\z", "")
    records = scan_records(spark, paths, recursive).filter("block > 0 OR number > 0")
    parsed = records.select(F.col("file_path").alias(FILE), "closed", text.alias("_text"))
    parsed = parsed.withColumn("_record", _from_csv("_text", schema, options))
    corrupt = F.when(~F.col("closed"), F.col("_text")).otherwise(F.col("_record").getField(FAULT))
    values = [F.col("_record").getField(n).alias(n) for n in names]
    return parsed.select(*values, FILE, _fault(corrupt, len(names), F.col("closed")).alias(FAULT))


def _from_csv(column: str, schema: T.StructType, options: dict[str, str]) -> Column:
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
    return F.from_csv(F.col(column), F.lit(ddl), options)


def is_refused(fault: Column) -> Column:
    """Whether a record's fault loses data if the record is taken as it is."""
    return F.coalesce(fault["reason"].isin(LONG, OPEN), F.lit(False))


def refusing(df: DataFrame, keep_path: bool = False) -> DataFrame:
    """The rows; a record that would lose fields ends the job that meets it, naming file and reason."""
    told = F.concat(F.col(FAULT)["reason"], F.lit(" in "), F.col(FILE), F.lit(": "), F.left(F.col(FAULT)["text"], F.lit(200)))
    bad = is_refused(F.col(FAULT))
    checked = df.filter(F.when(bad, F.raise_error(told).cast("boolean")).otherwise(F.lit(True)))
    return checked.drop(FAULT) if keep_path else checked.drop(FAULT, FILE)


def faults_of(df: DataFrame) -> DataFrame:
    """(file_path, reason, text, fields) of the records that a load must refuse or keep apart."""
    return df.filter(is_refused(F.col(FAULT))).select(F.col(FILE).alias("file_path"), f"{FAULT}.*")

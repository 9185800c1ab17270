"""Ranked lexical search by pipelined term partitioning.

The terms of the queries belong to owners, the rarest (which tell most) to the
first. A bundle carries, for the items of a block, a sparse accumulator of
document scores for one shard of documents. It visits the owners one after the
other: each stage is a cogroup of the bundles with that owner's postings of the same
shard, which adds integer contributions and sends the bundle on. Shards split the
postings of every term, so a term that a third of all documents hold is spread
over as many tasks as there are shards, and a group is bounded by a shard.

The pipeline is exact. After each stage the k-th best partial score of an item, over all
shards, is a floor of its final k-th score. An accumulator stays unless its score and
the most that later owners can add, with this shard's own postings, is below the floor; a stage
opens new accumulators for an item unless all that it and later owners can add is
below it. The last stage hands on each shard's k best, from which the k best of all are selected.

Scores are integers of one formula: a term weighs floor(1000 ln((2N+2) / (2df+1))), and adds
that times (10**9 tf) div (1000 tf + 20 m), where m = 50 + (50 n N) div L tells how long
the document is. N counts the documents with a term, L all terms, n the document's terms.

Items are taken in blocks of a bounded number of terms, each against all
documents; the terms of a block are all that is broadcast.

Edge cases: NULL, empty or blank texts have no terms: such documents do not count
and such items have no results. Terms are whole, whatever their length. A document
row with a NULL id is ranked, last among ties. Repeated document rows are ranked each on
its own, equal ones in any order. Item rows that are wholly equal count once;
different texts under one item id are ranked as items of their own. Empty tables give an empty result. Only
the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revflow.llm.blocks import pack, unpack
from revflow.llm.tables import frugal, stored
from revflow.llm.words import release, slices

OWNERS = 4
SHARD_DOCS = 8192
SHARD_POSTINGS = 1 << 21
BLOCK_TERMS = 1 << 18

_KEEP = np.zeros(256, bool)
_KEEP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NULL_ID = np.iinfo(np.int64).max


def terms_of(offsets: np.ndarray, data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The lower-case terms of consecutive texts, and the number of terms of each text."""
    keep = _KEEP[data]
    start = keep.copy()
    start[1:] &= ~keep[:-1]
    breaks = offsets[:-1][offsets[:-1] < len(data)]
    start[breaks] = keep[breaks]
    place = np.cumsum(keep, dtype=np.int64)  # kept bytes up to and with each byte
    at = np.flatnonzero(start)
    cuts = np.append(place[at] - 1, place[-1] if len(place) else 0).astype(np.int64)
    body = _LOWER[data[keep]]
    terms = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(cuts), pa.py_buffer(body)])
    return terms, np.diff(np.searchsorted(at, offsets))


# --- the postings of one shard of documents -----------------------------------------------------


def _indexer(vocabulary):
    """Batches of documents to rows (shard, postings, documents with terms, terms, documents of each query term)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(vocabulary.value, pa.large_binary())
        task, number = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        found: list[np.ndarray] = []
        docs = postings = 0

        def shard() -> pa.RecordBatch:
            nonlocal number, docs, postings
            doc, n = np.concatenate(ids), np.concatenate(sizes)
            rows = np.concatenate(found, axis=1)
            term, at = np.unique(rows[0], return_counts=True)
            order = np.lexsort((rows[1], rows[0]))
            body = pack(doc, n.astype(np.int64), *(rows[i][order].astype(np.int32) for i in range(3)))
            out = [[(task << 32) | number], [body], [int((n > 0).sum())], [int(n.sum())], [term.tolist()], [at.tolist()]]
            for held in (ids, sizes, found):
                held.clear()
            number, docs, postings = number + 1, 0, 0
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["shard", "body", "n_docs", "n_terms", "term", "df"]
            )

        for batch in batches:
            for piece, offsets, data in slices(batch):
                terms, n = terms_of(offsets, data)
                which = pc.index_in(terms, value_set=words)
                known = np.flatnonzero(pc.is_valid(which).to_numpy(zero_copy_only=False))
                which = which.fill_null(0).to_numpy(zero_copy_only=False)[known].astype(np.int64)
                doc = np.repeat(np.arange(len(n)), n)[known]
                key, tf = np.unique(doc * len(words) + which, return_counts=True)
                # documents without terms cannot score and need no place in a shard
                full = np.flatnonzero(n > 0)
                local = np.searchsorted(full, key // max(1, len(words))) + docs
                ids.append(piece.column("doc_id").fill_null(_NULL_ID).to_numpy(zero_copy_only=False)[full])
                sizes.append(n[full])
                found.append(np.stack([key % max(1, len(words)), local, tf]))
                docs, postings = docs + len(full), postings + len(key)
                if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                    yield shard()
        if docs:
            yield shard()
        release()

    return run


def _dealer(owner: np.ndarray, documents: int, terms: int):
    """Rows of the indexer to the postings of each owner, with their share of the length formula worked in.

    Row -1 of a shard is its empty bundle: document ids and the most that each query term adds to a document here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc, n, term, local, tf = unpack(batch.column("body")[i].as_py())
                m = np.array([50 + (50 * x * documents) // terms for x in n.tolist()], np.int64)  # Python integers do not overflow
                tf = tf.astype(np.int64)
                part = (1_000_000_000 * tf) // (1000 * tf + 20 * m[local])
                first = np.flatnonzero(np.append(True, term[1:] != term[:-1])[: len(term)])
                most = np.maximum.reduceat(part, first) if len(first) else np.empty(0, np.int64)
                bodies = [(-1, pack(doc, term[first], most.astype(np.int32)))]
                of = owner[term]
                for stage in np.unique(of).tolist():
                    own = np.flatnonzero(of == stage)
                    bodies.append((stage, pack(term[own], local[own], part[own].astype(np.int32))))
                shard = batch.column("shard")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * len(bodies), pa.int64()),
                        pa.array([b for _, b in bodies], pa.binary()),
                        pa.array([s for s, _ in bodies], pa.int32()),
                    ],
                    ["shard", "body", "owner"],
                )

    return run


# --- one stage ----------------------------------------------------------------------------------


class _Items:
    """The items of a block: their terms and the terms' weights and owners."""

    def __init__(self, items: list[np.ndarray], weight: np.ndarray, owner: np.ndarray):
        self.items, self.weight, self.owner = items, weight, owner


def _visit(shared, stage: int, last: bool, floors: np.ndarray, k: int):
    """A bundle at an owner: takes the contributions to it, and what can still matter goes on."""
    schema = pa.schema(
        [("shard", pa.int64()), ("body", pa.binary()), ("item", pa.list_(pa.int32())), ("doc_id", pa.list_(pa.int64())), ("score", pa.list_(pa.int64()))]
    )

    def run(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        own: _Items = shared.value
        if not bundle.num_rows:
            return schema.empty_table()
        doc, term, most, item_of, at_of, score_of = _opened(bundle.column("body")[0].as_py())
        full = np.zeros(len(own.weight), np.int64)
        full[term] = most.astype(np.int64) * own.weight[term]
        lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if postings.num_rows:
            of, local, part = unpack(postings.column("body")[0].as_py())
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1])[: len(of)])
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(of)], strict=True):
                lists[int(of[a])] = (local[a:b], part[a:b].astype(np.int64) * own.weight[of[a]])
        cut = np.searchsorted(item_of, np.arange(len(own.items) + 1))
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i, terms in enumerate(own.items):
            have = slice(cut[i], cut[i + 1])
            here = [t for t in terms[own.owner[terms] == stage].tolist() if t in lists]
            if not here and cut[i] == cut[i + 1]:
                continue
            later = int(full[terms[own.owner[terms] > stage]].sum())
            score = np.zeros(len(doc), np.int64)
            score[at_of[have]] = score_of[have]
            for t in here:
                local, value = lists[t]
                score[local] += value
            if floors[i] > later + int(full[here].sum()):  # a document without an accumulator cannot get there
                at = at_of[have].astype(np.int64)
            else:
                at = np.flatnonzero(score)
            value = score[at]
            # the shard's own k-th best is a floor too
            floor = max(int(floors[i]), int(np.partition(value, len(value) - k)[len(value) - k]) if len(value) >= k else 1)
            stays = (value > 0) & (value + later >= floor)
            at, value = at[stays], value[stays]
            if not last:
                kept.append((np.full(len(at), i, np.int32), at.astype(np.int32), value))
            top = np.lexsort((doc[at], -value))[:k]
            best.append((np.full(len(top), i, np.int32), doc[at[top]], value[top]))
        joined = lambda parts, c, kind: np.concatenate([p[c] for p in parts]).astype(kind) if parts else np.empty(0, kind)
        body = b"" if last else pack(doc, term, most, *(joined(kept, c, kind) for c, kind in ((0, np.int32), (1, np.int32), (2, np.int64))))
        release()
        return pa.table(
            {
                "shard": [bundle.column("shard")[0].as_py()],
                "body": [body],
                "item": [joined(best, 0, np.int32)],
                "doc_id": [joined(best, 1, np.int64)],
                "score": [joined(best, 2, np.int64)],
            },
            schema=schema,
        )

    return run


def _opened(body: bytes) -> list[np.ndarray]:
    arrays = unpack(body)
    return arrays if len(arrays) == 6 else [*arrays, np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int64)]


def _ranked(stage: DataFrame, k: int) -> DataFrame:
    """The k best (item, doc_id, score) of what the shards hand in, with their rank."""
    rows = stage.select(F.explode(F.arrays_zip("item", "doc_id", "score")).alias("r")).select("r.*")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


# --- the search ---------------------------------------------------------------------------------


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, text_hash, terms) of the items that have terms; wholly equal rows once."""
    lower = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.array_sort(F.array_distinct(F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))))
    rows = items.select("item_id", "text").distinct()
    return rows.select("item_id", F.xxhash64("item_id", "text").alias("spread"), terms.alias("terms")).filter(F.size("terms") > 0)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, owners: int = OWNERS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of every item (``item_id``, ``text``)."""
    spark = docs.sparkSession
    frugal(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asked = stored(query_terms(items), "search-items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // BLOCK_TERMS)
    kind = asked.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    if not blocks:
        return spark.createDataFrame([], schema)
    parts = [
        _of_block(rows, asked.filter(F.pmod("spread", F.lit(blocks)) == block), k, owners) for block in range(blocks)
    ]
    return reduce(DataFrame.unionAll, parts).select("item_id", "rank", "doc_id", "score")


def _of_block(rows: DataFrame, asked: DataFrame, k: int, owners: int) -> DataFrame:
    spark = rows.sparkSession
    # one block's items, a bounded number of terms
    own = asked.orderBy("spread", "item_id", "terms").toArrow()
    if not own.num_rows:
        return asked.selectExpr("item_id", "0 AS rank", "0L AS doc_id", "0L AS score").limit(0)
    flat = pc.list_flatten(own.column("terms")).combine_chunks().cast(pa.large_binary())
    words = pc.unique(flat)
    words = words.take(pc.sort_indices(words))
    sizes = pc.list_value_length(own.column("terms")).to_numpy()
    items = np.split(pc.index_in(flat, value_set=words).to_numpy(), np.cumsum(sizes)[:-1])
    indexed = rows.mapInArrow(
        _indexer(spark.sparkContext.broadcast(words.to_pylist())),
        "shard long, body binary, n_docs long, n_terms long, term array<int>, df array<long>",
    )
    indexed = stored(indexed, "search-shards")
    documents, terms = indexed.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    if not documents:
        return asked.selectExpr("item_id", "0 AS rank", "0L AS doc_id", "0L AS score").limit(0)
    counts = indexed.select(F.explode(F.arrays_zip("term", "df")).alias("r")).groupBy("r.term").agg(F.sum("r.df").alias("df")).toArrow()
    df = np.zeros(len(words), np.int64)
    df[counts.column("term").to_numpy()] = counts.column("df").to_numpy()
    weight = np.floor(1000 * np.log((2.0 * documents + 2) / (2.0 * df + 1))).astype(np.int64)
    owner = _owners(df, owners)
    dealt = stored(
        indexed.select("shard", "body").mapInArrow(_dealer(owner, documents, terms), "shard long, body binary, owner int"), "search-postings", "owner"
    )
    shared = spark.sparkContext.broadcast(_Items(items, weight, owner))
    schema = "shard long, body binary, item array<int>, doc_id array<long>, score array<long>"
    bundles = dealt.filter("owner = -1").select("shard", "body")
    floors = np.zeros(len(items), np.int64)
    for stage in range(owners):
        last = stage == owners - 1
        postings = dealt.filter(F.col("owner") == stage).select("shard", "body")
        visit = _visit(shared, stage, last, floors, k)
        after = stored(bundles.groupBy("shard").cogroup(postings.groupBy("shard")).applyInArrow(visit, schema), f"search-owner{stage}")
        if not last:
            reached = _ranked(after, k).filter(F.col("rank") == k).select("item", "score").toArrow()
            floors = np.zeros(len(items), np.int64)
            floors[reached.column("item").to_numpy()] = reached.column("score").to_numpy()
            bundles = after.select("shard", "body")
    names = spark.createDataFrame(
        pa.table({"item": pa.array(range(own.num_rows), pa.int32()), "item_id": own.column("item_id")})
    )
    found = _ranked(after, k).join(F.broadcast(names), "item")  # one block's items
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), F.nullif("doc_id", F.lit(_NULL_ID)).alias("doc_id"), "score")


def _owners(df: np.ndarray, owners: int) -> np.ndarray:
    """The owner of each term, rarest first; each owner has four times the postings of the one before it."""
    order = np.argsort(df, kind="stable")
    share = np.cumsum(df[order]) / max(1, int(df.sum()))
    edges = np.array([4.0 ** (s + 1 - owners) for s in range(owners - 1)])
    out = np.empty(len(df), np.int32)
    out[order] = np.searchsorted(edges, share)
    return np.minimum(out, owners - 1)

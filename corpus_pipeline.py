"""From raw documents to packed training sequences, in five stages.

Each stage works on all that the one before kept, as written to Parquet and read
again; all but the last return the columns of ``documents``, whatever further ones there are and
whatever they are called. Rows with a NULL id are never dropped as copies of others, since nothing could refer to
them. NULL and empty texts pass all stages but the first, if it rejects them, and the second, which keeps
one of them. Very long texts are read whole. Of rows equal in id and text the second stage keeps all or none; different texts
under one id are different documents. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revflow.llm import decontamination, exact_dedup, minhash, packing, quality, toxicity
from revflow.llm.tables import crc_of_id, small_side, stored, table, vocabulary


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches 0.3, by a classifier learned from the labelled ones."""
    learned = toxicity.labelled(table(spark, sf_dir, "labels"), "quality", crc_of_id(5) != 0)
    return quality.keep_good(docs, quality.fit(docs, learned), 0.3)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space."""
    gone = exact_dedup.exact_groups(docs).filter("NOT kept").select("doc_id", "text_sha256").distinct()
    gone = small_side(stored(gone, "copies"), 128)
    digest = F.sha2(exact_dedup.normalised(F.col("text")).cast("binary"), 256)
    return docs.join(gone, (docs["doc_id"] == gone["doc_id"]) & (digest == gone["text_sha256"]), "left_anti")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by sets of five-word shingles with a similarity of at least 0.8: the one with the smallest id.

    A document is known by its id and its text, so different texts under one id are judged each on its own.
    """
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    named = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("text"), key.alias("doc_id"))
    found = stored(minhash.near_duplicates(named, k=5, percent=80).select("doc_id", "component_id", "kept"), "near-copies")
    linked = found.filter("NOT kept").select("component_id").distinct()
    members = found.join(linked, "component_id").join(named.select("id", "doc_id").distinct(), "doc_id").distinct()
    smallest = members.groupBy("component_id").agg(F.min(F.struct("id", "doc_id")).alias("m"))
    stays = smallest.select(F.col("m.doc_id").alias("doc_id"))
    gone = members.select(F.col("doc_id")).distinct().join(stays, "doc_id", "left_anti").select(F.col("doc_id").alias("gone"))
    gone = small_side(stored(gone, "near-copies"), 16)
    return docs.join(gone, key == gone["gone"], "left_anti")


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no run of ten words with a benchmark item."""
    found = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"), words=10, k=5)
    gone = found.filter("n_hit > 0").select(F.col("doc_id").alias("gone_id"), "text_key").distinct()
    gone = small_side(stored(gone, "contaminated"), 32)
    same = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64(F.coalesce("text", F.lit(""))) == gone["text_key"])
    return docs.join(gone, same, "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of binary lengths, each a sequence of its own, with their token ids."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), longest=1024, end=0, ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmarks),
    ("packing", packed),
]

#: The quality classifier is not expressible in SQL; tests hold all stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is stored before the next reads it."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)

"""Near duplicates by a Hamming join of min-hash signatures through several indexes.

A signature has 60 components of 16 bits, each the reduced minimum of one hash
of the document's word pairs. It is split into 10 chunks of 6 components. When
two signatures differ in at most 19 components, some chunk holds at most one
difference by the pigeonhole principle, so the six ways of leaving out one
component of each chunk index all such pairs: 60 keys per document. Two
documents at a similarity of exactly 0.8 share no key with a probability of
0.00003; candidates are confirmed on their full sets. Five components in a key keep
documents apart that only share a common passage.

Groups of similar documents are not expanded into pairs. Documents with equal sets
are one class. Within each key, classes are compared with the one class that
shares the most keys overall, their centre; confirmed links give components. What
remains are classes around one centre in different components. Links between these are
found by what they differ in from the centre, through prefixes of rare differences, which
misses none and compares few.

Edge cases: texts without words (empty or NULL) have no shingles and are linked
with nothing; texts of one word have that word as their only shingle. Rows with equal
ids count as one document, and each row is returned. Rows with a NULL id keep
their shingle count, join no component, have component_id NULL and are kept. An
empty table gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revflow.llm.components import components
from revflow.llm.tables import frugal, small_side, stored
from revflow.llm.words import find_words, mix, slices, windows

CHUNKS, WIDTH = 10, 6
_PARTS = CHUNKS * WIDTH
#: Classes that differ from their centre in more components are not compared on their sets (at 0.8: one in a million).
FAR = 28
_RNG = np.random.default_rng(77)
_SEED = _RNG.integers(0, 2**63, _PARTS, dtype=np.uint64)
_FACTOR = _RNG.integers(0, 2**63, _PARTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(offsets: np.ndarray, data: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct k-word shingles of each document, sorted, and the shingles before each document."""
    words = find_words(offsets, data, lower=True)
    size = np.diff(words.first)
    n = len(words.hash)
    if k > 1:
        whole = windows(words.hash, k)
        left = np.repeat(words.first[1:], size) - np.arange(n)  # words from here to the end of the document
        at = np.flatnonzero(left >= k)
        short = np.flatnonzero((size > 0) & (size < k))
        hashes = [whole[at]]
        doc = [words.doc()[at]]
        for length in range(1, k):
            own = short[size[short] == length]
            hashes.append(windows(words.hash, length)[words.first[:-1][own]] ^ np.uint64(length))
            doc.append(own)
        hash_, doc = np.concatenate(hashes), np.concatenate(doc)
    else:
        hash_, doc = words.hash, words.doc()
    order = np.lexsort((hash_, doc))
    hash_, doc = hash_[order], doc[order]
    new = np.ones(len(hash_), bool)
    new[1:] = (hash_[1:] != hash_[:-1]) | (doc[1:] != doc[:-1])
    hash_, doc = hash_[new], doc[new]
    return hash_, np.searchsorted(doc, np.arange(len(size) + 1))


def _sketches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, offsets, data in slices(batch):
                hashes, first = shingle_sets(offsets, data, k)
                n = np.diff(first)
                full = np.flatnonzero(n > 0)
                at = first[:-1][full]
                low, high = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                signature = np.zeros((len(n), _PARTS), np.int16)
                if len(full):
                    low[full] = np.add.reduceat(mix(hashes), at)
                    high[full] = np.add.reduceat(mix(hashes ^ _SEED[0]), at)
                    for i in range(_PARTS):
                        least = np.minimum.reduceat((hashes ^ _SEED[i]) * _FACTOR[i], at)
                        signature[full, i] = mix(least).astype(np.uint16).view(np.int16)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array(n.astype(np.int64)),
                        pa.array(low.view(np.int64)),
                        pa.array(high.view(np.int64)),
                        pa.FixedSizeListArray.from_arrays(pa.array(signature.ravel()), _PARTS).cast(pa.list_(pa.int16())),
                    ],
                    ["doc_id", "n_shingles", "low", "high", "signature"],
                )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, offsets, data in slices(batch):
                hashes, first = shingle_sets(offsets, data, k)
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), lists], ["id", "set"])

    return run


def index_keys(signature: Column) -> Column:
    """The keys of a signature: for each chunk and each left-out component the hash of the others."""
    return F.array(
        *[
            F.xxhash64(F.lit(c * WIDTH + out), *[signature[c * WIDTH + i] for i in range(WIDTH) if i != out])
            for c in range(CHUNKS)
            for out in range(WIDTH)
        ]
    )


def _apart(a: str, b: str) -> Column:
    """Number of components in which two signatures differ."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda z: z))


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    rows = pairs.join(left, "a").join(right, "b").withColumn("common", common)
    return rows.filter(100 * F.col("common") >= percent * (F.size("set_a") + F.size("set_b") - F.col("common"))).select("a", "b")


def _across(around: DataFrame, sets: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` around one centre, in different components, whose sets may reach the similarity.

    Sets x and y are similar enough when their symmetric difference holds at most
    (1 - s) / (1 + s) * (|x| + |y|) elements. Let A and B be their differences from
    the centre. If x was not linked to the centre, A alone is larger than that, so
    x and y can only be linked if A and B have (|A| + |B| - the bound) / 2 elements
    in common. With the elements of each difference in one order, rarest first,
    such a pair has its first common element within a short prefix of both, with enough
    elements behind it. That leaves few pairs to compare, and none out.
    """
    part = (100 - percent) / (100 + percent)
    home = placed.select(F.col("node").alias("centre"), F.col("component").alias("home"))
    of_centre = sets.select(F.col("id").alias("centre"), F.col("set").alias("centre_set"))
    differing = (
        around.join(sets, "id")
        .join(of_centre, "centre")
        .join(home, "centre", "left")
        .select(
            "centre",
            "id",
            "component",
            (F.col("component") != F.coalesce("home", "centre")).alias("outside"),
            F.size("set").alias("n"),
            F.size("centre_set").alias("m"),
            F.concat(F.array_except("set", "centre_set"), F.array_except("centre_set", "set")).alias("d"),
        )
    )
    differing = stored(differing, "differences")
    elements = differing.select("centre", F.explode("d").alias("e"))
    often = elements.groupBy("centre", "e").agg(F.count("*").alias("f")).filter("f > 1")
    # elements that occur once come first in every order and join nothing, so only their number matters
    shared = differing.select("centre", "id", F.explode("d").alias("e")).join(often, ["centre", "e"])
    orders = shared.groupBy("centre", "id").agg(F.array_sort(F.collect_list(F.struct("f", "e"))).alias("order"))
    size = F.size("d")
    longest = F.when(F.col("outside"), part * F.col("n") * (1 + 100 / percent)).otherwise((size + part * (F.col("n") - F.col("m"))) / 2)
    prefix = F.greatest(F.lit(1), F.floor(longest + 1e-6).cast("int") + 1)
    rows = (
        differing.join(orders, ["centre", "id"])
        .select(
            "centre", "id", "component", "outside", "n", size.alias("size"), prefix.alias("prefix"), F.posexplode("order").alias("i", "x"),
            (size - F.size("order")).alias("alone"),
        )
        .select("centre", "id", "component", "outside", "n", "size", "prefix", F.col("x.e").alias("e"), (F.col("i") + F.col("alone")).alias("i"))
        .filter("i < prefix")
    )
    rows = stored(rows, "prefixes")
    p, q = rows.filter("outside").alias("p"), rows.alias("q")
    left = F.least(F.col("p.size") - F.col("p.i"), F.col("q.size") - F.col("q.i"))
    enough = (F.col("p.size") + F.col("q.size") - part * (F.col("p.n") + F.col("q.n"))) / 2 - 1e-6
    return (
        p.join(
            q,
            (F.col("p.centre") == F.col("q.centre"))
            & (F.col("p.e") == F.col("q.e"))
            & (F.col("p.component") != F.col("q.component"))
            & (~F.col("q.outside") | (F.col("p.id") < F.col("q.id")))
            & (left >= enough),
        )
        .select(F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, k: int = 2, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs``.

    Documents are linked when the Jaccard similarity of their sets of k-word
    shingles is at least ``percent`` / 100; the smallest id of a component stays.
    """
    frugal(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketches = stored(
        rows.mapInArrow(_sketches(k), "doc_id long, n_shingles long, low long, high long, signature array<short>"), "sketches"
    )
    linkable = sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # equal sets are one class; its smallest document stands for it
    classes = stored(
        linkable.groupBy("low", "high").agg(
            F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")
        ),
        "classes",
    )
    keyed = classes.select("id", F.explode(index_keys(F.col("signature"))).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    members = stored(keyed.join(shared, "key"), "members")
    busy = members.groupBy("id").agg(F.sum("c").alias("weight"))
    weighed = members.join(busy, "id")
    centres = weighed.groupBy("key").agg(F.max(F.struct("weight", F.bitwise_not("id").alias("i"))).alias("m"))
    centres = centres.select("key", F.bitwise_not("m.i").alias("centre"))
    looks = classes.select("id", "n", "signature")
    of_a = looks.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("s_a"))
    of_b = looks.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("s_b"))
    stars = (
        members.join(centres, "key")
        .filter("id <> centre")
        .select(F.col("centre").alias("a"), F.col("id").alias("b"))
        .distinct()
        .join(of_a, "a")
        .join(of_b, "b")
        .filter(_sizes_fit("n_a", "n_b", percent) & (_apart("s_a", "s_b") <= FAR))
        .select("a", "b")
    )
    needed = small_side(stored(members.select("id").distinct(), "needed"), 8)
    sets = stored(
        rows.join(needed, rows["doc_id"] == needed["id"], "left_semi").mapInArrow(_sets(k), "id long, set array<long>"), "sets"
    )
    links = stored(_confirmed(stars, sets, percent), "links")
    first = stored(components(links), "components")

    # what one centre did not settle: members of one key in different components
    placed = (
        members.filter("c > 2")
        .join(first, F.col("id") == F.col("node"), "left")
        .select("key", "id", F.coalesce("component", "id").alias("component"))
        .join(centres, "key")
    )
    open_keys = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    around = (
        placed.join(open_keys.select("key"), "key", "left_semi")
        .filter("id <> centre")
        .select("centre", "id", "component")
        .distinct()
    )
    rest = _across(stored(around, "around"), sets, first, percent)
    more = stored(_confirmed(rest, sets, percent), "links")
    final = components(links.union(more)) if more.count() else first
    named = classes.join(final, F.col("id") == F.col("node"), "left").select(
        "low", "high", F.coalesce("component", "id").alias("component")
    )
    out = linkable.join(named, ["low", "high"]).select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    alone = sketches.filter("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )

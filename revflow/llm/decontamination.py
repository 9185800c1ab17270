"""Benchmark decontamination by winnowing, in DataFrame operations only.

Every window of ``words - k + 1`` neighbouring k-gram hashes keeps its
minimum, in documents and benchmark items alike. A shared run of ``words`` words
has the same hashes on both sides, so it shares the kept one: no such run is
missed. Kept hashes of the two tables are joined; each hit is extended by
comparing the item with the document along the hit's offset, word by word. Items of
fewer words than a window are found by the hash of the whole item among all
runs of that length.

Fingerprints are distinct per document before the join, and a document meets a
benchmark item once per offset, however often the passage occurs elsewhere. The
benchmark side is broadcast if its counted size allows, else both sides are
shuffled with adaptive skew handling.

Edge cases: NULL and empty texts have no words: such documents are clean and
such items occur nowhere. Equal rows each get their result. NULL item ids count
as the empty text in lists of items. Items with the same id count once. An empty
table on either side is allowed. Other columns of either table are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revflow.llm.tables import small_side, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-case words: runs of a-z, 0-9 and characters beyond ASCII."""
    text = F.coalesce(text, F.lit(""))
    # lower() also changes letters beyond ASCII, so it serves only texts without any
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.filter(F.split(low, _GAP), lambda w: w != "")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, also where ``use`` has lambdas that read it."""
    return F.get(F.transform(F.array(value), use), 0)


def _runs(words: Column, k: int) -> Column:
    """Hashes of all runs of k words, in order."""
    return _let(
        words,
        lambda w: F.when(
            F.size(w) >= k, F.transform(F.sequence(F.lit(1), F.size(w) - k + 1), lambda i: F.xxhash64(F.slice(w, i, k)))
        ).otherwise(F.array().cast("array<bigint>")),
    )


def _kept(hashes: Column, width: int) -> Column:
    """The distinct minima of all windows of hashes."""
    return _let(
        hashes,
        lambda h: F.when(
            F.size(h) >= width,
            F.array_distinct(
                F.transform(F.sequence(F.lit(1), F.size(h) - width + 1), lambda i: F.array_min(F.slice(h, i, width)))
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    words: int = 10,
    k: int = 5,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids), spots (places of hit words, from 0) and text_key (xxhash64 of the text) for each row of ``docs``.

    ``words`` is the length of a window, ``k`` that of the hashed grams.
    """
    if not 1 <= k <= words:
        raise ValueError("k must lie between 1 and the window")
    width = words - k + 1
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # rows with the same id and text share one key, and one result
    key = [F.col("doc_id").alias("key_id"), F.xxhash64("text").alias("key_text")]
    empty = F.array().cast("array<bigint>")
    bench = stored(
        items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), words_of(F.col(item_text)).alias("words"))
        .filter(F.size("words") > 0)
        .distinct()
        .withColumn("runs", F.when(F.size("words") >= words, _runs(F.col("words"), k)).otherwise(empty))
        .select(
            F.monotonically_increasing_id().alias("item"),
            "item_id",
            "words",
            "runs",
            F.when(F.size("words") >= words, _kept(F.col("runs"), width)).otherwise(F.array(F.xxhash64("words"))).alias("kept"),
        ),
        "items",
    )
    short = [r[0] for r in bench.filter(F.size("words") < words).select(F.size("words")).distinct().collect()]
    prints = stored(bench.select("item", (F.size("words") < words).alias("short"), F.explode("kept").alias("print")), "item-prints")
    worded = rows.select(*key, words_of(F.col("text")).alias("words"))
    kept = _kept(_runs(F.col("words"), k), width)
    marked = stored(worded.select("key_id", "key_text", F.size("words").cast("long").alias("n_words"), kept.alias("prints")), "prints")
    of_long = small_side(prints.filter("NOT short"), 16)
    found = marked.select("key_id", "key_text", F.explode("prints").alias("print")).join(of_long, "print")
    if short:  # these have no window to choose from, so all runs of their lengths (fewer than ``words``) are looked up
        runs = F.array_distinct(F.concat(*[_runs(F.col("words"), n) for n in sorted(short)]))
        of_short = small_side(prints.filter("short"), 16)
        found = found.unionByName(worded.select("key_id", "key_text", F.explode(runs).alias("print")).join(of_short, "print"))
    hits = stored(found.select("key_id", "key_text", "item").distinct(), "hits")
    met = (
        hits.join(small_side(bench, 2048), "item")
        .groupBy(F.col("key_id").alias("met_id"), F.col("key_text").alias("met_text"))
        .agg(F.collect_list(F.struct("item_id", "words", "runs", "kept")).alias("items"))
    )
    met = stored(met, "met")
    # texts are dealt out only for the documents that met an item; equal rows need one look
    keyed = rows.select(*key, "text")
    some = small_side(stored(met.select("met_id", "met_text"), "met-keys"), 32)
    same = keyed["key_id"].eqNullSafe(some["met_id"]) & (keyed["key_text"] == some["met_text"])
    texts = keyed.join(some, same, "left_semi").dropDuplicates(["key_id", "key_text"])
    same = texts["key_id"].eqNullSafe(met["met_id"]) & (texts["key_text"] == met["met_text"])
    found = texts.join(met, same).select("met_id", "met_text", "items", words_of(F.col("text")).alias("words"))
    looked = found.select(
        "met_id",
        "met_text",
        _let(
            F.struct(F.col("words").alias("words"), _runs(F.col("words"), k).alias("runs"), F.col("items").alias("items")),
            lambda d: _occurrences(d["words"], d["runs"], d["items"], words),
        ).alias("seen"),
    )
    # stored, so that no filter on the result repeats the search
    seen = stored(looked.withColumn("seen", F.filter("seen", lambda x: F.size(x["spots"]) > 0)), "seen")
    places = F.array_sort(F.array_distinct(F.flatten(F.col("seen.spots"))))
    spots = seen.select(
        "met_id",
        "met_text",
        F.array_sort(F.array_distinct(F.col("seen.item_id"))).alias("items"),
        F.size(places).cast("long").alias("n_hit"),
        places.alias("spots"),
    )
    same = marked["key_id"].eqNullSafe(spots["met_id"]) & (marked["key_text"] == spots["met_text"])
    return marked.join(spots, same, "left").select(
        F.col("key_id").alias("doc_id"),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spots", F.array().cast("array<int>")).alias("spots"),
        F.col("key_text").alias("text_key"),
    )


def _occurrences(words: Column, runs: Column, items: Column, length: int) -> Column:
    """For each item its id and the places of the words inside occurrences of its windows."""

    def along(offset: Column, item: Column) -> Column:
        # word q of the item lies on word offset + q of the document
        low = F.greatest(F.lit(0), -offset)
        high = F.least(F.size(item["words"]), F.size(words) - offset)
        equal = F.transform(F.sequence(low, high - 1), lambda q: F.get(item["words"], q) == F.get(words, q + offset))
        return _let(
            equal,
            lambda e: F.when(
                F.size(e) >= length,
                F.flatten(
                    F.transform(
                        F.filter(
                            F.sequence(F.lit(0), F.size(e) - length), lambda i: F.forall(F.slice(e, i + 1, length), lambda x: x)
                        ),
                        lambda i: F.sequence(low + offset + i, low + offset + i + length - 1),
                    )
                ),
            ).otherwise(F.array().cast("array<int>")),
        )

    def of_long(item: Column) -> Column:
        seeds = F.filter(F.sequence(F.lit(0), F.size(runs) - 1), lambda p: F.array_contains(item["kept"], F.get(runs, p)))
        offsets = F.array_distinct(
            F.flatten(
                F.transform(
                    seeds,
                    lambda p: F.transform(
                        F.filter(F.sequence(F.lit(0), F.size(item["runs"]) - 1), lambda q: F.get(item["runs"], q) == F.get(runs, p)),
                        lambda q: p - q,
                    ),
                )
            )
        )
        return F.flatten(F.transform(offsets, lambda o: along(o, item)))

    def of_short(item: Column) -> Column:
        m = F.size(item["words"])
        begins = F.filter(
            F.sequence(F.lit(0), F.greatest(F.size(words) - m, F.lit(0))), lambda i: F.slice(words, i + 1, m) == item["words"]
        )
        return F.flatten(F.transform(begins, lambda i: F.sequence(i, i + m - 1)))

    places = lambda item: F.when(
        F.size(item["words"]) < length, of_short(item)
    ).when(F.size(runs) > 0, of_long(item)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        items, lambda item: F.struct(item["item_id"].alias("item_id"), F.array_distinct(places(item)).alias("spots"))
    )

"""Best-fit packing by a grouping genetic algorithm on islands.

Pieces shorter than a sequence are dealt evenly to regions of about a thousand sequences. A
region is evolved on several islands. A solution is a grouping: the bin of each
piece. Crossover injects whole well-filled bins of one parent into the other, whose bins
that hold any of the injected pieces are taken apart (so that no piece is twice), and best-fits
the pieces displaced by this, longest first. Mutation takes the emptiest bins and a few others
apart in the same way. Solutions are ranked by their bins, then by how unevenly these
are filled. After each epoch every island's best solution migrates to the next island
of its region, in a shuffle of elites. A region stops when it reaches the lower
bound of Martello and Toth: then its packing is an optimal one. Best-fit decreasing is the first solution of each
island, so evolving can only improve on it.

The emptiest bin of each region is opened again, and what it held is packed in the same way
by the next level, until one region is left. So regions cost no sequence of their own, and no task holds
more than one region, whatever the number of documents.

Edge cases: a NULL or empty text is one piece, the separator. Documents longer than a sequence
are cut; full pieces are sequences of their own. Very long texts are encoded whole. Equal
rows and equal ids are packed each on its own, NULL ids stay NULL. An empty
table gives an empty result. Only the id and text columns are read, so other columns may have any name.
A repeated task deals, evolves and numbers in the same way again.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revflow.llm.blocks import pack as packed
from revflow.llm.blocks import unpack
from revflow.llm.tables import frugal, stored
from revflow.llm.word_encoding import word_encoder
from revflow.llm.words import release

REGION = 1024  # sequences of a region, about
ISLANDS = 3
EPOCHS = 3
POPULATION = 6
OFFSPRING = 12


# --- pieces -------------------------------------------------------------------------------------


def _cutter(encode_with: Callable[[], Callable[[str], bytes]], longest: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = encode_with(), np.array([end], "<u4").tobytes()
        seat = TaskContext.get().partitionId() << 33
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["seat", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows: list[list] = [[] for _ in names]
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = encode(text or "") + last
                    for piece, start in enumerate(range(0, len(ids) // 4, longest)):
                        own = ids[4 * start : 4 * (start + longest)]
                        for column, value in zip(rows, (seat, doc, piece, start, len(own) // 4, zlib.crc32(own), own), strict=True):
                            column.append(value)
                        seat += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names)
            release()

    return run


# --- groupings ----------------------------------------------------------------------------------


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """The bound L2 of Martello and Toth on the number of bins."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    weight = count * np.arange(size + 1)
    upto, mass = np.cumsum(count), np.cumsum(weight)
    k = np.arange(size // 2 + 1)
    huge = upto[-1] - upto[size - k]  # longer than size - k
    large = upto[size - k] - upto[size // 2]
    middle = mass[size // 2] - np.where(k > 0, mass[np.maximum(k - 1, 0)], 0)
    room = large * size - (mass[size - k] - mass[size // 2])
    return int((huge + large + np.maximum(0, -(-(middle - room) // size))).max())


def best_fit(lengths: np.ndarray, pieces: np.ndarray, bin_of: np.ndarray, loads: list[int], size: int) -> None:
    """Put the pieces, in their order, each into the fullest bin with room; ``bin_of`` and ``loads`` are changed."""
    free = sorted((size - load, i) for i, load in enumerate(loads) if load < size)
    for p, length in zip(pieces.tolist(), lengths[pieces].tolist(), strict=True):
        at = bisect_left(free, (length, -1))
        if at == len(free):
            b, room = len(loads), size
            loads.append(0)
        else:
            room, b = free.pop(at)
        loads[b] += length
        bin_of[p] = b
        if room > length:
            insort(free, (room - length, b))


def longest_first(lengths: np.ndarray, pieces: np.ndarray, rng: np.random.Generator | None = None) -> np.ndarray:
    """Pieces by falling length, with a generator by lengths that are blurred a little."""
    key = lengths[pieces] if rng is None else lengths[pieces] * rng.uniform(0.9, 1.1, len(pieces))
    return pieces[np.argsort(-key, kind="stable")]


class Grouping:
    """The bin of each piece; bins are numbered without gaps."""

    def __init__(self, bin_of: np.ndarray, lengths: np.ndarray):
        _, self.bin_of = np.unique(bin_of, return_inverse=True)
        self.bin_of = self.bin_of.astype(np.int32)
        self.loads = np.bincount(self.bin_of, lengths).astype(np.int64)

    def rank(self) -> tuple[int, float]:
        """Smaller is better: the number of bins, then the evenness of their loads."""
        return len(self.loads), -float((self.loads.astype(float) ** 2).sum())


def _rebuilt(lengths: np.ndarray, bin_of: np.ndarray, displaced: np.ndarray, size: int) -> Grouping:
    """Best-fit the displaced pieces, longest first, into the bins that stay."""
    stay = np.ones(len(lengths), bool)
    stay[displaced] = False
    names, inner = np.unique(bin_of[stay], return_inverse=True)
    out = np.empty(len(lengths), np.int64)
    out[stay] = inner
    loads = np.bincount(inner, lengths[stay], len(names)).astype(np.int64).tolist()
    best_fit(lengths, longest_first(lengths, displaced), out, loads, size)
    return Grouping(out, lengths)


def crossover(a: Grouping, b: Grouping, lengths: np.ndarray, size: int, rng: np.random.Generator) -> Grouping:
    """Some of the better-filled half of the bins of ``a``, whole, into ``b``."""
    good = np.argsort(-a.loads, kind="stable")[: max(1, len(a.loads) // 2)]
    chosen = good[rng.random(len(good)) < rng.uniform(0.1, 0.6)]
    injected = np.isin(a.bin_of, chosen)
    broken = np.zeros(len(b.loads), bool)
    broken[b.bin_of[injected]] = True
    bin_of = np.where(injected, len(b.loads) + a.bin_of.astype(np.int64), b.bin_of)
    return _rebuilt(lengths, bin_of, np.flatnonzero(broken[b.bin_of] & ~injected), size)


def mutated(a: Grouping, lengths: np.ndarray, size: int, rng: np.random.Generator) -> Grouping:
    """The emptiest bins and a few others taken apart and best-fitted again."""
    few = max(2, len(a.loads) // 20)
    opened = np.append(np.argsort(a.loads, kind="stable")[:few], rng.integers(0, len(a.loads), few))
    return _rebuilt(lengths, a.bin_of.astype(np.int64), np.flatnonzero(np.isin(a.bin_of, opened)), size)


def evolve(population: list[Grouping], lengths: np.ndarray, size: int, least: int, rng: np.random.Generator) -> list[Grouping]:
    """One epoch of an island, best solution first; ends when a solution has ``least`` bins."""
    everything = np.arange(len(lengths))
    while len(population) < POPULATION:
        order = longest_first(lengths, everything, rng if population else None)
        bin_of = np.empty(len(lengths), np.int64)
        best_fit(lengths, order, bin_of, [], size)
        population.append(Grouping(bin_of, lengths))
        if len(population[-1].loads) <= least:
            return sorted(population, key=Grouping.rank)
    for _ in range(OFFSPRING):
        population.sort(key=Grouping.rank)
        if len(population[0].loads) <= least:
            break
        i, j = rng.permutation(max(2, len(population) * 2 // 3))[:2]  # of the better two thirds
        child = crossover(population[i], population[j], lengths, size, rng)
        if rng.random() < 0.5:
            child = mutated(child, lengths, size, rng)
        if child.rank() < population[-1].rank():
            population[-1] = child
    return sorted(population, key=Grouping.rank)[:POPULATION]


# --- islands ------------------------------------------------------------------------------------

_STATE = "region long, island int, shape binary, least int, bins int, people binary, best binary"
_FIELDS = [
    ("region", pa.int64()), ("island", pa.int32()), ("shape", pa.binary()), ("least", pa.int32()), ("bins", pa.int32()),
    ("people", pa.binary()), ("best", pa.binary()),
]


def _shape(group: pa.Table) -> pa.Table:
    """The seats and lengths of a region, in the order of the seats."""
    order = np.argsort(group.column("seat").to_numpy(), kind="stable")
    seat, length = (group.column(c).to_numpy()[order].astype(np.int64) for c in ("seat", "length"))
    return pa.table({"region": group.column("region").slice(0, 1), "shape": pa.array([packed(seat, length)], pa.binary())})


def _state(region: int, island: int, shape: bytes, people: list[Grouping], least: int) -> dict:
    return {
        "region": region, "island": island, "shape": shape, "least": least, "bins": len(people[0].loads),
        "people": packed(*(g.bin_of for g in people)), "best": packed(people[0].bin_of),
    }


def _epoch(number: int, size: int):
    """The state of an island and the elites that arrive, to its next state."""

    def run(own: pa.Table, arriving: pa.Table) -> pa.Table:
        names = pa.schema(_FIELDS)
        if not own.num_rows:
            return names.empty_table()
        region, island, shape = (own.column(c)[0].as_py() for c in ("region", "island", "shape"))
        lengths = unpack(shape)[1]
        least = lower_bound(lengths, size)
        people = [Grouping(g, lengths) for g in unpack(own.column("people")[0].as_py())]
        people += [Grouping(unpack(b)[0], lengths) for b in arriving.column("best").to_pylist()]
        rng = np.random.default_rng([number, island, region])
        people = evolve(people, lengths, size, least, rng)
        release()
        return pa.Table.from_pylist([_state(region, island, shape, people, least)], schema=names)

    return run


def _solved(rest: DataFrame, regions: int, size: int, islands: int, epochs: int) -> DataFrame:
    """(region, shape, best) of all regions of ``rest`` (seat, length)."""
    dealt = rest.select("seat", "length", F.pmod(F.xxhash64("seat"), F.lit(regions)).alias("region"))
    shapes = dealt.groupBy("region").applyInArrow(_shape, "region long, shape binary")
    alone = shapes.select(
        "region", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "shape", F.lit(packed()).alias("people")
    )
    open_, done = stored(alone, "islands"), []
    nobody = open_.select("region", "island", F.lit(None).cast("binary").alias("best")).limit(0)
    for number in range(epochs):
        elites = nobody if number == 0 else arriving
        grouped = open_.groupBy("region", "island").cogroup(elites.groupBy("region", "island"))
        state = stored(grouped.applyInArrow(_epoch(number, size), _STATE), "islands")
        best = state.groupBy("region").agg(F.min(F.struct("bins", "island")).alias("m"), F.first("least").alias("least"))
        ends = best.filter("m.bins <= least") if number < epochs - 1 else best
        done.append(
            state.join(ends.select("region", F.col("m.island").alias("island")), ["region", "island"]).select("region", "shape", "best")
        )
        if number < epochs - 1:
            going = best.filter("m.bins > least").select("region")
            if going.isEmpty():
                break
            open_ = state.join(going, "region").select("region", "island", "shape", "people")
            moved = ((F.col("island") + 1) % islands).cast("int").alias("island")
            arriving = stored(state.join(going, "region").select("region", moved, "best"), "elites")
    return stored(reduce(DataFrame.unionAll, done), "packed-regions")


def _placer(level: int, last: bool, size: int):
    """Packed regions to (seat, sequence_id, offset); the emptiest bin of a region has no sequence unless this is the last level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for region, shape, best in zip(*(batch.column(c).to_pylist() for c in ("region", "shape", "best")), strict=True):
                (seat, length), (bin_of,) = unpack(shape), unpack(best)
                order = np.argsort(bin_of, kind="stable")
                own, size_of = bin_of[order].astype(np.int64), length[order]
                before = np.cumsum(size_of) - size_of
                offset = before - before[np.searchsorted(own, own)]
                loads = np.bincount(own, size_of)
                sequence = ((level + 1) << 58) | (region << 24) | own
                emptiest = int(np.argmin(loads))
                opened = own == emptiest if not last and loads[emptiest] < size else np.zeros(len(own), bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seat[order]), pa.array(size_of), pa.array(sequence, pa.int64(), mask=opened), pa.array(offset, pa.int64())],
                    ["seat", "length", "sequence_id", "offset"],
                )

    return run


def pack(
    docs: DataFrame,
    vocabulary: str,
    longest: int = 4096,
    end: int = 1,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: its document, place, length, checksum, sequence, place there, and ids (little-endian unsigned 32-bit).

    ``vocabulary`` is the path of a tokenizer file on every machine. A sequence holds at most
    ``longest`` ids; the ids of a document end with ``end``.
    """
    if longest < 2 or islands < 1 or epochs < 1:
        raise ValueError("longest must be 2 at least, islands and epochs 1")
    frugal(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "seat long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    pieces = stored(rows.mapInArrow(_cutter(lambda: word_encoder(vocabulary), longest, end), schema), "pieces")
    placed = [pieces.filter(F.col("length") == longest).select("seat", F.col("seat").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    rest, level = pieces.filter(F.col("length") < longest).select("seat", "length"), 0
    while True:
        tokens = rest.agg(F.sum("length")).first()[0] or 0
        if not tokens:
            break
        regions = -(-tokens // (REGION * longest))
        solved = _solved(rest, regions, longest, islands, epochs)
        placing = solved.mapInArrow(_placer(level, regions == 1, longest), "seat long, length long, sequence_id long, offset long")
        if regions > 1:
            placing = stored(placing, "placed")
        placed.append(placing.filter("sequence_id IS NOT NULL").select("seat", "sequence_id", "offset"))
        if regions == 1:
            break
        rest, level = placing.filter("sequence_id IS NULL").select("seat", "length"), level + 1
    return pieces.join(reduce(DataFrame.unionAll, placed), "seat").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"
    )

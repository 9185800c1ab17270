"""Toxicity by class-conditional Kneser-Ney models of the letters of words.

Two models, one of toxic and one of ordinary texts, give each word a
log-likelihood letter by letter, from up to eleven letters (bytes) before it, so
from the whole word so far of nearly all words, word edges included. The counts of the full contexts belong
to a class; what an expression has shown less than ``least`` times, or not in its class, backs off to
continuation counts that both classes share, so a rare expression costs both models alike.

A word's evidence is the difference of its two log-likelihoods. How ordinary words fare depends on the language,
so a document's own median is what the evidence of its words is measured from. What a document says is the
sum of the evidence beyond that median, per byte of the whole text, once beyond one and once beyond two nats; the plain
difference per byte; its best word and the mean of its ``top`` best distinct words, since a short passage counts in a
long text; and the length. A logistic curve over these turns them into a score; it is fitted on
documents that the models have not seen (two halves of the sample judge each other).
As toxic texts are rarer in the sample than the question supposes, the constant is moved by three quarters of the logarithm of the classes' ratio.

Learning uses at most ``per_class`` labelled documents of each class, those with
the smallest hashes of their ids. Words are counted by Spark, and each model is made by one task from the distinct words of that
sample; only its finished table reaches the driver. Scoring covers all documents and whole texts.

Edge cases: texts without words (empty or NULL) have no evidence on either side.
Without labelled documents of both classes every score is the share of toxic
labels (0.5 without labels). NULL labels are not learned from. Documents with
several labels count once for each. Equal rows are scored each on its own,
NULL ids stay NULL, an empty table gives an empty result; only id, text and the
label columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revflow.llm.blocks import pack, unpack
from revflow.llm.logistic import fit_logistic, sigmoid
from revflow.llm.lookup import Lookup
from revflow.llm.tables import frugal, stored
from revflow.llm.words import _P, Words, find_words, mix, release, slices, span, sums

_OPEN, _CLOSE = 1, 2  # bytes that stand for the edges of a word
_ORDER = 12
_LEAST = 3
_DISCOUNT = 0.75
_FEATURES = 6


class Evidence:
    """Log-likelihood differences of letters in their contexts, and of unseen letters by context."""

    def __init__(self, letters: np.ndarray, letter_values: np.ndarray, contexts: np.ndarray, context_values: np.ndarray):
        self.tables = (letters, letter_values.astype(np.float32), contexts, context_values.astype(np.float32))
        self._found: tuple[Lookup, Lookup] | None = None

    def __reduce__(self):
        return Evidence, self.tables  # the tables that are probed are made where they are used

    @property
    def _lookups(self) -> tuple[Lookup, Lookup]:
        if self._found is None:
            self._found = tuple(Lookup(keys, np.arange(len(keys), dtype=np.int32)) for keys in self.tables[::2])
        return self._found

    def of_words(self, flat: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Difference of each word; words are bytes with their edges, cut at ``first``."""
        ends, starts = _full_grams(first)
        prefix = sums(flat.astype(np.uint64) + np.uint64(1), _P)
        gram = _keys(prefix, starts, ends + 1)
        letters, contexts = self._lookups
        out = _picked(self.tables[1], letters.get(gram))
        rest = np.flatnonzero(np.isnan(out))
        context = _picked(self.tables[3], contexts.get(_keys(prefix, starts[rest], ends[rest])))
        out[rest] = np.nan_to_num(context)
        return np.add.reduceat(out, np.append(0, np.cumsum(np.diff(first) - 1))[:-1]) if len(first) > 1 else np.empty(0)


def _picked(values: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Values of the places that were found, NaN for others."""
    out = np.full(len(which), np.nan)
    out[which >= 0] = values[which[which >= 0]]
    return out


def _keys(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return ((mix(span(prefix, start, end, _P) + (end - start).astype(np.uint64)) >> np.uint64(1))).astype(np.int64)


def _full_grams(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every byte behind a word's opening edge, with the start of its longest context."""
    ends = np.delete(np.arange(first[-1]), first[:-1])
    open_ = np.repeat(first[:-1], np.diff(first) - 1)
    return ends, np.maximum(open_, ends - _ORDER + 1)


def with_edges(words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case bytes of the given words between their edges."""
    size = words.end[which] - words.start[which]
    first = np.append(0, np.cumsum(size + 2))
    flat = np.empty(first[-1], np.uint8)
    inner = np.repeat(first[:-1] + 1, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    source = np.repeat(words.start[which], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    letters = words.data[source]
    flat[inner] = np.where((letters >= 65) & (letters <= 90), letters + 32, letters)
    flat[first[:-1]], flat[first[1:] - 1] = _OPEN, _CLOSE
    return flat, first


def kneser_ney(words: list[bytes], counts: np.ndarray, least: int = _LEAST) -> Evidence:
    """Fit the two models to distinct words; ``counts`` has a row for each word: toxic, ordinary.

    The classes' own counts are those of grams that occur ``least`` times in both together.
    """
    size = np.array([len(w) + 2 for w in words], np.int64)
    first = np.append(0, np.cumsum(size))
    flat = np.frombuffer(b"".join(bytes([_OPEN]) + w + bytes([_CLOSE]) for w in words), np.uint8)
    prefix = sums(flat.astype(np.uint64) + np.uint64(1), _P)
    ends, starts = _full_grams(first)
    gram, one, number = np.unique(_keys(prefix, starts, ends + 1), return_index=True, return_inverse=True)
    number = number.astype(np.int32)
    ends, starts = ends[one], starts[one]  # a sample of each distinct gram
    shared = _shared(prefix, starts, ends)
    n = [np.bincount(number, np.repeat(counts[:, label], size - 1), len(gram)) for label in range(2)]
    often = np.flatnonzero(n[0] + n[1] >= least)
    gram, ends, starts, shared = gram[often], ends[often], starts[often], shared[often]
    context, of = np.unique(_keys(prefix, starts, ends), return_inverse=True)
    values, unseen = [], []
    for own in (x[often] for x in n):
        total, types = np.bincount(of, own, len(context)), np.bincount(of, own > 0, len(context))
        with np.errstate(divide="ignore", invalid="ignore"):
            rest = np.where(total > 0, _DISCOUNT * types / total, 1.0)
            kept = np.where(own > 0, (own - _DISCOUNT) / total[of], 0.0)
        values.append(np.log(kept + rest[of] * shared))
        unseen.append(np.log(rest))
    return Evidence(gram, values[0] - values[1], context, unseen[0] - unseen[1])


def _shared(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """P(last letter | context without its first letter) from continuation counts of the distinct grams."""
    p = np.full(len(starts), 1 / 258)
    longest = int((ends - starts).max(initial=0))
    for length in range(1, longest + 1):
        # grams of this length, each with the distinct letters seen before it
        has = np.flatnonzero(ends - starts >= length)
        at = ends[has] - length + 1
        key = _keys(prefix, at, ends[has] + 1)
        longer = _keys(prefix, at - 1, ends[has] + 1)
        _, once = np.unique(longer, return_index=True)
        gram, number = np.unique(key, return_inverse=True)
        follow = np.bincount(number[once], minlength=len(gram)).astype(float)
        context, of = np.unique(_keys(prefix, at, ends[has]), return_inverse=True)
        of_gram = np.empty(len(gram), np.int64)
        of_gram[number] = of
        total = np.bincount(of_gram, follow, len(context))
        types = np.bincount(of_gram, minlength=len(context))
        p[has] = np.maximum(follow[number] - _DISCOUNT, 0) / total[of] + _DISCOUNT * types[of] / total[of] * p[has]
    return p


# --- documents ----------------------------------------------------------------------------------


def features(models: Evidence, offsets: np.ndarray, data: np.ndarray, top: int) -> np.ndarray:
    """Per document what its words say: see the module's docstring."""
    words = find_words(offsets, data, lower=True)
    out = np.zeros((words.docs, _FEATURES))
    if not len(words.hash):
        return out
    _, one, number = np.unique(words.hash, return_index=True, return_inverse=True)
    values = models.of_words(*with_edges(words, one))
    value, doc = values[number], words.doc()
    full = np.flatnonzero(np.diff(words.first) > 0)
    at = words.first[:-1][full]
    weight = np.add.reduceat((words.end - words.start + 1).astype(float), at)
    out[full, 0] = np.add.reduceat(value, at) / weight
    # distinct words of each document, best first; a missing word counts zero
    pair = np.unique(doc * len(one) + number)
    own, best = pair // len(one), values[pair % len(one)]
    order = np.lexsort((-best, own))
    own, best = own[order], best[order]
    begin = np.searchsorted(own, np.arange(words.docs + 1))
    rank = np.arange(len(own)) - begin[own]
    out[:, 1] = np.bincount(own[rank == 0], best[rank == 0], words.docs)
    out[:, 2] = np.bincount(own[rank < top], np.maximum(best[rank < top], 0), words.docs) / top
    median = np.zeros(words.docs)
    median[full] = best[(begin[:-1] + np.diff(begin) // 2)[full]]
    for column, nats in ((3, 1), (4, 2)):
        beyond = np.maximum(value - median[doc] - nats, 0)
        out[full, column] = np.sqrt(np.add.reduceat(beyond, at) / weight)
    out[full, 5] = np.log(np.diff(words.first)[full])
    return out


@dataclass
class Classifier:
    models: Evidence | None
    weights: np.ndarray  # of the features and one
    top: int
    words: int = 0  # distinct words that were learned from

    def score(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        if self.models is None:
            return np.full(len(offsets) - 1, sigmoid(self.weights[-1]))
        x = features(self.models, offsets, data, self.top)
        return sigmoid(x @ self.weights[:-1] + self.weights[-1])


_NOTHING = Evidence(*[np.empty(0, t) for t in (np.int64, float, np.int64, float)])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece, offsets, data in slices(batch, limit=1 << 21):
            words = find_words(offsets, data, lower=True)
            group = piece.column("group").to_numpy()[words.doc()]
            key, one, number = np.unique(words.hash, return_index=True, return_inverse=True)
            flat, first = with_edges(words, one)
            counts = np.bincount(number * 4 + group, minlength=4 * len(key)).reshape(-1, 4)
            names = [flat[a + 1 : b - 1].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            columns = [pa.array(names, pa.binary()), *(pa.array(counts[:, i].astype(np.int64)) for i in range(4))]
            yield pa.RecordBatch.from_arrays(columns, ["word", "g0", "g1", "g2", "g3"])


def _learner(group: pa.Table) -> pa.Table:
    """The distinct words of one model, with their counts, to its table."""
    names, counts = group.column("word").to_pylist(), np.stack([group.column(c).to_numpy() for c in ("toxic", "ordinary")], axis=1)
    made = kneser_ney(names, counts.astype(float))
    release()
    bodies = [pack(*made.tables[i : i + 2]) for i in (0, 2)]
    return pa.table(
        {"model": pa.array([group.column("model")[0].as_py()], pa.int32()), "letters": pa.array([bodies[0]], pa.binary()),
         "contexts": pa.array([bodies[1]], pa.binary()), "words": pa.array([len(names)], pa.int64())}
    )


def _described(halves, top: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, offsets, data in slices(batch, limit=1 << 21):
                group = piece.column("group").to_numpy()
                x = np.stack([features(m, offsets, data, top) for m in halves.value])
                other = 1 - group % 2  # the half that has not seen the document
                x = x[other, np.arange(len(group))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group), *(pa.array(x[:, i]) for i in range(_FEATURES))], ["group", *(f"x{i}" for i in range(_FEATURES))]
                )

    return describe


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 4000, top: int = 5) -> Classifier:
    """Learn from ``labels`` (doc_id, label 0/1) of ``docs`` (doc_id, text)."""
    frugal(docs.sparkSession)
    known = labels.filter("label IN (0, 1) AND doc_id IS NOT NULL")
    spread = F.xxhash64(F.col("doc_id"), F.lit(8))
    sample = None
    for label in (0, 1):
        part = known.filter(F.col("label") == label).orderBy(spread, "doc_id").limit(per_class)
        sample = part if sample is None else sample.union(part)
    half = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(9)), F.lit(2))
    sample = sample.select("doc_id", (2 * F.col("label") + half).cast("int").alias("group"))
    texts = docs.join(F.broadcast(sample), "doc_id").select("text", "group")  # at most 2 * per_class ids
    counted = texts.mapInArrow(_counted, "word binary, g0 long, g1 long, g2 long, g3 long")
    words = stored(counted.groupBy("word").agg(*[F.sum(f"g{i}").alias(f"g{i}") for i in range(4)]), "toxicity-words")
    ordinary, toxic = words.agg(F.sum(F.expr("g0 + g1")), F.sum(F.expr("g2 + g3"))).first()
    if not (ordinary and toxic):
        share = known.select(F.avg("label")).first()[0]
        share = 0.5 if share is None else min(max(share, 1e-6), 1 - 1e-6)
        return Classifier(None, np.array([0.0] * _FEATURES + [np.log(share / (1 - share))]), top)
    # models 0 and 1 of the halves, 2 of both
    chosen = F.explode(
        F.array(*[F.struct(F.lit(m).alias("model"), F.expr(t).alias("toxic"), F.expr(o).alias("ordinary"))
                  for m, t, o in ((0, "g2", "g0"), (1, "g3", "g1"), (2, "g2 + g3", "g0 + g1"))])
    )
    of_models = words.select("word", chosen.alias("m")).select("word", "m.*").filter("toxic + ordinary > 0")
    learned = of_models.groupBy("model").applyInArrow(_learner, "model int, letters binary, contexts binary, words long")
    learned = stored(learned, "toxicity-models")
    spark = docs.sparkSession

    def model(number: int) -> tuple[Evidence, int]:
        row = learned.filter(F.col("model") == number).first()
        return (Evidence(*unpack(row["letters"]), *unpack(row["contexts"])), row["words"]) if row else (_NOTHING, 0)

    halves = spark.sparkContext.broadcast([model(h)[0] for h in range(2)])  # bounded by the learned sample
    names = [f"x{i}" for i in range(_FEATURES)]
    judged = texts.mapInArrow(_described(halves, top), "group int, " + ", ".join(f"{x} double" for x in names)).toArrow()
    halves.destroy()
    x = np.stack([judged.column(c).to_numpy() for c in names], axis=1)
    y = judged.column("group").to_numpy() >= 2
    order = np.lexsort((*x.T, y))
    weights = fit_logistic(x[order], y[order])
    weights[-1] += 0.75 * np.log(max(1, (~y).sum()) / max(1, y.sum()))
    made, size = model(2)
    return Classifier(made, weights, top, size)


def score_toxicity(docs: DataFrame, classifier: Classifier, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: more likely toxic) of every row."""
    spark = docs.sparkSession
    frugal(spark)
    shared = spark.sparkContext.broadcast(classifier)  # bounded by the learned sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for piece, offsets, data in slices(batch, limit=1 << 21):
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(own.score(offsets, data))], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def labelled(labels: DataFrame, label: str, learn: Column) -> DataFrame:
    """doc_id and label of the rows to learn from."""
    return labels.filter(learn).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))

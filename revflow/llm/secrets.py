"""Secret scan with a random forest that removes false findings, in DataFrame operations only.

Candidates are all unbroken runs of 16 or more letters, digits and ``+/_-``, also several
in one word (addresses, minified JSON, lists, texts without blanks). Each is described by
its length, how often its kinds of characters change, how much of it a dictionary
covers, where it stands (path and place in the text), and the words beside it. The
dictionary holds the letter triples of the words that recur in the corpus, at
most 26**3 whatever the corpus, so it travels as a literal. A forest learns from
labelled findings which candidates are secrets; it is trained and
applied by Spark's own tree learner inside the executors.

Learning uses at most ``per_class`` labelled findings of each class, those with
the smallest hashes. Candidate search, the dictionary and scoring cover all rows and
whole texts. Texts are never grouped, and the dictionary's counts are summed
before they are shuffled, so sources or passages of any frequency do no harm.

Edge cases: NULL and empty texts have no candidates; a NULL path is the empty path.
Without labelled findings of both classes every score is the share of label 1 (0.5
without labels). NULL labels are not learned from. Equal rows give equal
findings, NULL ids stay NULL, empty tables give empty results; of the documents only
id, text and path are read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revflow.llm.tables import stored

SHORTEST = 16
_RUN = rf"[A-Za-z0-9+/_\-]{{{SHORTEST},}}"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
# words beside a value that announce a credential
_HINTS = r"(?i)(pass|pwd|secret|token|credential|auth|api|key)"
FEATURES = [
    "length", "changes", "digits", "capitals", "signs", "variety", "hexadecimal", "covered",
    "hint", "assigned", "quoted", "before_covered", "after_covered", "path_bucket", "depth",
]


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = "source") -> DataFrame:
    """One row per candidate: doc_id, path, place (number of its word), run (its number in that word), n_words, value, head, before, after.

    The first run of a word has the word up to it as head and the two words before it as before; a later run
    has the text since the run before it, and that run with its own head. After the last run
    comes the next word, after another one the text up to the end of the next run.
    """
    route = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), route.alias("path"), F.split(F.coalesce(F.col(text), F.lit("")), r"\s+").alias("words")
    )
    # octets are counted without looking at them, so most words cost nothing more
    places = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: (F.octet_length(F.get("words", i)) >= SHORTEST) & F.get("words", i).rlike(_RUN),
    )
    found = F.transform(
        places,
        lambda i: F.struct(
            i.cast("long").alias("place"),
            F.get("words", i).alias("word"),
            F.array_join(F.slice("words", F.greatest(i - 1, F.lit(1)), F.least(i, F.lit(2))), " ").alias("two_before"),
            F.coalesce(F.get("words", i + 1), F.lit("")).alias("next_word"),
        ),
    )
    each = rows.select("doc_id", "path", F.size("words").alias("n_words"), F.explode(found).alias("c")).select(
        "doc_id", "path", "n_words", "c.*"
    )
    cut = each.select(
        "*", F.regexp_extract_all("word", F.lit(_RUN), F.lit(0)).alias("runs"), F.split("word", _RUN).alias("heads")
    )
    joint = lambda k: F.concat(F.get("heads", k), F.get("runs", k))
    # each run has its own stretch of the word, so that a word of many runs is not copied for each
    runs = F.transform(
        "runs",
        lambda value, k: F.struct(
            k.cast("long").alias("run"),
            value.alias("value"),
            F.get("heads", k).alias("head"),
            F.when(k == 0, F.col("two_before")).otherwise(joint(k - 1)).alias("before"),
            F.when(k == F.size("runs") - 1, F.col("next_word")).otherwise(joint(k + 1)).alias("after"),
        ),
    )
    return cut.select("doc_id", "path", "place", "n_words", F.explode(runs).alias("c")).select(
        "doc_id", "path", "place", "c.run", "n_words", "c.value", "c.head", "c.before", "c.after"
    )


def dictionary(docs: DataFrame, text: str = "text", least: int = 5, share: float = 2e-6) -> str:
    """The letter triples of words that occur ``least`` times, as a string of 0 and 1 in the order aaa, aab, ...

    A triple counts if it makes up at least ``share`` of all triples of such words.
    """
    words = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}]+")).alias("word"))
    often = words.groupBy("word").agg(F.count("*").alias("n")).filter((F.col("n") >= least) & (F.char_length("word") >= 3))
    triples = often.select(
        "n", F.explode(F.transform(F.sequence(F.lit(1), F.char_length("word") - 2), lambda i: F.substring("word", i, 3))).alias("t")
    ).filter(F.col("t").rlike("^[a-z]{3}$"))
    counted = triples.groupBy("t").agg(F.sum("n").alias("n")).collect()  # at most 26**3 rows
    total = sum(r["n"] for r in counted)
    known = {r["t"] for r in counted if r["n"] >= share * total}
    return "".join("1" if a + b + c in known else "0" for a in _LETTERS for b in _LETTERS for c in _LETTERS)


def _covered(text: Column, known: str) -> Column:
    """Share of the letter triples of a text that the dictionary has; triples with other characters are not in it."""
    table = F.split(F.lit(",".join(known)), ",")  # folded into one literal
    low = F.lower(text)
    n = F.char_length(low) - 2
    code = lambda i: F.ascii(F.substring(low, i, 1)) - 97
    valid = lambda x: (x >= 0) & (x < 26)

    def hit(i: Column) -> Column:
        a, b, c = code(i), code(i + 1), code(i + 2)
        return F.when(valid(a) & valid(b) & valid(c), F.get(table, a * 676 + b * 26 + c) == "1").otherwise(F.lit(False))

    return F.when(n > 0, F.size(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), hit)) / n).otherwise(F.lit(0.0))


def described(found: DataFrame, known: str) -> DataFrame:
    """Candidates with the columns of ``FEATURES``."""
    value, n = F.col("value"), F.char_length("value")
    kinds = F.translate(
        value, _LETTERS + _LETTERS.upper() + "0123456789+/_-", "a" * 26 + "A" * 26 + "9" * 10 + "...."
    )
    share = lambda pattern: (n - F.char_length(F.regexp_replace(value, pattern, ""))) / n
    return found.select(
        "*",
        n.cast("double").alias("length"),
        ((F.char_length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1) / n).alias("changes"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("capitals"),
        share(r"[+/_\-]").alias("signs"),
        (F.size(F.array_distinct(F.split(value, ""))) / n).alias("variety"),
        value.rlike("^[0-9a-fA-F]+$").cast("double").alias("hexadecimal"),
        _covered(value, known).alias("covered"),
        (F.col("head").rlike(_HINTS) | F.col("before").rlike(_HINTS)).cast("double").alias("hint"),
        (F.col("head").rlike("[=:][\"']?$") | F.col("before").rlike("[=:]$")).cast("double").alias("assigned"),
        F.col("head").rlike("[\"']$").cast("double").alias("quoted"),
        _covered(F.col("before"), known).alias("before_covered"),
        _covered(F.col("after"), known).alias("after_covered"),
        F.pmod(F.xxhash64("path"), F.lit(16)).cast("double").alias("path_bucket"),
        (F.col("place") / F.col("n_words")).alias("depth"),
    )


def fit(labelled: DataFrame, per_class: int = 20000, trees: int = 20, depth: int = 6) -> RandomForestClassificationModel | float:
    """A forest from described candidates with a ``label`` (0 or 1), or the share of label 1 if there is only one class."""
    known = labelled.filter("label IN (0, 1)").select("label", *FEATURES)
    order = [F.xxhash64(*FEATURES), *FEATURES]
    parts = [known.filter(F.col("label") == v).orderBy(*order).limit(per_class) for v in (0, 1)]
    sample = stored(parts[0].union(parts[1]).coalesce(1), "findings")  # bounded, and in one order
    counts = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        return float(next(iter(counts))) if counts else 0.5
    weighted = sample.withColumn("weight", F.when(F.col("label") == 1, 0.5 / counts[1]).otherwise(0.5 / counts[0]) * sum(counts.values()))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(weighted).select(
        F.col("label").cast("double").alias("label"), "features", "weight"
    )
    learner = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=6, weightCol="weight", labelCol="label", featuresCol="features"
    )
    # a copy has no training summary, whose session cannot be sent to the workers once something was observed in it
    return learner.fit(rows).copy()


def scored(found: DataFrame, forest: RandomForestClassificationModel | float) -> DataFrame:
    """Described candidates with the forest's score (0 to 1)."""
    if isinstance(forest, float):
        return found.withColumn("score", F.lit(forest))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
    return forest.transform(rows).withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def rule_labels() -> Column:
    """Labels for findings nobody has looked at: formats that are surely secrets, and runs that surely are none.

    Known formats are keys with their issuer's prefix and hexadecimal values assigned to a credential's
    name; letters only, or digits only, are none. All else has no label.
    """
    value, head, before = F.col("value"), F.col("head"), F.col("before")
    return (
        F.when(value.rlike("^AKIA[A-Z0-9]{16}$"), 1)
        .when(value.rlike("^[0-9a-f]{16,}$") & head.rlike("(?i)(password|passwd|secret|token|key)[=:]"), 1)
        .when(value.rlike("^[0-9a-f]{32,}$") & before.rlike("(?i)(password|secret|token|key) ?[=:]$"), 1)
        .when(value.rlike("^([A-Za-z]+|[0-9]+)$"), 0)
    )

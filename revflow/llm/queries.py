"""The queries of this subpackage: one per operator, and the pipeline's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revflow.llm import (
    alignment,
    decontamination,
    exact_dedup,
    genetic_packing,
    katz,
    minhash,
    packing,
    quality,
    ranked_search,
    repeats,
    secrets,
    token_counts,
    toxicity,
)
from revflow.llm.tables import crc_of_id, stored, table, vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


@_query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs, vocabulary("piece_bpe_32k.model"), budget=4096, store=False)
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"), F.col("fit_points").alias("limit_points")
    )


@_query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), longest=1024, end=0, ids=False)


@_query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


ORACLE["op9_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), g AS (
  SELECT norm, count(*) AS group_size, first(doc_id ORDER BY length(t) DESC, doc_id ASC NULLS LAST) AS keep_id FROM d GROUP BY norm
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g USING (norm)
"""


@_query
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


ORACLE["op10_minhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
         ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)
), r AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.y FROM r JOIN e ON e.x = r.seen
), m AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN m ON m.node = d.doc_id
"""


@_query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), words=10, k=5)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE["op7_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS m, unnest(list_transform(range(1, greatest(len(ws) - 9, 1) + 1), lambda i: array_to_string(list_slice(ws, i, i + 9), ' '))) AS g
  FROM b WHERE len(ws) > 0
), m AS (SELECT DISTINCT m FROM iw
), dp AS (
  SELECT r, m, ws, unnest(range(1, len(ws) - m + 2)) AS i FROM d, m WHERE len(ws) >= m
), dw AS (SELECT r, m, i, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS g FROM dp
), h AS (SELECT DISTINCT dw.r, dw.i, dw.m, iw.item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.m = iw.m
), hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + m)) AS p FROM h) GROUP BY r
), its AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(its.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""


@_query
def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"), length=20)
    lengths = F.transform("removed", lambda r: r["end"] - r["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE["op2_repeats"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), p AS (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d WHERE len(ws) >= 20
), w AS (SELECT r, doc_id, i, sha256(array_to_string(list_slice(ws, i, i + 19), ' ')) AS g FROM p
), f AS (SELECT *, min(struct_pack(d := coalesce(doc_id, 9223372036854775807), i := i)) OVER (PARTITION BY g) AS m FROM w
), again AS (SELECT r, i FROM f WHERE struct_pack(d := coalesce(doc_id, 9223372036854775807), i := i) > m
), gone AS (SELECT DISTINCT r, unnest(range(i, i + 20)) AS p FROM again
), x AS (SELECT r, doc_id, len(ws) AS n, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d
), k AS (SELECT x.r, count(*) AS n, string_agg(word, ' ' ORDER BY x.p) AS t FROM x ANTI JOIN gone ON gone.r = x.r AND gone.p = x.p GROUP BY x.r)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""


@_query
def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = katz.katz_scores(table(spark, sf_dir, "documents"), crc_of_id(7) != 2, order=3, least=1)
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@_query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learned = toxicity.labelled(labels, "toxic", crc_of_id(3) != 1)
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs.select("doc_id", "text"), learned))
    return scored.select(
        "doc_id", (crc_of_id(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@_query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = quality.fit(docs, toxicity.labelled(labels, "quality", crc_of_id(5) != 0))
    return quality.score_quality(docs, machine).select(
        "doc_id", (crc_of_id(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@_query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = secrets.dictionary(docs)
    found = stored(secrets.described(secrets.candidates(docs), known).withColumn("label", secrets.rule_labels()), "candidates")
    held_out = crc_of_id(7) == 2
    forest = secrets.fit(found.filter(~held_out))
    return secrets.scored(found, forest).select(
        "doc_id",
        "place",
        "run",
        F.char_length("value").cast("long").alias("length"),
        held_out.alias("held_out"),
        "label",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@_query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


ORACLE["op11_ranked_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), q AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM (SELECT DISTINCT item_id, text FROM benchmark)
), sums AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(ts)) AS BIGINT) AS l FROM d WHERE len(ts) > 0
), m AS (SELECT r, doc_id, 100 - 50 + ((50 * len(ts) * sums.n) // sums.l) AS m FROM d, sums WHERE len(ts) > 0
), p AS (SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t
), w AS (SELECT t, CAST(floor(1000 * ln((2.0::DOUBLE * sums.n + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM p, sums GROUP BY t, sums.n
), s AS (
  SELECT qt.q, p.r, CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * m.m))) AS BIGINT) AS score
  FROM (SELECT DISTINCT q, unnest(ts) AS t FROM q) qt JOIN p USING (t) JOIN w USING (t) JOIN m ON m.r = p.r GROUP BY qt.q, p.r
), ranked AS (
  SELECT q.item_id, CAST(row_number() OVER (PARTITION BY s.q ORDER BY s.score DESC, m.doc_id ASC NULLS LAST) AS INT) AS rank, m.doc_id, s.score
  FROM s JOIN m USING (r) JOIN q ON q.q = s.q WHERE s.score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


@_query
def op13_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return genetic_packing.pack(docs, vocabulary("word_bpe_49k.json"), longest=4096, end=1).drop("ids")


@_query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = alignment.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    return alignment.document_scores(found)

"""Registered queries of the operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlake.llm.decontam import contained_items
from shiftlake.llm.fingerprint import fingerprint_edits
from shiftlake.llm.langid import predict_languages, train_languages
from shiftlake.llm.lm import score_documents
from shiftlake.llm.near_dup import near_duplicates
from shiftlake.llm.negatives import mine_hard_negatives
from shiftlake.llm.packing import pack_documents
from shiftlake.llm.pii import BASE, find_pii
from shiftlake.llm.quality import quality_score, train_quality
from shiftlake.llm.substring import remove_repeated_windows
from shiftlake.llm.topk import top_inner_products
from shiftlake.llm.toxicity import toxicity_score, train_toxicity
from shiftlake.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fold(id_col: str, n: int) -> F.Column:
    """crc32 of the id as text, modulo n (a null id is in fold -1)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % n, F.lit(-1))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train_languages(docs.where(_fold("doc_id", 3) != 1))
    out = predict_languages(docs, model)
    return out.select("doc_id", (_fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text").withColumnRenamed("text", "body"), "body")
    said = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["name"], x["start"], x["end"])))
    base = F.filter("pii", lambda x: x["base"])
    count = lambda kind: F.size(F.filter("pii", lambda x: x["name"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(said(base), 256).alias("base_sha256"), said("pii").alias("spans"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train_toxicity(docs, _table(spark, sf_dir, "labels"), train=_fold("id", 5) != 0)
    scored = docs.select("doc_id", (_fold("doc_id", 5) == 0).alias("held_out"), toxicity_score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train_quality(docs, _table(spark, sf_dir, "labels"), train=_fold("id", 4) != 2)
    scored = docs.select("doc_id", (_fold("doc_id", 4) == 2).alias("held_out"), quality_score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), width=2)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_documents(_table(spark, sf_dir, "documents"), _fold("doc_id", 5) != 1)
    return out.select("doc_id", (~F.col("trained_on")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_windows(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(_table(spark, sf_dir, "documents")).drop("n_rows")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whiten(_table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_exact_topk, op3_pii, op4_packing, op5_toxicity, op6_quality, op7_near_duplicates, op8_lm_score,
    op9_decontamination, op10_substring_dedup, op11_hard_negatives, op12_fingerprints, op13_whitening,
)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLE = {
    "op2_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 10""",
    "op7_near_duplicates": f"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents),
        s AS (
            SELECT doc_id, CASE WHEN len(w) < 2 THEN w
                ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS g FROM d),
        u AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
        links AS (
            SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id
            WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        reach AS (
            SELECT doc_id AS x, doc_id AS y FROM s
            UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
        c AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
        SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)""",
    "op9_decontamination": f"""
        WITH i AS (SELECT item_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM benchmark),
        p AS (SELECT *, least(len(w), 5) AS k FROM i WHERE len(w) > 0),
        g AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS g FROM p),
        n AS (SELECT item_id, count(*) AS n_shingles FROM g GROUP BY item_id),
        d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents),
        h AS (
            SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS g
            FROM d, (SELECT DISTINCT k FROM p) WHERE len(w) >= k),
        m AS (SELECT doc_id, item_id, count(*) AS n_common FROM g JOIN h USING (k, g) GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, n_shingles, n_common FROM m JOIN n USING (item_id) WHERE 100 * n_common >= 80 * n_shingles""",
    "op10_substring_dedup": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
        x AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
        y AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS t FROM x),
        z AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY t) AS c FROM y) WHERE c > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM z),
        words AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d),
        kept AS (SELECT doc_id, string_agg(t, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
        lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(lost.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        r AS (
            SELECT anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
                row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
            FROM p JOIN s USING (anchor_id)
            WHERE NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 5""",
}

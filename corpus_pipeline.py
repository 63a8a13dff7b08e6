"""Corpus pipeline: quality, near-duplicates, benchmark leaks, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftlake.llm.common import Scratch
from shiftlake.llm.decontam import decontaminate
from shiftlake.llm.near_dup import judged_texts
from shiftlake.llm.packing import pack_documents
from shiftlake.llm.pii import redacted
from shiftlake.llm.quality import quality_score, train_quality

#: A document with a lower probability of good quality goes.
LEAST_QUALITY = 0.7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train_quality(docs, _table(spark, sf_dir, "labels"))
    return docs.where(quality_score(F.col("text"), model) >= LEAST_QUALITY)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (5-word shingles, similarity 0.8) stays, that of the smallest id; rows without id all stay."""
    gone = judged_texts(docs).where("not kept").select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    this = (F.col("doc_id").cast("long") == F.col("gone_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("gone_key"))
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs.join(gone, this, "left_anti")
    left = docs.where("doc_id is not null").join(gone, this, "left_anti").dropDuplicates(["doc_id", "text"])
    return left.unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars, if there, follows."""
    clean = redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pii), ("packing", packing)]

#: SQL can't express the trained, hashed and packing stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

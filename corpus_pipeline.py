"""The training-data pipeline over ``documents``: language, copies, near copies,
benchmark passages, packing. Each stage gets what its predecessor kept, written
as Parquet and read again; all but the last return the columns of documents.

Null ids, null and empty texts, repeated rows and empty tables are as the
operators define them: texts that are null or hold no letter leave with the
language stage, repeated rows with exact dedup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, exact_dedup, langid, packing, simhash
from tidemark.llm.common import staged, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: one is predicted, with evidence."""
    model = langid.train(langid.training_rows(docs))
    guess = langid.predictor(model, spark)(F.col("text"))
    sure = docs.withColumn("__guess", guess).where((F.col("__guess.lang_pred") != langid.UND) & (F.col("__guess.score") >= langid.MIN_SCORE))
    return sure.select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("simhash_near_dedup", near),
          ("benchmark_decontamination", benchmark), ("best_fit_packing", packed)]

#: Fingerprints, language filters and tokens are beyond SQL; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

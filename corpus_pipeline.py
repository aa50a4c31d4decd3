"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next.

Every stage but the last returns rows of its input with all their columns, so
columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import decontaminate, langid, minhash, packing, toxicity
from riskloom.llm.common import small_batches, table
from riskloom.sources.scratch import materialise

# Texts in no known language, or spread over several, score lower than this.
LEAST_LANGUAGE = 0.3


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; NULL and empty texts stay."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.toxicity(F.col("text").cast("string"), model, spark)["score"] < 0.5)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; NULL texts and those without a letter go."""
    small_batches(spark)
    found = langid.predict(F.col("text").cast("string"), langid.train(docs), spark)
    return docs.filter(found["score"] >= LEAST_LANGUAGE)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each near-duplicate class; of rows with equal ids the one with the least hash stays.

    Rows with a NULL id are in no class and stay.
    """
    small_batches(spark)
    kept = minhash.near_duplicates(docs, count_links=False).filter("doc_id = class_id").select(F.col("doc_id").alias("_kept")).distinct()
    named = docs.filter("doc_id is not null").join(kept, docs["doc_id"] == kept["_kept"], "left_semi")
    # a fixed choice, so that a task that runs again makes the same one
    named = named.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")).select("row.*")
    return named.unionByName(docs.filter("doc_id is null"))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark window."""
    return decontaminate.without_hits(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row per piece."""
    small_batches(spark)
    return packing.pack_documents(docs, "word_bpe_49k.json", end_id=0)


STAGES = [
    ("toxicity", clean),
    ("language_id", known_language),
    ("near_duplicates", distinct_texts),
    ("decontamination", uncontaminated),
    ("packing", packed),
]
# Model fits and packing have no SQL; tests compare each stage with its own rule.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to encoded ones: five stages, each over all that its predecessor kept.

Each stage's rows are written as Parquet to the shared folder and read again. All but the
last stage return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import bpe, credentials, decontamination, ngram_join, queries, toxicity
from shelfmark.session import scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it is fitted on the folder's labelled documents."""
    return toxicity.without_toxic(docs, queries.toxic_machine(spark, folder))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group that n-gram links tie together: the one with the smallest id."""
    return ngram_join.without_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without an overlap with a benchmark item."""
    return decontamination.without_overlaps(docs, queries.table(spark, folder, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with credentials masked in the text and the length set anew."""
    masked = credentials.masked(docs)
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each document, and the digest of the text that they decode to."""
    coded = bpe.encode_decode(docs, queries.vocabulary("word_bpe_49k.json"), keep=["doc_id", "lang", "source"])
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("bpe", encode),
]

# Training, seeded hashing and BPE are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""The named queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (bpe, credentials, decontamination, impact_search, licenses, ngram_join, periodic_runs, quality_model, quality_rules,
                           ranked_search, repeats, token_counts, toxicity)
from shelfmark.llm.sampling import fold, labelled_sample
from shelfmark.llm.statements import STATEMENTS  # noqa: F401
from shelfmark.session import cut_lineage

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, folder), vocabulary("piece_bpe_32k.model"), keep=["doc_id"])


def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join_classes(documents(spark, folder))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder), licenses.known_digests(spark), keep=["doc_id"])


def op4_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    sample = labelled_sample(docs, table(spark, folder, "labels"), "quality", 4, 2, quality_model.SAMPLE_ROWS)
    scored = quality_model.score(docs, quality_model.fit(sample), keep=["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = credentials.scan(documents(spark, folder), keep=["doc_id"])
    base = credentials.written(credentials.base_only(F.col("spans")))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        credentials.written(F.col("spans")).alias("spans"))


def toxic_machine(spark: SparkSession, folder: str) -> toxicity.Machine:
    """The machine fitted on the folder's labelled documents outside the held-out fold."""
    sample = labelled_sample(documents(spark, folder), table(spark, folder, "labels"), "toxic", 5, 0, toxicity.SAMPLE_ROWS)
    return toxicity.fit(cut_lineage(sample))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score(documents(spark, folder), toxic_machine(spark, folder), keep=["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.removed(documents(spark, folder))


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.encode_decode(documents(spark, folder), vocabulary("word_bpe_49k.json"), keep=["doc_id"])
    return bpe.digests(coded, ["doc_id"])


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(documents(spark, folder), keep=["doc_id"])


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.overlaps(documents(spark, folder), table(spark, folder, "benchmark"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.with_planted_period(documents(spark, folder)), keep=["doc_id"])
    best = periodic_runs.strongest("runs")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(periodic_runs.written("runs").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select("doc_id", "n_runs", "best.start", "best.length", "best.period",
             F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_impact_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = impact_search.scaled(table(spark, folder, "embeddings"), 256)
    return impact_search.top_k(vectors, vectors.where("id % 50 = 0"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.rank(documents(spark, folder), table(spark, folder, "benchmark"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_token_counts, op2_ngram_join, op3_license_scan, op4_quality_model, op5_secret_scan, op6_toxicity, op7_repeats, op8_bpe, op9_quality_rules,
    op10_decontamination, op11_periodic_runs, op12_impact_search, op13_ranked_search, pipeline)}

"""Write, audit, publish: a table's new version is seen only once it has passed its audit.

A load writes a version of its own in one job: the rows that fit the contract, and beside them the
rows with a value that does not, which are the quarantine. The audit looks at what was
written. Publishing appends one row to a manifest, and readers take the table's path from its
newest row there: so a bad feed, or a job that dies half way, never replaces a good version.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.contracts import REJECTED, REJECTS, Contract, checked, quarantined
from shelfmark.functions.problems import first_cause
from shelfmark.sources.readers import empty

MANIFEST = "_manifest"
MANIFEST_COLUMNS = "table_name string, version bigint, path string, row_count bigint, rejected_count bigint"
VERDICT, FIT, UNFIT = "_verdict", "fit", "rejected"
OK, EMPTY, FAILED = "OK", "EMPTY", "FAILED"


@dataclass(frozen=True)
class Audit:
    """What the audit of a staged version found."""

    name: str
    status: str
    path: str
    row_count: int = 0
    rejected_count: int = 0
    message: str | None = None


def stage(df: DataFrame, folder: str, target: Contract, times: str | None = None, derived: dict | None = None) -> Audit:
    """Writes a version of a table under the folder and audits it; nothing is published.

    ``derived`` gives the columns that a contract is partitioned by but does not declare.
    """
    path = f"{folder}/{target.name}/{uuid.uuid4().hex}"
    try:
        rows = checked(df, target, times).withColumns({name: make for name, make in (derived or {}).items() if name in target.partition_by})
        fits = F.size(REJECTED) == 0
        marked = rows.withColumn(VERDICT, F.when(fits, FIT).otherwise(UNFIT))
        parts = [VERDICT, *target.partition_by]
        # Each task writes the rows that it has read, sorted by partition value: wide rows of text are not shuffled, and a hot
        # value is spread as it came. A task writes a file for each value that it meets.
        marked.write.partitionBy(*parts).parquet(path)
    except (PySparkException, Py4JJavaError) as problem:
        return Audit(target.name, FAILED, path, message=first_cause(problem))
    # Counted from the files' footers: what is there, not what was meant to be.
    written = df.sparkSession.read.schema(f"{VERDICT} string").parquet(path).groupBy(VERDICT).count()
    counts = {row[VERDICT]: row["count"] for row in written.collect()}
    return Audit(target.name, OK if counts.get(FIT) else EMPTY, path, counts.get(FIT, 0), counts.get(UNFIT, 0))


def _manifest(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST_COLUMNS).parquet(f"{folder}/{MANIFEST}")
    except AnalysisException:  # nothing has been published yet
        return None


def publish(spark: SparkSession, folder: str, audits: list[Audit]) -> None:
    """Makes the versions that passed their audit the current ones, all at once."""
    passed = [a for a in audits if a.status == OK]
    if not passed:
        return
    known = _manifest(spark, folder)
    newest = (known.agg(F.max("version").alias("v")).first()["v"] if known is not None else None) or 0
    rows = [(a.name, newest + 1, a.path, a.row_count, a.rejected_count) for a in passed]
    spark.createDataFrame(rows, MANIFEST_COLUMNS).coalesce(1).write.mode("append").parquet(f"{folder}/{MANIFEST}")


def published_path(spark: SparkSession, folder: str, name: str) -> str | None:
    """Where the current version of a table is, if it has one."""
    known = _manifest(spark, folder)
    if known is None:
        return None
    row = known.filter(F.col("table_name") == name).agg(F.max_by("path", "version").alias("path")).first()
    return row["path"]


def read_published(spark: SparkSession, folder: str, target: Contract) -> DataFrame:
    """The current version of a table; an empty frame if there is none."""
    path = published_path(spark, folder, target.name)
    if path is None:
        return empty(spark, target)
    return spark.read.schema(target.stored_ddl).parquet(f"{path}/{VERDICT}={FIT}")


def read_quarantine(spark: SparkSession, audit_path: str, target: Contract) -> DataFrame:
    """The values that did not fit in one staged version: table, key of the row, column, text."""
    rows = spark.read.schema(f"{target.stored_ddl}, {REJECTED} {REJECTS}, {VERDICT} string").parquet(audit_path)
    return quarantined(rows.filter(F.col(VERDICT) == UNFIT), target)

"""Loading all raw feeds: each is staged and audited, and the good ones are published together."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.contracts.bronze import BRONZE
from shelfmark.functions.problems import first_cause
from shelfmark.session import side_by_side
from shelfmark.sources import staging
from shelfmark.sources.readers import FEED_TIME, read_feed_text

REPORT = "table_name string, status string, row_count bigint, rejected_count bigint, message string, path string"


def load_feeds(spark: SparkSession, files: dict[str, str], target_dir: str) -> DataFrame:
    """Load ``{feed: csv path}`` into ``target_dir``; a bad feed stops neither the others nor its own last version.

    A feed is FAILED if its file is missing, its header is not the contract's, or it cannot be read to
    the end; EMPTY if no row fits the contract; else OK and published. Each file is read once. Feeds are
    staged side by side, so that the last tasks of one leave no core idle.
    """

    def staged(name: str) -> staging.Audit:
        target = BRONZE[name]
        try:
            feed = read_feed_text(spark, files[name], target.columns)
        except PySparkException as problem:
            return staging.Audit(name, staging.FAILED, "", message=first_cause(problem))
        return staging.stage(feed, target_dir, target, FEED_TIME, {"_ingestion_date": F.to_date("_ingestion_timestamp")})

    audits = side_by_side(spark, staged, list(files))
    staging.publish(spark, target_dir, audits)
    return spark.createDataFrame([(a.name, a.status, a.row_count, a.rejected_count, a.message, a.path) for a in audits], REPORT)

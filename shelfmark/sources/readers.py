"""Reading feeds and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.contracts import Contract, checked
from shelfmark.contracts.bronze import BRONZE

# Fixed value: time format of the audit column and of event times in the feeds.
FEED_TIME = "yyyy-MM-dd HH:mm:ss"


def read_feed_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A pipe-delimited file with header, every column as text; empty fields are NULL."""
    schema = ", ".join(f"`{name}` string" for name in columns)
    return spark.read.schema(schema).csv(path, sep="|", header=True, quote='"', escape='"', enforceSchema=False)


def read_feed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One raw feed under its bronze contract; ``_rejected`` lists audit values that are no time or number."""
    target = BRONZE[name]
    return checked(read_feed_text(spark, path, target.columns), target, FEED_TIME)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or Parquet files when ``name`` is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_layer(spark: SparkSession, path: str, target: Contract) -> DataFrame:
    """Files of a contract. The schema is given, so partition values get their declared types, not guessed ones."""
    return spark.read.schema(target.stored_ddl).parquet(path)


def read_optional(spark: SparkSession, name: str, target: Contract) -> DataFrame:
    """The table, or an empty frame of the same schema when the catalog does not have it.

    Only absence is forgiven: a table that exists but cannot be read still fails.
    """
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return empty(spark, target)


def empty(spark: SparkSession, target: Contract) -> DataFrame:
    return spark.createDataFrame([], target.ddl)


def arrived_since(df: DataFrame, moment: str) -> DataFrame:
    """Rows ingested after ``moment``; prunes partitions when the feed is split by arrival day."""
    late = F.col("_ingestion_timestamp") > F.lit(moment).cast("timestamp")
    if "_ingestion_date" in df.columns:
        late = late & (F.col("_ingestion_date") >= F.lit(moment).cast("timestamp").cast("date"))
    return df.filter(late)

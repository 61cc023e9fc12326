"""Writing tables without losing earlier partitions."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfmark.contracts import REJECTED, Contract, checked, conform, quarantined
from shelfmark.session import cut_lineage


def with_partition_columns(df: DataFrame, target: Contract) -> DataFrame:
    """Adds the storage-only partition columns a contract names but does not declare."""
    derived = {
        "_ingestion_date": lambda: F.to_date("_ingestion_timestamp"),
        "attribution_month": lambda: F.trunc("attribution_date", "MM"),
    }
    missing = [name for name in target.partition_by if name not in df.columns]
    return df.withColumns({name: derived[name]() for name in missing}) if missing else df


QUARANTINE = "_quarantine"


def write_table(df: DataFrame, path: str, target: Contract) -> None:
    """Write under the contract as Parquet, replacing only the partitions present in ``df``.

    Rows with a value that does not fit go to the quarantine beside the table, with the column and the
    value as text. They are counted while the others are written; only where there are
    any does a second pass write them.

    Partition values go to separate tasks only as far as the data needs it:
    ``rebalance`` lets adaptive execution split a hot partition value over
    several files and merge small ones.
    """
    carried = [name for name in target.partition_by if name not in target.columns and name in df.columns]
    rows = with_partition_columns(checked(df, target, extra=carried), target)
    fits = F.size(REJECTED) == 0
    seen = Observation(f"write {target.name} {uuid.uuid4().hex}")
    out = rows.observe(seen, F.count_if(~fits).alias("unfit")).filter(fits).drop(REJECTED)
    if target.partition_by:
        balanced = out.hint("rebalance", *target.partition_by)
        writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*target.partition_by).parquet(path)
    else:
        out.write.mode("overwrite").parquet(path)
    if _unfit(seen):
        quarantined(rows, target).write.mode("append").parquet(f"{path}{QUARANTINE}")


def _unfit(seen: Observation) -> int:
    try:
        return seen.get["unfit"]
    except Py4JJavaError:  # a frame known to be empty is not run, so nothing was observed
        return 0


def save_managed(df: DataFrame, name: str, target: Contract) -> None:
    """A managed catalog table under the contract."""
    rows = with_partition_columns(conform(df, target), target)
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*target.partition_by) if target.partition_by else writer).saveAsTable(name)


@contextmanager
def _dynamic(spark: SparkSession) -> Iterator[None]:
    """Inserts into catalog tables take the overwrite mode from the session, not from a writer option."""
    conf, mode = spark.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(mode)
    conf.set(mode, "dynamic")
    try:
        yield
    finally:
        conf.set(mode, before)


def overwrite_partitions(df: DataFrame, name: str, target: Contract) -> None:
    """Replace the matching partitions of an existing catalog table (dynamic insert overwrite)."""
    order = [field.name for field in df.sparkSession.table(name).schema.fields]
    ready = with_partition_columns(conform(df, target), target).select(*order)
    with _dynamic(df.sparkSession):
        ready.write.insertInto(name, overwrite=True)


def insert_select(spark: SparkSession, name: str, partitions: list[str], ctes: dict[str, str], select: str) -> None:
    """``INSERT OVERWRITE ... PARTITION (...) WITH ... SELECT``: the result's last columns are the partition's.

    The rows are read before any is replaced, also where the statement reads the table that it writes.
    """
    named = ", ".join(f"{cte} AS ({body})" for cte, body in ctes.items())
    rows = cut_lineage(spark.sql(f"WITH {named} {select}" if named else select))
    view = f"insert_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        with _dynamic(spark):
            spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({', '.join(partitions)}) WITH ready AS (SELECT * FROM {view}) SELECT * FROM ready")
    finally:
        spark.catalog.dropTempView(view)


def register_external(spark: SparkSession, name: str, path: str, target: Contract) -> None:
    """A catalog table over Parquet files that already exist."""
    split = f"PARTITIONED BY ({', '.join(target.partition_by)})" if target.partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({target.stored_ddl}) USING PARQUET {split} LOCATION '{path}'")
    if target.partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")

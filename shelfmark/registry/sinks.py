"""Writing and reading back: each sink over a whole table, judged by digests of its partitions."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from shelfmark.contracts import contract
from shelfmark.operators import digests
from shelfmark.session import cut_lineage, scratch
from shelfmark.sources import readers, shapes, writers

# The table that the sinks write, by year and month.
SALES = contract("sales", """
transaction_id bigint
customer_id bigint
total_amount decimal(12,2)
transaction_date date
transaction_year int
transaction_month int
""", "transaction_id", "transaction_year transaction_month")
PARTS = list(SALES.partition_by)


def sales(spark, folder):
    return shapes.transactions(spark, folder).select(SALES.columns)


def corrected(spark, folder):
    """The rows of 1997 with doubled amounts: what a later load brings for these months."""
    return sales(spark, folder).filter("transaction_year = 1997").withColumn("total_amount", (F.col("total_amount") * 2).cast("decimal(12,2)"))


@contextmanager
def database(spark, name):
    """A database of its own, whose tables lie in the shared folder; dropped in the end."""
    own = f"shelf_{name}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {own} LOCATION '{scratch(spark, name)}'")
    try:
        yield own
    finally:
        spark.sql(f"DROP DATABASE {own} CASCADE")


def sink_parquet(spark, folder):
    """Parquet write and read back."""
    path = scratch(spark, "sink")
    writers.write_table(sales(spark, folder), path, SALES)
    return digests.compared(sales(spark, folder), readers.read_layer(spark, path, SALES).select(SALES.columns), PARTS)


def sink_partition_replace(spark, folder):
    """A second write of some months replaces these and leaves the other files alone."""
    path = scratch(spark, "sink")
    writers.write_table(sales(spark, folder), path, SALES)
    before = cut_lineage(readers.read_layer(spark, path, SALES).select(SALES.columns))
    writers.write_table(corrected(spark, folder), path, SALES)
    return digests.compared(before, readers.read_layer(spark, path, SALES).select(SALES.columns), PARTS)


def sink_table_overwrite(spark, folder):
    """Whole-table overwrite: what the second write does not bring is gone."""
    flat = contract("sales_flat", "\n".join(f"{name} {kind}" for name, kind in SALES.fields), "transaction_id")
    path = scratch(spark, "sink")
    writers.write_table(sales(spark, folder), path, flat)
    before = cut_lineage(readers.read_layer(spark, path, flat))
    writers.write_table(corrected(spark, folder), path, flat)
    return digests.compared(before, readers.read_layer(spark, path, flat), PARTS)


def sink_managed_table(spark, folder):
    """A managed catalog table, and a scan of it by name."""
    with database(spark, "managed") as own:
        writers.save_managed(sales(spark, folder), f"{own}.sales", SALES)
        return cut_lineage(digests.compared(sales(spark, folder), readers.read_table(spark, f"{own}.sales").select(SALES.columns), PARTS))


def sink_external_table(spark, folder):
    """A catalog table over Parquet files that are there already."""
    path = scratch(spark, "sink")
    writers.write_table(sales(spark, folder), path, SALES)
    with database(spark, "external") as own:
        writers.register_external(spark, f"{own}.sales", path, SALES)
        return cut_lineage(digests.compared(sales(spark, folder), readers.read_table(spark, f"{own}.sales").select(SALES.columns), PARTS))


def sink_dynamic_insert(spark, folder):
    """Insert overwrite into a catalog table: only the partitions of the new rows are replaced."""
    path = scratch(spark, "sink")
    writers.write_table(sales(spark, folder), path, SALES)
    with database(spark, "dynamic") as own:
        writers.register_external(spark, f"{own}.sales", path, SALES)
        before = cut_lineage(spark.table(f"{own}.sales").select(SALES.columns))
        writers.overwrite_partitions(corrected(spark, folder), f"{own}.sales", SALES)
        spark.catalog.refreshTable(f"{own}.sales")
        return cut_lineage(digests.compared(before, spark.table(f"{own}.sales").select(SALES.columns), PARTS))


def sink_insert_with_ctes(spark, folder):
    """Insert overwrite of a statement with named subqueries over catalog tables: months with corrected amounts."""
    path = scratch(spark, "sink")
    writers.write_table(sales(spark, folder), path, SALES)
    with database(spark, "ctes") as own:
        writers.register_external(spark, f"{own}.sales", path, SALES)
        before = cut_lineage(spark.table(f"{own}.sales").select(SALES.columns))
        writers.insert_select(spark, f"{own}.sales", PARTS, ctes={
            "late": f"SELECT * FROM {own}.sales WHERE transaction_year = 1997",
            "doubled": "SELECT transaction_id, customer_id, CAST(total_amount * 2 AS DECIMAL(12,2)) AS total_amount, transaction_date,"
                       " transaction_year, transaction_month FROM late",
        }, select="SELECT * FROM doubled")
        spark.catalog.refreshTable(f"{own}.sales")
        return cut_lineage(digests.compared(before, spark.table(f"{own}.sales").select(SALES.columns), PARTS))


QUERIES = {
    f.__name__: f
    for f in (
        sink_parquet, sink_partition_replace, sink_table_overwrite, sink_managed_table, sink_external_table, sink_dynamic_insert,
        sink_insert_with_ctes,
    )
}

"""Lineage queries over the flow of goods: suppliers, the lots they supply, parts, order lines, orders, customers.

Sources, inner steps and readers are also those of the statement log, whose facts are taken from its texts.
"""

from __future__ import annotations

from shelfmark.operators import lineage
from shelfmark.sources import shapes


def said(spark, folder):
    return lineage.statements(shapes.query_log(spark, folder))


def lineage_sources(spark, folder):
    return shapes.flow_reads(spark, folder).unionByName(lineage.statement_reads(said(spark, folder))).distinct()


def lineage_targets(spark, folder):
    return shapes.flow_writes(spark, folder).distinct()


def lineage_ctes(spark, folder):
    """Inner steps of a job and their direct sources: the lines that packing an order goes through, and the steps that a statement defines."""
    defined = lineage.statement_steps(said(spark, folder)).drop("of_step")
    return shapes.flow_steps(spark, folder).unionByName(defined).distinct()


def lineage_edges(spark, folder):
    return lineage.edges(shapes.flow_reads(spark, folder), shapes.flow_writes(spark, folder), shapes.flow_steps(spark, folder))


def lineage_downstream(spark, folder):
    return lineage.reachable(lineage_edges(spark, folder), "supplier:1")


def lineage_upstream(spark, folder):
    return lineage.reachable(lineage_edges(spark, folder), "customer:1", upstream=True)


def lineage_readers(spark, folder):
    """Jobs of a part, and jobs whose statements read or write a table."""
    logged = lineage.readers(lineage.statement_edges(said(spark, folder)), "silver.table_1")
    return lineage.readers(lineage_edges(spark, folder), "part:1").unionByName(logged).distinct()


def lineage_paths(spark, folder):
    return lineage.layer_paths(lineage_edges(spark, folder), "part:", "order:", "customer:")


def lineage_hot_datasets(spark, folder):
    return lineage.hot_datasets(lineage_edges(spark, folder))


QUERIES = {
    f.__name__: f
    for f in (
        lineage_sources, lineage_targets, lineage_ctes, lineage_edges, lineage_downstream, lineage_upstream,
        lineage_readers, lineage_paths, lineage_hot_datasets,
    )
}

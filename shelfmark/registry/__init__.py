"""Named queries: library operators applied to a data folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    from shelfmark.registry import customers, layers, lineage, marketing, merchandise, reports, sinks

    merged: dict[str, Query] = {}
    for module in (layers, customers, merchandise, marketing, reports, lineage, sinks):
        merged.update(module.QUERIES)
    return merged

"""Store performance: overall and by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmark.functions import ladders, numbers
from shelfmark.operators.ranking import with_dense_ranks
from shelfmark.operators.totals import with_group_totals, with_running_sums
from shelfmark.session import cut_lineage


def store_metrics(txns: DataFrame, stores: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Orders, customers and revenue per store (and per ``extra`` key).

    Customers are counted in two steps, by (store, customer) first, so a store
    with a third of all orders is not counted in one task.
    """
    keys = ["store_id", *(extra or [])]
    per_customer = txns.groupBy(*keys, "customer_id").agg(
        F.count("transaction_id").alias("orders"), F.sum("total_amount").alias("revenue")
    )
    counted = per_customer.groupBy(*keys).agg(
        numbers.whole(F.sum("orders")).alias("daily_transactions"),
        F.count("customer_id").alias("daily_customers"),
        numbers.money(F.sum("revenue")).alias("daily_revenue"),
    )
    named = counted.join(stores, "store_id", "left")
    return named.withColumn("avg_transaction_value", numbers.ratio(F.col("daily_revenue"), F.col("daily_transactions")))


def store_ranks(metrics: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Rank in the region and percentile over all stores (of a day, with ``extra``), without a task per region or day.

    The percentile is the share of the other stores that sold less: the number of stores per distinct revenue,
    added up in revenue order, tells how many are below.
    """
    by = extra or []
    ranked = with_dense_ranks(metrics, ["store_id", *by], {"revenue_rank_in_region": ("daily_revenue", [*by, "store_region"])})
    sold = metrics.groupBy(*by, "daily_revenue").agg(F.count(F.lit(1)).alias("_stores"))
    summed = with_running_sums(sold, by, [F.col("daily_revenue").asc_nulls_first()], {"_upto": F.col("_stores")})
    places = with_group_totals(summed, by, {"_all": F.sum("_stores")}).select(
        *[F.col(name).alias(f"_p_{name}") for name in [*by, "daily_revenue"]], (F.col("_upto") - F.col("_stores")).alias("_below"), "_all")
    same = F.lit(True)
    for name in [*by, "daily_revenue"]:
        same = same & F.col(name).eqNullSafe(F.col(f"_p_{name}"))
    share = F.coalesce(F.try_divide(F.col("_below").cast("double"), (F.col("_all") - 1).cast("double")), F.lit(0.0))
    return ranked.join(places, same).withColumn("revenue_percentile", F.round(share * 100, 6)).drop(
        "_below", "_all", *[f"_p_{name}" for name in [*by, "daily_revenue"]])


def store_snapshot(txns: DataFrame, stores: DataFrame, as_of: Column) -> DataFrame:
    """One row per store over all given transactions, stamped with the reporting day."""
    return store_ranks(cut_lineage(store_metrics(txns, stores))).withColumn("analysis_date", as_of)


def store_performance(txns: DataFrame, stores: DataFrame) -> DataFrame:
    """One row per store and day, with rank, percentile, growth and trend of the day."""
    return store_daily(txns.filter(F.col("transaction_date").isNotNull()), stores).withColumnRenamed("transaction_date", "analysis_date")


def store_daily(txns: DataFrame, stores: DataFrame) -> DataFrame:
    """Store by day: rank and percentile of the day, growth against 7 days and one year before, 7-day trend.

    The windows run over one row per store and day; calendar ranges, not row
    counts, so days without sales do not shift the comparison.
    """
    daily = store_ranks(cut_lineage(store_metrics(txns, stores, ["transaction_date"])), ["transaction_date"])
    number = F.date_diff(F.col("transaction_date"), F.lit("1970-01-01").cast("date"))
    history = Window.partitionBy("store_id").orderBy("_day")
    on_day = lambda back: F.max("daily_revenue").over(history.rangeBetween(-back, -back))
    span = lambda first, last: F.coalesce(
        F.sum("daily_revenue").over(history.rangeBetween(first, last)), F.lit(0).cast("decimal(18,2)")
    )
    return daily.withColumn("_day", number).withColumns(
        {
            "revenue_growth_wow": numbers.growth(F.col("daily_revenue"), on_day(7)),
            "revenue_growth_yoy": numbers.growth(F.col("daily_revenue"), on_day(365)),
            "revenue_trend_7d": ladders.trend(span(-6, 0).cast("double"), span(-13, -7).cast("double")),
        }
    ).drop("_day")

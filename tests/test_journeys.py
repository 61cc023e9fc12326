"""The index of journeys for a customer with a million touches, and what the plan may not hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.plans import attribution

MILLION = 1_000_000


def many_touches(spark):
    """Customer 1 has a touch every second for eleven and a half days, and buys with every 250,000th; others have one purchase."""
    bought = (F.col("id") % 250_000 == 249_999)
    return spark.range(MILLION + 3).select(
        F.when(F.col("id") < MILLION, 1).otherwise(F.col("id")).alias("customer_id"), F.col("id").alias("touch_id"),
        F.timestamp_seconds(1_700_000_000 + F.col("id")).alias("touch_timestamp"), F.lit("online").alias("channel"),
        F.lit(None).cast("bigint").alias("campaign_id"),
        F.when(bought | (F.col("id") >= MILLION), "purchase").otherwise("interaction").alias("event_type"),
        F.lit(1).cast("decimal(12,2)").alias("revenue"))


def test_a_million_touches(spark):
    index = attribution.journey_index(many_touches(spark))
    found = {r["transaction_id"]: (r["first"], r["last"]) for r in attribution.journey_ranges(index).collect()}
    assert found == {**{250_000 * k - 1: (1, 250_000 * k) for k in (1, 2, 3, 4)}, **{MILLION + i: (1, 1) for i in range(3)}}
    listed = attribution.journey_arrays(many_touches(spark)).select("transaction_id", F.size("journey_touchpoints").alias("n"),
                                                                    F.get("journey_touchpoints", F.lit(100_000))["timestamp"].alias("at"))
    rows = {r["transaction_id"]: (r["n"], r["at"] and int(r["at"].timestamp())) for r in listed.collect()}
    assert {k: n for k, (n, _) in rows.items()} == {k: last for k, (_, last) in found.items()}
    assert {at for n, at in rows.values() if n > 1} == {1_700_100_000}


def test_purchases_meet_pieces_only(spark):
    plan = attribution.journey_arrays(many_touches(spark))._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert any("_piece" in line for line in joins) and not any("_block" in line or "touch_day" in line for line in joins)


def test_touches_without_customer_or_moment(spark):
    rows = spark.sql("""
        SELECT * FROM VALUES (null, 1L, timestamp'2025-01-01 10:00:00', 'purchase'), (1, 2L, null, 'purchase'),
          (1, 3L, timestamp'2025-01-01 10:00:00', 'purchase'), (1, 4L, timestamp'2025-01-01 10:00:00', 'interaction')
          AS t(customer_id, touch_id, touch_timestamp, event_type)
        """).withColumns({"channel": F.lit("x"), "campaign_id": F.lit(None).cast("bigint"), "revenue": F.lit(1).cast("decimal(12,2)")})
    assert [(r["transaction_id"], r["touch_id"]) for r in attribution.journey_touches(rows).orderBy("touch_id").collect()] == [(3, 3), (3, 4)]
    assert attribution.journey_touches(rows.limit(0)).count() == 0

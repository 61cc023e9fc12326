"""Feeds to gold on small handwritten files, and how tables are written."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from shelfmark.contracts import conform
from shelfmark.contracts.bronze import BRONZE
from shelfmark.contracts.gold import GOLD
from shelfmark.contracts.silver import SILVER
from shelfmark.plans import medallion
from shelfmark.sources import readers, staging, writers

AUDIT = "|tester|2025-11-05 04:30:00|part.csv|{}"

FEEDS = {
    "transactions_raw": [
        'TXN011|CUST4|2025-03-30 08:05:10|online||wire|completed|60.00|4.50|5.00|15.00|54.50|USD|54|0|["SPRING31"]',
        "TXN012|CUST5|2025-05-31 21:40:00|mobile||voucher|completed|33.30|1.11|0.00|0.00|34.41|USD|34|0|[]",
        "TXN013|CUST4|2025-07-01 07:00:59|store|STR002|cash|completed|120.06|6.06|0.00|0.00|126.12|USD|126|20|[]",
        'TXN014|CUST6|2025-12-25 23:59:59|online||wire|failed|400.10|20.20|7.70|40.00|388.00|USD|388|0|["VIP77","NOSHIP"]',
        "TXN015|CUST6|half past nine|marketplace||wire|pending|5.55|0.45|0.00|0.00|6.00|USD||0|",
    ],
    "transaction_items_raw": [
        "TXNI21|TXN011|PROD5|VAR5|3|20.00|25.00|0.10|0||shipped|WH004",
        "TXNI22|TXN011|PROD6|VAR6|2|30.03|0.00|0.05|2|torn|shipped|WH004",
        "TXNI23|TXN012|PROD5|VAR5|1|33.30|||0||shipped|WH005",
        "TXNI24|TXN013|PROD8|VAR8|4|30.00|0.00|0.05|0||completed|STR002",
        "TXNI25|TXN013|PROD5|VAR5|1|20.00|0.00|0.10|0||completed|STR002",
        "TXNI26|TXN014|PROD6|VAR6|5|30.03|0.00|0.05|0||pending|WH006",
    ],
    "subscriptions_raw": [
        "SUB7|CUST4|gold|PLAN014|2025-10-24||active|monthly|12.50|2026-01-24|true||",
        "SUB8|CUST5|silver|PLAN015|2023-02-01|2025-08-15|cancelled|annual|80.00||False|2025-08-01|moved_away",
    ],
    "customer_interactions_raw": [
        "INT41|CUST4|2025-03-25 12:00:01|chat|web|AGT021|billing|refund|0.12|15|5|Sorted out at once.",
        "INT42|CUST4|2025-06-11 18:30:00|phone|phone|AGT022|billing|refund|-0.35|55|2|Had to be escalated twice.",
        "INT43|CUST5|2025-06-12 09:09:09|email|email||billing|refund|||0|",
    ],
    "product_catalog_raw": [
        'PROD5|Desk lamp|Home|Lighting|Lamps|Lumo|Lumo Works|8.00|20.00||SUP031|9|1.500|{"height":40}|["metal"]|2023-09-09|',
        'PROD6|Rope|Outdoor||Climbing|Gripco|Grip Ltd|11.00|30.03||SUP032|3|2.100|{"length":900}|[]|2018-01-20|2025-02-02',
    ],
    "inventory_snapshots_raw": [
        "SNAP31|2025-11-02 00:00:00|PROD5|VAR5|WH004|80|5|75|30|90",
        "SNAP32|2025-11-03 00:00:00|PROD5|VAR5|WH004|6|6||30|90",
    ],
    "marketing_campaigns_raw": [
        'CAMP031|Spring|email|email|2025-03-15|2025-04-14|600.00|{"age_range":"18-99","interests":["x","y"],"segment":"t"}|CRE7',
        "CAMP077|Guests|social|facebook|2025-12-01|2025-12-31|250.00||CRE8",
    ],
    "campaign_events_raw": [
        "EVT51|CAMP031|CUST4|2025-03-28 06:00:00|impression|tablet|Oslo|0.00",
        "EVT52|CAMP031|CUST4|2025-03-28 06:01:30|click|tablet|Oslo|0.00",
        "EVT53|CAMP031|CUST4|2025-03-30 08:05:10|conversion|tablet|Oslo|54.50",
    ],
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lake")
    files = {}
    for name, lines in FEEDS.items():
        path = folder / f"{name}.csv"
        quoted = ["|".join(f'"{c.replace(chr(34), chr(34) * 2)}"' if '"' in c else c for c in line.split("|")) for line in lines]
        rows = [line + AUDIT.format(i) for i, line in enumerate(quoted)]
        path.write_text("\n".join(["|".join(BRONZE[name].columns), *rows]) + "\n")
        files[name] = str(path)
    report = medallion.bronze(spark, files, f"{folder}/bronze")
    raw = medallion.published(spark, f"{folder}/bronze")
    medallion.write_silver(medallion.silver(raw, "2026-01-02", "2026-01-02 06:00:00"), f"{folder}/silver")
    tables = {name: readers.read_layer(spark, f"{folder}/silver/{name}", SILVER[name]) for name in SILVER}
    stores = spark.createDataFrame([(1, "Main Street", "North")], "store_id long, store_name string, store_region string")
    medallion.write_gold(medallion.gold(tables, stores, "2026-01-02"), f"{folder}/gold", "2026-01-02 06:00:00")
    marts = {name: readers.read_layer(spark, f"{folder}/gold/{name}", GOLD[name]) for name in GOLD}
    return {"folder": str(folder), "report": report, "raw": raw, "silver": tables, "gold": marts}


def test_every_feed_loaded(lake):
    got = {r.table_name: (r.status, r.row_count) for r in lake["report"].collect()}
    assert got == {name: ("OK", len(lines)) for name, lines in FEEDS.items()}


def header(name):
    return "|".join(BRONZE[name].columns) + "\n"


def test_a_bad_feed_stops_neither_the_others_nor_its_last_version(spark, tmp_path, lake):
    good, bronze = f"{lake['folder']}/campaign_events_raw.csv", str(tmp_path / "bronze")
    status = lambda files: {r.table_name: (r.status, r.row_count) for r in medallion.bronze(spark, files, bronze).collect()}
    assert status({"campaign_events_raw": good, "transactions_raw": f"{tmp_path}/none.csv"}) == {
        "campaign_events_raw": ("OK", 3), "transactions_raw": ("FAILED", 0)}
    (tmp_path / "other.csv").write_text(header("subscriptions_raw") + "x|" * 16 + "\n")
    (tmp_path / "blank.csv").write_text(header("campaign_events_raw"))
    for bad, outcome in (("other.csv", "FAILED"), ("blank.csv", "EMPTY")):
        assert status({"campaign_events_raw": str(tmp_path / bad)}) == {"campaign_events_raw": (outcome, 0)}
        assert staging.read_published(spark, bronze, BRONZE["campaign_events_raw"]).count() == 3
    (tmp_path / "new.csv").write_text(header("campaign_events_raw") + "EVT9|CAMP1|CUST1|2025-01-01 00:00:00|click|tablet|Oslo|0.00" + AUDIT.format(7) + "\n")
    assert status({"campaign_events_raw": str(tmp_path / "new.csv")}) == {"campaign_events_raw": ("OK", 1)}
    assert [r.event_id for r in staging.read_published(spark, bronze, BRONZE["campaign_events_raw"]).collect()] == ["EVT9"]
    assert staging.read_published(spark, bronze, BRONZE["transactions_raw"]).isEmpty()


def test_the_cause_of_a_wrong_header_is_one_line(spark, tmp_path):
    (tmp_path / "other.csv").write_text(header("subscriptions_raw") + "x|" * 16 + "\n")
    row = medallion.bronze(spark, {"campaign_events_raw": str(tmp_path / "other.csv")}, str(tmp_path / "b")).first()
    assert "header" in row.message and "\n" not in row.message


def test_values_that_do_not_fit_are_quarantined(spark, tmp_path):
    lines = ["EVT1|C|C|2025-01-01 00:00:00|click|tablet|Oslo|0.00|s|2025-01-01 00:00:00|f|1",
             "EVT2|C|C|2025-01-01 00:00:00|click|tablet|Oslo|0.00|s|yesterday|f|two"]
    (tmp_path / "e.csv").write_text(header("campaign_events_raw") + "\n".join(lines) + "\n")
    report = medallion.bronze(spark, {"campaign_events_raw": str(tmp_path / "e.csv")}, str(tmp_path / "b")).first()
    assert (report.status, report.row_count, report.rejected_count) == ("OK", 1, 1)
    target = BRONZE["campaign_events_raw"]
    assert {tuple(r) for r in staging.read_quarantine(spark, report.path, target).collect()} == {
        ("campaign_events_raw", "EVT2", "_ingestion_timestamp", "yesterday"), ("campaign_events_raw", "EVT2", "_record_offset", "two")}
    assert [r.event_id for r in staging.read_published(spark, str(tmp_path / "b"), target).collect()] == ["EVT1"]


def test_marts_lose_no_value(spark, tmp_path):
    target, path = GOLD["store_performance"], str(tmp_path / "stores")
    rows = spark.sql("""SELECT * FROM VALUES (1, date'2025-01-01', cast(1e15 as double)), (2, date'2025-01-01', 1e30D)
        AS t(store_id, analysis_date, avg_transaction_value)""")
    writers.write_table(rows, path, target)
    assert [(r.store_id, r.avg_transaction_value) for r in spark.read.parquet(path).collect()] == [(1, Decimal("1000000000000000.00"))]
    bad = spark.read.parquet(path + writers.QUARANTINE).collect()
    assert [(r.table_name, r.column_name, r.text) for r in bad] == [("store_performance", "avg_transaction_value", "1.0E30")]
    with pytest.raises(ArithmeticException):
        conform(rows, target).collect()


def test_the_run_stops_at_the_gate(spark, tmp_path, lake):
    files = {name: f"{lake['folder']}/{name}.csv" for name in FEEDS}
    files["subscriptions_raw"] = f"{tmp_path}/none.csv"
    stores = spark.createDataFrame([(1, "Main Street", "North")], "store_id long, store_name string, store_region string")
    with pytest.raises(ValueError, match=r"subscriptions_raw \(EMPTY\)"):
        medallion.run(spark, files, stores, str(tmp_path / "run"), "2026-01-02", "2026-01-02 06:00:00")
    assert not (tmp_path / "run" / "silver").exists()


def test_silver_transactions(lake):
    rows = {r.transaction_id: r for r in lake["silver"]["transactions"].collect()}
    assert rows[13].store_id == 2 and rows[13].channel == "in-store" and rows[11].store_id is None
    assert rows[14].coupon_codes == ["VIP77", "NOSHIP"] and rows[14].is_holiday and rows[14].has_coupon
    assert not rows[12].has_coupon and rows[12].coupon_codes == []
    assert rows[11].is_first_purchase and not rows[13].is_first_purchase
    assert rows[11].is_return_transaction and not rows[13].is_return_transaction
    assert rows[15].transaction_timestamp is None and rows[15].loyalty_points_earned is None


def test_silver_items(lake):
    rows = {r.transaction_item_id: r for r in lake["silver"]["transaction_items"].collect()}
    first = rows[21]
    assert (first.line_subtotal, first.line_discount, first.line_tax, first.line_total) == tuple(
        map(Decimal, ("60.00", "15.00", "4.50", "49.50")))
    assert (first.line_cost, first.line_profit, first.net_line_revenue) == tuple(map(Decimal, ("42.00", "7.50", "45.00")))
    assert rows[22].net_quantity == 0 and rows[22].net_line_revenue == 0
    assert rows[23].discount_percentage == 0 and rows[23].tax_rate == 0
    assert rows[24].location_type == "store" and rows[24].warehouse_id == 2


def test_silver_subscriptions_and_products(lake):
    subs = {r.subscription_id: r for r in lake["silver"]["subscriptions"].collect()}
    assert subs[7].subscription_duration_days == 70 and subs[7].total_payments_made == 2 and not subs[7].is_churned
    assert subs[8].is_churned and subs[8].total_payments_made == 2 and subs[8].churn_risk_score == Decimal("1.00")
    products = {r.product_id: r for r in lake["silver"]["product_catalog"].collect()}
    assert products[6].full_category_path == "Outdoor > Climbing" and products[6].lifecycle_stage == "discontinued"
    assert products[5].price_tier == "budget" and products[5].tags == ["metal"] and products[6].tags is None


def test_gold_customers(lake):
    rows = {r.customer_id: r for r in lake["gold"]["customer_360"].collect()}
    assert set(rows) == {4, 5, 6} and sorted(r.customer_key for r in rows.values()) == [1, 2, 3]
    four = rows[4]
    assert four.total_orders == 2 and four.total_revenue == Decimal("180.62") and four.has_active_subscription
    assert four.total_support_interactions == 2 and four.total_returns == 1 and four.most_purchased_category == "Home"
    assert rows[6].total_orders == 2 and rows[5].subscription_mrr == 0


def test_gold_products_keep_lines_without_a_catalog_row(lake):
    rows = {r.product_id: r for r in lake["gold"]["product_performance"].collect()}
    assert rows[8].category_level1 == "Unknown" and rows[8].gross_revenue == Decimal("126.00")
    assert rows[5].top_cross_sell_products == ["6", "8"] and rows[5].requires_reorder


def test_gold_attribution_maps(lake):
    rows = {r.transaction_id: r for r in lake["gold"]["channel_attribution"].collect()}
    first = rows[11]
    assert first.first_touch_channel == "chat" and first.last_touch_channel == "online" and first.touchpoint_count == 2
    assert sum(first.time_decay_attribution_map.values()) == Decimal("54.50")
    assert [t.channel for t in first.journey_touchpoints] == ["chat", "online"]


def test_gold_campaigns_use_the_feeds(lake):
    rows = {(r.coupon_code, r.channel): r for r in lake["gold"]["campaign_roi_analysis"].collect()}
    spring = rows["SPRING31", "online"]
    assert spring.campaign_id == 31 and spring.actual_spend == Decimal("600.00") and spring.total_clicks == 1
    assert rows["NOSHIP", "online"].campaign_id is None and rows["ORGANIC", "mobile"].actual_spend == 0


def test_gold_schemas_follow_the_contracts(lake):
    for name, mart in lake["gold"].items():
        kinds = dict(mart.dtypes)
        for column, kind in GOLD[name].fields:
            assert kinds[column] == kind.replace(" ", "").lower(), (name, column)


def test_a_second_day_keeps_the_first(spark, tmp_path):
    target = GOLD["store_performance"]
    path = str(tmp_path / "stores")
    for day in ("2025-01-01", "2025-01-02", "2025-01-02"):
        rows = spark.createDataFrame([(1, day)], "store_id long, d string").withColumn("analysis_date", F.col("d").cast("date"))
        writers.write_table(rows, path, target)
    assert sorted(r.analysis_date for r in spark.read.parquet(path).collect()) == [dt.date(2025, 1, 1), dt.date(2025, 1, 2)]


def test_catalog_tables(spark, tmp_path):
    target = SILVER["campaign_events"]
    spark.sql("CREATE DATABASE IF NOT EXISTS shelf_test")
    rows = spark.createDataFrame([(1, 2, dt.date(2025, 1, 1)), (2, 2, dt.date(2025, 1, 2))], "event_id long, campaign_id long, event_date date")
    try:
        writers.save_managed(rows, "shelf_test.managed_events", target)
        assert spark.table("shelf_test.managed_events").count() == 2
        path = str(tmp_path / "events")
        writers.write_table(rows, path, target)
        writers.register_external(spark, "shelf_test.events", path, target)
        assert spark.table("shelf_test.events").count() == 2
        later = rows.filter("event_id = 2").withColumn("campaign_id", F.lit(9).cast("long"))
        writers.overwrite_partitions(later, "shelf_test.events", target)
        got = {r.event_id: r.campaign_id for r in spark.table("shelf_test.events").collect()}
        assert got == {1: 2, 2: 9}
        assert readers.read_optional(spark, "shelf_test.events", target).count() == 2
        assert readers.read_optional(spark, "shelf_test.absent", target).count() == 0
    finally:
        spark.sql("DROP DATABASE IF EXISTS shelf_test CASCADE")


def test_arrived_since_prunes_partitions(spark, lake):
    late = readers.arrived_since(lake["raw"]["transactions_raw"], "2025-11-05 04:00:00")
    assert late.count() == 5
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingestion_date" in plan


def test_conform_fills_and_narrows(spark):
    got = conform(spark.createDataFrame([(1, "x")], "store_id int, store_name string"), GOLD["store_performance"])
    assert got.columns == GOLD["store_performance"].columns
    row = got.first()
    assert row.store_id == 1 and row.nps_score is None

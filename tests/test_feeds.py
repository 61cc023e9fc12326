"""Feeds are written packed, and loaded without a shuffle of their rows."""

from __future__ import annotations

import gzip
import threading

from pyspark.sql import functions as F

from shelfmark.contracts import checked
from shelfmark.contracts.bronze import BRONZE
from shelfmark.registry import layers
from shelfmark.sources import loading, staging
from shelfmark.sources.readers import FEED_TIME

FOLDER = "/root/testdata/sf0.001"


def test_staging_a_feed_does_not_shuffle_its_rows(spark, tmp_path):
    target = BRONZE["transactions_raw"]
    feed = layers.RAW[target.name](spark, FOLDER).select(target.columns)
    audit = staging.stage(feed.repartition(3), str(tmp_path), target, derived={"_ingestion_date": F.to_date("_ingestion_timestamp")})
    assert audit.status == staging.OK and audit.row_count == feed.count()
    # Three tasks read, three tasks write: a day of arrival has a file of each of them.
    names = [f.name.split("-")[1] for f in tmp_path.rglob("part-*.parquet")]
    assert set(names) == {"00000", "00001", "00002"}


def test_feeds_are_written_packed_and_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layers, "FEED_ROWS", 100)
    files = layers.feed_files(spark, FOLDER, f"file://{tmp_path}")
    for name in ("transactions_raw", "marketing_campaigns_raw"):
        target = BRONZE[name]
        parts = list((tmp_path / name).glob("part-*"))
        assert parts and all(part.name.endswith(".csv.gz") for part in parts)
        assert layers.readers.read_feed_text(spark, files[name], target.columns).count() == layers.RAW[name](spark, FOLDER).count()


def test_feeds_are_packed_at_the_fastest_level(spark, tmp_path):
    layers.feed_files(spark, FOLDER, f"file://{tmp_path}")
    packed = max((tmp_path / "transaction_items_raw").glob("part-*.gz"), key=lambda f: f.stat().st_size).read_bytes()
    text = gzip.decompress(packed)
    assert len(packed) > 0.9 * len(gzip.compress(text, 1)) > 1.05 * len(gzip.compress(text, 6))


def test_reasons_are_put_together_only_for_rows_that_do_not_fit(spark):
    target = BRONZE["campaign_events_raw"]
    rows = [("a", "2024-01-01 00:00:00", "1"), ("b", "late", "2"), ("c", None, "x"), ("d", "late", "y")]
    feed = spark.createDataFrame(rows, "event_id string, _ingestion_timestamp string, _record_offset string")
    found = checked(feed, target, FEED_TIME)
    assert {r.event_id: [tuple(x) for x in r._rejected] for r in found.collect()} == {
        "a": [], "b": [("_ingestion_timestamp", "late")], "c": [("_record_offset", "x")],
        "d": [("_ingestion_timestamp", "late"), ("_record_offset", "y")]}
    # The array of reasons stands behind a condition.
    plan = found.select("_rejected")._jdf.queryExecution().analyzed().toString()
    assert plan.index("CASE WHEN") < plan.index("array_compact")


def test_feeds_are_staged_side_by_side_and_reported_in_order(spark, tmp_path, monkeypatch):
    names, met = ["transactions_raw", "subscriptions_raw", "campaign_events_raw"], threading.Barrier(3, timeout=60)
    whole = loading.staging.stage

    def waits(*args):
        met.wait()
        return whole(*args)

    monkeypatch.setattr(loading.staging, "stage", waits)
    files = layers.feed_files(spark, FOLDER, f"file://{tmp_path}/csv")
    report = loading.load_feeds(spark, {name: files[name] for name in names}, f"file://{tmp_path}/bronze").collect()
    assert [(row.table_name, row.status) for row in report] == [(name, "OK") for name in names]

"""Distributed operators against brute force on small frames, with hot keys."""

from __future__ import annotations

import datetime as dt
import itertools
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmark.operators import firsts, history, lineage, pairing, quality, ranking
from shelfmark.plans import attribution, baskets, cohorts


def skewed(spark, rows=600, seed=3):
    """Rows of which a third share one group and many share a value."""
    rng = random.Random(seed)
    data = [
        (i, "hot" if rng.random() < 0.34 else f"g{rng.randrange(12)}", rng.choice([None, 0, 0, 0, 1, 2, 5, 9, rng.randrange(100)]))
        for i in range(rows)
    ]
    return spark.createDataFrame(data, "id long, g string, v long").repartition(7)


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(*a.columns).collect()), key=repr)


@pytest.mark.parametrize("group", [[], ["g"]])
def test_row_number(spark, group):
    df = skewed(spark)
    order = [F.col("v").asc_nulls_first(), F.col("id").asc()]
    window = Window.partitionBy(*group)
    want = df.withColumn("n", F.row_number().over(window.orderBy(*order)).cast("bigint")).withColumn(
        "t", F.count(F.lit(1)).over(window))
    same(ranking.with_row_number(df, order, "n", group, total="t"), want)


@pytest.mark.parametrize("rows", [1, 4, 5, 599])
def test_ntiles_and_keys_in_one_sort(spark, rows):
    df = skewed(spark, rows)
    by_value = Window.orderBy(F.col("v").asc_nulls_first(), F.col("id"))
    by_falling = Window.orderBy((-F.col("v")).asc_nulls_first(), F.col("id"))
    want = (
        df.withColumn("key", F.row_number().over(Window.orderBy("id")).cast("bigint"))
        .withColumn("up", F.ntile(5).over(by_value)).withColumn("down", F.ntile(5).over(by_falling))
    )
    got = ranking.with_places(df, "id", {"key": F.col("id")}, {"up": (F.col("v"), 5), "down": (-F.col("v"), 5)})
    same(got, want)


def test_dense_ranks(spark):
    df = skewed(spark)
    falling = F.col("v").desc_nulls_last()
    want = df.withColumn("a", F.dense_rank().over(Window.partitionBy("g").orderBy(falling))).withColumn(
        "b", F.dense_rank().over(Window.orderBy(falling)))
    same(ranking.with_dense_ranks(df, "id", {"a": ("v", "g"), "b": ("v", None)}), want)
    same(ranking.with_dense_rank(df, "v", "a", ["g"]), want.drop("b"))


@pytest.mark.parametrize("following", [False, True])
def test_neighbour(spark, following):
    df = skewed(spark)
    window = Window.partitionBy("g").orderBy("id")
    step = F.lead if following else F.lag
    want = df.withColumn("w", step("v").over(window))
    same(ranking.with_neighbour(df, [F.col("id").asc()], {"v": "w"}, ["g"], following), want)


def test_first_purchase(spark):
    rows = [(1, 10, dt.datetime(2025, 1, 2)), (2, 10, dt.datetime(2025, 1, 1)), (3, 10, dt.datetime(2025, 1, 1)),
            (4, 11, dt.datetime(2025, 3, 1)), (5, 12, None)]
    df = spark.createDataFrame(rows, "transaction_id long, customer_id long, transaction_timestamp timestamp")
    got = {r.transaction_id: r.is_first_purchase for r in firsts.with_first_purchase(df).collect()}
    assert got == {1: False, 2: True, 3: False, 4: True, 5: False}


def test_dedupe_latest(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("a", 2, "y")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    got = sorted(map(tuple, firsts.dedupe_latest(df, ["k"], ["t"]).collect()))
    assert got == [("a", 2, "y"), ("b", 1, "z")]


def test_top_value_ties_go_to_the_smaller_name(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (1, "a", 1), (2, None, 9), (2, "c", 1)], "k int, v string, w int")
    got = sorted(map(tuple, firsts.top_value(df, "k", "v", "w", "best").collect()))
    assert got == [(1, "a"), (2, "c")]


def test_scd2_intervals(spark):
    day = lambda d: dt.date(2025, 1, d)
    rows = [("p", day(1), 5), ("p", day(3), 5), ("p", day(4), 6), ("p", day(9), 5), ("q", day(2), None), ("q", day(5), 1)]
    df = spark.createDataFrame(rows, "id string, day date, price int")
    got = sorted(map(tuple, history.scd2_history(df, "id", "day", ["price"]).collect()), key=lambda r: (r[0], r[2]))
    assert got == [
        ("p", 5, day(1), day(4), False), ("p", 6, day(4), day(9), False), ("p", 5, day(9), None, True),
        ("q", None, day(2), day(5), False), ("q", 1, day(5), None, True),
    ]


def test_scd2_with_a_hot_key(spark):
    rng = random.Random(5)
    start = dt.date(2020, 1, 1)
    rows = [("hot" if i % 3 else f"k{i % 20}", start + dt.timedelta(days=rng.randrange(900)), rng.randrange(3)) for i in range(900)]
    got = history.scd2_history(spark.createDataFrame(rows, "id string, day date, v int"), "id", "day", ["v"]).collect()
    latest = defaultdict(dict)
    for key, day, value in rows:
        latest[key][day] = max(value, latest[key].get(day, -1))
    want = []
    for key, days in latest.items():
        kept = []
        for day in sorted(days):
            if not kept or kept[-1][1] != days[day]:
                kept.append((day, days[day]))
        for (day, value), following in itertools.zip_longest(kept, kept[1:]):
            until = following[0] if following else None
            want.append((key, value, day, until, until is None))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("limit", [2, 512])
def test_item_pairs_meet_once_also_in_huge_baskets(spark, limit):
    rng = random.Random(1)
    rows = {(0, i) for i in range(40)} | {(rng.randrange(1, 30), rng.randrange(15)) for _ in range(150)}
    df = spark.createDataFrame([(o, i, 1) for o, i in rows], "o long, i long, c int")
    got = Counter((r.o, r.item_a, r.item_b) for r in pairing.item_pairs(df, "o", "i", ["c"], limit).collect())
    per_order = defaultdict(list)
    for o, i in rows:
        per_order[o].append(i)
    want = Counter((o, a, b) for o, items in per_order.items() for a, b in itertools.combinations(sorted(items), 2))
    assert got == want


def test_pruning_rare_items_keeps_all_frequent_pairs(spark):
    rng = random.Random(2)
    rows = {(rng.randrange(60), rng.randrange(25)) for _ in range(400)}
    items = spark.createDataFrame(list(rows), "transaction_id long, product_id long")
    txns = spark.createDataFrame([(i, Decimal("1.00")) for i in range(60)], "transaction_id long, total_amount decimal(12,2)")
    held = baskets.baskets(items, txns)
    everything = {tuple(r) for r in baskets.pair_counts(held).collect()}
    assert {tuple(r) for r in baskets.pair_counts(held, 3).collect()} == {r for r in everything if r[2] >= 3}


TOUCH = "customer_id long, touch_id long, touch_timestamp timestamp_ntz, channel string, campaign_id long, event_type string, revenue decimal(12,2)"


def random_touches(count=500, seed=11):
    rng = random.Random(seed)
    start = dt.datetime(2025, 1, 1)
    rows = []
    for i in range(count):
        bought = rng.random() < 0.3
        # Coarse times make touches of the same moment; customer 0 holds a third of all rows.
        ts = start + dt.timedelta(hours=6 * rng.randrange(4 * 80))
        rows.append((
            0 if rng.random() < 0.34 else rng.randrange(1, 9), i, ts, rng.choice(["online", "email", "chat", "phone"]),
            rng.choice([None, 1, 2]), "purchase" if bought else "interaction",
            Decimal(rng.randrange(1, 9999)) / 100 if bought else Decimal("0.00"),
        ))
    return rows


def brute_journeys(rows):
    found = {}
    for p in (r for r in rows if r[5] == "purchase"):
        steps = [t for t in rows if t[0] == p[0] and t[2] <= p[2] and (p[2].date() - t[2].date()).days <= 30]
        found[p[1]] = sorted(steps, key=lambda t: (t[2], t[5] == "purchase", t[1]))
    return found


@pytest.mark.parametrize("size", [5, 512])
def test_journey_touches(spark, size):
    rows = random_touches()
    got = Counter((r.transaction_id, r.touch_id) for r in attribution.journey_touches(spark.createDataFrame(rows, TOUCH), size).collect())
    assert got == Counter((p, t[1]) for p, steps in brute_journeys(rows).items() for t in steps)


def test_journey_counts_without_listing(spark):
    rows = random_touches()
    want = {}
    for purchase, steps in brute_journeys(rows).items():
        for channel, n in Counter(t[3] for t in steps).items():
            want[purchase, channel] = (n, len(steps), steps[0][3], steps[-1][3])
    got = {
        (r.transaction_id, r.channel): (r.touches, r.touchpoint_count, r.first_touch_channel, r.last_touch_channel)
        for r in attribution.journeys(spark.createDataFrame(rows, TOUCH)).collect()
    }
    assert got == want


@pytest.mark.parametrize("model", ["linear", "time_decay", "position", "first_last"])
def test_credits_add_up_to_revenue(spark, model):
    rows = random_touches(300, seed=4)
    revenue = {r[1]: r[6] for r in rows if r[5] == "purchase"}
    summed = defaultdict(Decimal)
    for r in attribution.credits(attribution.journeys(spark.createDataFrame(rows, TOUCH)), model).collect():
        summed[r.transaction_id] += r.credit
    assert dict(summed) == revenue


@pytest.mark.parametrize("size", [3, 512])
def test_journey_arrays_are_ordered(spark, size):
    rows = random_touches(200, seed=9)
    for r in attribution.journey_arrays(spark.createDataFrame(rows, TOUCH), size).collect():
        steps = brute_journeys(rows)[r.transaction_id]
        assert [(s.timestamp, s.channel, s.event_type) for s in r.journey_touchpoints] == [(t[2], t[3], t[5]) for t in steps]


def test_cohort_month_zero_and_gaps(spark):
    day = dt.date
    rows = [(1, 1, day(2025, 1, 31), "online"), (2, 1, day(2025, 2, 1), "store"), (3, 1, day(2025, 4, 1), "online"),
            (4, 2, day(2025, 2, 15), "mobile"), (5, 2, day(2025, 2, 20), "mobile")]
    txns = spark.createDataFrame([(*r, Decimal("10.00")) for r in rows],
                                 "transaction_id long, customer_id long, transaction_date date, channel string, total_amount decimal(12,2)")
    counted = cohorts.with_retention(cohorts.period_counts(cohorts.active_months(txns)))
    got = {(r.cohort_month, r.months_since_first_purchase): r for r in counted.collect()}
    assert set(got) == {(day(2025, 1, 1), 0), (day(2025, 1, 1), 1), (day(2025, 1, 1), 3), (day(2025, 2, 1), 0)}
    assert all(r.retention_rate == 100.0 for (c, o), r in got.items() if o == 0)
    assert got[day(2025, 1, 1), 1].avg_days_between_purchases == 1.0
    assert got[day(2025, 1, 1), 3].avg_days_between_purchases == 59.0
    assert got[day(2025, 2, 1), 0].avg_days_between_purchases == 5.0
    assert got[day(2025, 2, 1), 0].repeat_customers_count == 1


def links_of(spark, reads, writes, inner):
    return lineage.edges(
        spark.createDataFrame(reads, "job string, source string"), spark.createDataFrame(writes, "job string, target string, op string"),
        spark.createDataFrame(inner, "job string, step string, source string"))


def test_lineage_of_handwritten_flows(spark):
    links = links_of(
        spark,
        [("mill", "raw:wheat"), ("mill", "raw:wheat"), ("bakery", "mid:flour"), ("kitchen", "mid:flour")],
        [("mill", "mid:flour", "GRIND"), ("bakery", "top:bread", "BAKE")],
        [("bakery", "dough", "mid:flour"), ("bakery", "loaf", "dough")],
    )
    assert {tuple(r)[:3] for r in links.collect()} == {
        ("raw:wheat", "mill", "FLOWS_TO"), ("mid:flour", "bakery", "FLOWS_TO"), ("mid:flour", "kitchen", "FLOWS_TO"),
        ("mill", "mid:flour", "WRITES_TO"), ("bakery", "top:bread", "WRITES_TO"),
        ("mid:flour", "dough", "FLOWS_TO"), ("dough", "bakery", "FLOWS_TO"), ("dough", "loaf", "FLOWS_TO"), ("loaf", "bakery", "FLOWS_TO")}
    down = {r.node: r.steps for r in lineage.reachable(links, "raw:wheat").collect()}
    assert down == {"mill": 1, "mid:flour": 2, "bakery": 3, "kitchen": 3, "dough": 3, "loaf": 4, "top:bread": 4}
    assert {r.node for r in lineage.reachable(links, "top:bread", upstream=True).collect()} == {"bakery", "mid:flour", "mill", "raw:wheat", "dough", "loaf"}
    assert {tuple(r) for r in lineage.layer_paths(links, "raw:", "mid:", "top:").collect()} == {("raw:wheat", "mill", "mid:flour", "bakery", "top:bread")}
    assert {tuple(r) for r in lineage.hot_datasets(links).collect()} == {("mid:flour", 2)}
    assert {tuple(r) for r in lineage.readers(links, "mid:flour").collect()} == {("bakery", "reads"), ("kitchen", "reads"), ("mill", "writes")}


def test_reach_goes_to_the_end_of_long_chains_and_round_cycles(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(12)]
    cycle = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "c"), ("a", "c")]
    links = spark.createDataFrame(chain + cycle, "src string, dst string")
    assert {r.node: r.steps for r in lineage.reachable(links, "n0").collect()} == {f"n{i}": i for i in range(1, 13)}
    assert {r.node: r.steps for r in lineage.reachable(links, "n12", upstream=True).collect()} == {f"n{i}": 12 - i for i in range(12)}
    assert {r.node: r.steps for r in lineage.reachable(links, "a").collect()} == {"b": 1, "c": 1}
    assert lineage.reachable(links, "nowhere").count() == 0


def test_reach_from_a_hub(spark):
    hub = spark.range(30_000).selectExpr("'hub' as src", "concat('x', id) as dst").unionByName(
        spark.range(30_000).selectExpr("concat('x', id) as src", "'end' as dst"))
    rows = lineage.reachable(hub, "hub").groupBy("steps").count().collect()
    assert {r["steps"]: r["count"] for r in rows} == {1: 30_000, 2: 1}


def test_nonempty_gate(spark):
    full, none, broken = spark.range(3), spark.range(0), lambda: spark.read.parquet("/not/there")
    rows = {r.table_name: (r.row_count, r.status) for r in quality.nonempty(spark, {"a": full, "b": none, "c": broken}).collect()}
    assert rows == {"a": (3, "OK"), "b": (0, "EMPTY"), "c": (None, "ERROR")}
    quality.require_nonempty(spark, {"a": full})
    with pytest.raises(ValueError, match=r"b \(EMPTY\), c \(ERROR\)"):
        quality.require_nonempty(spark, {"a": full, "b": none, "c": broken})


def test_null_keys_count_rows_with_any_null(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (None, None), (1, 1)], "a int, b int")
    assert {(r.key_column, r.null_keys, r.valid_percentage) for r in quality.null_keys({"t": (df, ["a", "b"])}).collect()} == {
        ("a", 2, 25.0), ("b", 2, 25.0)}


def test_planted_pairs_are_strong_at_default_thresholds(spark):
    bought = [(o, i) for o in range(8) for i in (1, 2)] + [(o, 10 + o) for o in range(30)] + [(20, 1), (21, 3), (22, 3)]
    held = spark.createDataFrame([(o, i, Decimal("10.00")) for o, i in bought], "transaction_id int, item int, total_amount decimal(12,2)")
    rules = baskets.association_rules(held, spark.range(30))
    strong = {(r.item_a, r.item_b): (r.lift, r.confidence_a_to_b, r.support, r.conviction) for r in rules.filter("is_strong_association").collect()}
    assert strong == {(1, 2): (8 * 30 / (9 * 8), 8 / 9, 8 / 30, (1 - 8 / 30) / (1 - 8 / 9))}
    assert [(r.item_a, r.item_b) for r in baskets.top_associations(rules).collect()] == [(1, 2)]


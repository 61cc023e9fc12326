"""What the product mart shuffles: pairs in one direction, and no line again for the size of its order."""

from __future__ import annotations

from shelfmark.operators.partners import top_partners
from shelfmark.registry import merchandise

FOLDER = "/root/testdata/sf0.001"


def test_pairs_of_small_orders_are_counted_in_one_direction(spark):
    found = top_partners(spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 2), (2, 3)], "transaction_id int, item int"), 2)
    assert "(a#" in (plan := found._jdf.queryExecution().optimizedPlan().toString()) and " < b#" in plan
    assert sorted(map(tuple, found.collect())) == [(1, 1, 2, 1), (1, 2, 3, 1), (2, 1, 3, 2), (2, 2, 1, 1), (3, 1, 2, 2), (3, 2, 1, 1)]


def test_size_of_an_order_comes_with_its_lines(spark):
    sold = merchandise.sold(spark, FOLDER)
    lines = {}
    for row in sold.select("transaction_id", "size").collect():
        lines.setdefault(row.transaction_id, []).append(row.size)
    assert lines and all(set(sizes) == {len(sizes)} for sizes in lines.values())

"""Running sums, group totals, dense ranks and id sets with a third of all rows in one group."""

from __future__ import annotations

import random
from collections import defaultdict
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import idsets
from shelfmark.operators.ranking import with_dense_ranks
from shelfmark.operators.totals import with_group_totals, with_running_sums


def made(count=3000, seed=1):
    """(id, group or null, sort value with ties, amount or null); group 0 holds a third of all rows."""
    rng = random.Random(seed)
    return [(i, 0 if rng.random() < 0.34 else rng.choice([None, *range(1, 40)]), rng.randrange(50), rng.choice([None, rng.randrange(-5, 100)]))
            for i in range(count)]


def by_group(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    return groups


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(made(), "id int, g int, v int, x int").repartition(7)


def test_running_sums(spark, frame):
    want = {}
    for rows in by_group(made()).values():
        rows.sort(key=lambda r: (r[2], r[0]))
        sums = list(accumulate(r[3] or 0 for r in rows))
        known = list(accumulate(r[3] is not None for r in rows))
        want |= {r[0]: (s if k else None, n) for r, s, k, n in zip(rows, sums, known, range(1, len(rows) + 1))}
    got = with_running_sums(frame, ["g"], [F.col("v").asc(), F.col("id").asc()], {"total": F.col("x"), "n": F.lit(1)})
    assert got.columns == ["id", "g", "v", "x", "total", "n"]
    assert {r["id"]: (r["total"], r["n"]) for r in got.collect()} == want


def test_running_sums_keep_tasks_even(spark):
    hot = spark.range(40_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"))
    summed = with_running_sums(hot, ["g"], [F.col("id").asc()], {"n": F.lit(1)})
    assert summed.groupBy("g").agg(F.max("n").alias("n")).where("g = 0").first()["n"] == 13_334
    plan = summed._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window " in line]
    # Rows are added up within a slice; only the few sums of slices are added up by group.
    assert windows and all("_slice" in line for line in windows)


def test_group_totals(frame):
    want = {g: (sum(r[3] or 0 for r in rows), len(rows)) for g, rows in by_group(made()).items()}
    got = with_group_totals(frame, ["g"], {"total": F.sum("x"), "n": F.count("*")}).collect()
    assert len(got) == 3000 and all((r["total"] or 0, r["n"]) == want[r["g"]] for r in got)


def test_dense_ranks_of_several_groups(frame):
    rows = made()
    places = {g: {v: i for i, v in enumerate(sorted({r[2] for r in of}, reverse=True), 1)} for g, of in by_group(rows).items()}
    xs = {(g, v): {x: i for i, x in enumerate(sorted({r[3] for r in of if r[2] == v}, key=lambda x: (x is None, -(x or 0))), 1)}
          for g, of in by_group(rows).items() for v in {r[2] for r in of}}
    got = with_dense_ranks(frame, ["id"], {"by_v": ("v", "g"), "by_x": ("x", ["g", "v"])}).collect()
    assert {r["id"]: (r["by_v"], r["by_x"]) for r in got} == {r[0]: (places[r[1]][r[2]], xs[r[1], r[2]][r[3]]) for r in rows}


def test_id_sets_unite(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(4), rng.randrange(30), rng.choice([None, -1, -64, -65, 2**40, *range(200)])) for _ in range(4000)]
    df = idsets.with_word(spark.createDataFrame(rows, "g int, day int, who long"), "who")
    daily = df.groupBy("g", "day", idsets.WORD).agg(idsets.collected(F.lit(True)).alias("all"), idsets.collected(F.col("who") % 2 == 0).alias("even"))
    whole = daily.groupBy("g", idsets.WORD).agg(F.bit_or("all").alias("all"), F.bit_or("even").alias("even"))
    got = {r["g"]: (r["n"], r["m"]) for r in whole.groupBy("g").agg(idsets.counted("all").alias("n"), idsets.counted("even").alias("m")).collect()}
    ids = {g: {w for h, _, w in rows if h == g and w is not None} for g in range(4)}
    assert got == {g: (len(s), sum(w % 2 == 0 for w in s)) for g, s in ids.items()}

"""Facts of a statement log, and the lineage queries that hold them."""

from __future__ import annotations

from shelfmark.operators import lineage
from shelfmark.registry import lineage as registry

FOLDER = "/root/testdata/sf0.001"

LOG = [
    ("nightly", "INSERT OVERWRITE TABLE gold.sales WITH lines AS (SELECT max(a) m FROM silver.items WHERE a IN (SELECT a FROM silver.kept)),\n"
                " days AS (SELECT * FROM lines JOIN silver.calendar ON TRUE) SELECT * FROM days JOIN silver.stores ON TRUE"),
    ("nightly", "/* FROM a.comment\n JOIN b.comment */ insert into gold.notes select * from Silver.Talk -- join c.comment"),
    ("weekly", "CREATE OR REPLACE TABLE gold.week USING PARQUET"),
    ("weekly", "create external table if not exists gold.copy location 's3a://x/y' as select * from (select * from gold.week) t"),
    ("view", "CREATE VIEW v AS SELECT 1"),
    ("look", "SELECT count(*) FROM silver.items"),
    ("none", ""),
]


def found(df, *names):
    return {tuple(row) for row in df.select(*names).collect()}


def test_facts_of_statements(spark):
    log = lineage.statements(spark.createDataFrame(LOG, "job string, sql_text string"))
    assert found(lineage.statement_reads(log), "job", "source") == {
        ("nightly", "silver.items"), ("nightly", "silver.kept"), ("nightly", "silver.calendar"), ("nightly", "silver.stores"),
        ("nightly", "silver.talk"), ("weekly", "gold.week"), ("look", "silver.items")}
    assert found(lineage.statement_writes(log), "job", "target", "op") == {
        ("nightly", "gold.sales", "INSERT"), ("nightly", "gold.notes", "INSERT"), ("weekly", "gold.week", "REPLACE"), ("weekly", "gold.copy", "CTAS")}
    assert found(lineage.statement_steps(log), "job", "step", "source", "of_step") == {
        ("nightly", "lines", "silver.items", False), ("nightly", "lines", "silver.kept", False),
        ("nightly", "days", "lines", True), ("nightly", "days", "silver.calendar", False)}
    links = lineage.statement_edges(log)
    assert ("nightly/lines", "nightly/days", "FLOWS_TO") in found(links, "src", "dst", "kind")
    assert found(lineage.readers(links, "gold.week"), "job", "role") == {("weekly", "reads"), ("weekly", "writes")}
    assert {r.node: r.steps for r in lineage.reachable(links, "silver.kept").collect()} == {
        "nightly": 1, "nightly/lines": 1, "nightly/days": 2, "gold.sales": 2, "gold.notes": 2}


def test_sources_hold_those_of_statements(spark):
    rows = found(registry.lineage_sources(spark, FOLDER).filter("job like 'job%' or job like 'bill:%'"), "job", "source")
    assert ("job_0", "bronze.feed_0") in rows and ("job_1", "silver.calendar") in rows and ("bill:1", "order:1") in rows
    assert not {source for _, source in rows} & {"base", "totals", "bronze.ignored"}


def test_steps_hold_those_of_statements(spark):
    rows = found(registry.lineage_ctes(spark, FOLDER).filter("job = 'job_1'"), "step", "source")
    assert {("totals", "base"), ("totals", "silver.calendar")} < rows and {step for step, _ in rows} == {"base", "totals"}


def test_readers_hold_those_of_statements(spark):
    rows = found(registry.lineage_readers(spark, FOLDER), "job", "role")
    assert ("job_1", "reads") in rows and ("job_0", "writes") in rows and any(job.startswith("pack:") for job, _ in rows)

"""What each sink should leave behind, by year and month."""

from __future__ import annotations

MONTHS = """SELECT transaction_year, transaction_month, COUNT(*) AS n, bool_or(total_amount <> 0) AS worth FROM txn GROUP BY ALL"""


def kept(rows_after: str, outcome: str) -> str:
    return f"SELECT transaction_year, transaction_month, n AS rows_before, {rows_after} AS rows_after, {outcome} AS outcome FROM ({MONTHS})"


SAME = kept("n", "'same'")
REPLACED = kept("n", "CASE WHEN transaction_year = 1997 AND worth THEN 'changed' ELSE 'same' END")
ONLY_NEW = kept("CASE WHEN transaction_year = 1997 THEN n END", "CASE WHEN transaction_year = 1997 THEN 'changed' ELSE 'dropped' END")

STATEMENTS = {
    "sink_parquet": SAME,
    "sink_partition_replace": REPLACED,
    "sink_table_overwrite": ONLY_NEW,
    "sink_managed_table": SAME,
    "sink_external_table": SAME,
    "sink_dynamic_insert": REPLACED,
    "sink_insert_with_ctes": REPLACED,
}

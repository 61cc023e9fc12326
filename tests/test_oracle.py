"""Every registered query against its SQL, over whole tables of the smallest data folder."""

from __future__ import annotations

import os

import pytest
from check import compare, oracle_connection

import __spark_entry__ as entry

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, connection, name):
    outcome = compare(spark, connection, name, FOLDER)
    empty_is_right = outcome == "EMPTY" and connection.sql(f"SELECT COUNT(*) FROM ({entry.oracle_sql()[name]})").fetchall() == [(0,)]
    assert outcome.startswith("ok") or empty_is_right, outcome


def test_every_query_has_sql():
    from shelfmark.registry import all_queries

    assert set(all_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()

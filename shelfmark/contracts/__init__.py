"""Declared table schemas of the three layers, and name-based conformance."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Partition columns that exist on disk only.
STORAGE_COLUMNS = {"_ingestion_date": "date", "attribution_month": "date", "order_month": "date"}


@dataclass(frozen=True)
class Contract:
    """Column names and types of one table, its key, and how it is partitioned on disk."""

    name: str
    fields: tuple[tuple[str, str], ...]
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self.fields)

    @property
    def stored_ddl(self) -> str:
        """The schema on disk: declared columns and storage-only partition columns."""
        extra = [f"`{name}` {STORAGE_COLUMNS[name]}" for name in self.partition_by if name not in self.columns]
        return ", ".join([self.ddl, *extra])


def contract(name: str, text: str, key: str, partition_by: str = "") -> Contract:
    """Reads ``column TYPE`` lines."""
    fields = tuple(tuple(line.split(None, 1)) for line in text.strip().splitlines())
    return Contract(name, fields, tuple(key.split()), tuple(partition_by.split()))


# What a checked frame says about a row: the columns whose value does not fit, with the value as text.
REJECTED = "_rejected"
REJECTS = "array<struct<column: string, text: string>>"


def conform(df: DataFrame, target: Contract) -> DataFrame:
    """Select the contract's columns by name and cast them; absent columns become NULL.

    A value that does not fit its type is an error, never a NULL: see ``checked`` for keeping the other rows.
    """
    have = dict(df.dtypes)
    return df.select(*[(F.col(name) if name in have else F.lit(None)).cast(kind).alias(name) for name, kind in target.fields])


def checked(df: DataFrame, target: Contract, times: str | None = None, extra: list[str] | None = None) -> DataFrame:
    """The contract's columns, and in ``_rejected`` every value that does not fit, with its column and its text.

    ``times`` is the format of text that is to become a timestamp. ``extra`` columns are carried as they are.
    """
    have = dict(df.dtypes)
    picked, errors, misfits = [], [], []
    for name, kind in target.fields:
        if name not in have:
            picked.append(F.lit(None).cast(kind).alias(name))
            continue
        value = F.col(name)
        if "<" in kind or have[name] == kind.lower():
            picked.append(value.cast(kind).alias(name))
            continue
        if times and kind == "timestamp" and have[name] == "string":
            typed = F.try_to_timestamp(value, F.lit(times))
        else:
            typed = value.try_cast(kind)
        picked.append(typed.alias(name))
        misfits.append(value.isNotNull() & typed.isNull())
        errors.append(F.when(misfits[-1], F.struct(F.lit(name).alias("column"), value.cast("string").alias("text"))))
    none = F.array().cast(REJECTS)
    # Nearly every row fits: only where a value does not are the reasons put together.
    rejected = F.when(reduce(or_, misfits), F.array_compact(F.array(*errors)).cast(REJECTS)).otherwise(none) if errors else none
    return df.select(*picked, *(extra or []), rejected.alias(REJECTED))


def quarantined(rows: DataFrame, target: Contract) -> DataFrame:
    """One row per value that did not fit: table, key of the row as text, column and text."""
    key = F.concat_ws("|", *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in target.key])
    return rows.filter(F.size(REJECTED) > 0).select(
        F.lit(target.name).alias("table_name"), key.alias("row_key"), F.explode(REJECTED).alias("_r")
    ).select("table_name", "row_key", F.col("_r.column").alias("column_name"), F.col("_r.text").alias("text"))

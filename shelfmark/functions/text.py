"""Codes, JSON lists and free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words in an interaction note that mark an escalation.
ESCALATION_WORDS = ("escalat", "manager", "supervisor", "urgent")

# Spellings of an enabled flag in the subscription feed.
TRUE_WORDS = ("true", "1", "yes")


def code_to_id(code: Column) -> Column:
    """The first digit run of a prefixed code (``CUST10004`` -> 10004); NULL without digits."""
    return F.regexp_extract(code, "[0-9]+", 0).try_cast("bigint")


def location_type(code: Column) -> Column:
    """Tells stores from warehouses, whose numbers overlap once the prefix is gone."""
    return F.when(code.startswith("STR"), "store").when(code.isNotNull(), "warehouse")


def json_strings(text: Column) -> Column:
    """A JSON list of strings as an array; NULL for blank or unreadable text."""
    return F.from_json(F.when(text != "", text), "array<string>")


def truthy(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)).isin(*TRUE_WORDS), F.lit(False))


def normalise_channel(channel: Column) -> Column:
    """Lower-case channel with the two spellings of the shop floor merged."""
    plain = F.lower(F.trim(channel))
    return F.when(plain.isin("store", "in store", "instore"), "in-store").otherwise(plain)


def category_path(*levels: Column) -> Column:
    """``a > b > c`` over the levels that are present; NULL when none is."""
    return F.nullif(F.concat_ws(" > ", *levels), F.lit(""))


def is_escalated(notes: Column) -> Column:
    return F.coalesce(F.lower(notes).rlike("|".join(ESCALATION_WORDS)), F.lit(False))


def has_entries(values: Column) -> Column:
    """True for a non-empty array; NULL and empty arrays are both False."""
    return F.coalesce(F.size(values) > 0, F.lit(False))

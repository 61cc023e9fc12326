"""All oracle statements by query name."""

from __future__ import annotations

from oracle import customers, layers, marketing, merchandise, reports, sinks
from oracle.sql import statement


def all_statements() -> dict[str, str]:
    merged: dict[str, str] = {}
    for module in (layers, customers, merchandise, marketing, reports, sinks):
        merged.update(module.STATEMENTS)
    return {name: statement(text) for name, text in merged.items()}

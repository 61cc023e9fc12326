"""Small text helpers for the oracle statements."""

from __future__ import annotations

import re

from oracle.views import VIEWS


def R(a: str, b: str) -> str:
    """Rounded ratio."""
    return f"ROUND(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 6)"


def P(a: str, b: str) -> str:
    """Rounded percentage."""
    return f"ROUND(CAST({a} AS DOUBLE) * 100 / NULLIF(CAST({b} AS DOUBLE), 0), 6)"


def G(now: str, before: str) -> str:
    """Growth in percent."""
    return P(f"(({now}) - ({before}))", before)


def MEAN(x: str, where: str = "") -> str:
    if where:
        x = f"CASE WHEN {where} THEN {x} END"
    return R(f"SUM({x})", f"COUNT({x})")


def D(x: str, p: int, s: int) -> str:
    """DOUBLE to DECIMAL through six exact digits; a value that does not fit is an error."""
    return f"CAST(CAST({x} AS DECIMAL(26,6)) AS DECIMAL({max(p, 20)},{s}))"


def M(x: str, p: int = 18) -> str:
    return f"CAST({x} AS DECIMAL({p},2))"


def N(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def statement(text: str) -> str:
    """Prefixes the views the text uses, in definition order."""
    needed: set[str] = set()
    todo = [text]
    while todo:
        body = todo.pop()
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", body):
                needed.add(name)
                todo.append(VIEWS[name])
    ctes = [f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed]
    body = text.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body

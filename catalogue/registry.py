"""Where queries and their SQL are collected."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
_BODIES: dict[str, str] = {}

# Named sub-queries of the SQL side. Names begin with `x_`; other SQL uses them like tables.
_PARTS: dict[str, str] = {}


def part(name: str, body: str) -> None:
    """Define a sub-query."""
    if name in _PARTS:
        raise ValueError(f"{name} is defined twice")
    _PARTS[name] = body.strip()


def sql(body: str) -> str:
    """`body` under a WITH clause that holds every sub-query it needs, in order of need."""
    order: list[str] = []

    def need(text: str, inside: tuple[str, ...] = ()) -> None:
        for name in re.findall(r"\bx_\w+", text):
            if name not in order and name not in inside:
                need(_PARTS[name], (*inside, name))
                order.append(name)

    need(body)
    if not order:
        return body.strip()
    recursive = {name for name in order if re.search(rf"\b{name}\b", _PARTS[name])}
    parts = [
        f"{name} AS {'' if name in recursive else 'MATERIALIZED '}(\n{_PARTS[name]}\n)" for name in order
    ]
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)}\n{body.strip()}"


def query(oracle: str | None = None):
    """Register a query under its function name, with the SQL that gives the same rows."""

    def add(fn: QueryFn) -> QueryFn:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            _BODIES[fn.__name__] = oracle
        return fn

    return add


def oracle_sql() -> dict[str, str]:
    return {name: sql(body) for name, body in _BODIES.items()}

"""Registered queries over the given tables, each with its check in plain SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from catalog.fixtures import VIEWS, view_sql


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}

# Named sub-queries of the checks: name -> SQL. They may use views and one another.
PARTS: dict[str, str] = {}


def part(name: str, sql: str) -> None:
    PARTS[name] = sql


def with_parts(body: str) -> str:
    """Put the views and parts a check names, and what those name, in front of it."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z][a-z0-9_]+", text)):
            if word in order or word not in {*VIEWS, *PARTS}:
                continue
            inner = view_sql(word, "duckdb") if word in VIEWS else PARTS[word]
            visit(re.sub(rf"\b{word}\b", "", inner))
            if word not in order:
                order.append(word)

    visit(body)
    if not order:
        return body
    ctes = ",\n".join(
        # Evaluated once each: a part is used by many others.
        f"{n} AS MATERIALIZED ({view_sql(n, 'duckdb') if n in VIEWS else PARTS[n]})" for n in order
    )
    if body.lstrip().startswith("WITH "):
        return f"WITH {ctes},\n{body.lstrip()[5:]}"
    return f"WITH {ctes}\n{body}"


def query(covers: str, sql: str | None = None):
    """Register a function of (spark, folder); its name is the name of the query."""

    def add(fn):
        QUERIES[fn.__name__] = Query(fn.__name__, covers, fn, sql)
        return fn

    return add


def oracle(name: str) -> str | None:
    sql = QUERIES[name].sql
    return None if sql is None else with_parts(sql)

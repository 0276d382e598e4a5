"""Registry of checkable queries: a Spark callable and, where SQL can say it, the same result as SQL text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from voltmart.plans.market_views import SQL_VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = dict(SQL_VIEWS)


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def oracle(body: str) -> str:
    """Prefix ``body`` with the CTEs it names, directly or through another CTE."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in set(re.findall(r"[a-z_0-9]+", text)):
            if word in CTES and word not in needed:
                visit(CTES[word])
                if word not in needed:
                    needed.append(word)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in needed) + "\n" + body


def r(expr: str, digits: int = 6, alias: str | None = None) -> str:
    """SQL text of a value rounded for comparison.

    Sums differ in the last bits between engines, so exact halves are first pushed up by a thousandth of a unit.
    Adding 0.0 turns a negative zero positive.
    """
    return f"(round({expr} + CAST(1e-{digits + 3} AS DOUBLE), {digits}) + 0.0) AS {alias or expr}"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    nudge = F.lit(10.0 ** -(digits + 3))
    return df.withColumns({c: F.round(F.col(c) + nudge, digits) + F.lit(0.0) for c in columns})

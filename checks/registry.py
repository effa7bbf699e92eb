"""Query registry: name -> (Spark callable, SQL text built from named CTEs)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (needs, body.strip())


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for need in CTES[name][0]:
                add(need)
            order.append(name)

    for name in names:
        add(name)
    body = body.strip()
    if not order:
        return body
    head = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    # a body that brings its own WITH continues the list
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def query(name: str, sql: str | None = None, *ctes: str):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_ctes(sql, *ctes)
        return fn
    return wrap


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Round doubles to six places, as the SQL side does."""
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


def joined(col, sep: str = "; "):
    """Array to text for comparison."""
    return F.array_join(col, sep)

"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .standin import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, body: str | None = None, *needs: str):
    """Register a query and, where SQL can say the same, its counterpart."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if body is not None:
            ORACLES[name] = sql(body, *needs)
        return fn

    return register


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Floating sums and means depend on the order of addition; both sides
    are compared at six digits."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})

"""Registry of the driver-table queries: key -> (spark, sf_dir) -> DataFrame, plus DuckDB SQL.

Each query reads whole driver tables (or data Spark derives from them).  The SQL text is the same
statement for DuckDB, over views named like the tables; output columns carry the same aliases.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Decorator: register a query under ``key`` with its oracle SQL (None = rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def rnd(expr: str, k: int = 2) -> str:
    """DuckDB text of Spark's ``round(double, k)``.

    Spark rounds HALF_UP on the decimal text of the double (1.005 -> 1.01); DuckDB's own
    ``round`` on a double scales in binary (1.005 -> 1.0).  Going through DuckDB's text form and
    a DECIMAL wide enough for all 17 significant digits gives Spark's answer.
    """
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,22)), {k}) AS DOUBLE)"


GROSS = "(l_extendedprice + l_tax)"


def settled(expr: str) -> str:
    """DuckDB text of ``settled_sum``: an unrounded sum, rounded once to 6 decimals."""
    return rnd(f"sum({expr})", 6)


def settled_avg(expr: str, k: int = 2) -> str:
    """DuckDB text of ``settled_mean``."""
    return rnd(f"{settled(expr)} / count({expr})", k)


SCORE_CTE = """scored AS (
  SELECT event_id AS review_id, event_id AS order_id,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS score
  FROM events),
valid AS (SELECT * FROM scored WHERE score BETWEEN 1 AND 5)"""

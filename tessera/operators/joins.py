"""Join operators (J1-J7).

A side is hinted for broadcast only where its size is bounded by construction (a list that the caller
holds).  For tables no hint is given and nothing is probed: Catalyst and AQE choose from statistics
and from the bytes that a stage measured, and split skewed keys of a shuffle join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def join_full_outer(dim: DataFrame, facts: DataFrame, on: str | Sequence[str],
                    defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Every key of either side (co-group semantics), with defaults for the missing side.

    Aggregate the fact side *before* calling this so the join is one-row-per-key on that side.
    ``defaults`` maps column -> value used when the column is NULL after the join (e.g. title ''
    for a rating without a movie, count 0 for a movie without ratings); averages stay NULL.
    """
    out = dim.join(facts, on=on, how="full")
    for c, v in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def attach_attributes(fact: DataFrame, dim1: DataFrame, on1: str | Sequence[str],
                      dim2: DataFrame | None = None, on2: str | Sequence[str] | None = None,
                      how: str = "inner") -> DataFrame:
    """Two-hop enrichment: fact ⋈ dim1 (re-keyed) ⋈ dim2.  Catalyst picks each join strategy."""
    out = fact.join(dim1, on=on1, how=how)
    if dim2 is not None:
        out = out.join(dim2, on=on2, how=how)
    return out


def lookup(df: DataFrame, dim: DataFrame, key: str | tuple[str, str], value: str,
           default: str = "Unknown", out: str | None = None) -> DataFrame:
    """Dictionary lookup with a default for misses.

    ``key`` is a column name present on both sides, or ``(left_key, dim_key)``.  A key listed twice
    in the dictionary resolves to its largest value, so the result does not depend on row order.
    """
    left_key, dim_key = (key, key) if isinstance(key, str) else key
    d = dim.groupBy(F.col(dim_key).alias("__lk")).agg(F.max(value).alias("__lv"))
    joined = df.join(d, df[left_key] == d["__lk"], "left")
    return joined.withColumn(out or value, F.coalesce(F.col("__lv"), F.lit(default))) \
        .drop("__lk", "__lv")


def exclude_values(df: DataFrame, col: str, values: DataFrame | Sequence[str],
                   value_col: str | None = None) -> DataFrame:
    """Anti-join: rows of ``df`` whose ``col`` is not among ``values``.

    ``values`` may be a Python list (broadcast, bounded by construction) or a DataFrame.  An anti
    join never multiplies rows, so the right side needs no DISTINCT.
    """
    if isinstance(values, DataFrame):
        vc = value_col or values.columns[0]
        right = values.select(F.col(vc).alias("__ex"))
    else:
        spark = df.sparkSession
        right = F.broadcast(spark.createDataFrame([(v,) for v in dict.fromkeys(values)], "__ex string"))
    return df.join(right, df[col] == right["__ex"], "left_anti")


def bridge_join(items: DataFrame, events: DataFrame, bridge_keys: Sequence[str],
                on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """DISTINCT bridge pairs ⋈ events: an order with k products and r reviews yields k·r rows,
    so every product of the order receives each of the order's events."""
    bridge = items.select(*bridge_keys).distinct()
    return bridge.join(events, on=on, how=how)

"""Conditional and arithmetic column expressions: buckets, first-match CASE chains, safe ratios,
defaults for missing values, rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucketize(c: str | Column, edges: Sequence[float], labels: Sequence[str], closed: str) -> Column:
    """Label a numeric column by ``edges``; ``len(labels) == len(edges) + 1``.

    ``closed='left'``:  x < e0 -> l0, x < e1 -> l1, ... (half-open [lo, hi) buckets)
    ``closed='right'``: x < e0 -> l0, x <= e1 -> l1, ... the first bucket stays ``x < e0``
    and every later edge is inclusive (e.g. ``<18``, ``18..35``, ``36..50``, ``>50``).
    NULL input gives NULL.  No default convention: callers choose.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    if closed not in ("left", "right"):
        raise ValueError("closed must be 'left' or 'right'")
    x = _col(c)
    expr = F.when(x < F.lit(edges[0]), F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:-1]):
        cond = x < F.lit(edge) if closed == "left" else x <= F.lit(edge)
        expr = expr.when(cond, F.lit(label))
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(labels[-1])))


def first_match(cases: Sequence[tuple[Column, str]], default: str) -> Column:
    """CASE WHEN c1 THEN v1 WHEN c2 ... ELSE default; a NULL condition falls through."""
    expr = None
    for cond, value in cases:
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def safe_ratio(num: str | Column, den: str | Column, scale: int = 4) -> Column:
    """num/den rounded when den > 0, else num itself (as double)."""
    n, d = _col(num), _col(den)
    return F.when(d > 0, F.round(n / d, scale)).otherwise(n.cast("double"))


def coalesce_default(c: str | Column, default: str | Column, empty_is_missing: bool = True) -> Column:
    """Default for NULL (and, by default, for the empty string)."""
    x = _col(c)
    if empty_is_missing:
        x = F.nullif(x, F.lit(""))
    return F.coalesce(x, default if isinstance(default, Column) else F.lit(default))


def round_half_up(c: str | Column, scale: int = 2) -> Column:
    """Spark ``round`` is HALF_UP on the value's decimal form (2.675 -> 2.68)."""
    return F.round(_col(c), scale)


def settled_sum(c: str | Column, scale: int = 6) -> Column:
    """Sum of unrounded doubles without the noise of the order of addition.

    Nothing is rounded before the sum; the total is rounded once to ``scale`` decimals, so it does not
    depend on how rows are spread over tasks.  NaN stays NaN.
    """
    return F.round(F.sum(_col(c)), scale)


def settled_mean(c: str | Column, scale: int = 2) -> Column:
    """Mean as :func:`settled_sum` over the count of non-NULL values, rounded to ``scale``."""
    return F.round(settled_sum(c) / F.count(_col(c)), scale)

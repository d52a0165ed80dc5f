"""Projection and filter operators (P1-P9).

Every predicate here is a plain Catalyst expression, so it is pushed into the parquet scan where
the column is a plain column (``PushedFilters`` in ``explain``).  Period filters are written as a
half-open range on the raw timestamp instead of ``year(ts) = y``, because the range is pushed down
and the function call is not.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import nonempty


def project_cast(df: DataFrame, types: Mapping[str, str], keep: Sequence[str] = (),
                 strict: bool = False) -> DataFrame:
    """Select ``keep`` as-is and each ``types`` column cast to its type.

    ``strict=False`` uses ``try_cast`` (malformed -> NULL, as the text sources expect);
    ``strict=True`` fails the job on a bad value (ANSI cast).
    """
    cols = [F.col(c) for c in keep]
    for name, typ in types.items():
        c = F.col(name)
        cols.append((c.cast(typ) if strict else c.try_cast(typ)).alias(name))
    return df.select(*cols)


def filter_eq(df: DataFrame, col: str, value, ignore_case: bool = False) -> DataFrame:
    """Rows where ``col == value`` (optionally case-insensitive)."""
    if ignore_case:
        return df.where(F.upper(F.col(col)) == F.upper(F.lit(value)))
    return df.where(F.col(col) == F.lit(value))


def clean_score(df: DataFrame, col: str, lo: int = 1, hi: int = 5, as_type: str = "int",
                out: str | None = None) -> DataFrame:
    """Keep rows whose ``col`` casts to ``as_type`` and lies in ``[lo, hi]`` (NULL rejected).

    Text such as ``"4.0"`` is read through double first so it counts as 4, like a numeric source;
    a fractional value such as ``"4.7"`` is not a valid score.
    """
    raw = F.col(col)
    if as_type in ("int", "bigint", "long"):
        dbl = raw.try_cast("double")
        num = F.coalesce(raw.try_cast(as_type),
                         F.when(dbl == F.floor(dbl), dbl.try_cast(as_type)))
    else:
        num = raw.try_cast(as_type)
    target = out or col
    return df.withColumn(target, num).where(F.col(target).between(lo, hi))


def filter_nonempty(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where every column is non-NULL and not the empty string."""
    cond = None
    for c in cols:
        p = nonempty(c)
        cond = p if cond is None else cond & p
    return df.where(cond) if cond is not None else df


def split_malformed(df: DataFrame, required: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, rejects): good rows have every ``required`` column castable.

    The good side carries the typed columns; the reject side keeps the raw row.  Both are lazy
    views of one scan; nothing is collected.
    """
    typed = df
    ok = None
    for name, typ in required.items():
        tmp = f"__typed_{name}"
        typed = typed.withColumn(tmp, F.col(name).try_cast(typ))
        cond = F.col(tmp).isNotNull()
        ok = cond if ok is None else ok & cond
    good = typed.where(ok)
    for name in required:
        good = good.withColumn(name, F.col(f"__typed_{name}")).drop(f"__typed_{name}")
    rejects = typed.where(~ok).drop(*[f"__typed_{n}" for n in required])
    return good, rejects


def having(df: DataFrame, col: str, min_value, strict: bool = False) -> DataFrame:
    """Post-aggregation threshold: ``col > min_value`` (strict) or ``col >= min_value``."""
    c = F.col(col)
    return df.where(c > F.lit(min_value) if strict else c >= F.lit(min_value))


def filter_period(df: DataFrame, ts: str, start, end) -> DataFrame:
    """``start <= ts < end`` on the raw column, so parquet min/max pruning applies."""
    return df.where((F.col(ts) >= _ts_lit(start)) & (F.col(ts) < _ts_lit(end)))


def filter_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    """Rows of one calendar year, as a pushed-down range."""
    return filter_period(df, ts, _dt.datetime(year, 1, 1), _dt.datetime(year + 1, 1, 1))


def filter_optional(df: DataFrame, col: str, value=None) -> DataFrame:
    """Equality filter applied only when ``value`` is given."""
    return df if value is None else df.where(F.col(col) == F.lit(value))


def _ts_lit(v) -> Column:
    # A naive datetime literal compares with TIMESTAMP_NTZ columns without a cast on the column.
    if isinstance(v, _dt.datetime):
        return F.lit(v.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    if isinstance(v, _dt.date):
        return F.lit(v.isoformat()).cast("timestamp_ntz")
    return F.lit(v)

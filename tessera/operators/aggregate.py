"""Aggregation operators (A1-A16).

All of them are ``groupBy().agg()`` with algebraic aggregates, so Spark plans a partial
(map-side) ``HashAggregate`` before the shuffle and a final one after it: a hot key that holds a
third of the rows is pre-reduced in every task and only one partial row per task and key crosses
the network.  COUNT DISTINCT is planned as an aggregate on (key, value) first, which spreads a hot
key over many shuffle partitions before the per-key count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import nonempty

AGG_FUNCS = {
    "sum": F.sum,
    "avg": F.avg,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "count_distinct": F.count_distinct,
    "approx_count_distinct": F.approx_count_distinct,
}


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def mean_count(df: DataFrame, keys: str | Sequence[str], value: str,
               mean_name: str = "mean", count_name: str = "count") -> DataFrame:
    """Mean and number of non-NULL values per key (sum/count pairs, partially aggregated)."""
    return df.groupBy(*_keys(keys)).agg(F.avg(value).alias(mean_name),
                                        F.count(value).alias(count_name))


def count_by(df: DataFrame, keys: str | Sequence[str], id_col: str | None = None,
             name: str = "count") -> DataFrame:
    """Rows per key.  With ``id_col`` only rows whose id is non-NULL count (bag COUNT semantics)."""
    measure = F.count(id_col) if id_col else F.count(F.lit(1))
    return df.groupBy(*_keys(keys)).agg(measure.alias(name))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Row DISTINCT over a projection."""
    return (df.select(*cols) if cols else df).distinct()


def count_distinct_by(df: DataFrame, keys: str | Sequence[str], col: str, name: str = "n_distinct",
                      approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """COUNT(DISTINCT col) per key (NULL ignored); ``approx`` switches to HyperLogLog++."""
    agg = F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)
    return df.groupBy(*_keys(keys)).agg(agg.alias(name))


def distinct_sketches(df: DataFrame, keys: str | Sequence[str], col: str, lg_k: int = 12,
                      name: str = "sketch") -> DataFrame:
    """A mergeable sketch of the distinct values of ``col`` per key (NULL ignored; 2**lg_k registers)."""
    return df.groupBy(*_keys(keys)).agg(F.hll_sketch_agg(col, lg_k).alias(name))


def merge_sketches(sketches: DataFrame, keys: str | Sequence[str], name: str = "sketch") -> DataFrame:
    """Sketches of parts (batches, files, finer keys) united per key."""
    return sketches.groupBy(*_keys(keys)).agg(F.hll_union_agg(name).alias(name))


def distinct_estimates(sketches: DataFrame, keys: str | Sequence[str], out: str = "n_distinct",
                       name: str = "sketch") -> DataFrame:
    """About the number of distinct values per key of all parts together: standard error
    ``1.04 / sqrt(2**lg_k)``."""
    united = merge_sketches(sketches, keys, name)
    return united.select(*_keys(keys), F.hll_sketch_estimate(name).alias(out))


def metric_table(metrics: Mapping[str, tuple[DataFrame, str]], count_null: bool = True,
                 name_col: str = "metric", value_col: str = "value") -> DataFrame:
    """Distinct-value counts as a (name, value) table, one aggregation per metric, no driver counts.

    ``count_null=True`` counts NULL as one more distinct value, like ``select(c).distinct().count()``.
    """
    parts = []
    for metric, (df, col) in metrics.items():
        n = F.count_distinct(col)
        if count_null:
            n = n + F.coalesce(F.max(F.col(col).isNull().cast("long")), F.lit(0))
        parts.append(df.agg(F.lit(metric).alias(name_col), n.cast("long").alias(value_col)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def global_agg(df: DataFrame, aggs: Mapping[str, Column]) -> DataFrame:
    """Aggregate without a key: one row."""
    return df.agg(*[c.alias(name) for name, c in aggs.items()])


def measures(df: DataFrame, keys: str | Sequence[str], spec: Mapping[str, tuple[str, str]],
             scale: int | None = 2) -> DataFrame:
    """Several named measures per key: ``{alias: (fn, column)}``; fn in :data:`AGG_FUNCS`.

    Sums, averages, minima and maxima are rounded to ``scale`` (HALF_UP); counts are not.
    """
    exprs = []
    for alias, (fn, col) in spec.items():
        e = AGG_FUNCS[fn](col)
        if scale is not None and fn in ("sum", "avg", "mean", "min", "max"):
            e = F.round(e, scale)
        exprs.append(e.alias(alias))
    return df.groupBy(*_keys(keys)).agg(*exprs)


def pivot_mean(df: DataFrame, row: str | Sequence[str], col: str, values: Mapping[str, str],
               value: str, default: float | None = None) -> DataFrame:
    """Wide mean: one row per ``row`` key, one column per listed pivot value.

    ``values`` maps pivot value -> output column name.  Values not listed are ignored; a missing
    cell is ``default`` (``None`` keeps NULL, e.g. to print "NA" later).  The explicit value list
    avoids the extra job that discovers pivot values.
    """
    wide = df.groupBy(*_keys(row)).pivot(col, list(values)).agg(F.avg(value))
    for v, out in values.items():
        c = F.col(f"`{v}`")
        wide = wide.withColumn(out, F.coalesce(c, F.lit(default)) if default is not None else c)
        if out != v:
            wide = wide.drop(v)
    return wide


def explode_labels(df: DataFrame, labels_col: str, sep: str = "|", out: str = "label") -> DataFrame:
    """One row per non-empty label of a delimited multi-value column (``Drama||War`` -> 2 rows).

    A NULL label column (a line without that field) yields no rows, like an empty list.
    """
    import re
    arr = F.split(F.col(labels_col), re.escape(sep))
    exploded = df.withColumn(out, F.explode(arr))
    return exploded.where(nonempty(F.trim(F.col(out)))).withColumn(out, F.trim(F.col(out)))


def sum_count(df: DataFrame, keys: str | Sequence[str], value: str) -> DataFrame:
    """``__sum, __n`` of a value per key: the partial form of a mean, to be merged by ``merged_mean``."""
    return df.groupBy(*_keys(keys)).agg(F.sum(value).alias("__sum"), F.count(value).alias("__n"))


def merged_mean(parts: DataFrame, keys: str | Sequence[str], mean_name: str = "mean",
                count_name: str = "count") -> DataFrame:
    """Mean and count per key from rows of partial ``__sum, __n``."""
    total, n = F.sum("__sum"), F.sum("__n")
    return parts.groupBy(*_keys(keys)).agg(
        F.when(n > 0, total / n).alias(mean_name), n.alias(count_name))


def multilabel_mean(df: DataFrame, labels_col: str, value: str, sep: str = "|",
                    label: str = "label", mean_name: str = "mean", count_name: str = "count") -> DataFrame:
    """Mean per label where each row counts once for every label it carries.

    Rows are reduced per distinct label list before the lists are exploded.
    """
    parts = sum_count(df, labels_col, value)
    return merged_mean(explode_labels(parts, labels_col, sep, label), label, mean_name, count_name)


def two_level(df: DataFrame, inner_keys: Sequence[str], inner: Mapping[str, Column],
              outer_keys: Sequence[str], outer: Mapping[str, Column]) -> DataFrame:
    """Aggregate by ``inner_keys``, then aggregate that result by ``outer_keys``."""
    first = df.groupBy(*inner_keys).agg(*[c.alias(n) for n, c in inner.items()])
    return first.groupBy(*outer_keys).agg(*[c.alias(n) for n, c in outer.items()])


def score_histogram(df: DataFrame, score: str, id_col: str | None = None,
                    name: str = "count") -> DataFrame:
    """Count per score value (rows with a non-NULL id when ``id_col`` is given)."""
    return count_by(df, score, id_col, name)


def word_frequency(tokens: DataFrame, word: str = "word", keys: Sequence[str] = (),
                   name: str = "freq") -> DataFrame:
    """Occurrences per word (optionally per extra keys)."""
    return tokens.groupBy(*keys, word).agg(F.count(F.lit(1)).alias(name))

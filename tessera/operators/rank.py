"""Ranking, top-k and first-per-group operators (W1-W7, T4 batch form).

* ``top_n_per_group`` uses ``row_number() <= n`` so Spark plans ``WindowGroupLimit``: a partial
  per-task top-n runs *before* the shuffle, so a group holding a third of all rows ships at most n
  rows per task.
* ``top_n`` / ``latest_n`` use ``orderBy().limit()`` -> ``TakeOrderedAndProject`` (per-task top-n,
  then a merge of n rows per task).
* ``global_rank`` numbers all rows 1..N without a single-partition window: range-partition on the
  sort keys, sort inside partitions, cut lineage with ``checkpoint()`` (so partition ids and row
  positions are frozen), count rows per partition (a tiny table, broadcast), and add the offset.
* ``first_per_bucket`` finds the winner of each group with ``min(struct(order))``: an algebraic
  aggregate with map-side combine, so hot groups never gather in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir


def _cols(cs) -> list[Column]:
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def top_n_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column] | Column,
                    n: int, rank_col: str | None = None) -> DataFrame:
    """Top ``n`` rows of each group by ``order`` (add a unique tie-break to ``order``)."""
    w = Window.partitionBy(*_cols(group)).orderBy(*_cols(order))
    ranked = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n)
    if rank_col:
        return ranked.withColumnRenamed("__rn", rank_col)
    return ranked.drop("__rn")


def top_n(df: DataFrame, order: Sequence[Column] | Column, n: int = 1) -> DataFrame:
    """Global top ``n`` by ``order``."""
    return df.orderBy(*_cols(order)).limit(n)


def argmax(df: DataFrame, key: str, value: str, support: str, min_support: int,
           n: int = 1) -> DataFrame:
    """Best ``value`` among keys with ``support >= min_support``; ties broken by ``key``."""
    return df.where(F.col(support) >= min_support) \
        .orderBy(F.col(value).desc_nulls_last(), F.col(key).asc()).limit(n)


def latest_n(df: DataFrame, order: Sequence[Column] | Column, n: int) -> DataFrame:
    """Latest ``n`` rows (``order`` should be descending, with a unique tie-break)."""
    return top_n(df, order, n)


def latest_n_by_key(df: DataFrame, key: str, order: Sequence[Column] | Column, n: int,
                    value=None) -> DataFrame:
    """Latest ``n`` rows for one key value, or for every key when ``value`` is None."""
    if value is not None:
        return latest_n(df.where(F.col(key) == F.lit(value)), order, n)
    return top_n_per_group(df, key, order, n)


def global_rank(df: DataFrame, order: Sequence[Column] | Column, name: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Dense positions 1..N over a total order, computed in parallel.

    ``order`` must end in a unique key so the order is total (then the result equals a
    single-partition ``row_number``).  Lineage is cut with a reliable ``checkpoint()`` into the
    shared checkpoint folder, so a lost executor cannot renumber rows between the two passes.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order_cols = _cols(order)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per range partition: bounded by ``n``, safe to broadcast.
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return (ranged.join(F.broadcast(offsets), "__pid")
            .withColumn(name, (F.col("__off") + local + F.lit(1)).cast("long"))
            .drop("__pid", "__mid", "__off"))


def first_per_bucket(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column],
                     flag: str = "is_first", winners_only: bool = False) -> DataFrame:
    """First row of each group by ``order`` (which must end in a unique id).

    ``winners_only=True`` returns one row per group.  Otherwise every row is returned with a
    boolean ``flag`` marking the winner: the per-group minimum is a partial-aggregated
    ``groupBy`` and is joined back on the group keys (AQE splits a skewed key on the big side).
    """
    key_cols = _cols(keys)
    key_names = [f"__k{i}" for i in range(len(key_cols))]
    order_struct = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_cols(order))])
    keyed = df.select("*", *[c.alias(n) for c, n in zip(key_cols, key_names)],
                      order_struct.alias("__ord"))
    if winners_only:
        best = keyed.groupBy(*key_names).agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]),
                                                      F.col("__ord")).alias("__w"))
        return best.select("__w.*")
    best = keyed.groupBy(*key_names).agg(F.min("__ord").alias("__best"))
    best = best.select(*[F.col(k).alias(f"{k}_b") for k in key_names], "__best")
    # NULL is a group of its own (as in groupBy), so the join back is null-safe.
    cond = [keyed[k].eqNullSafe(best[f"{k}_b"]) for k in key_names]
    out = keyed.join(best, cond, "left")
    return out.withColumn(flag, F.coalesce(F.col("__ord") == F.col("__best"), F.lit(False))) \
        .drop("__ord", "__best", *key_names, *[f"{k}_b" for k in key_names])


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str,
                      percentiles: Mapping[str, float]) -> DataFrame:
    """Exact percentiles of a numeric column per key (linear between neighbours, NULLs left out):
    ``{name: p}``.

    Rows are range-partitioned by key and value, so a key of any size spreads over partitions.  A row's
    place within its key follows from its place in the partition and the counts of the partitions
    before; only the rows at the wanted places reach the final aggregation.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"__k{i}" for i in range(len(keys))]
    ranged = (df.where(F.col(value).isNotNull())
              .select(*[F.col(k).alias(a) for k, a in zip(keys, names)], F.col(value).alias("__v"))
              .repartitionByRange(n, *names, "__v").sortWithinPartitions(*names, "__v")
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    runs = ranged.groupBy("__pid", *names).agg(F.count(F.lit(1)).alias("__n"),
                                               F.min("__mid").alias("__start"))
    by_key = Window.partitionBy(*names) if names else Window.partitionBy(F.lit(0))
    before = by_key.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # One row per key and partition that holds it.
    placed = runs.select("__pid", "__start", *names, F.sum("__n").over(by_key).alias("__size"),
                         F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    right = placed.select(F.col("__pid").alias("__p"), "__start", "__size", "__off",
                          *[F.col(a).alias(f"{a}_r") for a in names])
    same = ranged["__pid"] == right["__p"]
    for a in names:
        same = same & ranged[a].eqNullSafe(right[f"{a}_r"])
    at = F.col("__off") + F.col("__mid") - F.col("__start")
    wanted = {m: F.lit(float(p)) * (F.col("__size") - 1) for m, p in percentiles.items()}
    rows = ranged.join(right, same).withColumn("__at", at).where(F.greatest(*[
        ((F.col("__at") == F.floor(w)) | (F.col("__at") == F.ceil(w))) for w in wanted.values()],
        F.lit(False)))
    low = {m: F.max(F.when(F.col("__at") == F.floor(w), F.col("__v"))) for m, w in wanted.items()}
    high = {m: F.max(F.when(F.col("__at") == F.ceil(w), F.col("__v"))) for m, w in wanted.items()}
    left = {m: F.max(F.ceil(w) - w) for m, w in wanted.items()}
    part = {m: F.max(w - F.floor(w)) for m, w in wanted.items()}
    return rows.groupBy(*names).agg(*[
        F.when(part[m] == 0, low[m].cast("double")).otherwise(left[m] * low[m] + part[m] * high[m])
        .alias(m) for m in wanted]).select(
        *[F.col(a).alias(k) for a, k in zip(names, keys)], *wanted)

"""Table-set sources: a named catalogue of DataFrames and UNION ALL of same-schema inputs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_tables(spark: SparkSession, base: str, names: Iterable[str], fmt: str = "parquet",
                options: Mapping[str, str] | None = None,
                schemas: Mapping[str, object] | None = None) -> dict[str, DataFrame]:
    """``{name: DataFrame}`` for ``base/name.<fmt>`` (lazy; explicit schemas skip inference)."""
    out = {}
    for name in names:
        reader = spark.read.format(fmt).options(**(options or {}))
        if schemas and name in schemas:
            reader = reader.schema(schemas[name])
        suffix = "parquet" if fmt == "parquet" else fmt
        out[name] = reader.load(f"{base.rstrip('/')}/{name}.{suffix}")
    return out


def union_sources(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name (duplicates kept); a narrow operation, no shuffle."""
    if not dfs:
        raise ValueError("need at least one input")
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=allow_missing)
    return out


def column_catalog(name: str, df: DataFrame) -> DataFrame:
    """``table_name, ordinal, column_name, type, nullable, n_values`` (non-NULL values) of every column,
    from one aggregation."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    cells = [F.struct(F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"),
                      F.lit(f.dataType.simpleString()).alias("type"), F.lit(f.nullable).alias("nullable"),
                      F.col(f"n{i}").alias("n_values")) for i, f in enumerate(df.schema.fields)]
    return counts.select(F.lit(name).alias("table_name"),
                         F.explode(F.array(*cells)).alias("x")).select("table_name", "x.*")

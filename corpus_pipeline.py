"""Pipeline over ``documents``: quality rules, one document of each group of similar texts, benchmark
decontamination, mixing of sources, token ids.

Each stage takes ``(spark, docs, sf_dir)``; :func:`run` writes its result as Parquet in the shared
folder and reads it again for the next one.  All but the last return the columns of ``documents``.
SQL cannot express the stages (hash buckets, min-hash trees, alignment), so the tests hold the result
against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontam, jaccard, mix, rules
from tessera.llm.queries import table, token_digests, trusted_ids
from tessera.llm.words import fresh
from tessera.session import ensure_checkpoint_dir, scratch_dir, ship_package


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    _ready(spark)
    name = fresh(docs, "quality")
    judged = rules.judge(docs, trusted_ids(spark, sf_dir), name=name)
    return judged.where(f"{name}.kept").select(docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    _ready(spark)
    return jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    _ready(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in as many copies as the mix takes."""
    _ready(spark)
    return mix.emit_copies(mix.mix_sources(docs)).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written to the block file, digested as read back."""
    _ready(spark)
    return token_digests(docs)


STAGES = [("quality_rules", quality_rules), ("jaccard_join", jaccard_join),
          ("decontaminate", decontaminate), ("mix_sources", mix_sources), ("token_ids", token_ids)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)

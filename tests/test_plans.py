"""Physical-plan properties that matter at scale: pushdown, pruning, broadcast only where bounded,
partial top-n before the shuffle, no single-partition rank, no Python in the batch queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.operators.joins import lookup
from tessera.plans.registry import QUERIES as BASE_QUERIES
from tessera.operators.rank import global_rank, top_n_per_group

from .conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonMapInArrow")
# Queries that write files first (sources/sinks) or run a stream are planned elsewhere.
SKIP = {k for k in QUERIES if k.startswith(("src_", "sink_", "stream_"))} | {
    "dead_letter", "upsert_by_key", "score_frames", "frame_pipeline", "running_stats", "global_rank",
    "seller_ranking", "table_profile", "schema_catalog", "camera_stats_stream", "running_stats_stream", "score_frames_batched"}
BASE = set(BASE_QUERIES) & set(ORACLE)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_pushes_year_range_and_prunes_columns(spark):
    plan = plan_of(E.entry(spark))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    for unused in ("l_shipdate", "l_returnflag", "l_quantity", "o_totalprice", "p_brand"):
        assert unused not in plan


def test_lookup_broadcasts_bounded_dictionary(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("k"))
    dim = spark.range(5).select(F.col("id").alias("k2"), F.col("id").cast("string").alias("name"))
    assert "BroadcastHashJoin" in plan_of(lookup(df, dim, ("k", "k2"), "name"))


def test_top_n_per_group_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 5).alias("g"), F.col("id"))
    plan = plan_of(top_n_per_group(df, "g", [F.col("id").desc()], 3))
    assert "WindowGroupLimit" in plan


def test_global_rank_never_sends_rows_to_one_partition(spark):
    df = spark.range(1000).select((F.col("id") * 31 % 97).alias("v"), "id")
    ranked = global_rank(df, [F.col("v"), F.col("id")], "r", num_partitions=4)
    lines = plan_of(ranked).splitlines()
    bcast = [i for i, line in enumerate(lines) if "BroadcastExchange" in line]
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    # The only single-partition step is the per-partition count table under the broadcast.
    assert bcast and all(i > bcast[0] for i in single)
    assert sorted(r.r for r in ranked.collect()) == list(range(1, 1001))


@pytest.mark.parametrize("key", sorted(BASE - SKIP))
def test_batch_queries_stay_in_the_jvm(spark, key):
    plan = plan_of(QUERIES[key](spark, SF_SMALL))
    assert not any(node in plan for node in PYTHON_NODES), key


def test_a_cluster_needs_a_shared_folder():
    from tessera.session import _own_folder

    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            _own_folder(master)


def test_ratings_reduce_before_the_join(spark):
    # Partial sums below the join: an aggregate comes before the dimension's join.
    for key in ("genre_mean", "occupation_mean"):
        plan = plan_of(QUERIES[key](spark, SF_SMALL))
        assert plan.count("partial_sum(rating") == 1, key
        assert plan.index("Join") < plan.index("partial_sum(rating"), key
    plan = plan_of(QUERIES["movie_mean_count"](spark, SF_SMALL))
    assert plan.count("orders.parquet") == 1


def test_anti_join_runs_no_probe(spark):
    plan = plan_of(QUERIES["anti_join"](spark, SF_SMALL))
    assert "Limit" not in plan and "SinglePartition" not in plan

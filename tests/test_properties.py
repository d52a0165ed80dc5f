"""Property tests (hypothesis) for the hand-designed operators."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.aggregate import mean_count
from tessera.operators.joins import join_full_outer
from tessera.operators.rank import global_rank, top_n_per_group
from tessera.sources.tables import union_sources

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
rows_st = st.lists(st.tuples(st.integers(0, 4), st.integers(-50, 50)), min_size=1, max_size=60)


@SETTINGS
@given(rows=rows_st, parts=st.integers(1, 6))
def test_global_rank_is_row_number(spark, rows, parts):
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(rows)], "g int, v int, id int")
    order = [F.col("v").desc(), F.col("g").asc(), F.col("id").asc()]
    want = {r.id: r.rn for r in df.select("id", F.row_number().over(Window.orderBy(*order)).alias("rn")).collect()}
    got = {r.id: r.rk for r in global_rank(df, order, "rk", num_partitions=parts).collect()}
    assert got == want


@SETTINGS
@given(rows=rows_st, n=st.integers(1, 4))
def test_top_n_per_group_bounded_and_dominant(spark, rows, n):
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(rows)], "g int, v int, id int")
    top = top_n_per_group(df, "g", [F.col("v").desc(), F.col("id").asc()], n).collect()
    by_group = {}
    for g, v, i in [(g, v, i) for i, (g, v) in enumerate(rows)]:
        by_group.setdefault(g, []).append((-v, i))
    for g, items in by_group.items():
        want = sorted(items)[:n]
        got = sorted((-r.v, r.id) for r in top if r.g == g)
        assert got == want


@SETTINGS
@given(a=rows_st, b=rows_st)
def test_mean_over_union_is_weighted_mean_of_parts(spark, a, b):
    da = spark.createDataFrame(a, "g int, v int")
    db = spark.createDataFrame(b, "g int, v int")
    whole = {r.g: (r.mean, r["count"]) for r in mean_count(union_sources(da, db), "g", "v").collect()}
    parts = {}
    for g, v in a + b:
        s, c = parts.get(g, (0, 0))
        parts[g] = (s + v, c + 1)
    assert set(whole) == set(parts)
    for g, (s, c) in parts.items():
        assert whole[g][1] == c and abs(whole[g][0] - s / c) < 1e-9


@SETTINGS
@given(left=st.sets(st.integers(0, 20), max_size=10), right=st.sets(st.integers(0, 20), max_size=10))
def test_full_outer_keeps_every_key(spark, left, right):
    dl = spark.createDataFrame([(k, f"t{k}") for k in left], "k int, title string")
    dr = spark.createDataFrame([(k, 1) for k in right], "k int, n int")
    out = {r.k: (r.title, r.n) for r in join_full_outer(dl, dr, "k", {"title": "", "n": 0}).collect()}
    assert set(out) == left | right
    for k, (title, n) in out.items():
        assert title == (f"t{k}" if k in left else "")
        assert n == (1 if k in right else 0)

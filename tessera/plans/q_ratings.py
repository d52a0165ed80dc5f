"""Driver-table queries for the ratings analytics and the join/aggregate operators they use.

rating = lineitem ⋈ orders (user = o_custkey, movie = l_partkey, rating = l_quantity,
ts = epoch seconds of o_orderdate); movies = part; users = customer (gender = c_mktsegment,
occupation = c_nationkey); occupation names = nation.  Age analytics use p_size as the age and
p_brand as the movie (lineitem ⋈ part).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.time import epoch_year as epoch_year_expr
from tessera.operators.aggregate import mean_count as mean_count_op
from tessera.operators.aggregate import multilabel_mean as multilabel_op
from tessera.operators.aggregate import pivot_mean
from tessera.operators.joins import attach_attributes, join_full_outer as full_outer_op, lookup
from tessera.plans import ratings as R
from tessera.plans import testbed as tb
from tessera.plans.registry import register

RATING_CTE = """rating AS (
  SELECT o_custkey AS "user", l_partkey AS movie, l_quantity AS rating,
         CAST(epoch(o_orderdate) AS BIGINT) AS ts, l_linestatus AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
WIDE_SEGMENTS = {"BUILDING": "building_mean", "MACHINERY": "machinery_mean"}
MIN_SUPPORT_MOVIE = 30
MIN_SUPPORT_USER = 60
AGE_NAMES = ["mean_0_18", "mean_18_35", "mean_35_50", "mean_50_plus"]


def _movies(spark, sf):
    return tb.table(spark, sf, "part").select(
        F.col("p_partkey").alias("movie"), F.col("p_name").alias("title"),
        F.col("p_name").alias("genres"))


def _users(spark, sf):
    return tb.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user"), F.col("c_mktsegment").alias("gender"),
        F.col("c_nationkey").alias("occupation"))


def _brand_sizes(spark, sf):
    part = tb.table(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("movie"),
        F.col("p_type").alias("kind"), F.col("p_size").alias("age"))
    li = tb.table(spark, sf, "lineitem").select("l_partkey", F.col("l_quantity").alias("rating"))
    return li.join(part, "l_partkey").drop("l_partkey")


@register("mean_count", f"""
WITH {RATING_CTE}
SELECT movie, avg(rating) AS mean_rating, count(rating) AS n_ratings FROM rating GROUP BY movie""")
def mean_count(spark, sf):
    return mean_count_op(tb.ratings(spark, sf), "movie", "rating", "mean_rating", "n_ratings")


_MOVIE_MEAN_SQL = f"""
WITH {RATING_CTE},
parts AS (SELECT * FROM rating WHERE status = 'O' UNION ALL SELECT * FROM rating WHERE status = 'F'),
stats AS (SELECT movie, avg(rating) AS mean_rating, count(rating) AS n_ratings FROM parts GROUP BY movie)
SELECT coalesce(p_partkey, stats.movie) AS movie, coalesce(p_name, '') AS title, mean_rating,
       coalesce(n_ratings, 0) AS n_ratings
FROM part FULL OUTER JOIN stats ON p_partkey = stats.movie"""


def _movie_stats(spark, sf):
    return R.movie_mean_count([tb.ratings(spark, sf, ("O", "F"))],
                              _movies(spark, sf).select("movie", "title"))


@register("movie_mean_count", _MOVIE_MEAN_SQL)
def movie_mean_count(spark, sf):
    return _movie_stats(spark, sf)


@register("union_all", """
SELECT l_linestatus AS status, count(*) AS n_lines, sum(l_quantity) AS total_qty FROM (
  SELECT l_linestatus, l_quantity FROM lineitem WHERE l_linestatus = 'O'
  UNION ALL
  SELECT l_linestatus, l_quantity FROM lineitem WHERE l_linestatus = 'F') GROUP BY l_linestatus""")
def union_all(spark, sf):
    from tessera.sources.tables import union_sources
    li = tb.table(spark, sf, "lineitem").select(F.col("l_linestatus").alias("status"), "l_quantity")
    u = union_sources(li.where(F.col("status") == "O"), li.where(F.col("status") == "F"))
    return u.groupBy("status").agg(F.count(F.lit(1)).alias("n_lines"),
                                   F.sum("l_quantity").alias("total_qty"))


@register("best_rated_movie", f"""
WITH {RATING_CTE},
stats AS (SELECT movie, avg(rating) AS mean_rating, count(rating) AS n_ratings FROM rating GROUP BY movie)
SELECT movie, p_name AS title, mean_rating, n_ratings FROM stats JOIN part ON movie = p_partkey
WHERE n_ratings >= {MIN_SUPPORT_MOVIE} ORDER BY mean_rating DESC, movie ASC LIMIT 1""")
def best_rated_movie(spark, sf):
    stats = mean_count_op(tb.ratings(spark, sf), "movie", "rating", "mean_rating", "n_ratings") \
        .join(_movies(spark, sf).select("movie", "title"), "movie")
    return R.best_rated_movie(stats, min_support=MIN_SUPPORT_MOVIE)


@register("argmax_min_support", f"""
WITH {RATING_CTE},
stats AS (SELECT "user", avg(rating) AS mean_rating, count(rating) AS n_ratings FROM rating GROUP BY "user")
SELECT "user", mean_rating, n_ratings FROM stats WHERE n_ratings >= {MIN_SUPPORT_USER}
ORDER BY mean_rating DESC, "user" ASC LIMIT 1""")
def argmax_min_support(spark, sf):
    from tessera.operators.rank import argmax
    stats = mean_count_op(tb.ratings(spark, sf), "user", "rating", "mean_rating", "n_ratings")
    return argmax(stats, "user", "mean_rating", "n_ratings", MIN_SUPPORT_USER)


@register("mean_by_composite_key", f"""
WITH {RATING_CTE}
SELECT movie, c_mktsegment AS gender, avg(rating) AS mean_rating, count(rating) AS n_ratings
FROM rating JOIN customer ON "user" = c_custkey GROUP BY movie, c_mktsegment""")
def mean_by_composite_key(spark, sf):
    return R.movie_gender_long(tb.ratings(spark, sf), _users(spark, sf))


@register("movie_gender_long", f"""
WITH {RATING_CTE}
SELECT movie, c_mktsegment AS gender, avg(rating) AS mean_rating, count(rating) AS n_ratings
FROM rating JOIN customer ON "user" = c_custkey GROUP BY movie, c_mktsegment""")
def movie_gender_long(spark, sf):
    return R.movie_gender_long(tb.ratings(spark, sf), _users(spark, sf))


_WIDE_SQL = f"""
WITH {RATING_CTE},
w AS (SELECT movie,
             avg(rating) FILTER (WHERE c_mktsegment = 'BUILDING') AS b,
             avg(rating) FILTER (WHERE c_mktsegment = 'MACHINERY') AS m
      FROM rating JOIN customer ON "user" = c_custkey GROUP BY movie)"""


@register("pivot_mean_zero", f"""
{_WIDE_SQL}
SELECT movie, coalesce(b, 0.0) AS building_mean, coalesce(m, 0.0) AS machinery_mean FROM w""")
def pivot_mean_zero(spark, sf):
    rated = attach_attributes(tb.ratings(spark, sf), _users(spark, sf), "user")
    return pivot_mean(rated, "movie", "gender", WIDE_SEGMENTS, "rating", default=0.0)


@register("movie_gender_wide", f"""
{_WIDE_SQL}
SELECT coalesce(p_partkey, w.movie) AS movie, coalesce(p_name, '') AS title,
       coalesce(b, 0.0) AS building_mean, coalesce(m, 0.0) AS machinery_mean
FROM part FULL OUTER JOIN w ON p_partkey = w.movie""")
def movie_gender_wide(spark, sf):
    return R.movie_gender_wide(tb.ratings(spark, sf), _users(spark, sf), _movies(spark, sf),
                               values=WIDE_SEGMENTS)


def _bucket_sql(closed: str) -> str:
    if closed == "left":
        return ("CASE WHEN p_size IS NULL THEN NULL WHEN p_size < 18 THEN '0-18' WHEN p_size < 35 "
                "THEN '18-35' WHEN p_size < 50 THEN '35-50' ELSE '50+' END")
    return ("CASE WHEN p_size IS NULL THEN NULL WHEN p_size < 18 THEN 'Under 18' WHEN p_size <= 35 "
            "THEN '18-35' WHEN p_size <= 50 THEN '36-50' ELSE '50+' END")


@register("bucketize_left", f"SELECT p_partkey, p_size, {_bucket_sql('left')} AS bucket FROM part")
def bucketize_left(spark, sf):
    return tb.table(spark, sf, "part").select("p_partkey", "p_size",
                                              R.age_bucket("p_size", "left").alias("bucket"))


@register("bucketize_right", f"SELECT p_partkey, p_size, {_bucket_sql('right')} AS bucket FROM part")
def bucketize_right(spark, sf):
    return tb.table(spark, sf, "part").select("p_partkey", "p_size",
                                              R.age_bucket("p_size", "right").alias("bucket"))


def _wide_age_sql(key: str, alias: str) -> str:
    b = _bucket_sql("left")
    cols = ", ".join(f"avg(l_quantity) FILTER (WHERE {b} = '{lab}') AS {name}"
                     for lab, name in zip(R.AGE_LABELS_LEFT, AGE_NAMES))
    return (f"SELECT {key} AS {alias}, {cols} FROM lineitem JOIN part ON l_partkey = p_partkey "
            f"GROUP BY {key}")


@register("movie_age_wide", _wide_age_sql("p_brand", "movie"))
def movie_age_wide(spark, sf):
    return R.movie_age_wide(_brand_sizes(spark, sf), closed="left", names=AGE_NAMES)


@register("pivot_mean_na", _wide_age_sql("p_type", "kind"))
def pivot_mean_na(spark, sf):
    return R.movie_age_wide(_brand_sizes(spark, sf), movie="kind", closed="left", names=AGE_NAMES)


@register("pivot_mean_empty_cells", _wide_age_sql("l_orderkey", "movie"))
def pivot_mean_empty_cells(spark, sf):
    """An order has few lines, so most of its buckets are empty (NULL)."""
    part = tb.table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("age"))
    li = tb.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("movie"), F.col("l_partkey").alias("p_partkey"),
        F.col("l_quantity").alias("rating"))
    return R.movie_age_wide(li.join(part, "p_partkey"), closed="left", names=AGE_NAMES)


@register("movie_age_long", f"""
SELECT p_brand AS movie, {_bucket_sql('right')} AS age_group, avg(l_quantity) AS mean_rating,
       count(l_quantity) AS n_ratings
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def movie_age_long(spark, sf):
    return R.movie_age_long(_brand_sizes(spark, sf), closed="right")


@register("multilabel_mean", """
SELECT label, avg(l_quantity) AS mean, count(l_quantity) AS count FROM (
  SELECT l_quantity, unnest(string_split(p_type || '|' || p_brand, '|')) AS label
  FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE label <> '' GROUP BY label""")
def multilabel_mean(spark, sf):
    part = tb.table(spark, sf, "part").select(
        "p_partkey", F.concat_ws("|", "p_type", "p_brand").alias("labels"))
    li = tb.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity")
    return multilabel_op(li.join(part, "p_partkey"), "labels", "l_quantity", "|")


@register("genre_mean", f"""
WITH {RATING_CTE}
SELECT genre, avg(rating) AS mean_rating, count(rating) AS n_ratings FROM (
  SELECT rating, trim(unnest(string_split(p_name, ' '))) AS genre
  FROM rating JOIN part ON movie = p_partkey) WHERE genre <> '' GROUP BY genre""")
def genre_mean(spark, sf):
    return R.genre_mean(tb.ratings(spark, sf), _movies(spark, sf), sep=" ")


@register("occupation_mean", f"""
WITH {RATING_CTE}
SELECT coalesce(n_name, 'Unknown') AS occupation_name, avg(rating) AS mean_rating,
       count(rating) AS n_ratings
FROM rating JOIN customer ON "user" = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1""")
def occupation_mean(spark, sf):
    occ = tb.table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"),
                                               F.col("n_name").alias("name"))
    return R.occupation_mean(tb.ratings(spark, sf), _users(spark, sf), occ)


@register("occupation_mean_unknown", f"""
WITH {RATING_CTE}
SELECT coalesce(r_name, 'Unknown') AS occupation_name, avg(rating) AS mean_rating,
       count(rating) AS n_ratings
FROM rating JOIN customer ON "user" = c_custkey LEFT JOIN region ON c_nationkey = r_regionkey
GROUP BY 1""")
def occupation_mean_unknown(spark, sf):
    """A dictionary that lacks most ids: they share the default name."""
    occ = tb.table(spark, sf, "region").select(F.col("r_regionkey").alias("id"),
                                               F.col("r_name").alias("name"))
    return R.occupation_mean(tb.ratings(spark, sf), _users(spark, sf), occ)


@register("lookup_unknown", """
SELECT c_custkey, coalesce(r_name, 'Unknown') AS name
FROM customer LEFT JOIN region ON c_nationkey = r_regionkey""")
def lookup_unknown(spark, sf):
    cust = tb.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return lookup(cust, tb.table(spark, sf, "region"), ("c_nationkey", "r_regionkey"), "r_name",
                  out="name").select("c_custkey", "name")


@register("lookup_broadcast", """
SELECT c_custkey, coalesce(n_name, 'Unknown') AS nation_name
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def lookup_broadcast(spark, sf):
    cust = tb.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nat = tb.table(spark, sf, "nation")
    return lookup(cust, nat, ("c_nationkey", "n_nationkey"), "n_name", "Unknown",
                  out="nation_name").select("c_custkey", "nation_name")


@register("year_mean", f"""
WITH {RATING_CTE}
SELECT CAST(year(make_timestamp(ts * 1000000)) AS INTEGER) AS year, avg(rating) AS mean_rating,
       count(rating) AS n_ratings FROM rating GROUP BY 1""")
def year_mean(spark, sf):
    return R.year_mean(tb.ratings(spark, sf))


@register("epoch_year", """
SELECT o_orderkey AS order_id, CAST(year(make_timestamp(CAST(epoch(o_orderdate) AS BIGINT) * 1000000)) AS INTEGER) AS year
FROM orders""")
def epoch_year(spark, sf):
    from tessera.functions.time import epoch_seconds
    od = tb.table(spark, sf, "orders")
    return od.select(F.col("o_orderkey").alias("order_id"),
                     epoch_year_expr(epoch_seconds("o_orderdate")).alias("year"))


# --- plain join shapes --------------------------------------------------------------------------

@register("join_inner", """
SELECT o_orderstatus AS status, count(*) AS n_lines, count(DISTINCT o_orderkey) AS n_orders
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderstatus""")
def join_inner(spark, sf):
    od = tb.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"),
                                              F.col("o_orderstatus").alias("status"))
    li = tb.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"))
    return od.join(li, "k", "inner").groupBy("status").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("k").alias("n_orders"))


@register("join_left", """
SELECT o_orderkey AS order_id, count(l_orderkey) AS n_lines
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def join_left(spark, sf):
    od = tb.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"))
    li = tb.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"),
                                                F.col("l_orderkey").alias("line_order"))
    return od.join(li, "order_id", "left").groupBy("order_id").agg(
        F.count("line_order").alias("n_lines"))


@register("join_full_outer", f"""
WITH agg AS (SELECT l_orderkey AS order_id, count(*) AS n_lines, avg(l_quantity) AS mean_qty
             FROM lineitem GROUP BY l_orderkey)
SELECT coalesce(o_orderkey, agg.order_id) AS order_id, coalesce(o_orderpriority, '') AS priority,
       coalesce(n_lines, 0) AS n_lines, mean_qty
FROM orders FULL OUTER JOIN agg ON o_orderkey = agg.order_id""")
def join_full_outer(spark, sf):
    od = tb.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"),
                                              F.col("o_orderpriority").alias("priority"))
    li = tb.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"), "l_quantity")
    agg = li.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_lines"),
                                     F.avg("l_quantity").alias("mean_qty"))
    return full_outer_op(od, agg, "order_id", defaults={"priority": "", "n_lines": 0})


@register("movie_mean_orphans", """
WITH stats AS (SELECT l_partkey * 3 AS movie, avg(l_quantity) AS mean_rating,
                      count(l_quantity) AS n_ratings FROM lineitem GROUP BY 1)
SELECT coalesce(p_partkey * 2, stats.movie) AS movie, coalesce(p_name, '') AS title, mean_rating,
       coalesce(n_ratings, 0) AS n_ratings
FROM part FULL OUTER JOIN stats ON p_partkey * 2 = stats.movie""")
def movie_mean_orphans(spark, sf):
    """Both orphans: movies without ratings (count 0) and ratings without a movie (empty title)."""
    movies = tb.table(spark, sf, "part").select((F.col("p_partkey") * 2).alias("movie"),
                                                F.col("p_name").alias("title"))
    rated = tb.table(spark, sf, "lineitem").select((F.col("l_partkey") * 3).alias("movie"),
                                                   F.col("l_quantity").alias("rating"))
    return R.movie_mean_count([rated], movies)


@register("join_two_hop", """
SELECT c_mktsegment AS segment, p_type AS category, count(*) AS n_lines, sum(l_quantity) AS total_qty
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def join_two_hop(spark, sf):
    cust = tb.table(spark, sf, "customer").select(F.col("c_custkey").alias("cust"),
                                                  F.col("c_mktsegment").alias("segment"))
    od = tb.table(spark, sf, "orders").select(F.col("o_orderkey").alias("ok"),
                                              F.col("o_custkey").alias("cust"))
    li = tb.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("ok"),
                                                F.col("l_partkey").alias("pk"), "l_quantity")
    part = tb.table(spark, sf, "part").select(F.col("p_partkey").alias("pk"),
                                              F.col("p_type").alias("category"))
    lines = attach_attributes(li, od, "ok", cust, "cust")
    return attach_attributes(lines, part, "pk").groupBy("segment", "category").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("total_qty"))

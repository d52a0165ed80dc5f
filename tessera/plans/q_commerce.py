"""Driver-table queries for the e-commerce analytics (orders / lines / parts / events as reviews)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.logic import safe_ratio
from tessera.functions.time import gap_days as gap_days_expr
from tessera.functions.time import parse_ts as parse_ts_expr
from tessera.functions.time import whole_day_span
from tessera.operators.aggregate import measures, metric_table, two_level
from tessera.operators.filters import clean_score as clean_score_op
from tessera.plans import commerce as C
from tessera.plans import testbed as tb
from tessera.plans.registry import GROSS, SCORE_CTE, register, rnd, settled, settled_avg

YEAR = 1997
# Segment thresholds scaled to the driver tables (1..25 orders per customer, order values ~1e5).
VIP_ORDERS, VIP_VALUE, REPEAT_ORDERS, HIGH_VALUE = 10, 200000.0, 5, 200000.0
TS_FMT_SPARK = "yyyy-MM-dd HH:mm:ss"
TS_FMT_DUCK = "%Y-%m-%d %H:%M:%S"


def _gross() -> F.Column:
    return C.line_revenue("price", "freight")


# --- revenue by category for one year -----------------------------------------------------------

_CATEGORY_REVENUE_SQL = f"""
SELECT p_type AS category,
       {rnd(settled(GROSS))} AS revenue,
       count(DISTINCT l_orderkey) AS n_orders,
       CAST(sum(l_linenumber) AS BIGINT) AS ordinal_sum,
       count(l_linenumber) AS n_lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN part ON l_partkey = p_partkey
WHERE o_orderdate >= TIMESTAMP '{YEAR}-01-01' AND o_orderdate < TIMESTAMP '{YEAR + 1}-01-01'
GROUP BY p_type"""


@register("category_revenue_year", _CATEGORY_REVENUE_SQL)
def category_revenue_year(spark, sf):
    return C.category_revenue_year(tb.order_lines(spark, sf), tb.orders(spark, sf),
                                   tb.products(spark, sf), YEAR)


@register("revenue", f"""
SELECT l_orderkey AS order_id, l_linenumber AS item_ordinal, {GROSS} AS revenue
FROM lineitem""")
def revenue(spark, sf):
    return tb.order_lines(spark, sf).select("order_id", "item_ordinal",
                                            _gross().alias("revenue"))


@register("sum_of_ordinal", """
SELECT p_type AS category, CAST(sum(l_linenumber) AS BIGINT) AS ordinal_sum, count(l_linenumber) AS n_lines
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def sum_of_ordinal(spark, sf):
    lines = tb.order_lines(spark, sf).join(tb.products(spark, sf), "product_id")
    return measures(lines, "category", {"ordinal_sum": ("sum", "item_ordinal"),
                                        "n_lines": ("count", "item_ordinal")}, scale=None) \
        .withColumn("ordinal_sum", F.col("ordinal_sum").cast("long"))


# --- product sales with review scores -----------------------------------------------------------

@register("product_sales_reviews", f"""
WITH {SCORE_CTE},
sold AS (SELECT l_partkey AS product_id, count(l_linenumber) AS units,
                count(DISTINCT l_orderkey) AS n_orders,
                {rnd(settled(GROSS))} AS revenue
         FROM lineitem GROUP BY l_partkey),
pairs AS (SELECT DISTINCT l_orderkey AS order_id, l_partkey AS product_id FROM lineitem),
byp AS (SELECT product_id, {rnd('avg(score)')} AS avg_score, count(score) AS n_reviews
        FROM pairs JOIN valid USING (order_id) GROUP BY product_id)
SELECT sold.product_id AS product_id, units, n_orders, revenue, avg_score, n_reviews, p_type AS category
FROM sold LEFT JOIN byp ON sold.product_id = byp.product_id
LEFT JOIN part ON sold.product_id = p_partkey""")
def product_sales_reviews(spark, sf):
    return C.product_sales_reviews(tb.order_lines(spark, sf), tb.score_events(spark, sf),
                                   tb.products(spark, sf))


@register("multi_measure", f"""
SELECT l_suppkey AS seller_id,
       round(sum(l_quantity), 2) AS sum_qty, {rnd('avg(l_quantity)')} AS avg_qty,
       round(min(l_extendedprice), 2) AS min_price, round(max(l_extendedprice), 2) AS max_price,
       count(l_linenumber) AS n_lines
FROM lineitem GROUP BY l_suppkey""")
def multi_measure(spark, sf):
    li = tb.table(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "seller_id")
    return measures(li, "seller_id", {"sum_qty": ("sum", "l_quantity"), "avg_qty": ("avg", "l_quantity"),
                                      "min_price": ("min", "l_extendedprice"),
                                      "max_price": ("max", "l_extendedprice"),
                                      "n_lines": ("count", "l_linenumber")}, scale=2)


# --- delivery gap (ship date vs order date) -----------------------------------------------------

_GAP = "round(date_diff('second', o_orderdate, l_shipdate) / 86400, 2)"
_DETAIL_CTE = f"""detail AS (
  SELECT l_orderkey AS order_id, l_linenumber AS item_ordinal, l_suppkey AS seller_id,
         {_GAP} AS gap_days,
         CASE WHEN {_GAP} <= 0 THEN '{C.STATUS_ON_TIME}' ELSE '{C.STATUS_LATE}' END AS status
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  WHERE l_shipdate IS NOT NULL AND o_orderdate IS NOT NULL)"""


def _delivery(spark, sf):
    od = tb.orders(spark, sf).select("order_id", F.col("purchase_ts").alias("limit_ts"))
    return C.delivery_gaps(od, tb.order_lines(spark, sf), actual_ts="delivered_ts",
                           limit_ts="limit_ts")


@register("gap_days", f"WITH {_DETAIL_CTE} SELECT order_id, item_ordinal, gap_days FROM detail")
def gap_days(spark, sf):
    od = tb.orders(spark, sf).select("order_id", "purchase_ts")
    return tb.order_lines(spark, sf).join(od, "order_id").select(
        "order_id", "item_ordinal", gap_days_expr("delivered_ts", "purchase_ts", 2).alias("gap_days"))


@register("on_time_flag", f"WITH {_DETAIL_CTE} SELECT order_id, item_ordinal, status FROM detail")
def on_time_flag(spark, sf):
    return _delivery(spark, sf)[0].select("order_id", "item_ordinal", "status")


@register("delivery_gap_detail", f"WITH {_DETAIL_CTE} SELECT * FROM detail")
def delivery_gap_detail(spark, sf):
    return _delivery(spark, sf)[0]


@register("delivery_gap_summary", f"""
WITH {_DETAIL_CTE}
SELECT status, count(order_id) AS n_lines,
       {settled_avg("gap_days")} AS avg_gap,
       round(min(gap_days), 2) AS min_gap, round(max(gap_days), 2) AS max_gap
FROM detail GROUP BY status""")
def delivery_gap_summary(spark, sf):
    return _delivery(spark, sf)[1]


# --- customer segments (two-level aggregation) --------------------------------------------------

_SEG_CTE = f"""ov AS (
  SELECT l_orderkey AS order_id, {rnd(settled(GROSS))} AS order_value
  FROM lineitem GROUP BY l_orderkey),
stats AS (
  SELECT o_custkey AS customer_id, c_nationkey AS country, c_mktsegment AS city,
         count(DISTINCT o_orderkey) AS n_orders,
         {settled_avg('order_value')} AS avg_order_value,
         {rnd(settled('order_value'))} AS total_value,
         min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts
  FROM orders LEFT JOIN ov ON o_orderkey = ov.order_id
  LEFT JOIN customer ON o_custkey = c_custkey
  GROUP BY o_custkey, c_nationkey, c_mktsegment),
seg AS (
  SELECT *, CAST(date_diff('day', CAST(first_ts AS DATE), CAST(last_ts AS DATE)) AS INTEGER) AS span_days
  FROM stats),
segs AS (
  SELECT customer_id, country, city, n_orders, avg_order_value, total_value,
         strftime(first_ts, '{TS_FMT_DUCK}') AS first_purchase,
         strftime(last_ts, '{TS_FMT_DUCK}') AS last_purchase, span_days,
         CASE WHEN span_days > 0 THEN {rnd('n_orders / span_days', 4)}
              ELSE CAST(n_orders AS DOUBLE) END AS frequency,
         CASE WHEN n_orders >= {VIP_ORDERS} AND avg_order_value >= {VIP_VALUE} THEN '{C.SEGMENT_VIP}'
              WHEN n_orders >= {REPEAT_ORDERS} THEN '{C.SEGMENT_REPEAT}'
              WHEN avg_order_value >= {HIGH_VALUE} THEN '{C.SEGMENT_HIGH_VALUE}'
              ELSE '{C.SEGMENT_REGULAR}' END AS segment
  FROM seg)"""


def _segments(spark, sf):
    cust = tb.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("country"),
        F.col("c_mktsegment").alias("city"))
    return C.customer_segments(tb.orders(spark, sf), tb.order_lines(spark, sf), cust,
                               vip_orders=VIP_ORDERS, vip_value=VIP_VALUE,
                               repeat_orders=REPEAT_ORDERS, high_value=HIGH_VALUE)


@register("customer_segments", f"WITH {_SEG_CTE} SELECT * FROM segs")
def customer_segments(spark, sf):
    return _segments(spark, sf) \
        .withColumn("first_purchase", F.date_format("first_purchase", TS_FMT_SPARK)) \
        .withColumn("last_purchase", F.date_format("last_purchase", TS_FMT_SPARK))


@register("segment_summary", f"""
WITH {_SEG_CTE}
SELECT segment, count(customer_id) AS n_customers, {rnd('avg(n_orders)')} AS avg_orders,
       {settled_avg("avg_order_value")} AS avg_value
FROM segs GROUP BY segment""")
def segment_summary(spark, sf):
    return C.segment_summary(_segments(spark, sf))


@register("two_level_agg", f"""
WITH ov AS (SELECT l_orderkey AS order_id, {rnd(settled(GROSS))} AS order_value
            FROM lineitem GROUP BY l_orderkey),
per_cust AS (SELECT o_custkey AS customer_id, count(*) AS n_orders, sum(order_value) AS value
             FROM orders JOIN ov ON o_orderkey = ov.order_id GROUP BY o_custkey)
SELECT n_orders, count(*) AS n_customers, {rnd(settled('value'))} AS total_value
FROM per_cust GROUP BY n_orders""")
def two_level_agg(spark, sf):
    ov = tb.order_lines(spark, sf).groupBy("order_id").agg(
        C.total(_gross()).alias("order_value"))
    joined = tb.orders(spark, sf).select("order_id", "customer_id").join(ov, "order_id")
    return two_level(joined, ["customer_id"],
                     {"n_orders": F.count(F.lit(1)), "value": F.sum("order_value")},
                     ["n_orders"],
                     {"n_customers": F.count(F.lit(1)),
                      "total_value": C.total("value")})


@register("purchase_span_days", """
SELECT o_custkey AS customer_id,
       CAST(date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) AS INTEGER)
         AS span_days
FROM orders GROUP BY o_custkey""")
def purchase_span_days(spark, sf):
    return tb.orders(spark, sf).groupBy("customer_id").agg(
        whole_day_span(F.max("purchase_ts"), F.min("purchase_ts")).alias("span_days"))


@register("purchase_frequency", f"""
WITH s AS (SELECT o_custkey AS customer_id, count(DISTINCT o_orderkey) AS n_orders,
                  date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) AS span
           FROM orders GROUP BY o_custkey)
SELECT customer_id, CASE WHEN span > 0 THEN {rnd('n_orders / span', 4)} ELSE CAST(n_orders AS DOUBLE) END
       AS frequency
FROM s""")
def purchase_frequency(spark, sf):
    s = tb.orders(spark, sf).groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("n_orders"),
        whole_day_span(F.max("purchase_ts"), F.min("purchase_ts")).alias("span"))
    return s.select("customer_id", safe_ratio("n_orders", "span", 4).alias("frequency"))


@register("customer_segment", f"""
WITH {_SEG_CTE} SELECT customer_id, segment FROM segs""")
def customer_segment(spark, sf):
    return _segments(spark, sf).select("customer_id", "segment")


# --- seller ranking -----------------------------------------------------------------------------

_SELLER_SQL = f"""
WITH s AS (
  SELECT l_suppkey AS seller_id, {rnd(settled(GROSS))} AS rev,
         count(DISTINCT l_orderkey) AS n_orders, count(l_linenumber) AS n_items,
         {settled_avg(GROSS)} AS avg_line_revenue
  FROM lineitem GROUP BY l_suppkey)
SELECT seller_id, rev AS revenue, n_orders, n_items, avg_line_revenue,
       row_number() OVER (ORDER BY rev DESC, n_orders DESC, n_items DESC, seller_id ASC) AS seller_rank
FROM s"""


@register("seller_ranking", _SELLER_SQL)
def seller_ranking(spark, sf):
    return C.seller_ranking(tb.order_lines(spark, sf))


@register("global_rank", """
SELECT o_orderkey AS order_id,
       row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey ASC) AS price_rank
FROM orders""")
def global_rank(spark, sf):
    from tessera.operators.rank import global_rank as rank_op
    od = tb.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), "o_totalprice")
    return rank_op(od, [F.col("o_totalprice").desc(), F.col("order_id").asc()], "price_rank") \
        .select("order_id", "price_rank")


# --- orders by country / month, totals, timestamps ----------------------------------------------

@register("orders_by_country", """
SELECT n_name AS country, r_name AS country_code, count(DISTINCT o_orderkey) AS n_orders
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY n_name, r_name""")
def orders_by_country(spark, sf):
    nat = tb.table(spark, sf, "nation").join(
        tb.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    cust = tb.table(spark, sf, "customer").join(
        nat, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("country"),
        F.col("r_name").alias("country_code"))
    return C.orders_by_country(tb.orders(spark, sf), cust)


@register("orders_by_month", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(DISTINCT o_orderkey) AS n_orders
FROM orders GROUP BY 1, 2""")
def orders_by_month(spark, sf):
    return C.orders_by_month(tb.orders(spark, sf))


@register("parse_ts", f"""
SELECT o_orderkey AS order_id,
       CAST(epoch(strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M'), '%Y-%m-%d %H:%M')) AS BIGINT)
         AS purchase_epoch
FROM orders""")
def parse_ts(spark, sf):
    od = tb.orders(spark, sf)
    text = F.date_format("purchase_ts", "yyyy-MM-dd HH:mm")
    return od.select("order_id", F.unix_timestamp(parse_ts_expr(text, "yyyy-MM-dd HH:mm"))
                     .alias("purchase_epoch"))


@register("sort_mixed", """
SELECT o_orderkey AS order_id, o_orderpriority AS priority, o_totalprice AS total_price
FROM orders ORDER BY o_orderpriority ASC, o_totalprice DESC, o_orderkey ASC""")
def sort_mixed(spark, sf):
    od = tb.table(spark, sf, "orders")
    return od.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority"),
                     F.col("o_totalprice").alias("total_price")) \
        .orderBy(F.col("priority").asc_nulls_last(), F.col("total_price").desc_nulls_last(),
                 F.col("order_id").asc())


@register("entity_totals", """
SELECT 'total_orders' AS metric, CAST(count(DISTINCT o_orderkey) + max(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS value FROM orders
UNION ALL
SELECT 'total_customers', CAST(count(DISTINCT c_custkey) + max(CASE WHEN c_custkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM customer
UNION ALL
SELECT 'total_sellers', CAST(count(DISTINCT l_suppkey) + max(CASE WHEN l_suppkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM lineitem""")
def entity_totals(spark, sf):
    cust = tb.table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"))
    return C.entity_totals(tb.orders(spark, sf), cust, tb.order_lines(spark, sf))


@register("metric_table", """
SELECT 'distinct_brands' AS metric, CAST(count(DISTINCT p_brand) + max(CASE WHEN p_brand IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS value FROM part
UNION ALL
SELECT 'distinct_types', CAST(count(DISTINCT p_type) + max(CASE WHEN p_type IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM part
UNION ALL
SELECT 'distinct_ship_days', CAST(count(DISTINCT l_shipdate) + max(CASE WHEN l_shipdate IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM lineitem""")
def metric_table_q(spark, sf):
    part = tb.table(spark, sf, "part")
    li = tb.table(spark, sf, "lineitem")
    return metric_table({"distinct_brands": (part, "p_brand"), "distinct_types": (part, "p_type"),
                         "distinct_ship_days": (li, "l_shipdate")})


# --- review scores ------------------------------------------------------------------------------

@register("clean_score", f"WITH {SCORE_CTE} SELECT review_id, score FROM valid")
def clean_score(spark, sf):
    return clean_score_op(tb.score_events(spark, sf), "score", 1, 5).select("review_id", "score")


@register("score_histogram", f"""
WITH {SCORE_CTE} SELECT score, count(review_id) AS n_reviews FROM valid GROUP BY score""")
def score_histogram(spark, sf):
    return C.review_scores(tb.score_events(spark, sf))[1]


@register("review_score_summary", f"""
WITH {SCORE_CTE} SELECT {rnd('avg(score)')} AS avg_score, count(score) AS n_valid FROM valid""")
def review_score_summary(spark, sf):
    return C.review_scores(tb.score_events(spark, sf))[0]


@register("global_agg", f"""
SELECT count(*) AS n_lines, CAST(sum(l_quantity) AS DOUBLE) AS total_qty,
       {rnd('avg(l_quantity)')} AS avg_qty, {rnd(settled('l_extendedprice'))} AS total_price
FROM lineitem""")
def global_agg(spark, sf):
    from tessera.operators.aggregate import global_agg as agg_op
    li = tb.table(spark, sf, "lineitem")
    return agg_op(li, {"n_lines": F.count(F.lit(1)), "total_qty": F.sum("l_quantity"),
                       "avg_qty": F.round(F.avg("l_quantity"), 2),
                       "total_price": C.total("l_extendedprice")})

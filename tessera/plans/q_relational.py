"""Driver-table queries for filters, projections, DISTINCT, anti/bridge joins, frame endpoints,
detections and payload functions.

frames = events: camera_id = event_type, frame_id = event_id, source_ts = ts,
person_count = k % 5 (k = ``$.k`` of props), processing_ms = value, processed_ts = ts + value
seconds; boxes are generated from (k, value) so every frame carries k % 5 detections.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import detections as D
from tessera.functions.logic import coalesce_default as coalesce_default_expr
from tessera.functions.logic import round_half_up as round_expr
from tessera.functions.time import iso_parse as iso_parse_expr
from tessera.operators.aggregate import count_distinct_by, distinct_rows as distinct_op
from tessera.operators.filters import filter_eq as filter_eq_op
from tessera.operators.filters import filter_nonempty as nonempty_op
from tessera.operators.filters import filter_optional as optional_op
from tessera.operators.filters import filter_year as year_op
from tessera.operators.filters import project_cast as cast_op
from tessera.operators.filters import split_malformed
from tessera.operators.joins import bridge_join as bridge_op
from tessera.operators.joins import exclude_values
from tessera.operators.filters import clean_score as clean_score_op
from tessera.plans import frames as FR
from tessera.plans import testbed as tb
from tessera.plans.registry import SCORE_CTE, register, rnd

TS_FMT_SPARK = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_FMT_DUCK = "%Y-%m-%d %H:%M:%S.%f"
CLASS_NAMES = ("person", "car", "dog")


def frames(spark, sf):
    """Stored-result stand-in built from ``events`` (one row per event)."""
    ev = tb.table(spark, sf, "events").select(
        "event_type", "event_id", "user_id", "ts", "value", "props",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"))
    k, value = F.col("k"), F.col("value")
    n = (k % 5).cast("long")
    processed = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp"))
                                   + F.round(value * 1e6).cast("long"))
    names = F.array(*[F.lit(c) for c in CLASS_NAMES])

    def box(i):
        cls = (k + i) % 3
        x1 = value + i * F.lit(1.2345)
        y1 = value / 2 + i
        return F.struct(x1.alias("x1"), y1.alias("y1"), (x1 + F.lit(10.5555)).alias("x2"),
                        (y1 + F.lit(20.4444)).alias("y2"),
                        (((k + i * 7) % 100) / F.lit(100.0) + F.lit(0.00375)).alias("confidence"),
                        cls.cast("long").alias("class_id"),
                        F.element_at(names, (cls + 1).cast("int")).alias("class_name"))
    boxes = F.when(n > 0, F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), box)) \
        .otherwise(F.array().cast(D.BOXES_TYPE))
    return ev.select(F.col("event_type").alias("camera_id"), F.col("event_id").alias("frame_id"),
                     F.col("user_id"), F.col("ts").cast("timestamp").alias("source_ts"),
                     processed.alias("processed_ts"), n.alias("person_count"),
                     value.alias("processing_ms"), boxes.alias("boxes"), "props")


FRAMES_CTE = """fr AS (
  SELECT event_type AS camera_id, event_id AS frame_id, user_id, ts AS source_ts,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS BIGINT) AS person_count,
         make_timestamp(epoch_us(ts) + CAST(round(value * 1e6) AS BIGINT)) AS processed_ts
  FROM events),
bx AS (
  SELECT frame_id, k, value, i, (k + i) % 3 AS cls,
         value + i * 1.2345::DOUBLE AS x1, value / 2 + i AS y1,
         value + i * 1.2345::DOUBLE + 10.5555::DOUBLE AS x2, value / 2 + i + 20.4444::DOUBLE AS y2,
         ((k + i * 7) % 100) / 100.0::DOUBLE + 0.00375::DOUBLE AS confidence
  FROM (SELECT frame_id, k, value, unnest(range(CAST(person_count AS BIGINT))) AS i FROM fr))"""


# --- projections and filters --------------------------------------------------------------------

@register("project_cast", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       TRY_CAST(user_id AS INTEGER) AS user_id
FROM events""")
def project_cast(spark, sf):
    ev = tb.table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"),
                                              "user_id")
    return cast_op(ev, {"k": "int", "user_id": "int"}, keep=["event_id"])


@register("project_prune", "SELECT o_orderkey AS order_id, o_orderstatus AS status FROM orders")
def project_prune(spark, sf):
    return tb.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"),
                                                F.col("o_orderstatus").alias("status"))


@register("filter_eq", """
SELECT o_orderkey AS order_id, o_totalprice AS total_price FROM orders WHERE o_orderpriority = '1-URGENT'""")
def filter_eq(spark, sf):
    od = tb.table(spark, sf, "orders")
    return filter_eq_op(od, "o_orderpriority", "1-URGENT").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total_price"))


@register("filter_nonempty", """
SELECT doc_id, lang FROM documents WHERE text IS NOT NULL AND text <> '' AND source IS NOT NULL AND source <> ''""")
def filter_nonempty(spark, sf):
    return nonempty_op(tb.table(spark, sf, "documents"), ["text", "source"]).select("doc_id", "lang")


_DAMAGED_SQL = """(
  SELECT l_orderkey, l_partkey,
         CASE WHEN l_returnflag = 'R' THEN '#' || CAST(l_linenumber AS VARCHAR)
              ELSE CAST(l_linenumber AS VARCHAR) END AS ln
  FROM lineitem)"""


def _split_lines(spark, sf):
    li = tb.table(spark, sf, "lineitem")
    damaged = li.select("l_orderkey", "l_partkey", F.when(
        F.col("l_returnflag") == "R", F.concat(F.lit("#"), F.col("l_linenumber").cast("string")))
        .otherwise(F.col("l_linenumber").cast("string")).alias("l_linenumber"))
    return split_malformed(damaged, {"l_linenumber": "int"})


@register("reject_malformed", f"""
SELECT l_orderkey, l_partkey, TRY_CAST(ln AS INTEGER) AS l_linenumber FROM {_DAMAGED_SQL}
WHERE TRY_CAST(ln AS INTEGER) IS NOT NULL""")
def reject_malformed(spark, sf):
    return _split_lines(spark, sf)[0]


@register("malformed_rows", f"""
SELECT l_orderkey, l_partkey, ln AS l_linenumber FROM {_DAMAGED_SQL}
WHERE TRY_CAST(ln AS INTEGER) IS NULL""")
def malformed_rows(spark, sf):
    """The other side of ``reject_malformed``: rows as they came."""
    return _split_lines(spark, sf)[1]


@register("filter_year", f"""
SELECT o_orderkey AS order_id, strftime(o_orderdate, '{TS_FMT_DUCK}') AS order_date FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def filter_year(spark, sf):
    od = year_op(tb.table(spark, sf, "orders"), "o_orderdate", 1997)
    return od.select(F.col("o_orderkey").alias("order_id"),
                     F.date_format("o_orderdate", TS_FMT_SPARK).alias("order_date"))


@register("filter_optional", "SELECT event_id, user_id FROM events WHERE event_type = 'click'")
def filter_optional(spark, sf):
    return optional_op(tb.table(spark, sf, "events"), "event_type", "click").select("event_id", "user_id")


@register("filter_optional_none", "SELECT event_id, user_id FROM events")
def filter_optional_none(spark, sf):
    """Without a value the filter lets every row through."""
    return optional_op(tb.table(spark, sf, "events"), "event_type").select("event_id", "user_id")


@register("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(spark, sf):
    return distinct_op(tb.table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@register("count_distinct_by_key", """
SELECT l_suppkey AS seller_id, count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY 1""")
def count_distinct_by_key(spark, sf):
    li = tb.table(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "seller_id")
    return count_distinct_by(li, "seller_id", "l_orderkey", "n_orders")


@register("anti_join", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def anti_join(spark, sf):
    od = tb.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"),
                                              F.col("o_custkey").alias("customer_id"))
    lines = tb.table(spark, sf, "lineitem").select("l_orderkey")
    return exclude_values(od, "order_id", lines, "l_orderkey")


@register("bridge_join", f"""
WITH {SCORE_CTE}
SELECT p.order_id, p.product_id, v.score FROM
  (SELECT DISTINCT l_orderkey AS order_id, l_partkey AS product_id FROM lineitem) p
  JOIN valid v ON p.order_id = v.order_id""")
def bridge_join(spark, sf):
    valid = clean_score_op(tb.score_events(spark, sf), "score", 1, 5).select("order_id", "score")
    return bridge_op(tb.order_lines(spark, sf), valid, ["order_id", "product_id"], "order_id")


# --- frame endpoints ----------------------------------------------------------------------------

def _fmt(c):
    return F.date_format(c, TS_FMT_SPARK)


@register("latest_n", f"""
WITH {FRAMES_CTE}
SELECT frame_id, camera_id, strftime(processed_ts, '{TS_FMT_DUCK}') AS processed_ts FROM fr
ORDER BY fr.processed_ts DESC, frame_id DESC LIMIT 10""")
def latest_n(spark, sf):
    out = FR.latest_results(frames(spark, sf), 10)
    return out.select("frame_id", "camera_id", _fmt("processed_ts").alias("processed_ts"))


@register("latest_n_by_key", f"""
WITH {FRAMES_CTE}
SELECT frame_id, camera_id, strftime(processed_ts, '{TS_FMT_DUCK}') AS processed_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY camera_id ORDER BY processed_ts DESC, frame_id DESC) AS rn
  FROM fr) WHERE rn <= 5""")
def latest_n_by_key(spark, sf):
    out = FR.latest_results_by_camera(frames(spark, sf), 5)
    return out.select("frame_id", "camera_id", _fmt("processed_ts").alias("processed_ts"))


@register("camera_stats", f"""
WITH {FRAMES_CTE}
SELECT camera_id, count(*) AS total_frames, avg(person_count) AS avg_persons,
       max(person_count) AS max_persons, min(person_count) AS min_persons
FROM fr GROUP BY camera_id""")
def camera_stats(spark, sf):
    return FR.camera_stats(frames(spark, sf))


def _pct(p: float) -> str:
    """Spark's exact ``percentile``: linear interpolation at position (n - 1) * p."""
    pos = f"((n - 1)::DOUBLE * {p}::DOUBLE)"
    lo = f"s[CAST(floor({pos}) AS BIGINT) + 1]::DOUBLE"
    hi = f"s[CAST(ceil({pos}) AS BIGINT) + 1]::DOUBLE"
    return (f"CASE WHEN ceil({pos}) = floor({pos}) THEN {lo} "
            f"ELSE (ceil({pos}) - {pos}) * {lo} + ({pos} - floor({pos})) * {hi} END")


@register("stream_lag", f"""
WITH {FRAMES_CTE},
l AS (SELECT camera_id, epoch_us(processed_ts) - epoch_us(source_ts) AS lag_us FROM fr),
g AS (SELECT camera_id, count(lag_us) AS n, avg(lag_us) AS mean_us, min(lag_us) AS mn, max(lag_us) AS mx,
             list_sort(list(lag_us)) AS s FROM l GROUP BY camera_id)
SELECT camera_id, n, mean_us / 1e6 AS mean_lag_s, mn / 1e6 AS min_lag_s, mx / 1e6 AS max_lag_s,
       ({_pct(0.5)}) / 1e6 AS p50_lag_s, ({_pct(0.95)}) / 1e6 AS p95_lag_s,
       ({_pct(0.99)}) / 1e6 AS p99_lag_s
FROM g""")
def stream_lag(spark, sf):
    return FR.lag_stats(frames(spark, sf), "source_ts", "processed_ts", keys=["camera_id"])


@register("first_per_bucket", """
SELECT event_id AS frame_id, user_id,
       CASE WHEN rn = 1 THEN 'cam' || CAST(user_id AS VARCHAR) || '_' || strftime(date_trunc('hour', ts), '%Y%m%d_%H')
            || '.jpg' END AS image_path
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) AS rn
      FROM events)""")
def first_per_bucket(spark, sf):
    fr = frames(spark, sf)
    out = FR.mark_first_per_second(fr, camera="user_id", ts="source_ts",
                                   order=("source_ts", "frame_id"), unit="hour", fmt="yyyyMMdd_HH",
                                   path_prefix="cam")
    return out.select("frame_id", "user_id", "image_path")


# --- detections ---------------------------------------------------------------------------------

@register("detections_count", f"""
WITH {FRAMES_CTE}
SELECT fr.frame_id, count(bx.i) AS person_count FROM fr LEFT JOIN bx ON fr.frame_id = bx.frame_id
GROUP BY fr.frame_id""")
def detections_count(spark, sf):
    return frames(spark, sf).select("frame_id", D.box_count("boxes").alias("person_count"))


_KEEP = f"cls = {D.PERSON_CLASS_ID} AND confidence >= {D.MIN_CONFIDENCE}"


@register("detections_filter", f"""
WITH {FRAMES_CTE}
SELECT frame_id, CAST(row_number() OVER (PARTITION BY frame_id ORDER BY i) - 1 AS INTEGER) AS pos,
       confidence, CAST(cls AS BIGINT) AS class_id
FROM bx WHERE {_KEEP}""")
def detections_filter(spark, sf):
    kept = frames(spark, sf).select("frame_id", D.keep_boxes("boxes").alias("kept"))
    return kept.select("frame_id", F.posexplode("kept").alias("pos", "b")).select(
        "frame_id", "pos", F.col("b.confidence").alias("confidence"), F.col("b.class_id").alias("class_id"))


@register("detections_round", f"""
WITH {FRAMES_CTE}
SELECT frame_id, CAST(i AS INTEGER) AS pos, {rnd('x1')} AS x1, {rnd('y1')} AS y1, {rnd('x2')} AS x2,
       {rnd('y2')} AS y2, {rnd('confidence', 4)} AS confidence
FROM bx""")
def detections_round(spark, sf):
    r = frames(spark, sf).select("frame_id", D.round_boxes("boxes").alias("boxes"))
    return r.select("frame_id", F.posexplode("boxes").alias("pos", "b")).select(
        "frame_id", "pos", *[F.col(f"b.{c}").alias(c) for c in ("x1", "y1", "x2", "y2", "confidence")])


# --- payload functions --------------------------------------------------------------------------

@register("json_roundtrip", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(to_json(struct_pack(k := TRY_CAST(json_extract_string(props, '$.k') AS INTEGER))) AS VARCHAR) AS payload
FROM events""")
def json_roundtrip(spark, sf):
    parsed = tb.table(spark, sf, "events").select(
        "event_id", D.from_payload("props", "k int").alias("p"))
    return parsed.select("event_id", F.col("p.k").alias("k"), D.to_payload(F.col("p.k").alias("k"))
                         .alias("payload"))


@register("to_json_payload", """
SELECT event_id, CAST(to_json(struct_pack(event_id := event_id, camera_id := event_type, user_id := user_id))
       AS VARCHAR) AS payload FROM events""")
def to_json_payload(spark, sf):
    ev = tb.table(spark, sf, "events")
    return ev.select("event_id", D.to_payload("event_id", F.col("event_type").alias("camera_id"),
                                              "user_id").alias("payload"))


@register("base64_payload", """
SELECT doc_id, to_base64(encode(text)) AS b64,
       decode(from_base64(to_base64(encode(text)))) = text AS roundtrip_ok
FROM documents""")
def base64_payload(spark, sf):
    docs = tb.table(spark, sf, "documents")
    b64 = D.encode_base64(F.encode("text", "UTF-8"))
    return docs.select("doc_id", b64.alias("b64"),
                       (F.decode(D.decode_base64(b64), "UTF-8") == F.col("text")).alias("roundtrip_ok"))


@register("iso_parse", """
SELECT event_id, iso_text,
       coalesce(epoch_us(TRY_CAST(nullif(trim(iso_text), '') AS TIMESTAMPTZ)), epoch_us(ts)) AS parsed_us
FROM (SELECT event_id, ts,
             CASE WHEN event_type = 'error' THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS iso_text
      FROM events)""")
def iso_parse(spark, sf):
    ev = tb.table(spark, sf, "events")
    iso = F.when(F.col("event_type") == "error", F.lit("")) \
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    src = ev.select("event_id", F.col("ts").cast("timestamp").alias("ts"), iso.alias("iso_text"))
    return src.select("event_id", "iso_text",
                      F.unix_micros(iso_parse_expr("iso_text", fallback="ts")).alias("parsed_us"))


@register("coalesce_default", """
SELECT event_id, coalesce(nullif(CASE WHEN event_type = 'error' THEN '' ELSE event_type END, ''), 'unknown')
       AS camera_id FROM events""")
def coalesce_default(spark, sf):
    ev = tb.table(spark, sf, "events")
    cam = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type"))
    return ev.select("event_id", coalesce_default_expr(cam, "unknown").alias("camera_id"))


@register("round_half_up", f"SELECT event_id, {rnd('value', 1)} AS value_1dp FROM events")
def round_half_up(spark, sf):
    ev = tb.table(spark, sf, "events")
    return ev.select("event_id", round_expr("value", 1).alias("value_1dp"))

"""Driver-table queries for stream state that is kept up batch by batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans import testbed as tb
from tessera.plans.q_relational import FRAMES_CTE
from tessera.plans.q_streaming import _scored as scored_frames
from tessera.plans.q_streaming import files_per_batch, result_documents, write_messages
from tessera.plans.registry import ORACLE, register
from tessera.plans.stub_detector import fragile_detector_factory
from tessera.session import scratch_dir
from tessera.streaming import frames as S
from tessera.streaming import rollup as R
from tessera.streaming.first import image_files, mark_first_stream
from tessera.streaming.store import append_batch, read_table, run_to_end, store_results, supervise


def _kept(spark, sf, keys, measures) -> R.Rollup:
    """The rollup of the result documents, fed in three batches and merged after two."""
    each = files_per_batch(spark, 3)
    stream = result_documents(spark, sf, files=3 * each, files_per_trigger=each)
    kept = R.Rollup(spark, scratch_dir(spark, "rollup"), keys, measures, merge_every=2)
    run_to_end(R.keep_rollup(stream, kept, scratch_dir(spark, "ckpt")))
    return kept


@register("camera_stats_stream", f"""
WITH {FRAMES_CTE}
SELECT camera_id, count(*) AS total_frames, avg(person_count) AS avg_persons,
       max(person_count) AS max_persons, min(person_count) AS min_persons
FROM fr GROUP BY camera_id""")
def camera_stats_stream(spark, sf):
    """Per-camera statistics of the stream, from partial rows per batch."""
    return R.camera_stats(_kept(spark, sf, ["camera_id"], R.camera_measures()))


@register("running_stats_stream", ORACLE["running_stats"])
def running_stats_stream(spark, sf):
    """The running counters, from partial rows per batch."""
    return R.running_stats(_kept(spark, sf, [], R.running_measures()))


LAG = "epoch_us(processed_ts) - epoch_us(source_ts)"


@register("stream_lag_sketch", f"""
WITH {FRAMES_CTE}
SELECT camera_id, count({LAG}) AS n, sum({LAG}) / count({LAG}) / 1e6 AS mean_lag_s,
       min({LAG}) / 1e6 AS min_lag_s, max({LAG}) / 1e6 AS max_lag_s,
       true AS p50_within, true AS p95_within, true AS p99_within
FROM fr GROUP BY camera_id""")
def stream_lag_sketch(spark, sf):
    """Lag of every camera from merged sketches, and whether each percentile's rank is within 1 % of the
    rows of the exact one."""
    from tessera.plans.q_relational import frames
    kept = R.lag_stats(_kept(spark, sf, ["camera_id"], R.lag_measures("source_ts", "processed_ts")))
    lag = (F.unix_micros(F.col("processed_ts").cast("timestamp"))
           - F.unix_micros(F.col("source_ts").cast("timestamp"))) / F.lit(1e6)
    rows = frames(spark, sf).select(F.col("camera_id").alias("c"), lag.alias("lag"))
    flags = []
    for p in (0.5, 0.95, 0.99):
        name = f"p{int(p * 100)}"
        below = F.avg((F.col("lag") < F.col(f"{name}_lag_s")).cast("int"))
        upto = F.avg((F.col("lag") <= F.col(f"{name}_lag_s")).cast("int"))
        flags.append(((below <= p + 0.01) & (upto >= p - 0.01)).alias(f"{name}_within"))
    same = ["camera_id", "n", "mean_lag_s", "min_lag_s", "max_lag_s"]
    return rows.join(kept, F.col("c") == F.col("camera_id")).groupBy(*same).agg(*flags)


@register("count_distinct_sketch", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(DISTINCT l_partkey) AS n_exact, true AS within
FROM lineitem GROUP BY year(l_shipdate)""")
def count_distinct_sketch(spark, sf):
    """Distinct parts per shipping year from sketches of the rows of each line status, merged; and whether
    the estimate is within three standard errors (1.04 / sqrt(2**14)) of the exact number."""
    from tessera.operators.aggregate import (count_distinct_by, distinct_estimates, distinct_sketches)
    lines = tb.table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("ship_year"), "l_partkey", "l_linestatus")
    parts = distinct_sketches(lines, ["l_linestatus", "ship_year"], "l_partkey", lg_k=14)
    found = distinct_estimates(parts, ["ship_year"], "n_about")
    exact = count_distinct_by(lines, "ship_year", "l_partkey", "n_exact")
    error = F.abs(F.col("n_about") - F.col("n_exact"))
    return exact.join(found, "ship_year").select(
        "ship_year", "n_exact", (error <= 3 * 1.04 / 2 ** 7 * F.col("n_exact") + 1).alias("within"))


END = "__end"


def _shuffled_frames(spark, sf, batches: int):
    """Stream of frames dealt at random over the files of some batches; a last file holds one frame far ahead in
    time, which closes all buckets."""
    from tessera.plans.q_relational import frames
    path = scratch_dir(spark, "frames")
    rows = frames(spark, sf).select("frame_id", F.col("user_id").cast("string").alias("camera_id"),
                                    F.col("source_ts").cast("timestamp").alias("source_ts"),
                                    F.col("person_count").cast("long").alias("person_count"))
    rows = rows.join(tb.table(spark, sf, "events").select(
        F.col("event_id").alias("frame_id"), F.encode("props", "UTF-8").alias("image_bytes")), "frame_id")
    each = files_per_batch(spark, batches)
    rows.repartition(batches * each, F.xxhash64("frame_id")).write.parquet(path)
    ahead = rows.agg(F.max("source_ts").alias("t")).select(
        F.lit(-1).cast("long").alias("frame_id"), F.lit(END).alias("camera_id"),
        (F.col("t") + F.expr("INTERVAL 10 YEARS")).alias("source_ts"),
        F.lit(0).cast("long").alias("person_count"), F.lit(b"").alias("image_bytes"))
    ahead.select(rows.columns).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", each).parquet(path)


_FIRST_SQL = """
SELECT event_id AS frame_id, CAST(user_id AS VARCHAR) AS camera_id,
  CASE WHEN row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) = 1
       THEN 'images/' || user_id || '_' || strftime(date_trunc('hour', ts), '%Y%m%d_%H') || '.jpg'
  END AS image_path, CAST(strlen(props) AS BIGINT) AS size FROM events"""


def _first_stream(spark, sf):
    return mark_first_stream(_shuffled_frames(spark, sf, 3), unit="hour", delay="2 years", fmt="yyyyMMdd_HH",
                             path_prefix="images/").where(F.col("camera_id") != END)


@register("stream_first_per_bucket", f"""
SELECT frame_id, camera_id, image_path, false AS late,
  CASE WHEN image_path IS NOT NULL THEN size END AS image_length FROM ({_FIRST_SQL})""")
def stream_first_per_bucket(spark, sf):
    """Every frame as the stream passes it on, the first of each camera-hour with its path and image."""
    out = scratch_dir(spark, "first")
    run_to_end(store_results(_first_stream(spark, sf), table_path=out,
                             checkpoint=scratch_dir(spark, "ckpt"), stamp=None))
    return read_table(spark, out).select("frame_id", "camera_id", "image_path", "late",
                                         F.length("image_bytes").cast("long").alias("image_length"))


@register("stream_image_files", f"""
SELECT image_path, size AS length FROM ({_FIRST_SQL}) WHERE image_path IS NOT NULL""")
def stream_image_files(spark, sf):
    """The image files that the stream leaves: path below the image folder and length on disk."""
    out, folder = scratch_dir(spark, "first"), scratch_dir(spark, "image-files")
    run_to_end(store_results(_first_stream(spark, sf), table_path=out, image_folder=folder,
                             checkpoint=scratch_dir(spark, "ckpt"), stamp=None))
    name = F.concat(F.lit("images/"), F.regexp_extract("path", r"([^/]+)$", 1))
    return image_files(spark, folder).select(name.alias("image_path"), "length")


@register("score_frames_batched", f"""
SELECT event_type AS camera_id, event_id AS frame_index,
  CASE WHEN k % 50 = 0 THEN 'detector_failed: ValueError: an image without k' END AS error,
  CASE WHEN k % 50 <> 0 THEN CAST(k % 5 AS INTEGER) END AS n_boxes
FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""")
def score_frames_batched(spark, sf):
    """Frames scored 128 at once by a detector that a poisoned image makes fail: each of these ends alone
    among the dead letters, the others are scored."""
    events = tb.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    frames = events.select(
        F.col("event_type").alias("camera_id"), F.col("event_id").alias("frame_index"),
        F.encode(F.when(k % 50 == 0, F.lit('{"poison": 1}')).otherwise(F.col("props")), "UTF-8")
        .alias("image_bytes"))
    scored = S.score_frames(frames, fragile_detector_factory, "fragile-stub", batch_size=128,
                            keep=("camera_id", "frame_index"))
    return scored.select("camera_id", "frame_index", "error",
                         F.when(F.col("error").isNull(), F.size("boxes")).alias("n_boxes"))


@register("stream_retry", ORACLE["stream_exactly_once"])
def stream_retry(spark, sf):
    """A stream whose sink fails twice, restarted from its checkpoint: every frame is stored once."""
    each = files_per_batch(spark, 3)
    src = write_messages(spark, sf, scratch_dir(spark, "msgs"), files=3 * each)
    table, ckpt = scratch_dir(spark, "table"), scratch_dir(spark, "ckpt")
    left = [2]

    def start():
        def write(batch, batch_id):
            append_batch(batch, batch_id, table)  # fails after the batch is written
            if left[0] and batch_id:
                left[0] -= 1
                raise OSError("the store is away")
        return scored_frames(spark, src, each).writeStream.foreachBatch(write).option(
            "checkpointLocation", ckpt).trigger(availableNow=True).start()
    supervise(start, pause_s=0.1)
    return read_table(spark, table).select("frame_id", "camera_id", "person_count")

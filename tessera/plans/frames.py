"""Frame/detection analytics on stored results (batch side of the camera stream).

A stored result row: camera_id, frame_id, frame_index, source_ts, processed_ts, stored_ts,
person_count, boxes (array<struct>), processing_ms, model, image_path.  The query endpoints
(latest N, latest N per camera, per-camera statistics) and the "first frame per camera-second
keeps its image" policy are DataFrame operators here; the stream module reuses them per batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.rank import (exact_percentiles, first_per_bucket, latest_n,
                                    latest_n_by_key)


def camera_stats(results: DataFrame, *, camera: str = "camera_id", count: str = "person_count",
                 camera_id: str | None = None) -> DataFrame:
    """Frames, mean/max/min person count per camera (optionally for one camera)."""
    src = results if camera_id is None else results.where(F.col(camera) == F.lit(camera_id))
    return src.groupBy(camera).agg(F.count(F.lit(1)).alias("total_frames"),
                                   F.avg(count).alias("avg_persons"),
                                   F.max(count).alias("max_persons"),
                                   F.min(count).alias("min_persons"))


def latest_results(results: DataFrame, n: int, *, ts: str = "processed_ts",
                   tie: str = "frame_id") -> DataFrame:
    """Latest ``n`` stored results overall."""
    return latest_n(results, [F.col(ts).desc(), F.col(tie).desc()], n)


def latest_results_by_camera(results: DataFrame, n: int, *, camera: str = "camera_id",
                             ts: str = "processed_ts", tie: str = "frame_id",
                             camera_id: str | None = None) -> DataFrame:
    """Latest ``n`` results of one camera, or of every camera when ``camera_id`` is None."""
    return latest_n_by_key(results, camera, [F.col(ts).desc(), F.col(tie).desc()], n, camera_id)


def mark_first_per_second(results: DataFrame, *, camera: str = "camera_id", ts: str = "source_ts",
                          order: Sequence[str | Column] = ("source_ts", "frame_id"),
                          unit: str = "second", fmt: str = "yyyyMMdd_HHmmss",
                          path_prefix: str = "", path_col: str = "image_path") -> DataFrame:
    """Keep every row; the first row of each (camera, ``unit``) bucket gets an image path
    ``<prefix><camera>_<bucket>.jpg``, the others NULL.

    The winner is decided on (source time, frame id), so batch and replayed streams agree,
    whatever order the rows arrive in.
    """
    bucket = F.date_trunc(unit, F.col(ts))
    marked = first_per_bucket(results.withColumn("__bucket", bucket), [camera, "__bucket"],
                              list(order), flag="__first")
    path = F.concat(F.lit(path_prefix), F.col(camera).cast("string"), F.lit("_"),
                    F.date_format("__bucket", fmt), F.lit(".jpg"))
    return marked.withColumn(path_col, F.when(F.col("__first"), path)) \
        .drop("__bucket", "__first")


def lag_stats(results: DataFrame, from_ts: str, to_ts: str, *, keys: Sequence[str] = (),
              percentiles: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """End-to-end lag (``to_ts - from_ts``) in seconds: mean, min, max and exact percentiles.

    The lag is taken in whole microseconds (a long) so sums are exact; percentiles come from the places
    of range-partitioned rows, so a camera of any size is spread over tasks.
    """
    lag_us = F.unix_micros(F.col(to_ts).cast("timestamp")) - F.unix_micros(F.col(from_ts).cast("timestamp"))
    src = results.select(*keys, lag_us.alias("__lag_us"))
    basic = src.groupBy(*keys).agg(
        F.count("__lag_us").alias("n"), (F.avg("__lag_us") / F.lit(1e6)).alias("mean_lag_s"),
        (F.min("__lag_us") / F.lit(1e6)).alias("min_lag_s"),
        (F.max("__lag_us") / F.lit(1e6)).alias("max_lag_s"))
    names = {f"p{int(round(p * 100))}_lag_s": p for p in percentiles}
    tails = exact_percentiles(src, list(keys), "__lag_us", names)
    tails = tails.select(*[F.col(k).alias(f"__{k}") for k in keys],
                         *[(F.col(n) / F.lit(1e6)).alias(n) for n in names])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return basic.join(tails, same, "left").drop(*[f"__{k}" for k in keys])

"""Frame stream stages: read messages, decode, score with a plug-in detector, enrich.

* ``read_json_stream`` — Kafka (``startingOffsets=latest`` by default) or a file stream of JSON
  / parquet messages, parsed with an explicit schema; a message that does not parse keeps its text.
* ``decode_frames`` — base64 image -> binary, ISO-8601 time -> timestamp, defaults for a missing camera
  or frame id, and an ``error`` column naming why a message cannot be processed.
* ``split_errors`` — (good, dead-letter) views of one stream; nothing is dropped silently.
* ``score_frames`` — ``mapInArrow`` around a user-supplied detector; the detector is built
  once per Python worker process and model key.  A frame that it fails on gets an ``error``; the
  others go on.
* ``enrich_results`` — JVM expressions: keep person boxes >= threshold, round them, count them,
  stamp model name and processing time.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessera.functions.detections import (BOXES_TYPE, box_count, decode_base64, keep_boxes,
                                          round_boxes)
from tessera.functions.logic import coalesce_default
from tessera.functions.time import iso_parse

MESSAGE_SCHEMA = T.StructType([
    T.StructField("camera_id", T.StringType()),
    T.StructField("frame_id", T.StringType()),
    T.StructField("frame_index", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("image", T.StringType()),
])

# A detector factory returns a callable: pandas Series of image bytes -> list (per row) of box
# dicts with keys x1, y1, x2, y2, confidence, class_id, class_name.
Detector = Callable[[pd.Series], Sequence[Sequence[Mapping[str, object]]]]
DetectorFactory = Callable[[], Detector]

_B64_TEXT = r"^[A-Za-z0-9+/\r\n]*={0,2}$"


def read_json_stream(spark: SparkSession, fmt: str, schema: T.StructType, *,
                     path: str | None = None, options: Mapping[str, str] | None = None,
                     raw: str | None = "raw") -> DataFrame:
    """Streaming messages with ``schema``.

    ``fmt='kafka'``: the ``value`` bytes are JSON; ``startingOffsets`` defaults to ``latest``
    (the reference consumer's choice) and offsets live in the query checkpoint.  Any other
    ``fmt`` is a file source over ``path`` (JSON lines or parquet with the message columns).
    ``raw`` names a column with the text of a JSON message that does not parse (else NULL).
    """
    opts = dict(options or {})
    wide = T.StructType([*schema.fields, T.StructField(raw, T.StringType())]) if raw else schema
    corrupt = {"columnNameOfCorruptRecord": raw} if raw else {}
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "latest")
        source = spark.readStream.format("kafka").options(**opts).load()
        parsed = F.from_json(F.col("value").cast("string"), wide, corrupt)
        return source.select(parsed.alias("m"), F.col("timestamp").alias("ingest_ts"),
                             F.col("partition").alias("source_partition"),
                             F.col("offset").alias("source_offset")).select(
            "m.*", "ingest_ts", "source_partition", "source_offset")
    if fmt == "json":
        return spark.readStream.format(fmt).schema(wide).options(**corrupt, **opts).load(path)
    return spark.readStream.format(fmt).schema(schema).options(**opts).load(path)


def decode_frames(msgs: DataFrame, *, image: str = "image", ts: str = "timestamp",
                  fallback_ts: Column | None = None, raw: str = "raw",
                  default_id: str = "unknown") -> DataFrame:
    """Add ``image_bytes``, ``source_ts`` and ``error`` (NULL when the frame is usable).

    A missing camera or frame id becomes ``default_id``; a missing or unparseable timestamp falls back
    to ``fallback_ts`` (default: processing time).  A message that did not parse, and an empty or
    undecodable image, is an error.
    """
    text = F.col(image)
    valid = text.isNotNull() & text.rlike(_B64_TEXT)
    data = F.when(valid, decode_base64(text))
    usable = data.isNotNull() & (F.length(data) > 0)
    fb = fallback_ts if fallback_ts is not None else F.current_timestamp()
    broken = F.col(raw).isNotNull() if raw in msgs.columns else F.lit(False)
    err = (F.when(broken, F.lit("malformed_message"))
           .when(~F.coalesce(usable, F.lit(False)), F.lit("undecodable_image")))
    return msgs.withColumn("image_bytes", F.when(err.isNull(), data)) \
        .withColumn("camera_id", coalesce_default("camera_id", default_id)) \
        .withColumn("frame_id", coalesce_default("frame_id", default_id)) \
        .withColumn("source_ts", iso_parse(ts, fallback=fb)) \
        .withColumn("error", err)


def split_errors(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(rows without error, rows with error) — the second is the dead-letter output."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


_DETECTORS: dict[str, Detector] = {}


def cached_detector(factory: DetectorFactory, model_key: str) -> Detector:
    """The detector of ``model_key``, built by ``factory`` once per Python worker process.

    Workers are reused across tasks and micro-batches, and this module is imported (not pickled)
    on them, so the cache lives as long as the worker.  The caller's key says which model it is:
    factories that build different detectors need different keys.
    """
    if model_key not in _DETECTORS:
        _DETECTORS[model_key] = factory()
    return _DETECTORS[model_key]


def detect_all(detect: Detector, images: Sequence[bytes]
               ) -> list[tuple[list[dict] | None, float | None, str | None]]:
    """Boxes, milliseconds and error of every image, by as few calls of the detector as failures allow.

    All images go to one call, which they share the time of.  Where it raises (or returns another number
    of results), the halves are tried, and so on: a failing image ends alone after about log2(n) levels of
    two calls each, and the others are scored.
    """
    began = time.perf_counter()
    try:
        found = [[dict(b) for b in boxes] for boxes in detect(pd.Series(list(images), dtype=object))]
        if len(found) != len(images):
            raise ValueError(f"{len(found)} results for {len(images)} images")
        share = (time.perf_counter() - began) * 1000.0 / len(images)
        return [(boxes, share, None) for boxes in found]
    except Exception as exc:  # the failing ones go to the dead letters
        if len(images) == 1:
            return [(None, None, f"detector_failed: {type(exc).__name__}: {exc}")]
    half = len(images) // 2
    return detect_all(detect, images[:half]) + detect_all(detect, images[half:])


def score_frames(df: DataFrame, detector_factory: DetectorFactory, model_key: str, *,
                 image: str = "image_bytes", batch_size: int = 1,
                 keep: Sequence[str] = ("camera_id", "frame_id", "frame_index", "timestamp",
                                        "source_ts")) -> DataFrame:
    """Run the detector over every frame; adds ``boxes``, ``processing_time_ms`` and ``error``.

    The detector is called on ``batch_size`` frames at once, which share the call's time; with 1 each
    frame has a time of its own.  A frame on which it raises gets ``error = "detector_failed: ..."`` and
    no boxes, found by halving (:func:`detect_all`); rows that come with an ``error`` are passed on
    unscored.  Works on batch and streaming DataFrames.
    """
    had_error = "error" in df.columns
    keep = list(dict.fromkeys([*keep, image]))
    src = df.select(*keep, F.col("error") if had_error else F.lit(None).cast("string").alias("error"))
    out_schema = T.StructType([*src.schema.fields[:-1], T.StructField("boxes", BOXES_TYPE),
                               T.StructField("processing_time_ms", T.DoubleType()),
                               T.StructField("error", T.StringType())])

    box_type = to_arrow_type(BOXES_TYPE).value_type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detect = cached_detector(detector_factory, model_key)
        for batch in batches:
            found: list = [(None, None, error) for error in batch.column("error").to_pylist()]
            usable = [k for k, (_, _, error) in enumerate(found) if error is None]
            images = batch.column(image).to_pylist()
            for at in range(0, len(usable), batch_size):
                some = usable[at:at + batch_size]
                for k, result in zip(some, detect_all(detect, [images[k] for k in some])):
                    found[k] = result
            scored, ms, errors = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], _box_lists(scored, box_type),
                 pa.array(ms, pa.float64()), pa.array(errors, pa.string())], names=out_schema.names)

    return src.mapInArrow(run, out_schema)


def _box_lists(scored: Sequence[list[dict] | None], box_type: pa.StructType) -> pa.ListArray:
    """The boxes of every row, each field of them converted as one column."""
    flat = [box for boxes in scored if boxes for box in boxes]
    fields = [pa.array([box.get(f.name) for box in flat], f.type) for f in box_type]
    ends, starts = 0, []
    for boxes in scored:
        starts.append(None if boxes is None else ends)  # no start: NULL
        ends += len(boxes or ())
    return pa.ListArray.from_arrays(pa.array([*starts, ends], pa.int32()),
                                    pa.StructArray.from_arrays(fields, fields=list(box_type)))


def enrich_results(scored: DataFrame, model_name: str, *, processed_ts: Column | None = None,
                   class_id: int = 0, min_confidence: float = 0.35) -> DataFrame:
    """Detection result documents: kept+rounded boxes, their count, model, processing time."""
    kept = round_boxes(keep_boxes("boxes", class_id, min_confidence))
    return scored.withColumn("boxes", kept) \
        .withColumn("person_count", box_count("boxes")) \
        .withColumn("model", F.lit(model_name)) \
        .withColumn("processing_time_ms", F.round("processing_time_ms", 2)) \
        .withColumn("processed_ts", processed_ts if processed_ts is not None else F.current_timestamp())


def running_stats(results: DataFrame, *, ts: str = "processed_ts", tie: str = "frame_id",
                  ms: str = "processing_time_ms", count: str = "person_count") -> DataFrame:
    """Processed total, last processing time and last person count (latest by ``ts``, ``tie``).

    An aggregation without keys: on a stream it runs in ``complete`` mode with state of one row.
    """
    order = F.struct(F.col(ts), F.col(tie))
    return results.agg(F.count(F.lit(1)).alias("processed_total"),
                       F.max_by(F.col(ms), order).alias("last_processing_ms"),
                       F.max_by(F.col(count), order).alias("last_person_count"))

"""Driver-table queries for the frame stream.

Frame messages are derived from ``events`` (camera = event_type, frame index = event_id, time =
ts as ISO-8601 'Z' text, image = base64 of the props JSON; frames of type 'error' carry an
undecodable image so the dead-letter path is exercised) and written as JSON files to a fresh
folder under the shared checkpoint folder.  Each query runs a Structured Streaming query with
``availableNow`` over those files into parquet under the same folder and returns the batch read of
what was stored.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.detections import encode_base64
from tessera.plans import testbed as tb
from tessera.plans.q_relational import FRAMES_CTE
from tessera.plans.registry import register, rnd
from tessera.plans.stub_detector import stub_detector_factory
from tessera.session import scratch_dir
from tessera.streaming import frames as S
from tessera.streaming.keyed import KeyedDocuments
from tessera.streaming.store import (image_winners, read_complete, read_table, run_to_end, store_results,
                                     write_complete, write_json_stream)

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
BAD_IMAGE = "!!not-base64!!"
MODEL = "stub-detector-v1"
FRAME_ID_SQL = "event_type || '_' || lpad(lower(hex(event_id)), 12, '0')"


def _messages(spark, sf):
    ev = tb.table(spark, sf, "events")
    frame_id = F.concat_ws("_", F.col("event_type"), F.lpad(F.lower(F.hex("event_id")), 12, "0"))
    image = F.when(F.col("event_type") == "error", F.lit(BAD_IMAGE)) \
        .otherwise(encode_base64(F.encode("props", "UTF-8")))
    return ev.select(F.col("event_type").alias("camera_id"), frame_id.alias("frame_id"),
                     F.col("event_id").alias("frame_index"),
                     F.date_format("ts", ISO).alias("timestamp"), image.alias("image"),
                     F.col("ts"))


def write_messages(spark, sf, path, *, copies: int = 1, where=None, files: int | None = None) -> str:
    """Write frame messages as JSON files; ``files`` range-splits them on the frame index."""
    msgs = _messages(spark, sf)
    if where is not None:
        msgs = msgs.where(where)
    msgs = msgs.drop("ts")
    if files:
        msgs = msgs.repartitionByRange(files, "frame_index")
    if copies > 1:
        msgs = msgs.persist()  # the table is read, and cut into ranges, once
    try:
        for _ in range(copies):
            msgs.write.mode("append").json(path)
    finally:
        if copies > 1:
            msgs.unpersist()
    return path


def files_per_batch(spark, batches: int) -> int:
    """Files of one batch, so that the input of all ``batches`` is written by as many tasks as a shuffle has."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // batches)


def _stream(spark, path, files_per_trigger: int | None = None):
    options = {"maxFilesPerTrigger": str(files_per_trigger)} if files_per_trigger else {}
    return S.read_json_stream(spark, "json", S.MESSAGE_SCHEMA, path=path, options=options)


def _results(spark, path, files_per_trigger: int | None = None):
    """Every frame scored and enriched; those that failed carry an ``error``."""
    decoded = S.decode_frames(_stream(spark, path, files_per_trigger))
    scored = S.score_frames(decoded, stub_detector_factory, MODEL, batch_size=256)
    return S.enrich_results(scored, MODEL)


def _scored(spark, path, files_per_trigger: int | None = None):
    """Results of the decodable frames, without images."""
    return S.split_errors(_results(spark, path, files_per_trigger))[0].drop("image_bytes")


def _ok_columns(df):
    return df.select("frame_id", "camera_id", "frame_index", "person_count", "model",
                     F.array_max(F.transform("boxes", lambda b: b["confidence"])).alias("max_confidence"))


_ENRICH_SQL = f"""
WITH {FRAMES_CTE},
kept AS (SELECT frame_id, count(*) AS n, max(confidence) AS mc FROM bx
         WHERE cls = 0 AND confidence >= 0.35 GROUP BY frame_id)
SELECT camera_id || '_' || lpad(lower(hex(fr.frame_id)), 12, '0') AS frame_id, camera_id,
       fr.frame_id AS frame_index, coalesce(kept.n, 0) AS person_count, '{MODEL}' AS model,
       {rnd('kept.mc', 4)} AS max_confidence
FROM fr LEFT JOIN kept ON fr.frame_id = kept.frame_id WHERE camera_id <> 'error'"""


@register("stream_read", f"""
SELECT event_type AS camera_id, {FRAME_ID_SQL} AS frame_id, event_id AS frame_index,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp", epoch_us(ts) AS source_us,
       CASE WHEN event_type = 'error' THEN 'undecodable_image' END AS error
FROM events""")
def stream_read(spark, sf):
    """Messages -> parsed typed rows, stored by an availableNow stream."""
    src = write_messages(spark, sf, scratch_dir(spark, "msgs"))
    parsed = S.decode_frames(_stream(spark, src), fallback_ts=F.lit(None).cast("timestamp"))
    table = scratch_dir(spark, "stream-read")
    run_to_end(store_results(parsed.drop("image", "image_bytes", "raw"), table_path=table,
                             checkpoint=scratch_dir(spark, "ckpt"), stamp=None))
    return read_table(spark, table).select(
        "camera_id", "frame_id", "frame_index", "timestamp",
        F.unix_micros("source_ts").alias("source_us"), "error")


@register("score_frames", f"""
WITH {FRAMES_CTE}
SELECT camera_id || '_' || lpad(lower(hex(frame_id)), 12, '0') AS frame_id, camera_id,
       CAST(coalesce(person_count, 0) AS INTEGER) AS n_boxes
FROM fr WHERE camera_id <> 'error'""")
def score_frames(spark, sf):
    """Decoded frames scored by the plug-in detector through mapInPandas."""
    src = write_messages(spark, sf, scratch_dir(spark, "msgs"))
    good, _ = S.split_errors(S.decode_frames(_stream(spark, src)))
    scored = S.score_frames(good, stub_detector_factory, MODEL).select("frame_id", "camera_id", "boxes")
    table = scratch_dir(spark, "scored")
    run_to_end(store_results(scored, table_path=table, checkpoint=scratch_dir(spark, "ckpt"),
                             stamp=None))
    return read_table(spark, table).select("frame_id", "camera_id", F.size("boxes").alias("n_boxes"))


@register("stream_enrich", _ENRICH_SQL)
def stream_enrich(spark, sf):
    """Enriched detection results of every decodable frame."""
    src = write_messages(spark, sf, scratch_dir(spark, "msgs"))
    table = scratch_dir(spark, "enriched")
    run_to_end(store_results(_scored(spark, src), table_path=table,
                             checkpoint=scratch_dir(spark, "ckpt")))
    return _ok_columns(read_table(spark, table))


@register("dead_letter", """
SELECT event_type || '_' || lpad(lower(hex(event_id)), 12, '0') AS frame_id, event_type AS camera_id,
       'undecodable_image' AS error
FROM events WHERE event_type = 'error'""")
def dead_letter(spark, sf):
    """Frames that cannot be processed, with the reason (routed, not dropped)."""
    src = write_messages(spark, sf, scratch_dir(spark, "msgs"))
    _, dead = S.split_errors(S.decode_frames(_stream(spark, src)))
    table = scratch_dir(spark, "dead")
    run_to_end(store_results(dead.select("frame_id", "camera_id", "error"), table_path=table,
                             checkpoint=scratch_dir(spark, "ckpt"), stamp=None))
    return read_table(spark, table)


@register("upsert_by_key", f"""
WITH e AS ({_ENRICH_SQL}) SELECT frame_id, camera_id, frame_index, person_count FROM e""")
def upsert_by_key(spark, sf):
    """Every message delivered twice; the keyed documents hold one current row per frame."""
    each = files_per_batch(spark, 2)
    src = write_messages(spark, sf, scratch_dir(spark, "msgs"), copies=2, files=2 * each)
    docs = KeyedDocuments(spark, scratch_dir(spark, "documents"), ["frame_id"], ["frame_index"],
                          snapshot_every=2)
    run_to_end(store_results(_scored(spark, src, files_per_trigger=each), documents=docs,
                             table_path=scratch_dir(spark, "table"),
                             checkpoint=scratch_dir(spark, "ckpt")))
    return docs.read().select("frame_id", "camera_id", "frame_index", "person_count")


@register("stream_append", f"""
WITH e AS ({_ENRICH_SQL})
SELECT frame_id, camera_id, person_count FROM e
UNION ALL SELECT frame_id, camera_id, person_count FROM e""")
def stream_append(spark, sf):
    """Append-only result table: a replayed delivery keeps both copies."""
    src = write_messages(spark, sf, scratch_dir(spark, "msgs"), copies=2)
    table = scratch_dir(spark, "table")
    run_to_end(store_results(_scored(spark, src), table_path=table,
                             checkpoint=scratch_dir(spark, "ckpt")))
    return read_table(spark, table).select("frame_id", "camera_id", "person_count")


@register("stream_json_sink", f"""
WITH e AS ({_ENRICH_SQL}) SELECT frame_id, camera_id, person_count FROM e""")
def stream_json_sink(spark, sf):
    """Results as a stream of JSON messages, read back."""
    src = write_messages(spark, sf, scratch_dir(spark, "msgs"))
    results = _scored(spark, src).select("frame_id", "camera_id", "person_count")
    out = scratch_dir(spark, "topic")
    run_to_end(write_json_stream(results, fmt="json", path=out, checkpoint=scratch_dir(spark, "ckpt")))
    parsed = F.from_json("value", results.schema)
    return spark.read.text(out).select(parsed.alias("m")).select("m.*")


@register("stream_exactly_once", f"""
WITH e AS ({_ENRICH_SQL}) SELECT frame_id, camera_id, person_count FROM e""")
def stream_exactly_once(spark, sf):
    """Two arrival waves, the query restarted from its checkpoint in between: every frame is
    stored exactly once."""
    src = scratch_dir(spark, "msgs")
    ckpt, table = scratch_dir(spark, "ckpt"), scratch_dir(spark, "table")
    first_wave = F.dayofmonth("ts") <= 15
    for wave in (first_wave, ~first_wave):
        write_messages(spark, sf, src, where=wave)
        run_to_end(store_results(_scored(spark, src), table_path=table, checkpoint=ckpt))
    return read_table(spark, table).select("frame_id", "camera_id", "person_count")


@register("frame_pipeline", f"""
WITH {FRAMES_CTE},
good AS (SELECT *, row_number() OVER (PARTITION BY camera_id, date_trunc('second', source_ts)
                                      ORDER BY source_ts, frame_id) = 1 AS wins
         FROM fr WHERE camera_id <> 'error'),
kept AS (SELECT frame_id, count(*) AS n FROM bx WHERE cls = 0 AND confidence >= 0.35 GROUP BY frame_id)
SELECT good.camera_id || '_' || lpad(lower(hex(good.frame_id)), 12, '0') AS frame_id, good.camera_id,
       coalesce(kept.n, 0) AS person_count,
       CASE WHEN wins THEN 'images/' || good.camera_id || '_' ||
            strftime(date_trunc('second', good.source_ts), '%Y%m%d_%H%M%S') || '.jpg' END AS image_path,
       CASE WHEN wins THEN CAST(strlen(props) AS BIGINT) END AS image_length,
       '{MODEL}' AS model, NULL AS error
FROM good LEFT JOIN kept ON good.frame_id = kept.frame_id JOIN events ON event_id = good.frame_id
UNION ALL
SELECT {FRAME_ID_SQL}, event_type, NULL, NULL, NULL, NULL, 'undecodable_image'
FROM events WHERE event_type = 'error'""")
def frame_pipeline(spark, sf):
    """frames -> decode -> detect -> enrich -> table, dead letters and first images in one query;
    returns the stored results with the image that the first frame of each camera-second keeps, and
    the dead letters with their reason."""
    src = write_messages(spark, sf, scratch_dir(spark, "msgs"))
    table, dead = scratch_dir(spark, "table"), scratch_dir(spark, "dead")
    images = scratch_dir(spark, "images")
    run_to_end(store_results(_results(spark, src), table_path=table, dead_path=dead,
                             images_path=images, checkpoint=scratch_dir(spark, "ckpt")))
    path = F.concat(F.lit("images/"), F.col("camera_id"), F.lit("_"),
                    F.date_format(F.date_trunc("second", "source_ts"), "yyyyMMdd_HHmmss"),
                    F.lit(".jpg"))
    kept = image_winners(spark, images).select(
        F.col("frame_id").alias("__frame"), path.alias("image_path"),
        F.length("image_bytes").cast("long").alias("image_length"))
    results = read_table(spark, table)
    none = F.lit(None)
    stored = results.join(kept, F.col("frame_id") == F.col("__frame"), "left").select(
        "frame_id", "camera_id", F.col("person_count").cast("long").alias("person_count"),
        "image_path", "image_length", "model", none.cast("string").alias("error"))
    return stored.unionByName(read_table(spark, dead).select(
        "frame_id", "camera_id", none.cast("long").alias("person_count"),
        none.cast("string").alias("image_path"), none.cast("long").alias("image_length"),
        none.cast("string").alias("model"), "error"))


_RESULT_DOC_CTE = f"""{FRAMES_CTE},
r AS (SELECT camera_id || '_' || lpad(lower(hex(frame_id)), 12, '0') AS fid, processed_ts, value,
             person_count FROM fr)"""


def result_documents(spark, sf, files: int | None = None, files_per_trigger: int | None = None):
    """Stream of result documents written as JSON, ``files`` of them in an order of their own."""
    from tessera.plans.q_relational import frames as frame_rows
    path = scratch_dir(spark, "result-docs")
    fid = F.concat_ws("_", F.col("camera_id"), F.lpad(F.lower(F.hex("frame_id")), 12, "0"))
    docs = frame_rows(spark, sf).select(
        fid.alias("frame_id"), "camera_id", F.date_format("source_ts", ISO).alias("source_timestamp"),
        F.date_format("processed_ts", ISO).alias("processed_timestamp"),
        F.col("processing_ms").alias("processing_time_ms"), "person_count")
    (docs.repartition(files, "frame_id") if files else docs).write.json(path)
    schema = "frame_id string, camera_id string, source_timestamp string, processed_timestamp string, " \
             "processing_time_ms double, person_count long"
    options = {"maxFilesPerTrigger": str(files_per_trigger)} if files_per_trigger else {}
    stream = S.read_json_stream(spark, "json", _schema(spark, schema), path=path, raw=None, options=options)
    return stream.withColumn("processed_ts", F.col("processed_timestamp").try_cast("timestamp")) \
        .withColumn("source_ts", F.col("source_timestamp").try_cast("timestamp"))


@register("running_stats", f"""
WITH {_RESULT_DOC_CTE}
SELECT (SELECT count(*) FROM r) AS processed_total,
       (SELECT value FROM r ORDER BY processed_ts DESC, fid DESC LIMIT 1) AS last_processing_ms,
       (SELECT person_count FROM r ORDER BY processed_ts DESC, fid DESC LIMIT 1) AS last_person_count""")
def running_stats(spark, sf):
    """Processed total / last processing time / last count over the result-document stream,
    kept in complete mode and rewritten per batch."""
    stream = result_documents(spark, sf)
    out = scratch_dir(spark, "running-stats")
    run_to_end(write_complete(S.running_stats(stream), out, scratch_dir(spark, "ckpt")))
    return read_complete(spark, out)


def _schema(spark, ddl):
    from pyspark.sql.types import _parse_datatype_string
    return _parse_datatype_string(ddl)

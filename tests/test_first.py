"""First frame per bucket on a stream: equal to the batch operator, late frames, state, image files."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.operators.rank import first_per_bucket
from tessera.session import scratch_dir
from tessera.streaming.first import image_path, mark_first_stream, write_images
from tessera.streaming.store import read_table, run_to_end, store_results

from .conftest import SF_SMALL

COLS = "camera_id string, frame_id string, source_ts timestamp, image_bytes binary, box array<struct<x:double>>"


def put(spark, path, rows, n):
    """One file, later than those before it."""
    df = spark.createDataFrame([(c, f, None, f.encode(), [(float(n),)]) for c, f, _ in rows], COLS).drop("source_ts")
    when = spark.createDataFrame([(f, t) for _, f, t in rows], "frame_id string, t string")
    df.join(when, "frame_id").withColumn("source_ts", F.to_timestamp("t")).select(
        "camera_id", "frame_id", "source_ts", "image_bytes", "box").coalesce(1).write.mode("append").parquet(path)
    folder = path.removeprefix("file:")
    for name in os.listdir(folder):
        if name.endswith(".parquet") and os.path.getmtime(os.path.join(folder, name)) > 10 ** 9 + 10 ** 6:
            os.utime(os.path.join(folder, name), (10 ** 9 + n, 10 ** 9 + n))


def run(spark, path, out, ckpt, **options):
    stream = spark.readStream.schema(COLS).option("maxFilesPerTrigger", 1).parquet(path)
    marked = mark_first_stream(stream, **{"delay": "10 seconds", "retain": "1 minute", **options})
    query = store_results(marked, table_path=out, checkpoint=ckpt, stamp=None)
    run_to_end(query)
    return query


def test_shuffled_files_and_a_restart_equal_the_batch_operator(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    rows = events.select(F.col("user_id").cast("string").alias("camera_id"), F.col("event_id").alias("frame_id"),
                         F.col("ts").cast("timestamp").alias("source_ts"),
                         F.encode("props", "UTF-8").alias("image_bytes"), "value")
    path, out, ckpt = (scratch_dir(spark, n) for n in ("in", "out", "ckpt"))
    ahead = rows.agg(F.max("source_ts").alias("t")).select(
        F.lit("end").alias("camera_id"), F.lit(-1).cast("long").alias("frame_id"),
        (F.col("t") + F.expr("INTERVAL 5 YEARS")).alias("source_ts"), F.lit(b"").alias("image_bytes"),
        F.lit(0.0).alias("value"))
    for part in (0, 1, 2):  # a restart after each
        (ahead if part == 2 else rows.where(F.pmod(F.xxhash64("frame_id"), F.lit(2)) == part)
         .repartition(3, F.rand(part))).write.mode("append").parquet(path)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)
        run_to_end(store_results(mark_first_stream(stream, unit="hour", delay="2 years"), table_path=out,
                                 checkpoint=ckpt, stamp=None))
    got = read_table(spark, out).where("camera_id <> 'end'")
    batch = first_per_bucket(rows, ["camera_id", F.date_trunc("hour", "source_ts")], ["source_ts", "frame_id"])
    want = {(r.camera_id, r.frame_id, r.source_ts, r.value, bytes(r.image_bytes) if r.is_first else None)
            for r in batch.collect()}
    rows = got.collect()
    assert len(rows) == len(want) and not any(r.late for r in rows)
    assert {(r.camera_id, r.frame_id, r.source_ts, r.value,
             None if r.image_bytes is None else bytes(r.image_bytes)) for r in rows} == want
    assert all((r.image_path is None) == (r.image_bytes is None) for r in rows)


def test_late_frames_are_passed_on(spark):
    path, out, ckpt = (scratch_dir(spark, n) for n in ("in", "out", "ckpt"))
    day = "2030-05-06 07:"
    put(spark, path, [("a", "a2", day + "00:00.5"), ("a", "a3", day + "00:00.7"), ("b", "b1", day + "00:00.1"),
                      ("a", "a1", day + "00:00.2"), ("none", "n", None)], 0)
    put(spark, path, [("a", "a5", day + "00:08.0"), ("a", "a0", day + "00:00.1")], 1)  # within the delay
    put(spark, path, [("b", "b9", day + "00:30.0")], 2)  # lets the buckets of the first second close
    put(spark, path, [("b", "b8", day + "00:30.1")], 3)
    put(spark, path, [("a", "late", day + "00:00.0"), ("c", "alone", day + "00:00.3")], 4)
    put(spark, path, [("c", "second", day + "00:00.2")], 5)
    put(spark, path, [("b", "far", day + "09:00.0")], 6)  # past every mark that is retained
    put(spark, path, [("b", "far too", day + "09:00.0")], 7)
    put(spark, path, [("d", "too late", day + "00:01.0"), ("a", "again", day + "00:00.0")], 8)
    query = run(spark, path, out, ckpt)
    rows = {r.frame_id: r for r in read_table(spark, out).collect()}
    assert read_table(spark, out).count() == len(rows) == 16 - 2  # the far ones wait for their bucket to close
    name = "20300506_0700"
    assert {f: r.image_path for f, r in rows.items() if r.image_path} == {
        "a0": f"a_{name}00.jpg", "b1": f"b_{name}00.jpg", "a5": f"a_{name}08.jpg", "b9": f"b_{name}30.jpg",
        "alone": f"c_{name}00.jpg"}
    assert {f for f, r in rows.items() if r.late} == {"n", "late", "alone", "second", "too late", "again"}
    assert {f: bytes(r.image_bytes).decode() for f, r in rows.items() if r.image_bytes} == {
        f: f for f in ("a0", "b1", "a5", "b9", "alone")}
    assert rows["a1"].box[0].x == 0.0
    # The state holds the one open bucket (a row, its best and its timer), whatever came before.
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] <= 6


def test_image_files(spark):
    folder = scratch_dir(spark, "images")
    rows = [("x/../y", b"one"), ("x_.._y", b"two"), ("50%", b"three")]
    df = spark.createDataFrame(rows, "camera_id string, image_bytes binary").withColumn(
        "image_path", image_path("camera_id", F.timestamp_millis(F.lit(0)), prefix="images/")).unionByName(
        spark.createDataFrame([("loser", b"no", None)], "camera_id string, image_bytes binary, image_path string"))
    for _ in range(2):  # a replayed batch
        write_images(df.repartition(3), folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).collect()
    assert {(os.path.basename(f.path), bytes(f.content)) for f in files} == {
        ("x%2F..%2Fy_19700101_000000.jpg", b"one"), ("x_.._y_19700101_000000.jpg", b"two"),
        ("50%25_19700101_000000.jpg", b"three")}
    assert all(os.path.dirname(f.path) == f"{folder}/images" for f in files)


def test_a_failing_writer_leaves_no_image(spark, monkeypatch):
    import tessera.streaming.first as first
    folder = scratch_dir(spark, "images")
    df = spark.createDataFrame([("p/a.jpg", b"x")], "image_path string, image_bytes binary")

    def broken(*_):
        def run(batches):
            for _ in batches:
                raise OSError("disk")
            yield from ()
        return run
    with monkeypatch.context() as m:
        m.setattr(first, "_settle", broken)
        with pytest.raises(Exception):
            write_images(df, folder)
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jpg")
    assert read.load(folder).count() == 0
    write_images(df, folder)
    assert read.load(folder).count() == 1

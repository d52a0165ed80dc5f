"""Stream stages: stream = batch on the same messages, replay/restart safety, failing frames, first
images, one-document-per-file JSON source."""

import functools
import json
import os

import pandas as pd
from pyspark.sql import functions as F

from tessera.operators.rank import first_per_bucket
from tessera.plans import q_streaming as Q
from tessera.plans.stub_detector import stub_detector_factory
from tessera.session import scratch_dir
from tessera.sources.text import read_json_documents
from tessera.streaming import frames as S
from tessera.streaming.store import (append_batch, image_winners, read_latest, read_table, run_to_end,
                                     store_results)

from .conftest import SF_SMALL


def _batch_results(spark, path):
    msgs = spark.read.schema(S.MESSAGE_SCHEMA).json(path)
    good, dead = S.split_errors(S.decode_frames(msgs))
    scored = S.score_frames(good, stub_detector_factory, Q.MODEL)
    return S.enrich_results(scored, Q.MODEL).drop("image_bytes"), dead


def _events(spark, bad=False):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    return events.where("event_type = 'error'" if bad else "event_type <> 'error'")


def test_stream_equals_batch(spark):
    src = Q.write_messages(spark, SF_SMALL, scratch_dir(spark, "msgs"), files=4)
    table = scratch_dir(spark, "t")
    run_to_end(store_results(Q._scored(spark, src, files_per_trigger=1), table_path=table,
                             checkpoint=scratch_dir(spark, "c")))
    streamed = {(r.frame_id, r.person_count) for r in read_table(spark, table).collect()}
    batch_ok, batch_dead = _batch_results(spark, src)
    batched = {(r.frame_id, r.person_count) for r in batch_ok.collect()}
    assert streamed == batched and len(streamed) > 0
    assert batch_dead.count() == _events(spark, bad=True).count()


def test_replayed_delivery_and_upsert(spark):
    src = Q.write_messages(spark, SF_SMALL, scratch_dir(spark, "msgs"), copies=2)
    table = scratch_dir(spark, "t")
    run_to_end(store_results(Q._scored(spark, src), table_path=table,
                             checkpoint=scratch_dir(spark, "c")))
    stored = read_table(spark, table)
    latest = read_latest(spark, table, ["frame_id"], ["frame_index"])
    assert stored.count() == 2 * latest.count()
    assert latest.select("frame_id").distinct().count() == latest.count()
    assert stored.select("stored_ts").distinct().count() == 1  # one time for the one batch


def test_latest_document_follows_the_source_order(spark):
    path = scratch_dir(spark, "docs")
    cols = "frame_id string, source_offset long, person_count long"
    first = [("a", i, i * 10) for i in (3, 1, 5, 2, 4)] + [("b", 1, 1), ("c", None, 7), ("c", 1, 8)]
    append_batch(spark.createDataFrame(first, cols).repartition(3), 0, path)
    append_batch(spark.createDataFrame([("b", 0, 99)], cols), 1, path)
    got = {r.frame_id: r.person_count for r in
           read_latest(spark, path, ["frame_id"], ["source_offset"]).collect()}
    assert got == {"a": 50, "b": 99, "c": 8}


def test_restart_from_checkpoint_is_exactly_once(spark):
    src, ckpt, table = scratch_dir(spark, "msgs"), scratch_dir(spark, "c"), scratch_dir(spark, "t")
    first = F.dayofmonth("ts") <= 15
    for wave in (first, ~first):
        Q.write_messages(spark, SF_SMALL, src, where=wave)
        run_to_end(store_results(Q._scored(spark, src), table_path=table, checkpoint=ckpt))
    stored = read_table(spark, table)
    assert stored.count() == stored.select("frame_id").distinct().count()
    assert stored.count() == _events(spark).count()


def test_first_images_equal_the_batch_operator(spark):
    # Frames dealt at random over files, several micro-batches, a restart in between.
    src, ckpt = scratch_dir(spark, "msgs"), scratch_dir(spark, "c")
    table, dead, images = (scratch_dir(spark, n) for n in ("t", "d", "i"))
    for part in (0, 1):
        Q._messages(spark, SF_SMALL).where(F.pmod(F.xxhash64("frame_id"), F.lit(2)) == part) \
            .drop("ts").repartition(3, F.rand(7)).write.mode("append").json(src)
        run_to_end(store_results(Q._results(spark, src, files_per_trigger=1), table_path=table,
                                 dead_path=dead, images_path=images, checkpoint=ckpt,
                                 first={"unit": "hour"}))
    won = image_winners(spark, images, unit="hour").collect()
    batch = _batch_results(spark, src)[0].withColumn("bucket", F.date_trunc("hour", "source_ts"))
    want = first_per_bucket(batch, ["camera_id", "bucket"], ["source_ts", "frame_id"],
                            winners_only=True)
    assert {r.frame_id for r in won} == {r.frame_id for r in want.collect()}
    assert all(len(r.image_bytes) > 0 for r in won)
    assert read_table(spark, dead).count() == _events(spark, bad=True).count()
    assert "image_bytes" not in read_table(spark, table).columns
    assert read_table(spark, table).count() == _events(spark).count()


def fragile_factory(poison=b"poison"):
    def detect(images):
        if any(bytes(b) == poison for b in images):
            raise ValueError("cannot read this one")
        return [[] for _ in images]
    return detect


def _message(**fields):
    return json.dumps({"camera_id": "c1", "frame_id": "f", "frame_index": 1,
                       "timestamp": "2030-05-06T07:08:09Z", "image": "b2s=", **fields})


def test_one_failing_frame_is_recorded_and_the_rest_go_on(spark, tmp_dir):
    lines = [_message(frame_id="good"), _message(frame_id="bad", image="cG9pc29u"),
             _message(frame_id="empty", image=""), _message(camera_id=None, frame_id=""),
             '{"frame_id": "cut", "camera', _message(frame_id="none", image=None)]
    with open(os.path.join(tmp_dir, "m.json"), "w") as f:
        f.write("\n".join(lines))
    stream = S.read_json_stream(spark, "json", S.MESSAGE_SCHEMA, path=tmp_dir)
    keep = ("camera_id", "frame_id", "frame_index", "timestamp", "source_ts", "raw")
    scored = S.enrich_results(S.score_frames(S.decode_frames(stream), fragile_factory, "fragile",
                                             keep=keep), "m")
    table, dead = scratch_dir(spark, "t"), scratch_dir(spark, "d")
    run_to_end(store_results(scored, table_path=table, dead_path=dead,
                             checkpoint=scratch_dir(spark, "c")))
    good = {(r.camera_id, r.frame_id) for r in read_table(spark, table).collect()}
    assert good == {("c1", "good"), ("unknown", "unknown")}
    lost = {(r.frame_id, r.error): r.raw for r in read_table(spark, dead).collect()}
    assert lost == {("bad", "detector_failed: ValueError: cannot read this one"): None,
                    ("empty", "undecodable_image"): None, ("none", "undecodable_image"): None,
                    ("unknown", "malformed_message"): lines[4]}


def counting_factory(n):
    return lambda images: [[{"class_id": 0, "class_name": "person", "confidence": 0.9, "x1": 0.0,
                             "y1": 0.0, "x2": 1.0, "y2": 1.0}] * n for _ in images]


def test_detectors_are_told_apart_by_their_key(spark):
    frames = spark.createDataFrame([(b"x",)], "image_bytes binary")
    for _ in range(2):
        for n in (1, 3):
            made = [functools.partial(counting_factory, n), lambda n=n: counting_factory(n)]
            for k, factory in enumerate(made):
                out = S.score_frames(frames, factory, f"counting-{n}-{k}", keep=()).collect()
                assert [len(r.boxes) for r in out] == [n]


def test_each_frame_has_its_own_time(spark):
    import time

    def slow_factory():
        def detect(images: pd.Series):
            time.sleep(0.05 if bytes(images.iloc[0]) == b"slow" else 0)
            return [[] for _ in images]
        return detect
    frames = spark.createDataFrame([(b"slow",), (b"fast",)], "image_bytes binary").coalesce(1)
    rows = S.score_frames(frames, slow_factory, "slow", keep=()).collect()
    times = {bytes(r.image_bytes): r.processing_time_ms for r in rows}
    assert times[b"slow"] >= 50 > times[b"fast"]


def test_running_stats_complete_mode(spark):
    df = Q.running_stats(spark, SF_SMALL)
    row = df.collect()[0]
    assert row.processed_total == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_pretty_printed_document_per_file(spark, tmp_dir):
    docs = [{"camera_id": "cam_01", "frame_id": "cam_01_0000000000aa", "source_timestamp":
             "2024-01-01T09:24:45.123456+00:00", "person_count": 1, "boxes": [
                 {"x1": 1.0, "y1": 2.0, "x2": 3.0, "y2": 4.0, "confidence": 0.5, "class_id": 0,
                  "class_name": "person"}], "processing_time_ms": 87.5},
            {"camera_id": "cam_01", "frame_id": "cam_01_0000000000ab", "source_timestamp":
             "2024-01-01T09:24:46Z", "person_count": 0, "boxes": [], "processing_time_ms": 200.0}]
    for i, d in enumerate(docs):
        with open(os.path.join(tmp_dir, f"doc{i}.json"), "w") as f:
            json.dump(d, f, indent=2)
    from pyspark.sql import types as T
    from tessera.plans.q_io import FRAME_DOC_SCHEMA
    schema = T.StructType([T.StructField("frame_id", T.StringType()) if f.name == "frame_id" else f
                           for f in FRAME_DOC_SCHEMA.fields])
    rows = read_json_documents(spark, tmp_dir, schema).orderBy("frame_id").collect()
    assert [(r.frame_id, r.person_count, len(r.boxes)) for r in rows] == [
        ("cam_01_0000000000aa", 1, 1), ("cam_01_0000000000ab", 0, 0)]


def test_camera_stats_stream_equals_batch(spark):
    from tessera.plans.frames import camera_stats
    from tessera.streaming.store import read_complete, write_complete
    src = Q.write_messages(spark, SF_SMALL, scratch_dir(spark, "msgs"))
    ok = Q._scored(spark, src)
    out = scratch_dir(spark, "stats")
    run_to_end(write_complete(camera_stats(ok), out, scratch_dir(spark, "c")))
    streamed = {tuple(r) for r in read_complete(spark, out).collect()}
    batch_ok, _ = _batch_results(spark, src)
    assert streamed == {tuple(r) for r in camera_stats(batch_ok).collect()}


def test_json_message_sink_round_trip(spark):
    from tessera.streaming.store import write_json_stream
    src = Q.write_messages(spark, SF_SMALL, scratch_dir(spark, "msgs"))
    ok = Q._scored(spark, src)
    out = scratch_dir(spark, "topic")
    results = ok.select("camera_id", "frame_id", "person_count", "boxes")
    run_to_end(write_json_stream(results, fmt="json", path=out, checkpoint=scratch_dir(spark, "c")))
    schema = results.schema
    back = spark.read.text(out).select(F.from_json("value", schema).alias("m")).select("m.*")
    batch_ok, _ = _batch_results(spark, src)
    want = {(r.frame_id, r.person_count, len(r.boxes)) for r in batch_ok.collect()}
    assert {(r.frame_id, r.person_count, len(r.boxes)) for r in back.collect()} == want


def test_parquet_message_source(spark):
    msgs = Q._messages(spark, SF_SMALL).drop("ts")
    src = scratch_dir(spark, "msgs-parquet")
    msgs.repartitionByRange(3, "frame_index").write.parquet(src)
    stream = S.read_json_stream(spark, "parquet", S.MESSAGE_SCHEMA, path=src,
                                options={"maxFilesPerTrigger": "1"})
    good, dead = S.split_errors(S.decode_frames(stream))
    table = scratch_dir(spark, "t")
    run_to_end(store_results(good.drop("image", "image_bytes"), table_path=table,
                             checkpoint=scratch_dir(spark, "c"), stamp=None))
    assert read_table(spark, table).count() == _events(spark).count()


def test_halving_finds_the_poisoned_frame_in_a_few_calls():
    calls = []

    def detect(images):
        calls.append(len(images))
        if any(b == b"poison" for b in images):
            raise ValueError("cannot read this one")
        return [[{"class_id": len(b)}] for b in images]
    images = [b"x" * (k % 7) for k in range(1000)]
    images[613] = b"poison"
    got = S.detect_all(detect, images)
    assert [k for k, (_, _, error) in enumerate(got) if error] == [613]
    assert got[613] == (None, None, "detector_failed: ValueError: cannot read this one")
    assert all(b == [{"class_id": k % 7}] and ms > 0 for k, (b, ms, _) in enumerate(got) if k != 613)
    assert len(calls) <= 1 + 2 * 10  # two calls on each of log2(1000) levels
    assert S.detect_all(detect, [b"poison"] * 3) == [got[613]] * 3
    assert [e for _, _, e in S.detect_all(lambda x: [], [b"a"])] == [
        "detector_failed: ValueError: 0 results for 1 images"]


def test_batched_frames_share_a_time_and_fail_alone(spark):
    def factory():
        def detect(images: pd.Series):
            if any(bytes(b) == b"bad" for b in images):
                raise KeyError("bad")
            return [[{"class_id": 0, "class_name": "n", "confidence": float(len(images)), "x1": 0.0, "y1": 0.0,
                      "x2": 1.0, "y2": 1.0}] for _ in images]
        return detect
    rows = [(i, b"bad" if i in (17, 40) else b"ok", "early" if i == 3 else None) for i in range(64)]
    frames = spark.createDataFrame(rows, "id long, image_bytes binary, error string").coalesce(1)
    got = {r.id: r for r in S.score_frames(frames, factory, "batched", keep=("id",), batch_size=32).collect()}
    assert {i for i, r in got.items() if r.error == "detector_failed: KeyError: 'bad'"} == {17, 40}
    assert got[3].error == "early" and got[3].boxes is None
    assert got[0].processing_time_ms == got[1].processing_time_ms > 0
    assert got[0].boxes[0].confidence == 16.0 and got[18].boxes[0].confidence == 1.0


def test_supervised_queries_restart_and_give_up(spark):
    import pytest
    from tessera.streaming.store import supervise
    pauses, runs = [], []

    class Query:
        def __init__(self, fails):
            self.fails = fails

        def awaitTermination(self):
            if self.fails:
                raise OSError("away")

        def exception(self):
            return None

    def start(fails):
        def run():
            runs.append(1)
            if len(runs) == 1 and fails > 1:
                raise ConnectionError("no broker yet")  # fails before it runs
            return Query(len(runs) <= fails)
        return run
    assert supervise(start(3), pause_s=7, wait=pauses.append) == 3
    assert pauses == [7, 7, 7] and len(runs) == 4
    runs.clear()
    with pytest.raises(OSError):
        supervise(start(99), limit=2, wait=pauses.append)
    assert len(runs) == 3
    runs.clear()
    # Runs that were healthy for long enough begin a new row of failures.
    assert supervise(start(6), limit=1, healthy_s=0.0, wait=pauses.append) == 6

"""Stream state kept up batch by batch: replays, crashes, bounded reads, sketches."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.aggregate import count_distinct_by, distinct_estimates, distinct_sketches
from tessera.session import scratch_dir
from tessera.streaming import rollup as R
from tessera.streaming.keyed import KeyedDocuments
from tessera.streaming.store import read_complete, run_to_end, write_complete
from tessera.streaming.versions import Versions

COLS = "camera_id string, frame_id long, person_count long, processed_ts long, processing_time_ms double"


def frames(spark, n, seed=1):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "b", None]), i, rng.choice([None, 0, 1, 5]), rng.randrange(50),
             rng.random()) for i in range(n)]


class Crash(Exception):
    pass


def crashing(monkeypatch):
    def publish(self, number, content):
        raise Crash()
    monkeypatch.setattr(Versions, "publish", publish)


@pytest.mark.parametrize("merge_every", [2, 3, 100])
def test_rollup_equals_one_aggregation(spark, merge_every):
    rows = frames(spark, 300)
    cuts = [0, 1, 40, 40, 200, 290, 300]  # one batch is empty
    cameras = R.Rollup(spark, scratch_dir(spark, "r"), ["camera_id"], R.camera_measures(), merge_every)
    totals = R.Rollup(spark, scratch_dir(spark, "r"), [], R.running_measures(), merge_every)
    for b, (i, j) in enumerate(zip(cuts, cuts[1:])):
        batch = spark.createDataFrame(rows[i:j], COLS)
        assert cameras.add(batch, b) and totals.add(batch, b)
        assert not cameras.add(batch, b) and not totals.add(batch, b)  # a replay changes nothing
    whole = spark.createDataFrame(rows, COLS)
    from tessera.plans.frames import camera_stats
    from tessera.streaming.frames import running_stats
    assert {tuple(r) for r in R.camera_stats(cameras).collect()} == {
        tuple(r) for r in camera_stats(whole).collect()}
    assert R.running_stats(totals).collect() == running_stats(whole).collect()
    assert not totals.add(whole, 0)  # also a batch that was merged away


def test_a_crash_before_publishing_leaves_the_last_version(spark, monkeypatch):
    path = scratch_dir(spark, "r")
    kept = R.Rollup(spark, path, ["camera_id"], R.camera_measures(), merge_every=2)
    batches = [spark.createDataFrame(frames(spark, 50, s), COLS) for s in range(3)]
    kept.add(batches[0], 0)
    before = sorted(map(tuple, kept.read().collect()), key=repr)
    for b in (1, 1):  # with a merge on the way
        with monkeypatch.context() as m:
            crashing(m)
            with pytest.raises(Crash):
                kept.add(batches[1], b)
        assert sorted(map(tuple, kept.read().collect()), key=repr) == before
    again = R.Rollup(spark, path, ["camera_id"], R.camera_measures(), merge_every=2)
    assert again.add(batches[1], 1) and again.add(batches[2], 2)
    want = R.partial(batches[0].union(batches[1]).union(batches[2]), ["camera_id"], R.camera_measures())
    assert sorted(map(tuple, again.read().collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert len(again.versions._names("data")) <= 3  # what the crashes left is gone


def test_complete_results_stay_readable(spark, monkeypatch, tmp_dir):
    import json
    import os

    def arrive(k):
        with open(os.path.join(tmp_dir, f"{k}.json"), "w") as f:
            f.write("\n".join(json.dumps({"k": i % 2}) for i in range(k)))
    out, ckpt = scratch_dir(spark, "complete"), scratch_dir(spark, "c")

    def run():
        stream = spark.readStream.schema("k long").json(tmp_dir).groupBy("k").count()
        run_to_end(write_complete(stream, out, ckpt))
    arrive(4)
    run()
    first = sorted(read_complete(spark, out).collect())
    assert [tuple(r) for r in first] == [(0, 2), (1, 2)]
    arrive(6)
    with monkeypatch.context() as m:
        crashing(m)
        with pytest.raises(Exception):
            run()
    assert sorted(read_complete(spark, out).collect()) == first
    run()  # from the checkpoint
    assert [tuple(r) for r in sorted(read_complete(spark, out).collect())] == [(0, 5), (1, 5)]


DOCS = "k string, sub long, seq long, v long"


def last_of(batches):
    found = {}
    for b, rows in enumerate(batches):
        for r in rows:
            at = (b, r[2] is not None, r[2] or 0)
            if r[:2] not in found or at > found[r[:2]][0]:
                found[r[:2]] = (at, r)
    return sorted((r for _, r in found.values()), key=repr)


def test_documents_after_many_batches(spark):
    rng = random.Random(5)
    keys = [(k, s) for k in ("a", "b", "ä", None) for s in (1, 2, None)]
    batches = [[(*rng.choice(keys), seq, 100 * b + seq) for seq in rng.sample(range(50), 3)]
               for b in range(200)]
    batches[7].append(("once", 1, None, -1))
    docs = KeyedDocuments(spark, scratch_dir(spark, "docs"), ["k", "sub"], ["seq"], buckets=4,
                          snapshot_every=30)
    for b, rows in enumerate(batches):
        assert docs.add(spark.createDataFrame(rows, DOCS).coalesce(1), b)
    assert not docs.add(spark.createDataFrame(batches[3], DOCS), 3)  # long since in a snapshot
    assert not docs.add(spark.createDataFrame(batches[199], DOCS), 199)
    current = docs.read()
    assert sorted((tuple(r) for r in current.collect()), key=repr) == last_of(batches)
    # 200 batches: the buckets of one snapshot and the batches after it (200 - 180).
    assert len(current.inputFiles()) <= 4 + 20
    one = docs.get("a", 2)
    assert [tuple(r) for r in one.collect()] == [r for r in last_of(batches) if r[:2] == ("a", 2)]
    assert docs.get(None, 1).count() == 1 and docs.get("none", 1).count() == 0
    plan = docs.get("a", 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__bucket" in plan


def test_documents_survive_a_crash_while_a_snapshot_is_made(spark, monkeypatch):
    batches = [[("a", 1, 1, b), ("b", b, 1, b)] for b in range(4)]
    path = scratch_dir(spark, "docs")
    docs = KeyedDocuments(spark, path, ["k", "sub"], ["seq"], buckets=2, snapshot_every=2)
    for b in (0, 1, 2):
        docs.add(spark.createDataFrame(batches[b], DOCS), b)
    with monkeypatch.context() as m:
        crashing(m)
        with pytest.raises(Crash):
            docs.add(spark.createDataFrame(batches[3], DOCS), 3)
    assert sorted((tuple(r) for r in docs.read().collect()), key=repr) == last_of(batches[:3])
    docs = KeyedDocuments(spark, path, ["k", "sub"], ["seq"], buckets=3, snapshot_every=2)
    docs.add(spark.createDataFrame(batches[3], DOCS), 3)
    assert sorted((tuple(r) for r in docs.read().collect()), key=repr) == last_of(batches)


def test_quantiles_of_merged_batches(spark):
    # Skewed lags over many batches, merged again and again: the rank error stays within its bound.
    rows = spark.range(60_000).select(
        (F.col("id") % 3).alias("camera_id"),
        F.timestamp_micros(F.lit(0)).alias("a"),
        F.timestamp_micros((F.pow(F.rand(4), 5) * 1e9).cast("long")).alias("b"),
        (F.col("id") % 20).alias("part")).cache()
    kept = R.Rollup(spark, scratch_dir(spark, "lag"), ["camera_id"], R.lag_measures("a", "b"), 4)
    for b in range(20):
        kept.add(rows.where(F.col("part") == b).drop("part"), b)
    got = R.lag_stats(kept).collect()
    assert {r.camera_id: r.n for r in got} == {0: 20_000, 1: 20_000, 2: 20_000}
    for r in got:
        lags = [x.lag for x in rows.where(F.col("camera_id") == r.camera_id).select(
            (F.unix_micros("b") / F.lit(1e6)).alias("lag")).collect()]
        assert (r.min_lag_s, r.max_lag_s) == (min(lags), max(lags))
        for p, at in ((0.5, r.p50_lag_s), (0.95, r.p95_lag_s), (0.99, r.p99_lag_s)):
            assert abs(sum(x <= at for x in lags) / len(lags) - p) <= 0.004
    rows.unpersist()


def test_distinct_sketches_of_batches(spark):
    rows = spark.range(40_000).select((F.col("id") % 2).alias("g"), (F.col("id") % 9000).alias("v"),
                                      (F.col("id") % 13).alias("batch"))
    rows = rows.unionAll(spark.range(5).select(F.lit(2).alias("g"), F.lit(None).alias("v"), "id"))
    parts = distinct_sketches(rows, ["batch", "g"], "v", lg_k=12)
    about = {r.g: r.n for r in distinct_estimates(parts, "g", "n").collect()}
    whole = {r.g: r.n for r in distinct_estimates(distinct_sketches(rows, "g", "v"), "g", "n").collect()}
    exact = {r.g: r.n_distinct for r in count_distinct_by(rows, "g", "v").collect()}
    near = {r.g: r.n_distinct for r in count_distinct_by(rows, "g", "v", approx=True).collect()}
    assert about[2] == whole[2] == exact[2] == near[2] == 0
    for g in (0, 1):
        for found, error in ((about, 1.04 / 64), (whole, 1.04 / 64), (near, 0.01)):
            assert abs(found[g] - exact[g]) <= 3 * error * exact[g]

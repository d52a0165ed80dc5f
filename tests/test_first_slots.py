"""First frame per bucket: the state goes with buckets and slots, however many cameras there are."""

from tessera.session import scratch_dir
from tessera.streaming.store import read_table

from .test_first import put, run


def test_state_of_many_cameras_is_kept_by_slot(spark):
    path, out, ckpt = (scratch_dir(spark, n) for n in ("in", "out", "ckpt"))
    cameras = [None, *(f"c{n}" for n in range(80))]
    for n, part in enumerate((".9", ".6", ".3", ".1")):  # ever better frames: the images held are replaced
        put(spark, path, [(c, f"{c}-{n}", f"2030-05-06 07:00:00{part}") for c in cameras], n)
    query = run(spark, path, out, ckpt, slots=4)
    # Rows, ranks, images and a timer for each slot, not for each camera.
    assert 0 < query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4 * 6
    put(spark, path, [("far", "far", "2030-05-06 07:00:59")], 4)
    put(spark, path, [("far", "far too", "2030-05-06 07:00:59.5")], 5)  # the bucket leaves
    put(spark, path, [("c1", "late", "2030-05-06 07:00:00")], 6)
    run(spark, path, out, ckpt, slots=4)
    rows = read_table(spark, out).collect()
    assert sorted(r.frame_id for r in rows) == sorted([f"{c}-{n}" for c in cameras for n in range(4)] + ["late"])
    assert {r.frame_id: r.image_bytes.decode() for r in rows if r.image_bytes is not None} == {
        f"{c}-3": f"{c}-3" for c in cameras}
    assert {r.frame_id for r in rows if r.late} == {"late"}
    # The path of a camera without a name is NULL, as that of a frame that is not the first.
    assert {r.frame_id for r in rows if r.image_path} == {f"{c}-3" for c in cameras if c}


def test_a_frame_without_a_time_leaves_other_buckets_alone(spark):
    path, out, ckpt = (scratch_dir(spark, n) for n in ("in", "out", "ckpt"))
    frames = [(c, f"{c}{n}", f"2030-05-06 07:00:0{n}.5") for c in "abc" for n in range(5)]
    put(spark, path, [*frames, ("a", "no time", None)], 0)
    put(spark, path, [("far", "far", "2030-05-06 07:00:59")], 1)
    run(spark, path, out, ckpt, slots=1)
    rows = read_table(spark, out).where("camera_id <> 'far'").collect()
    assert sorted(r.frame_id for r in rows) == sorted([*(f for _, f, _ in frames), "no time"])
    assert {r.frame_id for r in rows if r.image_path} == {f for _, f, _ in frames}
    assert {r.frame_id for r in rows if r.late} == {"no time"}

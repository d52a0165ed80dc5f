"""One CSV file written by many tasks."""

import os

from pyspark.sql import functions as F

from tessera.session import scratch_dir
from tessera.sinks.files import join_files, part_files, write_single_csv


def only_file(path):
    folder = path.removeprefix("file:")
    names = [n for n in os.listdir(folder) if not n.startswith((".", "_"))]
    assert len(names) == 1
    with open(os.path.join(folder, names[0]), "rb") as f:
        return f.read()


def by_one_task(df, path, **options):
    df.coalesce(1).write.option("header", True).options(**options).csv(path)
    return only_file(path)


def test_same_bytes_as_one_task(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 7 == 0, F.lit('a,"b"\nç')).when(
        F.col("id") % 7 == 1, F.lit("")).otherwise(F.lit(" x")).alias("te,xt"), (F.col("id") / 3).alias("v"))
    for df in (rows.repartitionByRange(9, "id").sortWithinPartitions("id"), rows.where("id < 3").coalesce(1),
               rows.where("id < 0")):
        path = scratch_dir(spark, "one csv")
        write_single_csv(df, path)
        assert only_file(path) == by_one_task(df, scratch_dir(spark, "want"))
        write_single_csv(df, path, sep=";")  # overwrites
        assert only_file(path) == by_one_task(df, scratch_dir(spark, "want"), sep=";")
    path = scratch_dir(spark, "bare")
    write_single_csv(rows, path, header=False)
    assert only_file(path).count("ç".encode()) == 143 and not only_file(path).startswith(b"id")
    parent = os.path.dirname(path.removeprefix("file:"))
    assert not [n for n in os.listdir(parent) if "._work-" in n]


def test_every_part_is_copied_by_its_own_task(spark):
    src, out = scratch_dir(spark, "parts"), scratch_dir(spark, "joined") + ".bin"
    spark.range(5000).select(F.col("id").cast("string")).repartitionByRange(
        12, "id").sortWithinPartitions("id").write.text(src)
    parts = part_files(spark, src)
    assert len(parts) == 12
    for _ in range(2):  # copying again changes nothing
        join_files(spark, parts, out)
        with open(out.removeprefix("file:"), "rb") as f:
            whole = f.read()
        assert whole == b"".join(open(p.removeprefix("file:"), "rb").read() for p, _ in parts)
    join_files(spark, [], out)
    assert os.path.getsize(out.removeprefix("file:")) == 0

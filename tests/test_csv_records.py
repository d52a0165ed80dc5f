"""Quoted CSV with line breaks, read in splits: equal to Spark's one-task reader on the same files."""

import csv
import os
import random

import pytest
from pyspark.sql import types as T

from tessera.sources.text import read_csv_records, read_csv_table

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()),
                       T.StructField("b c", T.DoubleType()), T.StructField("d", T.StringType())])


def write(path, rows, end="\n", header=("id", "a", "b c", "d")):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, delimiter=";", lineterminator=end)
        out.writerow(header)
        out.writerows(rows)


def texts(rng):
    bits = ["x", "ä", ";", '"', "\n", '"\n', '";"', " ", "end", "\n\n", "word " * 9, "1"]
    return "".join(rng.choices(bits, k=rng.choice([1, 2, 5, 30])))


def both(spark, path, split):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    want = sorted(map(tuple, read_csv_table(spark, path, SCHEMA, multi_line=True).collect()), key=repr)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = sorted(map(tuple, read_csv_records(spark, path, SCHEMA).collect()), key=repr)
        tasks = spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return got, want, tasks


@pytest.mark.parametrize("split", [37, 200, 1 << 20])
def test_records_over_many_splits(spark, tmp_dir, split):
    rng = random.Random(split)
    for name in ("one.csv", "two.csv"):
        rows = [(i, "t" + texts(rng) + "e", rng.choice(["", "1.5", "x"]), "q" + texts(rng)) for i in range(60)]
        write(os.path.join(tmp_dir, name), [[c.rstrip() if isinstance(c, str) else c for c in r] for r in rows])
    got, want, tasks = both(spark, tmp_dir, split)
    assert got == want and len(got) == 120
    assert tasks > (50 if split == 37 else 1)  # files are read by many tasks


def test_one_field_over_several_splits(spark, tmp_dir):
    write(os.path.join(tmp_dir, "f.csv"), [(1, "s\n" + "line\n" * 400 + "e", 1.0, "x"), (2, "p", 2.0, "y")])
    got, want, tasks = both(spark, tmp_dir, 64)
    assert got == want and len(got) == 2 and got[0][1].count("\n") == 401 and tasks > 20


def test_edges(spark, tmp_dir):
    path = os.path.join(tmp_dir, "e.csv")
    body = ('"id";"a\nwith a break";b c;d\n\n1;"two ""quoted""\nlines";3.5;""\n2;;;\n\n'
            '3;"semi;colon";nan;"last\r\nbreak"\n4;short\n5;"open at the end\nof the file')
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(body)
    got, want, _ = both(spark, path, 16)
    assert got[:3] == want[:3] and [r[0] for r in got] == [1, 2, 3, 4, 5]
    assert got[0][1] == 'two "quoted"\nlines' and got[2][3] == "last\r\nbreak" and got[4][1].endswith("of the file")
    crlf = os.path.join(tmp_dir, "crlf.csv")
    write(crlf, [(1, "a\nb", 1.5, "z"), (2, "c", "", "y")], end="\r\n")
    assert [tuple(r) for r in read_csv_records(spark, crlf, SCHEMA).orderBy("id").collect()] == [
        (1, "a\nb", 1.5, "z"), (2, "c", None, "y")]
    empty = os.path.join(tmp_dir, "empty.csv")
    write(empty, [])
    assert read_csv_records(spark, empty, SCHEMA).count() == 0
    assert read_csv_records(spark, crlf, SCHEMA, header=False).count() == 3

"""Boxes of scored frames by columns; batches of a stream's input in as many files as a shuffle has tasks."""

import os

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_type

from tessera.functions.detections import BOXES_TYPE
from tessera.plans import q_streaming as Q
from tessera.session import scratch_dir
from tessera.streaming import frames as S

from .conftest import SF_SMALL


def test_box_lists():
    kind = to_arrow_type(BOXES_TYPE).value_type
    box = {"x1": 1, "y1": 2.5, "x2": 3.0, "y2": 4.0, "confidence": 0.5, "class_id": 0, "class_name": "a"}
    got = S._box_lists([[box], None, [], [{**box, "x1": None}, {"x1": 7.0}]], kind).to_pylist()
    none = dict.fromkeys(box)
    assert got == [[box], None, [], [{**box, "x1": None}, {**none, "x1": 7.0}]]
    assert S._box_lists([], kind).to_pylist() == []
    assert S._box_lists([None], kind).type.equals(pa.list_(kind))


def test_messages_of_a_batch_are_written_by_many_tasks(spark):
    each = Q.files_per_batch(spark, 2)
    assert each == int(spark.conf.get("spark.sql.shuffle.partitions")) // 2
    folder = Q.write_messages(spark, SF_SMALL, scratch_dir(spark, "msgs"), copies=2, files=2 * each)
    files = [f for f in os.listdir(folder.removeprefix("file:")) if f.endswith(".json")]
    assert len(files) == 4 * each
    read = spark.read.schema(S.MESSAGE_SCHEMA).json(folder)
    assert read.count() == 2 * spark.read.parquet(f"{SF_SMALL}/events.parquet").count()

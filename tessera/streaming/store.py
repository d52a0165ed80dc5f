"""Idempotent stream storage with ``foreachBatch``.

* ``append_batch`` — the batch goes to ``<table>/batch_id=<n>`` with overwrite of that folder
  only, so a batch replayed after a failure rewrites the same files (no duplicates from
  replays; duplicates *in the data* are kept, like an append-only store).
* ``read_latest`` — keyed documents as a view of that table: per key the row of the last batch, and
  within a batch the last by a unique order.  Rows are cut to one per key in each task before the
  shuffle, so a hot key never gathers its rows.
* ``first_frames`` / ``image_winners`` — the first frame of each (camera, time bucket) keeps its
  image.  First means least (source time, frame id).  A micro-batch stores the images of its own
  first frames; the least of those least ones is the winner.  The answer does not depend on the order
  of arrival, on how batches are cut or on restarts, and no state has to expire.
* ``store_results`` — wires these into one streaming query with a checkpoint (exactly-once with a
  replayable source such as Kafka or files).
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.rank import top_n_per_group
from tessera.streaming.first import write_images
from tessera.streaming.keyed import KeyedDocuments
from tessera.streaming.versions import Versions


def append_batch(batch: DataFrame, batch_id: int, table_path: str) -> None:
    """Write one micro-batch to its own partition folder (replay-safe)."""
    batch.write.mode("overwrite").parquet(f"{table_path.rstrip('/')}/batch_id={int(batch_id)}")


def read_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The append-only table (all batches), without the batch folder column."""
    return spark.read.parquet(table_path).drop("batch_id")


def read_latest(spark: SparkSession, table_path: str, keys: Sequence[str],
                order: Sequence[str] = ()) -> DataFrame:
    """Current document per key: last ``batch_id``, then last ``order`` (e.g. the source offset), then
    the greater hash of the row, so that the choice is never arbitrary."""
    rows = spark.read.parquet(table_path)
    plain = [c for c, kind in rows.dtypes if not kind.startswith("map")]
    last = [F.desc("batch_id"), *[F.col(c).desc_nulls_last() for c in order],
            F.xxhash64(*plain).desc()]
    return top_n_per_group(rows, list(keys), last, 1).drop("batch_id")


def first_frames(frames: DataFrame, *, camera: str = "camera_id", ts: str = "source_ts",
                 tie: str = "frame_id", unit: str = "second") -> DataFrame:
    """The row of least (``ts``, ``tie``) of each (camera, ``unit`` bucket)."""
    bucketed = frames.withColumn("__bucket", F.date_trunc(unit, F.col(ts)))
    least = [F.asc(ts), F.asc(tie)]
    return top_n_per_group(bucketed, [camera, "__bucket"], least, 1).drop("__bucket")


def image_winners(spark: SparkSession, images_path: str, **options) -> DataFrame:
    """Of the images that the micro-batches stored, the one that each bucket keeps."""
    return first_frames(read_table(spark, images_path), **options)


def store_results(stream: DataFrame, *, table_path: str, checkpoint: str,
                  dead_path: str | None = None, images_path: str | None = None,
                  image: str = "image_bytes", error: str = "error",
                  stamp: str | None = "stored_ts", trigger: dict | None = None,
                  query_name: str | None = None, first: dict | None = None,
                  documents: KeyedDocuments | None = None,
                  image_folder: str | None = None) -> StreamingQuery:
    """Start a query that appends every batch to the table, and to the keyed ``documents`` if given.

    With ``image_folder``, rows that carry an ``image_path`` have their ``image`` written there as a file
    (before the row is stored, so every stored path names a file), and the table leaves the bytes out.

    With ``dead_path``, rows with an ``error`` go there and the others to the table; with
    ``images_path``, the batch's first frames (``first``: options of :func:`first_frames`) go there
    with their ``image``, which the table leaves out.  Upstream stages run once per batch: what is
    written several times is persisted first, stamped with one time.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if stamp:
            now = dt.datetime.now(dt.timezone.utc)
            batch = batch.withColumn(stamp, F.lit(now))
        shared = any(x is not None for x in (dead_path, images_path, documents, image_folder))
        rows = batch.persist() if shared else batch
        try:
            good = rows
            if dead_path is not None:
                append_batch(rows.where(F.col(error).isNotNull()).drop(image), batch_id, dead_path)
                good = rows.where(F.col(error).isNull()).drop(error)
            if images_path is not None:
                append_batch(first_frames(good, **(first or {})), batch_id, images_path)
                good = good.drop(image)
            if image_folder is not None:
                write_images(good, image_folder, image=image)
                good = good.drop(image)
            append_batch(good, batch_id, table_path)
            if documents is not None:
                documents.add(good, batch_id)
        finally:
            if shared:
                rows.unpersist()

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def write_json_stream(stream: DataFrame, *, fmt: str = "kafka", checkpoint: str,
                      path: str | None = None, options: dict | None = None,
                      key: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """JSON message sink: each row becomes ``value = to_json(struct(*))`` (and ``key``).

    ``fmt='kafka'`` writes to the topic given in ``options`` (e.g. ``{"kafka.bootstrap.servers":
    ..., "topic": ...}``); ``fmt='json'`` / ``'text'`` writes the messages as files under ``path``
    (append mode; the file sink is exactly-once with the checkpoint).
    """
    if fmt != "kafka" and key:
        raise ValueError("file sinks carry only the value; drop key= or use kafka")
    cols = [F.to_json(F.struct(*[F.col(c) for c in stream.columns])).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    msgs = stream.select(*cols)
    w = msgs.writeStream.format("text" if fmt == "json" else fmt).outputMode("append") \
        .option("checkpointLocation", checkpoint).options(**(options or {}))
    if path:
        w = w.option("path", path)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def write_complete(stream: DataFrame, path: str, checkpoint: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Complete-mode aggregate -> each batch's full result as the next version of the table at ``path``
    (:func:`read_complete`); the one before stays readable until the new one is published."""
    def write(batch: DataFrame, batch_id: int) -> None:
        versions = Versions(batch.sparkSession, path)
        number, _ = versions.current()
        folder = versions.folder(f"batch-{batch_id}")
        batch.write.parquet(versions.full(folder))
        versions.publish(number, {"folder": folder})
        versions.prune()

    return stream.writeStream.outputMode("complete").foreachBatch(write) \
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    """The newest published result of :func:`write_complete`."""
    versions = Versions(spark, path)
    _, content = versions.current()
    if not content:
        raise ValueError(f"no result is published under {path}")
    return spark.read.parquet(versions.full(content["folder"]))


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query; re-raise its failure."""
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"stream failed: {exc}")


def supervise(start: Callable[[], StreamingQuery], *, limit: int = 5, pause_s: float = 5.0,
              healthy_s: float = 600.0, wait: Callable[[float], object] = time.sleep) -> int:
    """Run a query to its end, starting it again from its checkpoint when it fails; the number of restarts.

    ``start`` defines and starts the query (with the same checkpoint each time).  After a failure it is
    called again once ``pause_s`` has passed.  After ``limit`` failures in a row the last one is raised; a
    run of at least ``healthy_s`` seconds begins a new row.  A query that is stopped is not restarted.
    """
    failures = restarts = 0
    while True:
        began = time.monotonic()
        try:
            query = start()  # a source that cannot be reached may fail here already
            run_to_end(query)
            return restarts
        except Exception:
            failures = 1 if time.monotonic() - began >= healthy_s else failures + 1
            if failures > limit:
                raise
        restarts += 1
        wait(pause_s)

"""First frame per camera and time bucket, decided while the stream runs.

Every frame is passed on; the first of its (camera, bucket) by (source time, frame id) carries the image
and the image's path.  A bucket's frames wait in keyed state until the watermark is past the bucket's end,
then all leave together; so arrival order, batch cuts and restarts do not matter for frames that are at
most ``delay`` late.  Later ones are passed on at once and marked ``late``:

* within ``retain`` of the bucket's closing the state still knows whether the image is taken: if it is, the
  late frame goes without; if no frame had come at all, the late one takes it;
* after that the state of the bucket is gone, and a late frame goes without.

State holds frames of open buckets (one image for each camera, at most as many again that better ones have
replaced) and a mark per camera and bucket closed within ``retain``; it is kept by RocksDB (set on the
session when the query is defined, before it starts).  The state's key is the bucket and a slot of cameras.

:func:`write_images` puts the images of a batch into files: tasks write to a folder of their own attempt
and the files are moved to their final names once the whole batch is written.  A replay finds them there.
:func:`image_files` lists them.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_OUT = "body string, first boolean, late boolean, image binary"


class _FirstFrame(StatefulProcessor):
    """All cameras of one slot and bucket share a state, which is read and appended to as a whole: calls of
    the state store go with the groups, not with the frames.

    The watermark trails the greatest time by the delay: a bucket closes when it is past its end.
    """

    def __init__(self, retain_ms: int) -> None:
        self.retain_ms = retain_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "camera string, rank string, body string")
        self.ranks = handle.getListState("ranks", "camera string, rank string")  # each less than the one before
        self.images = handle.getListState("images", "camera string, rank string, image binary")  # of ranks
        self.taken = handle.getListState("taken", "camera string")

    def _best(self) -> tuple[dict, int]:
        """Least rank of every camera that waits, and how many ranks are held."""
        held = list(self.ranks.get())
        return dict(held), len(held)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now, out, waiting, fresh, new = timerValues.getCurrentWatermarkInMs(), [], [], {}, []
        taken = best = None
        for pdf in rows:
            ends = int(pdf["ends"].iloc[0])
            if ends + self.retain_ms <= now:
                out += [(body, False, True, None) for body in pdf["body"]]
                continue
            if best is None:
                best, held = self._best()
                taken = {c for c, in self.taken.get()} if ends <= now else set()
            for camera, body, rank, image in zip(pdf["camera"], pdf["body"], pdf["rank"], pdf["image"]):
                if camera in taken:
                    out.append((body, False, True, None))
                elif ends <= now and camera not in best:  # nothing came in time
                    taken.add(camera)
                    new.append((camera,))
                    out.append((body, True, True, image))
                else:
                    waiting.append((camera, rank, body))
                    if camera not in best or rank < best[camera]:
                        best[camera] = rank
                        fresh[camera] = image
        if new:
            self.taken.appendList(new)
            self.handle.registerTimer(ends + self.retain_ms)
        if waiting:
            self.rows.appendList(waiting)
            self.handle.registerTimer(ends)
        if fresh:
            self._hold(best, held, fresh)
        yield from _frames(out)

    def _hold(self, best: dict, held: int, fresh: dict) -> None:
        """Append the images of new least ranks; those that they replace go once they are the greater part."""
        images = [(camera, best[camera], image) for camera, image in fresh.items()]
        if held + len(images) <= 2 * len(best):
            self.images.appendList(images)
            self.ranks.appendList([row[:2] for row in images])
            return
        images += [row for row in self.images.get() if row[0] not in fresh and row[1] == best[row[0]]]
        self.images.put(images)
        self.ranks.put([row[:2] for row in images])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        best, _ = self._best()
        if not best:
            self.taken.clear()
            return
        out, firsts = [], {}
        for camera, rank, body in self.rows.get():
            if rank == best[camera] and camera not in firsts:  # equal rows: one of them
                firsts[camera] = body
            else:
                out.append((body, False, False, None))
        yield from _frames(out)
        out = []
        for camera, rank, image in self.images.get():
            if rank == best[camera]:
                out.append((firsts[camera], True, False, image))
                if len(out) == 256:
                    yield from _frames(out)
                    out = []
        yield from _frames(out)
        for state in (self.rows, self.ranks, self.images):
            state.clear()
        self.taken.appendList([(camera,) for camera in best])
        self.handle.registerTimer(expiredTimerInfo.getExpiryTimeInMs() + self.retain_ms)

    def close(self) -> None:
        pass


def _frames(out: list[tuple]) -> Iterator[pd.DataFrame]:
    if out:
        yield pd.DataFrame(out, columns=["body", "first", "late", "image"])


def _sortable(column: Column, kind: T.DataType) -> Column:
    """Text that orders as the values do, NULL first."""
    if isinstance(kind, T.StringType):
        text = column
    else:
        flipped = column.cast("long").bitwiseXOR(F.lit(-(1 << 63)))
        text = F.lpad(F.hex(flipped), 16, "0")
    return F.coalesce(F.concat(F.lit("1"), text), F.lit("0"))


def image_path(camera: str | Column, bucket: Column, fmt: str = "yyyyMMdd_HHmmss", prefix: str = "") -> Column:
    """``<prefix><camera>_<bucket>.jpg``; ``%``, ``/`` and the backslash of a camera's name are
    percent-encoded, so no name leads out of the folder and no two share a path."""
    name = (F.col(camera) if isinstance(camera, str) else camera).cast("string")
    for mark, code in (("%", "%25"), ("/", "%2F"), ("\\", "%5C")):
        name = F.replace(name, F.lit(mark), F.lit(code))
    return F.concat(F.lit(prefix), name, F.lit("_"), F.date_format(bucket, fmt), F.lit(".jpg"))


def mark_first_stream(frames: DataFrame, *, camera: str = "camera_id", ts: str = "source_ts",
                      tie: str = "frame_id", image: str | None = "image_bytes", unit: str = "second",
                      delay: str = "10 seconds", retain: str = "1 hour", fmt: str = "yyyyMMdd_HHmmss",
                      path_prefix: str = "", path_col: str = "image_path", slots: int = 8) -> DataFrame:
    """``frames`` (a stream) with ``path_col`` and ``late``; ``image`` stays with first frames only.

    The first frame of each (``camera``, ``unit`` of ``ts``) by (``ts``, ``tie``) gets the path.  A frame
    without a time is passed on as late.  The cameras of a bucket are dealt into ``slots`` groups, which is
    how many tasks work on one bucket (fixed for the life of a checkpoint).
    """
    spark = frames.sparkSession
    spark.conf.set(PROVIDER, ROCKSDB)
    body = frames.drop(image) if image else frames
    bucket = F.date_trunc(unit, F.col(ts))
    ends = F.unix_millis(bucket + F.expr(f"INTERVAL 1 {unit}"))
    rank = F.concat(_sortable(F.unix_micros(ts), T.LongType()),
                    _sortable(F.col(tie), frames.schema[tie].dataType))
    packed = frames.select(
        F.col(camera).cast("string").alias("camera"),
        # No NULL in a key: pandas turns the buckets beside it into floats, whose states then mix.
        F.coalesce(F.unix_micros(bucket), F.lit(-(1 << 62))).alias("bucket"),
        F.pmod(F.xxhash64(F.col(camera).cast("string")), F.lit(slots)).alias("slot"),
        F.coalesce(ends, F.lit(-(1 << 60))).alias("ends"), rank.alias("rank"),
        F.to_json(F.struct(*body.columns), {"timestampFormat": STAMP}).alias("body"),
        (F.col(image) if image else F.lit(None).cast("binary")).alias("image"), F.col(ts).alias("__time"))
    # The time column is left out behind the watermark: late frames reach the operator, which knows the
    # watermark all the same.
    keyed = packed.withWatermark("__time", delay).drop("__time").groupBy("slot", "bucket")
    retain_ms = spark.range(1).select(F.unix_millis(
        F.timestamp_millis(F.lit(0)) + F.expr(f"INTERVAL {retain}"))).first()[0]
    marked = keyed.transformWithStateInPandas(_FirstFrame(retain_ms), _OUT, "Append", "EventTime")
    rows = marked.select(F.from_json("body", body.schema, {"timestampFormat": STAMP}).alias("r"), "first",
                         "late", "image")
    path = F.when(F.col("first"), image_path(F.col(f"r.{camera}"), F.date_trunc(unit, F.col(f"r.{ts}")), fmt,
                                             path_prefix))
    found = [path.alias(path_col), "late"] + ([F.col("image").alias(image)] if image else [])
    return rows.select("r.*", *found)


# ---- images as files

def _file_system(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _put(draft: str, path_col: str, image: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = _file_system(draft)
        made = False
        for pdf in batches:
            drafts = []
            for data in pdf[image]:
                name = uuid.uuid4().hex
                if not made:
                    files.create_dir(root, recursive=True)
                    made = True
                with files.open_output_stream(f"{root}/{name}") as f:
                    f.write(bytes(data))
                drafts.append(name)
            yield pd.DataFrame({path_col: pdf[path_col], "draft": drafts,
                                "length": [len(x) for x in pdf[image]]})
    return run


def _settle(draft: str, final: str, path_col: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileType
        files, source = _file_system(draft)
        _, root = _file_system(final)
        made = set()
        for pdf in batches:
            for path, name in zip(pdf[path_col], pdf["draft"]):
                target = f"{root}/{path}"
                above = target.rpartition("/")[0]
                if above not in made:
                    files.create_dir(above, recursive=True)
                    made.add(above)
                # A task that is run again has moved its drafts already.
                if files.get_file_info(f"{source}/{name}").type == FileType.File:
                    files.move(f"{source}/{name}", target)
            yield pdf[[path_col, "length"]]
    return run


def write_images(rows: DataFrame, folder: str, *, path_col: str = "image_path", image: str = "image_bytes"
                 ) -> None:
    """The images of the rows that have a path, as files ``<folder>/<path>`` (a shared folder).

    Tasks write drafts; one table of the drafts of the successful tasks is stored, and only those are
    moved to their names, so no reader sees half a file and a task that is run twice leaves one file.
    """
    from tessera.streaming.versions import Versions

    folder = folder.rstrip("/")
    attempt = f"{folder}/_drafts/{uuid.uuid4().hex}"
    wanted = rows.where(F.col(path_col).isNotNull() & F.col(image).isNotNull()).select(path_col, image)
    kind = "string, draft string, length long"
    wanted.mapInPandas(_put(f"{attempt}/files", path_col, image), f"{path_col} {kind}").write.parquet(
        f"{attempt}/list")
    listed = rows.sparkSession.read.parquet(f"{attempt}/list")
    listed.mapInPandas(_settle(f"{attempt}/files", folder, path_col), f"{path_col} string, length long") \
        .write.format("noop").mode("overwrite").save()
    versions = Versions(rows.sparkSession, folder)
    versions.fs.delete(versions._path(attempt), True)


# ---- the image files of a folder

def _store(folder: str):
    """File system and root of a folder that Hadoop has qualified (whose ``file:`` paths are not encoded)."""
    from pyarrow.fs import LocalFileSystem
    return (LocalFileSystem(), folder.removeprefix("file:")) if folder.startswith("file:") else _file_system(folder)


def _entries(files, at: str) -> Iterator[tuple[str, bool]]:
    """Name of everything in one folder, and whether it is a folder.

    Local and mounted folders are read as a stream, however much is in them; other stores list a folder whole.
    """
    from pyarrow.fs import FileSelector, FileType, LocalFileSystem
    if isinstance(files, LocalFileSystem):
        with os.scandir(at) as found:
            for entry in found:
                yield entry.name, entry.is_dir()
    else:
        for info in files.get_file_info(FileSelector(at)):
            yield info.base_name, info.type == FileType.Directory


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _image_names(folder: str, size: int = 10_000):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _ in batches:
            files, root = _store(folder)
            above, names = [""], []
            while above:
                at = above.pop()
                for name, is_folder in _entries(files, f"{root}/{at}".rstrip("/")):
                    if _hidden(name):
                        continue
                    if is_folder:
                        above.append(f"{at}{name}/")
                    elif name.endswith(".jpg"):
                        names.append(at + name)
                        if len(names) == size:
                            yield pd.DataFrame({"name": names})
                            names = []
            yield pd.DataFrame({"name": names}, dtype=object)
    return run


def _lengths(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileType
        files, root = _store(folder)
        for pdf in batches:
            found = files.get_file_info([f"{root}/{name}" for name in pdf["name"]])
            if gone := [info.path for info in found if info.type == FileType.NotFound]:
                raise FileNotFoundError(f"{len(gone)} images were removed while they were listed: {gone[:3]}")
            yield pd.DataFrame({"path": [f"{folder}/{name}" for name in pdf["name"]],
                                "length": [info.size for info in found]})
    return run


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, length`` of the image files below ``folder``, whatever wrote them.

    Spark's own readers hold the status of every file in the driver.  Here a task reads the names as a
    stream, and as many tasks as a shuffle has look the files up; the driver sees none of them.
    """
    from tessera.streaming.versions import Versions

    at = Versions(spark, folder)
    top = at.fs.makeQualified(at._path(at.path))
    if not at.fs.exists(top):
        raise AnalysisException(f"[PATH_NOT_FOUND] Path does not exist: {top.toString()}.")
    names = spark.range(1, numPartitions=1).mapInPandas(_image_names(top.toString()), "name string")
    dealt = names.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "name")
    return dealt.mapInPandas(_lengths(top.toString()), "path string, length long")

"""File sinks: formatted text lines, TSV, single-file CSV, JSON lines.

Writers never collect: every one is a distributed ``DataFrameWriter`` job, also where one file is to come
of it.
"""

from __future__ import annotations

import shutil
import uuid
from collections.abc import Sequence
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def format_lines(df: DataFrame, template: str, cols: Sequence[str | Column], out: str = "value") -> DataFrame:
    """One formatted text value per row (``printf``-style template, e.g. ``"%-15s %.2f"``)."""
    return df.select(F.format_string(template, *[F.col(c) if isinstance(c, str) else c for c in cols])
                     .alias(out))


def write_lines(df: DataFrame, template: str, cols: Sequence[str | Column], path: str,
                mode: str = "errorifexists") -> None:
    """Formatted lines, one file per partition; fails if ``path`` exists unless ``mode`` says so."""
    format_lines(df, template, cols).write.mode(mode).text(path)


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = False) -> None:
    """Tab-separated text, one file per partition."""
    df.write.mode(mode).option("sep", "\t").option("header", header) \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_csv(df: DataFrame, path: str, *, sep: str = ";", header: bool = True,
              mode: str = "overwrite") -> None:
    """Header CSV with RFC-4180 quoting (``""`` inside quoted fields), whitespace preserved."""
    df.write.mode(mode).option("header", header).option("sep", sep).option("quote", '"') \
        .option("escape", '"').option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)


def write_single_csv(df: DataFrame, path: str, *, sep: str = ",", header: bool = True) -> None:
    """One CSV file with header (overwrite), in a folder ``path`` of its own, written by many tasks.

    The rows are written as part files in parallel, in the order of the result's partitions; their byte
    counts give each its place in the one file, and tasks copy them there side by side
    (:func:`join_files`).  No task sees all rows, and nothing passes through the driver but file names.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    work = f"{path}._work-{uuid.uuid4().hex[:12]}"
    df.write.option("sep", sep).csv(f"{work}/rows")
    if header:
        df.limit(0).coalesce(1).write.option("sep", sep).option("header", True).csv(f"{work}/header")
    parts = [f for name in ("header", "rows") for f in part_files(spark, f"{work}/{name}")]
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(work).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop.Path(f"{work}/done"))
    join_files(spark, parts, f"{work}/done/part-00000.csv")
    files.delete(hadoop.Path(path), True)
    if not files.rename(hadoop.Path(f"{work}/done"), hadoop.Path(path)):
        raise OSError(f"cannot move the file to {path}")
    files.delete(hadoop.Path(work), True)


def part_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Path and length of a folder's part files, in order; empty ones left out."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(folder)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return []
    found = [(f.getPath().toString(), f.getLen()) for f in files.listStatus(at)]
    return sorted((p, n) for p, n in found if n and p.rpartition("/")[2].startswith("part-"))


def join_files(spark: SparkSession, parts: Sequence[tuple[str, int]], target: str) -> None:
    """The parts (path, length) one after the other as the file ``target``.

    On a shared folder (``file:``) every part is copied to its offset by a task of its own, any number of
    times with the same result.  Where the file system can join files by itself (HDFS) it does.  Others
    have no way to write one file from many tasks: there one task copies the bytes in small blocks.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(target)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getScheme() == "hdfs" and parts:
        paths = spark.sparkContext._gateway.new_array(hadoop.Path, len(parts) - 1)
        for k, (part, _) in enumerate(parts[1:]):
            paths[k] = hadoop.Path(part)
        if len(parts) > 1:
            files.concat(hadoop.Path(parts[0][0]), paths)
        files.rename(hadoop.Path(parts[0][0]), at)
        return
    local = files.getScheme() == "file"
    if local:  # written past Hadoop's checksum files
        files = files.getRawFileSystem()
    files.create(at, True).close()
    offset, rows = 0, []
    for part, n in parts:
        rows.append((part, offset, n))
        offset += n
    if not rows:
        return
    todo = spark.createDataFrame(rows, "part string, offset long, n long")
    todo = todo.repartition(min(len(rows), 1000)) if local else todo.coalesce(1).sortWithinPartitions(
        "offset")
    place = files.makeQualified(at).toString()
    todo.mapInPandas(_copy_at(place) if local else _copy_after(place), "n long").write.format(
        "noop").mode("overwrite").save()
    if files.getFileStatus(at).getLen() != offset:
        raise OSError(f"{target} has {files.getFileStatus(at).getLen()} bytes instead of {offset}")


def _plain(uri: str) -> str:
    return unquote(urlparse(uri).path) if uri.startswith("file:") else uri


def _copy_at(target: str):
    def run(batches):
        for pdf in batches:
            with open(_plain(target), "r+b") as out:
                for part, offset in zip(pdf["part"], pdf["offset"]):
                    out.seek(offset)
                    with open(_plain(part), "rb") as src:
                        shutil.copyfileobj(src, out, 1 << 20)
            yield pdf[["n"]]
    return run


def _copy_after(target: str):
    def run(batches):
        from pyarrow import fs
        files, place = fs.FileSystem.from_uri(target)
        with files.open_output_stream(place) as out:
            for pdf in batches:
                for part in pdf["part"]:
                    with files.open_input_stream(fs.FileSystem.from_uri(part)[1]) as src:
                        shutil.copyfileobj(src, out, 1 << 20)
                yield pdf[["n"]]
    return run


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines (one document per line, splittable for readers)."""
    df.write.mode(mode).json(path)


def write_json_arrays(df: DataFrame, path: str, doc: str, *, order: str, per_file: int = 1000,
                      mode: str = "errorifexists") -> None:
    """The JSON texts of ``doc`` (line breaks and all) as files that hold one array each, which readers of
    whole documents take as rows; about ``per_file`` documents a file, split by a hash of ``order``."""
    n = -(-df.count() // per_file) or 1
    bins = df.select(F.pmod(F.xxhash64(order), F.lit(n)).alias("bin"), doc).groupBy("bin").agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list(doc), ",\n"), F.lit("\n]")).alias("value"))
    bins.select("value").write.mode(mode).option("maxRecordsPerFile", 1).text(path)

"""Many small image files are read by a bounded number of tasks."""

import os

import pytest
from pyspark.errors import AnalysisException

from tessera.session import scratch_dir
from tessera.streaming.first import image_files


def test_image_files_of_a_large_folder(spark):
    folder = scratch_dir(spark, "images").removeprefix("file:")
    os.makedirs(f"{folder}/images")
    os.makedirs(f"{folder}/_drafts")
    for n in range(600):
        with open(f"{folder}/images/c_{n}.jpg", "wb") as f:
            f.write(b"x" * (n % 7 + 1))
    open(f"{folder}/_drafts/draft", "wb").close()
    files = image_files(spark, folder)
    assert {(os.path.basename(r.path), r.length) for r in files.collect()} == {
        (f"c_{n}.jpg", n % 7 + 1) for n in range(600)}
    assert files.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_the_driver_holds_no_image_file(spark):
    folder = scratch_dir(spark, "images")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        image_files(spark, folder)
    at = folder.removeprefix("file:")
    os.makedirs(f"{at}/images")
    assert image_files(spark, folder).collect() == []
    for n in range(50):
        open(f"{at}/images/c_{n}.jpg", "wb").close()
    files = image_files(spark, folder)
    assert files.inputFiles() == []
    assert {r.length for r in files.collect()} == {0}  # an empty image is one too
    assert files.count() == 50


def test_image_files_are_those_of_sparks_reader(spark):
    folder = scratch_dir(spark, "images of a %41 folder")
    at = folder.removeprefix("file:")
    names = ["top.jpg", "images/a.jpg", "images/a.JPG", "images/a.jpg.crc", "images/.jpg", "images/.a.jpg",
             "images/_a.jpg", "images/_a=1.jpg", "images/_metadata_1.jpg", "images/a%2Fb c:1.jpg",
             "images/deep/er/a.jpg", "images/_deep/a.jpg", "images/.deep/a.jpg",
             "images/deep=1/a.jpg", "images/d._COPYING_/a.jpg", "images/folder.jpg/a.jpg", "_drafts/a.jpg"]
    for n, name in enumerate(names):
        os.makedirs(os.path.dirname(f"{at}/{name}"), exist_ok=True)
        with open(f"{at}/{name}", "wb") as f:
            f.write(b"x" * (n + 1))
    wanted = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.jpg").load(folder).select("path", "length")
    for given in (folder, at, f"file://{at}/"):
        files = image_files(spark, given)
        assert files.schema == wanted.schema
        assert sorted(files.collect()) == sorted(wanted.collect())
    assert wanted.count() == 7


def test_image_files_of_cameras_with_names_beyond_ascii(spark):
    folder = scratch_dir(spark, "images")
    at = folder.removeprefix("file:")
    os.makedirs(f"{at}/images")
    with open(f"{at}/images/Tür 🎈_1.jpg", "wb") as f:
        f.write(b"xyz")
    assert [tuple(r) for r in image_files(spark, folder).collect()] == [(f"{folder}/images/Tür 🎈_1.jpg", 3)]


def test_image_files_of_another_store_are_listed_by_folder(tmp_path):
    from pyarrow.fs import LocalFileSystem, SubTreeFileSystem

    from tessera.streaming.first import _entries

    (tmp_path / "deep").mkdir()
    (tmp_path / "a.jpg").write_bytes(b"x")
    found = [("a.jpg", False), ("deep", True)]
    assert sorted(_entries(SubTreeFileSystem(str(tmp_path), LocalFileSystem()), "")) == found
    assert sorted(_entries(LocalFileSystem(), str(tmp_path))) == found

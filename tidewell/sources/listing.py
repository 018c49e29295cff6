"""Complete folder listings as a table: names with a leading dot or underscore included, unreadable entries as rows."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import materialise, scratch, ship_code

SCHEMA = "rel string, is_dir boolean, size long, mtime_ns long, error string"
#: Entries that one Arrow batch of a listing holds.
ENTRIES = 4096


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and its path there, by Arrow; ``pyarrow.ArrowInvalid`` for schemes that it doesn't know."""
    return fs.FileSystem.from_uri(root) if ":/" in root else (fs.LocalFileSystem(), os.path.abspath(root))


def _local(path: str, folder: str) -> Iterator[tuple]:
    try:
        with os.scandir(os.path.join(path, folder)) as found:
            for entry in found:
                rel = f"{folder}/{entry.name}" if folder else entry.name
                try:
                    is_dir, stat = entry.is_dir(follow_symlinks=False), entry.stat(follow_symlinks=False)
                    yield rel, is_dir, 0 if is_dir else stat.st_size, stat.st_mtime_ns, None
                except OSError as error:
                    yield rel, False, -1, 0, str(error)
    except OSError as error:
        yield folder, True, -1, 0, str(error)


def entries(files: fs.FileSystem, path: str, folder: str) -> Iterator[tuple]:
    """Rows of a folder's own entries; links aren't followed. What can't be read is a row with its error."""
    if isinstance(files, fs.LocalFileSystem):
        yield from _local(path, folder)
        return
    try:
        for info in files.get_file_info(fs.FileSelector(f"{path}/{folder}".rstrip("/"), recursive=False)):
            is_dir = info.type == fs.FileType.Directory
            yield (f"{folder}/{info.base_name}" if folder else info.base_name), is_dir, 0 if is_dir else info.size, info.mtime_ns or 0, None
    except OSError as error:
        yield folder, True, -1, 0, str(error)


def spread(roots: DataFrame, skip: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """All entries below some folders (``tag string``, ``root string``): ``tag``, ``root``, ``rel``, ``is_dir``, ``size``,
    ``mtime_ns``, ``error``; folders of ``skip`` (``root``, ``rel``) are left out with all below them.

    Executors list level by level: the folders of a level are dealt among them, the entries that they find are a
    written table, whose folders are the next level. The driver sees no entry; a folder's entries stream through one
    task, a tree's through as many as its levels have folders."""
    spark = roots.sparkSession
    ship_code(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.string()]
        names = ["tag", "root", "rel", "is_dir", "size", "mtime_ns", "error"]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        held: list[tuple] = []
        for batch in batches:
            for tag, root, folder in zip(*(c.to_pylist() for c in batch.columns)):
                files, path = opened(root)
                for row in entries(files, path, folder):
                    held.append((tag, root, *row))
                    if len(held) == ENTRIES:
                        yield pack(held)
                        held = []
        if held:
            yield pack(held)

    with scratch() as kept:
        level, out = roots.select("tag", "root", F.lit("").alias("rel")), None
        while True:
            found = (level.repartition(tasks, "root", "rel") if tasks else level.repartition("root", "rel")).mapInArrow(run, f"tag string, root string, {SCHEMA}")
            found = materialise(found if skip is None else found.join(skip, ["root", "rel"], "left_anti").select(found.columns), "listing")
            kept.append(found)
            out = found if out is None else out.union(found)
            level = found.filter("is_dir and error is null").select("tag", "root", "rel")
            if level.isEmpty():
                return out


def listing(spark: SparkSession, root: str) -> DataFrame:
    """All entries below ``root``: ``rel``, ``is_dir``, ``size``, ``mtime_ns``, ``error``. An entry that can't be read
    has size -1 and the reason, and the scan goes on. The folder may be mounted everywhere or in a store that Arrow
    knows (s3, gs, hdfs); other file systems are listed by the driver from their own recursive listing (files only)."""
    try:
        opened(root)
    except pa.ArrowInvalid:
        return _by_driver(spark, root)
    return spread(spark.createDataFrame([("", root)], "tag string, root string")).drop("tag", "root")


def _by_driver(spark: SparkSession, root: str) -> DataFrame:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(where, True)
    rows, base = [], where.toUri().getPath().rstrip("/") + "/"
    while found.hasNext():
        status = found.next()
        rows.append((status.getPath().toUri().getPath().removeprefix(base), False, status.getLen(), status.getModificationTime() * 1_000_000, None))
    return spark.createDataFrame(rows, SCHEMA)


def scan_tree(spark: SparkSession, root: str, tree: str = "leaf") -> DataFrame:
    """Every file below ``root``: ``tree``, ``rel``, ``size`` (-1 if unreadable), ``modified``, ``error``."""
    files = listing(spark, root).filter("not is_dir or size < 0")
    return files.select(F.lit(tree).alias("tree"), "rel", "size", F.timestamp_micros(F.floor(F.col("mtime_ns") / 1000).cast("long")).alias("modified"), "error")


def scan_dataset(spark: SparkSession, leaf: str, mirror: str | None = None, stores: list[str] | None = None) -> DataFrame:
    """Files of one dataset out of its trees: ``leaf``, ``mirror`` and, as ``master``, each channel store of its raw data
    (their ``rel`` begins with the store's name). Trees that a dataset doesn't have add nothing."""
    out = scan_tree(spark, leaf, "leaf")
    if mirror:
        out = out.unionByName(scan_tree(spark, mirror, "mirror"))
    for store in stores or []:
        name = store.rstrip("/").rsplit("/", 1)[-1]
        out = out.unionByName(scan_tree(spark, store, "master").withColumn("rel", F.concat(F.lit(f"{name}/"), "rel")))
    return out

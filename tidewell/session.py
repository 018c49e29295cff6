"""Session factory and the shared work folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings every Tidewell job wants; all can be overridden by the caller or by the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def session(app: str = "tidewell", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset (a local test session) a folder of our own is made.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "tidewell-shared")
    return base.rstrip("/")


_SCRATCH: list[list[DataFrame]] = []


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: the lineage is cut, and a lost
    executor costs no recomputation. The table is deleted when the driver's JVM ends, or before by :func:`discard`
    or :func:`scratch`."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidewell/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    discard_path(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidewell_path = path
    if _SCRATCH:
        _SCRATCH[-1].append(out)
    return out


def discard_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared one when the driver's JVM ends."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)


def materialise_bucketed(df: DataFrame, by: list[str], tag: str) -> DataFrame:
    """Like :func:`materialise`, as a table bucketed by some columns: joins and groupings on them shuffle the other side
    only. Its entry in the catalog is dropped when Python ends."""
    spark, name = df.sparkSession, f"tidewell_{tag}_{uuid.uuid4().hex}"
    path, n = f"{shared_dir(spark)}/tidewell/{name}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, *by).write.bucketBy(n, *by).option("path", path).saveAsTable(name)
    discard_path(spark, path)
    atexit.register(_drop_table, spark, name)
    return spark.table(name)


def _drop_table(spark: SparkSession, name: str) -> None:
    if spark.sparkContext._jsc is not None:  # else the session has ended
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`materialise` that no later plan reads."""
    path = getattr(df, "_tidewell_path", None)
    if path:
        spark = df.sparkSession
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Tables made inside are deleted at its end, but for those put in the list it gives; these belong to the block
    around, if there is one."""
    kept: list[DataFrame] = []
    _SCRATCH.append([])
    try:
        yield kept
    finally:
        made = _SCRATCH.pop()
        paths = {getattr(df, "_tidewell_path", None) for df in kept}
        for df in made:
            if df._tidewell_path in paths:
                if _SCRATCH:
                    _SCRATCH[-1].append(df)
            else:
                discard(df)


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: executors have no copy of their own."""
    context = spark.sparkContext
    if getattr(context, "_tidewell_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tidewell-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "tidewell-code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for inside, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(inside, name)
                    out.write(full, os.path.join("tidewell", os.path.relpath(full, top)))
    context.addPyFile(path)
    context._tidewell_shipped = True

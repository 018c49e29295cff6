"""Sinks: replace by key, versioned tables, reports, verified removal."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def replace_keys(df: DataFrame, path: str, key: str) -> None:
    """Replace the partitions of the keys in ``df``, leave all others; idempotent."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


class Folder:
    """Small files and names of one folder, through Hadoop's file system of its path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path("").getFileSystem(self.conf)
        self.gateway = spark.sparkContext._gateway

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._path(name))

    def names(self) -> list[str]:
        return sorted(x.getPath().getName() for x in self.fs.listStatus(self._path(""))) if self.exists() else []

    def read(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str, instead_of: str | None = None) -> bool:
        """Put a file in place in one step: readers see the old text or the new. With ``instead_of`` only while the
        file still holds that text ("" for no file); returns whether it was written."""
        part = f".{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(part), True)
        stream.write(text.encode())
        stream.close()
        if instead_of is not None and (self.read(name) or "") != instead_of:
            self.fs.delete(self._path(part), False)
            return False
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self.conf)
        how = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.gateway.new_array(how, 1)
        options[0] = how.OVERWRITE
        context.rename(self._path(part), self._path(name), options)
        return True

    def remove(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


POINTER = "CURRENT"


def current(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The table that the pointer of a versioned folder names; an empty one of ``schema`` before the first write."""
    name = Folder(spark, path).read(POINTER)
    if name is None:
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path.rstrip('/')}/{name}")


def replace_table(spark: SparkSession, path: str, make: Callable[[DataFrame | None], DataFrame], attempts: int = 20, delay: float = 5.0, keep: int = 2) -> DataFrame:
    """Write ``make(table so far, or None)`` as a new version and turn the pointer to it.

    A crash at any time leaves the old table or the new one, and readers of the old version aren't disturbed (``keep``
    versions stay). If another writer turned the pointer meanwhile, the version is made again from its table, up to
    ``attempts`` times with ``delay`` seconds between. Between the last look at the pointer and its turn lies one
    rename; writers that must not meet there need a lock of the catalog's.
    """
    folder = Folder(spark, path)
    for attempt in range(attempts):
        before = folder.read(POINTER) or ""
        name = f"v{int(before.split('-')[0][1:] if before else 0) + 1:09d}-{uuid.uuid4().hex}"
        old = spark.read.parquet(f"{folder.path}/{before}") if before else None
        make(old).write.parquet(f"{folder.path}/{name}")
        if folder.write(POINTER, name, instead_of=before):
            for stale in [n for n in folder.names() if n.startswith("v") and n < name][: -(keep - 1) or None]:
                folder.remove(stale)
            return spark.read.parquet(f"{folder.path}/{name}")
        folder.remove(name)
        if attempt + 1 < attempts:
            time.sleep(delay)
    raise TimeoutError(f"{path} changed under each of {attempts} attempts")


def upsert(spark: SparkSession, new: DataFrame, path: str, keys: list[str], **retry: float) -> DataFrame:
    """Rows at ``path`` with those of ``new`` in place of rows of equal keys; see :func:`replace_table`."""

    def merged(old: DataFrame | None) -> DataFrame:
        return new if old is None else old.join(new.select(*keys), keys, "left_anti").select(new.columns).unionByName(new)

    return replace_table(spark, path, merged, **retry)


def unique_dir(spark: SparkSession, base: str, stem: str) -> str:
    """A new folder ``stem`` below ``base``, or ``stem-2``, ``stem-3``, ... where names are taken."""
    folder, n = Folder(spark, base), 1
    while True:
        name = stem if n == 1 else f"{stem}-{n}"
        if not folder.exists(name):
            folder.fs.mkdirs(folder._path(name))
            return f"{folder.path}/{name}"
        n += 1


def report(suggestions: DataFrame, review: DataFrame, notes: list[str], path: str, tiers: dict[str, str], verdicts: DataFrame, rules: list[str], extra: dict | None = None) -> dict:
    """The report folder: ``suggestions`` (CSV by tier, then bytes falling), ``review_queue`` (CSV, bytes falling),
    ``paths`` (one folder per tier, its distinct paths), ``notes.txt`` and ``summary.json``, which is returned.

    ``suggestions``: tier, rule, dataset_key, path, bytes, nfiles, paths (array, empty: the path itself), class_bytes
    (map) and any further columns; ``review``: rule, bytes, dataset_key, reasons (array). CSVs are range-sorted.
    """
    spark = suggestions.sparkSession
    place = lambda c: F.regexp_extract(c, "^(/[^/]*)", 1)
    flat = suggestions.withColumn("filesystem", place("path")).withColumn("class_bytes", F.to_json("class_bytes"))
    flat.drop("paths").orderBy("tier", F.desc("bytes"), "path").write.mode("overwrite").option("header", "true").csv(f"{path}/suggestions")
    named = suggestions.select("tier", F.explode(F.when(F.size("paths") > 0, F.col("paths")).otherwise(F.array("path"))).alias("p")).distinct()
    named.write.mode("overwrite").partitionBy("tier").text(f"{path}/paths")
    asked = review.select("rule", "bytes", place("dataset_key").alias("filesystem"), "dataset_key", F.array_join("reasons", " | ").alias("reasons"))
    asked.orderBy(F.desc("bytes"), "dataset_key").write.mode("overwrite").option("header", "true").csv(f"{path}/review_queue")
    of_tier = {r["tier"]: r for r in suggestions.groupBy("tier").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("dataset_key").alias("datasets"), F.sum("bytes").alias("bytes")).collect()}
    by_place = suggestions.groupBy("tier", place("path").alias("fs")).agg(F.sum("bytes").alias("bytes")).collect()  # a row per tier and mount
    of_rule = {r["rule"]: r["n"] for r in verdicts.groupBy("rule").agg(F.count(F.lit(1)).alias("n")).collect()}
    queue = review.agg(F.count(F.lit(1)).alias("datasets"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    out = {
        "datasets_assessed": sum(of_rule.values()),
        "verdicts": {rule: of_rule.get(rule, 0) for rule in rules},
        "tiers": {t: {"what": what, **{k: of_tier[t][k] if t in of_tier else 0 for k in ("rows", "datasets", "bytes")}, "by_filesystem": {r["fs"]: r["bytes"] for r in by_place if r["tier"] == t}} for t, what in tiers.items()},
        "review_queue": queue.asDict(),
        **(extra or {}),
    }
    folder = Folder(spark, path)
    folder.write("notes.txt", "\n".join(notes) + "\n")
    folder.write("summary.json", json.dumps(out, indent=2))
    return out


def summary(rows: DataFrame, tier: str, tiers: list[str], key: str, size: str) -> DataFrame:
    """Rows, keys and bytes of each tier; tiers without rows are zero."""
    fixed = rows.sparkSession.createDataFrame([(t,) for t in tiers], f"{tier} string")
    agg = rows.groupBy(tier).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("keys"), F.sum(size).alias("bytes"))
    return fixed.join(agg, tier, "left").select(tier, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "keys", "bytes")))


def remove_verified(frames: DataFrame, stored: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Frames whose stored copy is equal element by element and may go; any difference or absence fails the job."""
    met = frames.alias("f").join(stored.alias("s"), keys, "full")
    same = F.col(f"f.{value}").eqNullSafe(F.col(f"s.{value}"))
    return met.select(*keys, F.assert_true(same, F.lit("a frame differs from its stored copy")).alias("ok")).filter("ok is null").select(*keys)


def merge_manifest(old: DataFrame, new: DataFrame, present: DataFrame, name: str) -> DataFrame:
    """Arms of a manifest: earlier ones stay, new ones replace those of their name, and what has no file is left out."""
    kept = old.join(new.select(name), name, "left_anti").select(new.columns).unionByName(new)
    return kept.join(present.select(name).distinct(), name, "left_semi")


def fill_template(spark: SparkSession, template: str, mark: str, document: dict, path: str, name: str) -> None:
    """The template's text with ``mark`` replaced by the JSON document, put in place in one step."""
    Folder(spark, path).write(name, template.replace(mark, json.dumps(document)))


def times_note(stored: DataFrame, raw: DataFrame, t: str, value: str) -> tuple[DataFrame, str]:
    """Stored frames (``t`` by rank) with the raw series' times, null where it has none, and one line that says what
    came of it."""
    met = stored.select(t).distinct().join(raw.select(t, value), t, "left")
    n, known = met.agg(F.count(F.lit(1)), F.count(value)).first()
    said = "no acquisition times" if not known else "acquisition times of all frames" if known == n else f"acquisition times of {known} of {n} frames"
    return met, said


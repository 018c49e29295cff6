"""Jobs over a registry of datasets: ``scan``, ``hash`` and ``report``, each safe to run again after a crash.

State lies below a work folder in versioned tables: ``files`` and ``scans`` (inventory), ``hashes`` (digests), and one
folder per report. Dataset folders must be mounted on all executors. ``python -m tidewell.jobs --help`` runs them.
"""

from __future__ import annotations

import argparse
import hashlib
import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import decisions, dedup, inventory
from tidewell.session import discard, materialise, session, ship_code
from tidewell.sources import listing, sinks

FILES = "dataset_key string, leaf_dir string, rel string, size long, mtime_ns long, error string"
SCANS = "dataset_key string, scanned_at string"
HASHES = "path string, size long, mtime long, sha string"
# They decide which datasets are compared.
MIN_LINK_BYTES, MIN_SHARED_FRACTION = 1 << 20, 0.5
#: Bytes of one read of a file.
CHUNK = 4 << 20


class StaleInventory(RuntimeError):
    """Suggestions were asked for from an inventory that is too old."""


def list_datasets(datasets: DataFrame, registry: DataFrame, tasks: int = 256) -> DataFrame:
    """Files of datasets (``dataset_key``, ``leaf_dir``), listed by the executors as rows of :data:`FILES`; folders of
    other datasets of the registry below one are theirs alone. Folders of all datasets are dealt level by level, so a
    dataset spans tasks; what can't be read has size -1 and the reason. Null folders have no rows."""
    rows = datasets.select(F.col("dataset_key").alias("tag"), F.rtrim("leaf_dir", F.lit("/")).alias("root")).filter("root is not null")
    every = registry.select(F.col("leaf_dir").alias("path")).filter("path is not null").distinct()
    below = inventory.nested(every).select(F.col("outer").alias("root"), F.substr("inner", F.length("outer") + 2).alias("rel"))
    found = listing.spread(rows, below, tasks).filter("not is_dir or size < 0")
    return found.select(F.col("tag").alias("dataset_key"), F.col("root").alias("leaf_dir"), "rel", "size", "mtime_ns", "error")


def scan(spark: SparkSession, registry: DataFrame, work: str, refresh: bool = False, tasks: int = 256) -> int:
    """List the registered datasets that weren't scanned yet (all with ``refresh``); returns how many.

    Files are written before the note that a dataset is scanned, so a crash between leads to another scan."""
    scans = sinks.current(spark, f"{work}/scans", SCANS)
    todo = registry if refresh else inventory.to_scan(registry, scans, ["dataset_key"])
    todo = materialise(todo.select("dataset_key", "leaf_dir", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("scanned_at")), "jobs-todo")
    n = todo.count()
    if n:
        found = materialise(list_datasets(todo, registry, tasks), "jobs-files")
        keys = todo.select("dataset_key")
        replace = lambda new: lambda old: new if old is None else old.join(keys, "dataset_key", "left_anti").select(new.columns).unionByName(new)
        sinks.replace_table(spark, f"{work}/files", replace(found))
        sinks.replace_table(spark, f"{work}/scans", replace(todo.select("dataset_key", "scanned_at")))
        discard(found)
    discard(todo)
    return n


def raw_files(spark: SparkSession, registry: DataFrame, work: str) -> DataFrame:
    """Raw files of registered datasets with their digest, null where none holds: ``dataset_key``, ``path``, ``size``,
    ``mtime``, ``sha``."""
    cls = inventory.classify(inventory.parts_of(F.col("rel")), F.array().cast("array<string>"))
    path = F.concat("leaf_dir", F.lit("/"), "rel").alias("path")
    files = sinks.current(spark, f"{work}/files", FILES).select("dataset_key", path, "size", F.col("mtime_ns").alias("mtime"), cls.alias("cls")).filter("size >= 0")
    return decisions.raw_digests(files, sinks.current(spark, f"{work}/hashes", HASHES), registry.select("dataset_key").distinct(), "dataset_key")


def digests(files: DataFrame) -> DataFrame:
    """``path``, ``size``, ``mtime``, ``sha`` of files, read in pieces by the executors; ``sha`` is null and ``error``
    says why where a file can't be read or isn't what was scanned."""
    ship_code(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, errors = [], []
            for path, size, mtime in zip(*(c.to_pylist() for c in batch.columns)):
                sha = error = None
                try:
                    stat = os.stat(path)
                    if (stat.st_size, stat.st_mtime_ns) != (size, mtime):
                        error = "changed since scan"
                    else:
                        state = hashlib.sha256()
                        with open(path, "rb", buffering=0) as file:
                            while piece := file.read(CHUNK):
                                state.update(piece)
                        sha = state.hexdigest()
                except OSError as problem:
                    error = str(problem)
                shas.append(sha)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shas, pa.string()), pa.array(errors, pa.string())], names=["path", "size", "mtime", "sha", "error"])

    return files.select("path", "size", "mtime").mapInArrow(run, f"{HASHES}, error string")


def hash_files(spark: SparkSession, registry: DataFrame, work: str, rounds: int = 1, tasks: int = 256, dry_run: bool = False, min_size: int = MIN_LINK_BYTES, share: float = MIN_SHARED_FRACTION) -> dict[str, int]:
    """Digests of all raw files, small ones too, of datasets that may be copies by size; those that have one are left.

    The work is dealt into ``rounds`` that are committed one by one: a crash costs the round it falls in. Returns
    ``pairs``, ``files``, ``bytes`` to hash, and ``failed`` (no digest; tried again by the next run)."""
    raw = materialise(raw_files(spark, registry, work), "jobs-raw")
    pairs = materialise(dedup.candidate_pairs(raw, "dataset_key", "size", min_size, share), "jobs-pairs")
    keys = pairs.select(F.explode(F.array("a", "b")).alias("dataset_key")).distinct()
    todo = materialise(raw.join(keys, "dataset_key", "left_semi").filter("sha is null").select("path", "size", "mtime").distinct(), "jobs-todo")
    n, size = todo.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    out = {"pairs": pairs.count(), "files": n, "bytes": size, "failed": 0}
    for k in range(0 if dry_run or not n else rounds):
        part = todo.filter(F.pmod(F.xxhash64("path"), F.lit(rounds)) == k).repartition(tasks, "path")
        done = materialise(digests(part), "jobs-hashes")
        out["failed"] += done.filter("sha is null").count()
        sinks.upsert(spark, done.filter("sha is not null").drop("error"), f"{work}/hashes", ["path"])
        discard(done)
    for table in (raw, pairs, todo):
        discard(table)
    return out


def report(spark: SparkSession, registry: DataFrame, work: str, suggestions: DataFrame, review: DataFrame, verdicts: DataFrame, tiers: dict[str, str], rules: list[str], stem: str, max_age_hours: float = 24.0, allow_stale: bool = False, rescan: bool = False) -> dict:
    """A report folder ``stem`` that overwrites no other, from tables as :func:`tidewell.sources.sinks.report` takes them; returns its summary.

    Refused (:class:`StaleInventory`) while any dataset's scan is older than ``max_age_hours``, unless ``allow_stale``:
    the summary then says how many. Datasets that were never scanned are noted and refuse nothing."""
    if rescan:
        scan(spark, registry, work, refresh=True)
    ages = decisions.scan_ages(registry, sinks.current(spark, f"{work}/scans", SCANS), "dataset_key", "scanned_at", F.current_timestamp())
    oldest, stale, never = ages.agg(F.max("hours"), F.count(F.when(F.col("hours") > max_age_hours, 1)), F.count(F.when(F.col("hours").isNull(), 1))).first()
    if stale and not allow_stale:
        raise StaleInventory(f"{stale} datasets were scanned more than {max_age_hours:g} hours ago, the oldest {oldest:.1f}; scan with refresh first, or allow it")
    notes = [f"inventory: {stale} datasets older than {max_age_hours:g} hours, {never} never scanned"]
    path = sinks.unique_dir(spark, work, stem)
    extra = {"report_dir": path, "oldest_scan_age_hours": None if oldest is None else round(oldest, 1), "stale_datasets": stale, "allow_stale": allow_stale}
    return sinks.report(suggestions, review, notes, path, tiers, verdicts, rules, extra)


def main(argv: list[str] | None = None) -> None:
    """Command line; tables are Parquet folders."""
    parser = argparse.ArgumentParser(prog="tidewell.jobs", description=__doc__)
    parser.add_argument("job", choices=("scan", "hash", "report"))
    parser.add_argument("--registry", required=True, help="table of dataset_key, leaf_dir")
    parser.add_argument("--work", required=True, help="folder of the state, shared by driver and executors")
    parser.add_argument("--refresh", action="store_true", help="scan: scanned datasets too")
    parser.add_argument("--rounds", type=int, default=1, help="hash: parts that are committed one by one")
    parser.add_argument("--dry-run", action="store_true", help="hash: only say what there is to do")
    for name in ("suggestions", "review", "verdicts"):
        parser.add_argument(f"--{name}", help=f"report: table of {name}")
    parser.add_argument("--tiers", type=json.loads, default={}, help="report: JSON object from tier to what it means")
    parser.add_argument("--rules", nargs="*", default=["P1", "P2", "R1", "D1", "K0"], help="report: rules to count")
    parser.add_argument("--stem", default="report", help="report: name of its folder")
    parser.add_argument("--max-scan-age-hours", type=float, default=24.0)
    parser.add_argument("--allow-stale", action="store_true")
    parser.add_argument("--rescan", action="store_true")
    a = parser.parse_args(argv)
    if a.job == "report" and not (a.suggestions and a.review and a.verdicts):
        parser.error("report needs --suggestions, --review and --verdicts")
    spark = session(f"tidewell-{a.job}")
    registry = spark.read.parquet(a.registry)
    if a.job == "scan":
        print(json.dumps({"scanned": scan(spark, registry, a.work, a.refresh)}))
    elif a.job == "hash":
        print(json.dumps(hash_files(spark, registry, a.work, a.rounds, dry_run=a.dry_run)))
    else:
        tables = [spark.read.parquet(p) for p in (a.suggestions, a.review, a.verdicts)]
        print(json.dumps(report(spark, registry, a.work, *tables, a.tiers, a.rules, a.stem, a.max_scan_age_hours, a.allow_stale, a.rescan), indent=2))


if __name__ == "__main__":
    main()

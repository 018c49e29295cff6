"""Stages of a dataset: provenance, priorities, outcomes, giving up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.scan import RANGE, scan
from tidewell.session import materialise


def provenance_matches(psf: Column, want_psf: Column, params: Column, want_params: Column, strict: bool = False) -> Column:
    """Equal PSF (null matches null); without a PSF nothing more is asked; null parameters are accepted unless ``strict``."""
    old = F.lit(not strict)
    return F.when(~psf.eqNullSafe(want_psf), False).when(psf.isNull(), True).when(params.isNull(), old).otherwise(params.eqNullSafe(want_params))


def priority(flag: Column, ranks: dict[str, int], default: int = 1) -> Column:
    """Rank of a flag, ``default`` for others and null."""
    out = F.lit(default)
    for k, v in ranks.items():
        out = F.when(flag == k, v).otherwise(out)
    return out


def queue_position(rows: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Position of every row in one total order, without drawing all rows into one task: rows are dealt into ranges of
    the order, counted per range, and numbered inside a range from where the ranges before it end."""
    ranged = materialise(rows.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "queue")
    sizes = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))  # a row per range
    before = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return ranged.withColumn("_in", inside).join(before, "_p").withColumn(name, F.col("_before") + F.col("_in")).drop("_p", "_in", "_before")


def longest_failure_run(events: DataFrame, key: str, order: list[str], failed: Column) -> DataFrame:
    """Longest run of consecutive failures of each key; a null outcome is no failure. Failures with as many successes
    before them are one run, so a key may span tasks."""
    rows = events.select(key, *order, F.coalesce(failed, F.lit(False)).alias("_f"))
    numbered = scan(rows, [key], order, _g=("sum", (~F.col("_f")).cast("int")))
    runs = numbered.groupBy(key, "_g").agg(F.count_if("_f").alias("n"))
    return runs.groupBy(key).agg(F.max("n").alias("longest"))


def latest(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key in a total order, by an aggregation."""
    rest = [c for c in events.columns if c != key]
    return events.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(key, "_r.*")


def stale_labels(labels: DataFrame, key: str, labelled_at: str, redone_at: str) -> DataFrame:
    """Whether each label is older than the last processing; without a processing it is fresh."""
    return labels.select(key, F.when(F.col(labelled_at) < F.col(redone_at), "stale").otherwise("fresh").alias("state"))


def changes(events: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from the key's row before, and each key's first; a key may span tasks."""
    seen = scan(events, [key], order, _p=("before", F.col(value)))
    return seen.filter(F.col("_p").isNull() | ~F.col("_p.v").eqNullSafe(F.col(value))).select(events.columns)


def admitted(rows: DataFrame, order: list[Column], cap: int, in_flight: int) -> DataFrame:
    """The first rows of a queue up to what the cap leaves."""
    return rows.orderBy(*order).limit(max(0, cap - in_flight))


def idle_sessions(events: DataFrame, key: str, ts: str, gap_s: int) -> DataFrame:
    """Sessions of each key: a new one starts where more than ``gap_s`` seconds lie between two events. A key may span
    tasks: two scans over the same ranges, for the time before and for the number of the session."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    seen = scan(events.select(key, ts), [key], [ts], _b=("before", at))
    fresh = materialise(seen.select(key, ts, RANGE, F.coalesce((at - F.col("_b.v") > gap_s * 1_000_000).cast("int"), F.lit(1)).alias("_n")), "sessions")
    rows = scan(fresh, [key], [ts], session=("sum", F.col("_n")))
    return rows.groupBy(key, "session").agg(F.min(ts).alias("started"), F.max(ts).alias("ended"), F.count(F.lit(1)).alias("n"))


def in_flight(stages: DataFrame, ours: DataFrame, key: str, stage: str, ticket: str) -> DataFrame:
    """Pending rows of a stage, with a ticket, whose datasets belong to this pass."""
    rows = stages.filter((F.col("stage") == stage) & (F.col("status") == "pending") & F.col(ticket).isNotNull())
    return rows.join(ours.select(key).distinct(), key, "left_semi")


def needs_stage(datasets: DataFrame, stages: DataFrame, key: str, stage: str) -> DataFrame:
    """Datasets whose stage isn't done."""
    done = stages.filter((F.col("stage") == stage) & (F.col("status") == "done")).select(key).distinct()
    return datasets.join(done, key, "left_anti")


def build_and_prune(wanted: DataFrame, present: DataFrame, cells: list[str], newest: str, built: str) -> DataFrame:
    """What to do with each cell: ``build`` what is missing or older than its source, ``prune`` what nobody wants."""
    both = wanted.select(*cells, F.col(newest).alias("_n"), F.lit(1).alias("_w")).join(present.select(*cells, F.col(built).alias("_b"), F.lit(1).alias("_p")), cells, "full")
    what = F.when(F.col("_w").isNull(), "prune").when(F.col("_p").isNull() | (F.col("_b") < F.col("_n")), "build").otherwise("keep")
    return both.select(*cells, what.alias("what"))

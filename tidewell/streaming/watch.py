"""Watch passes: what a pass over the catalogue decides, as tables that can be decided again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def plan_pass(found: DataFrame, registered: DataFrame, stages: DataFrame, tickets: DataFrame, failures: DataFrame, flags: dict[str, int], give_up: int, cap: int) -> dict[str, DataFrame]:
    """What one pass does, as tables; each step sees what those before it decided.

    ``found``: key, kind of what is there now; ``registered``: key, flag of what is known; ``stages``: key, stage,
    status; ``tickets``: key, outcome (``done``, ``failed``, ``lost``, ``in flight``) of pending work; ``failures``:
    key, n in a row. Gives: ``register`` (new keys), ``collect`` (tickets with an outcome, and the status that follows:
    lost work is pending again), ``dropped`` (keys that failed ``give_up`` times), ``triage`` (keys whose signal isn't
    known yet; cropped stores never need it), ``submit`` (the first ``cap`` less what is in flight, by flag, then key)
    and ``finish`` (keys whose work is done but not encoded).
    """
    done = lambda stage: stages.filter((F.col("stage") == stage) & (F.col("status") == "done")).select("key").distinct()
    register = found.join(registered, "key", "left_anti")
    status = F.when(F.col("outcome") == "done", "done").when(F.col("outcome") == "failed", "failed").when(F.col("outcome") == "lost", "pending")
    collect = tickets.withColumn("status", status).filter("status is not null")
    dropped = failures.filter(F.col("n") >= give_up).select("key").distinct()
    left = found.join(dropped, "key", "left_anti")
    triage = left.filter("kind <> 'precropped'").join(done("mip_encode"), "key", "left_anti").join(done("roi_detect"), "key", "left_anti")
    busy = tickets.filter("outcome = 'in flight'").select("key").distinct()
    finished = done("deskew").union(collect.filter("status = 'done'").select("key")).distinct()
    open_ = left.join(registered.select("key", "flag"), "key", "left").join(finished, "key", "left_anti").join(busy, "key", "left_anti")
    rank = F.lit(1)
    for flag, place in flags.items():
        rank = F.when(F.col("flag") == flag, place).otherwise(rank)
    submit = open_.orderBy(rank, "key").limit(max(0, cap - busy.count())).select("key")
    finish = left.select("key").join(finished, "key", "left_semi").join(done("mip_encode"), "key", "left_anti")
    return {"register": register.select("key"), "collect": collect.select("key", "outcome", "status"), "dropped": dropped, "triage": triage.select("key"), "submit": submit, "finish": finish}


def commit_pass(stages: DataFrame, plan: dict[str, DataFrame], stage: str = "deskew") -> DataFrame:
    """The stage rows after a pass: collected outcomes in place of what was pending, submitted keys pending. Applying a
    pass again to its own result changes nothing."""
    new = plan["collect"].select("key", F.lit(stage).alias("stage"), "status").union(plan["submit"].select("key", F.lit(stage).alias("stage"), F.lit("pending").alias("status")))
    new = new.groupBy("key", "stage").agg(F.min("status").alias("status"))  # done, then failed, then pending
    return stages.join(new, ["key", "stage"], "left_anti").select("key", "stage", "status").unionByName(new)


def timed_out(tasks: DataFrame, submitted: str, finished: str, now_s: float, limit_s: float) -> DataFrame:
    """``state`` of each task, with a deadline counted from its submission: ``done``, ``timed out`` or ``running``. A
    task that came back too late has timed out."""
    spent = F.coalesce(F.col(finished), F.lit(now_s)) - F.col(submitted)
    return tasks.withColumn("state", F.when(spent > limit_s, "timed out").when(F.col(finished).isNotNull(), "done").otherwise("running"))


def late_data(stages: DataFrame, completed: DataFrame, key: str, stage: str, following: list[str]) -> DataFrame:
    """Stage rows after late data: where a store was completed (``completed_at``) after ``stage`` finished
    (``finished_at``), the stage is pending again and the stages in ``following`` are gone; others stay as they are."""
    at = stages.filter((F.col("stage") == stage) & (F.col("status") == "done")).join(completed.select(key, "completed_at"), key)
    late = at.filter(F.col("completed_at") > F.col("finished_at")).select(key, F.lit(True).alias("late")).distinct()
    met = stages.join(late, key, "left")
    gone = F.coalesce("late", F.lit(False)) & F.col("stage").isin(*following)
    again = F.coalesce("late", F.lit(False)) & (F.col("stage") == stage)
    return met.filter(~gone).select(key, "stage", F.when(again, "pending").otherwise(F.col("status")).alias("status"), F.when(~again, F.col("finished_at")).alias("finished_at"))


def session_dataset(sessions: DataFrame, roots: list[str]) -> DataFrame:
    """The dataset that each session's data will be: ``leaf`` (``<folder>/<name>`` of the store ``<folder>/<name>_dsr
    .ome.zarr`` or ``<folder>/<name>/...``'s own folder), ``root`` and the planned raw stores ``<leaf>_<label>.ome.zarr``,
    sorted. Sessions without a store, or under none of the roots (the first that fits counts), have none."""
    leaf = F.nullif(F.regexp_extract("store", r"^(.*)_dsr\.ome\.zarr/?$", 1), F.lit(""))
    root = F.lit(None).cast("string")
    for r in reversed([x.rstrip("/") for x in roots]):
        root = F.when((F.col("leaf") == r) | F.startswith("leaf", F.lit(f"{r}/")), r).otherwise(root)
    raw = F.array_sort(F.transform(F.coalesce("channel_labels", F.array().cast("array<string>")), lambda x: F.concat("leaf", F.lit("_"), x, F.lit(".ome.zarr"))))
    return sessions.withColumn("leaf", leaf).withColumn("root", root).filter("root is not null").withColumn("raw", raw)

"""What becomes of submitted tickets, by a join of two streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fates(submitted: DataFrame, completed: DataFrame, wait: str, late: str) -> DataFrame:
    """Two streams, both with ``key``, ``id`` and ``at`` (timestamp), met by key where a completion comes at most ``wait``
    after its submission. Emits ``key``, ``submitted``, ``completed`` (ids) and ``outcome``:

    ``done`` as soon as both are there; ``lost`` for a submission without a completion, once the watermark (``late``
    behind the slower of the two streams) has passed its deadline; ``late`` for a completion that meets no submission in time,
    once none can come any more. A submission that has none of these yet is in flight: it is in the join's state, and
    the state holds nothing older than ``wait`` and ``late`` together. Rows of null key or time meet nobody and are
    left out.
    """
    full = lambda df: df.filter(F.col("key").isNotNull() & F.col("at").isNotNull())
    s = full(submitted).withWatermark("at", late).select(F.col("key").alias("key_s"), F.col("id").alias("submitted"), F.col("at").alias("at_s"))
    c = full(completed).withWatermark("at", late).select(F.col("key").alias("key_c"), F.col("id").alias("completed"), F.col("at").alias("at_c"))
    on = (F.col("key_s") == F.col("key_c")) & (F.col("at_c") >= F.col("at_s")) & (F.col("at_c") <= F.col("at_s") + F.expr(f"INTERVAL {wait}"))
    outcome = F.when(F.col("completed").isNull(), "lost").when(F.col("submitted").isNull(), "late").otherwise("done")
    return s.join(c, on, "full_outer").select(F.coalesce("key_s", "key_c").alias("key"), "submitted", "completed", outcome.alias("outcome"))


def with_in_flight(emitted: DataFrame, submitted: DataFrame) -> DataFrame:
    """What the stream has emitted, and the submissions (a table) that it hasn't spoken of, as ``in flight``."""
    open_ = submitted.filter(F.col("key").isNotNull() & F.col("at").isNotNull()).join(emitted.select(F.col("submitted").alias("id")).dropna().distinct(), "id", "left_anti")
    return emitted.select("key", "submitted", "completed", "outcome").union(open_.select("key", F.col("id"), F.lit(None).cast("long"), F.lit("in flight")))


def reopened(finished: DataFrame, completed: DataFrame, within: str, late: str) -> DataFrame:
    """Stages to do again: of two streams (``key``, ``id``, ``at``) each finished stage whose store was completed after it,
    ``within`` that time at most, as ``key``, ``id`` and ``completed`` (the store's). Emitted as soon as both are there, in
    any order; the state holds nothing older than ``within`` and ``late`` together."""
    full = lambda df: df.filter(F.col("key").isNotNull() & F.col("at").isNotNull())
    f = full(finished).withWatermark("at", late).select("key", "id", F.col("at").alias("finished_at"))
    c = full(completed).withWatermark("at", late).select(F.col("key").alias("key_c"), F.col("id").alias("completed"), F.col("at").alias("completed_at"))
    on = (F.col("key") == F.col("key_c")) & (F.col("completed_at") > F.col("finished_at")) & (F.col("completed_at") <= F.col("finished_at") + F.expr(f"INTERVAL {within}"))
    return f.join(c, on).select("key", "id", "completed")

"""Is a series, a grid or a chunked array whole?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.scan import scan

#: Values of a fixed dimension of a grid.
MAX_SIDE = 10_000


def series(frames: DataFrame, series_key: str, channel: str, t: str, size: str, expected: Column | None = None) -> DataFrame:
    """``series_key``, ``ok``, ``detail``: channels hold t = 0..T-1 without gap, no empty frame, equal T, the expected
    T; the first failure names itself. Of rows that repeat a (channel, t) the largest counts."""
    one = frames.groupBy(series_key, channel, t).agg(F.max(size).alias("s"))
    by = one.groupBy(series_key, channel).agg(F.min(t).alias("lo"), F.max(t).alias("hi"), F.count(F.lit(1)).alias("n"), F.min("s").alias("least"))
    by = by.groupBy(series_key).agg(
        F.bool_and((F.col("lo") == 0) & (F.col("hi") + 1 == F.col("n"))).alias("whole"), F.bool_and(F.col("least") > 0).alias("full"),
        F.count_distinct("n").alias("lengths"), F.min("n").alias("n_t"),
    )
    want = F.lit(None).cast("long") if expected is None else expected
    detail = (
        F.when(~F.col("whole"), "gap").when(~F.col("full"), "empty frame").when(F.col("lengths") > 1, "unequal channels")
        .when(want.isNotNull() & (want > 0) & (want != F.col("n_t")), "wrong length").otherwise("ok")
    )
    return by.select(series_key, (detail == "ok").alias("ok"), detail.alias("detail"), "n_t")


def grid_missing(rows: DataFrame, left: str, right: str, right_values: DataFrame) -> DataFrame:
    """Cells of (every left value) x (``right_values``, a fixed dimension of ``MAX_SIDE`` values at most) without a row.

    The dimension's size is checked, then it is a constant: a left value is exploded to the values that its own set
    lacks, so cells that are there are never made."""
    side = [r[0] for r in right_values.select(right).distinct().limit(MAX_SIDE + 1).collect()]
    if len(side) > MAX_SIDE:
        raise ValueError(f"{right} has more than {MAX_SIDE} values: join the grid's cells as a table")
    every = F.array(*(F.lit(v) for v in side)).cast(f"array<{rows.schema[right].dataType.simpleString()}>")
    have = rows.groupBy(left).agg(F.collect_set(right).alias("_have"))
    return have.select(left, F.explode(F.array_except(every, F.array_intersect(every, "_have"))).alias(right))


def constant_blocks(rows: DataFrame, key: str, size: str, least: int) -> DataFrame:
    """Keys with at least ``least`` non-empty blocks that all have one size."""
    full = F.col(size) > 0
    agg = rows.groupBy(key).agg(F.count(F.when(full, 1)).alias("n"), F.min(F.when(full, F.col(size))).alias("lo"), F.max(F.when(full, F.col(size))).alias("hi"))
    return agg.select(key, F.coalesce((F.col("n") >= least) & (F.col("lo") == F.col("hi")), F.lit(False)).alias("blank"))


def chunk_count(shape: Column, chunks: Column) -> Column:
    """Chunks of an array of that shape."""
    return F.aggregate(F.zip_with(shape, chunks, lambda s, c: F.ceil(s / c).cast("long")), F.lit(1).cast("long"), lambda a, x: a * x)


def usable_length(stores: DataFrame, key: str, declared: str, written: str) -> DataFrame:
    """Least written and largest declared length over the stores of a key; written is capped by declared."""
    return stores.groupBy(key).agg(F.coalesce(F.min(F.least(declared, written)), F.lit(1)).alias("usable"), F.coalesce(F.max(declared), F.lit(1)).alias("declared"))


def modal(rows: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """Commonest value of each key; the one first seen in ``order`` wins a tie."""
    seen = rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("first"))
    best = F.min_by(value, F.struct((-F.col("n")).alias("n"), F.col("first")))
    return seen.groupBy(key).agg(best.alias(value), F.max("n").alias("n"))


def readable_prefix(parts: DataFrame, series_key: str, seq: str, bad: Column, pages: str, pages_per_t: int) -> DataFrame:
    """The run of good parts that leads each series, its pages, and how many whole timepoints they hold; a series may
    span tasks."""
    lead = scan(parts, [series_key], [seq], _b=("max", F.coalesce(bad, F.lit(False)).cast("int")))
    good = F.coalesce(F.sum(F.when(F.col("_b") == 0, F.col(pages))), F.lit(0))
    return lead.groupBy(series_key).agg(F.count(F.when(F.col("_b") == 0, 1)).alias("n_good"), good.alias("pages"), F.floor(good / pages_per_t).cast("long").alias("n_t"))


def readable_master(parts: DataFrame, series_key: str, seq: str, name: str, bad: Column, pages: str, pages_per_t: int) -> DataFrame:
    """What can be read of a series: ``path`` (its first part), ``actual_timepoints`` (null where nothing is excluded: the
    declared ones are true), ``excluded`` (the names from the first bad part on, in order). A series whose first part is
    bad has no path. Parts may span tasks; the names of a series' excluded parts are one row."""
    lead = scan(parts, [series_key], [seq], _b=("max", F.coalesce(bad, F.lit(False)).cast("int")))
    good = F.col("_b") == 0
    out = F.array_sort(F.collect_list(F.when(~good, F.struct(F.col(seq).alias("s"), F.col(name).alias("n")))))
    agg = lead.groupBy(series_key).agg(F.min_by(F.when(good, F.col(name)), seq).alias("path"), F.coalesce(F.sum(F.when(good, F.col(pages))), F.lit(0)).alias("p"), out.alias("x"))
    n_t = F.when(F.size("x") > 0, F.floor(F.col("p") / pages_per_t).cast("long"))
    return agg.select(series_key, "path", n_t.alias("actual_timepoints"), F.transform("x", lambda x: x["n"]).alias("excluded"))

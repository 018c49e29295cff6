"""Ordered computations over keys of any size: a segmented scan over ranges.

Rows are dealt into ranges of (key, order), so a key that holds most rows spans many tasks. Each range is scanned by
itself; what a key brings along from the ranges before (a sum, a least or greatest value, the last row's value) is
summarised for the keys that straddle a range's end, one for each end at most, and added to the rows of the next range.
The operations are associative, so this equals one scan over the whole key. The ranges are a written table: their
bounds come from a sample, and a task that is run again must deal as before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import materialise

#: Column that holds the number of a row's range.
RANGE = "_range"


def null_safe(rows: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined to ``other`` on keys where null equals null; the keys come once."""
    renamed = other.withColumnsRenamed({k: f"_other_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_other_{k}"))
    return rows.join(renamed, on, how).drop(*(f"_other_{k}" for k in keys))


def ranged(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows in ranges of (keys, order), ascending with nulls first, as a written table."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(rows.repartitionByRange(n, *keys, *order).withColumn(RANGE, F.spark_partition_id()), "ranges")


def _straddling(dealt: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one range holds; a range's ends tell them, so there are fewer than ranges."""
    ends = dealt.groupBy(RANGE).agg(F.min(F.struct(*keys)).alias("lo"), F.max(F.struct(*keys)).alias("hi"))
    both = ends.select(RANGE, F.explode(F.array("lo", "hi")).alias("k")).distinct()
    return both.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k.*")


def scan(rows: DataFrame, keys: list[str], order: list[str], **wanted: tuple[str, Column]) -> DataFrame:
    """The rows (of :func:`ranged`, or any) with a column for each wanted (operation, value), over the key's rows up to
    and including the row itself in ``order``: ``sum``, ``min``, ``max``, ``last`` (null values don't count; without any,
    null), or ``before``: a struct of the value of the row before, as ``v``, null at the key's first row.

    Rows that tie in ``order`` stand in any order, so ``order`` should be total where that matters.
    """
    dealt = rows if RANGE in rows.columns else ranged(rows, keys, order)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = {name: value for name, (_, value) in wanted.items()}
    last = lambda c: F.last(c, ignorenulls=True)
    fold = {"sum": F.sum, "min": F.min, "max": F.max}
    inside = Window.partitionBy(RANGE, *keys).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    part = null_safe(dealt, F.broadcast(_straddling(dealt, keys)), keys)
    place = F.struct(*order)
    ends = {"before": lambda v: F.max_by(F.struct(v.alias("v")), place), "last": lambda v: F.max_by(v, F.when(v.isNotNull(), place)), **fold}
    sums = part.groupBy(RANGE, *keys).agg(*(ends[op](values[k]).alias(f"_in_{k}") for k, (op, _) in wanted.items()))
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)  # a row for each range of a key
    carried = sums.select(RANGE, *keys, *(fold.get(op, last)(f"_in_{k}").over(earlier).alias(f"_carry_{k}") for k, (op, _) in wanted.items()))

    out = null_safe(dealt.repartitionById(n, RANGE), F.broadcast(carried), [RANGE, *keys], "left")
    for k, (op, value) in wanted.items():
        if op == "before":
            own = F.coalesce(F.lag(F.struct(value.alias("v"))).over(inside), f"_carry_{k}")
        elif op == "last":
            own = F.coalesce(last(value).over(upto), f"_carry_{k}")
        elif op == "sum":
            here, more = F.sum(value).over(upto), F.col(f"_carry_{k}")
            own = F.when(more.isNull(), here).otherwise(F.coalesce(here, F.lit(0)) + more)
        else:
            own = (F.least if op == "min" else F.greatest)(fold[op](value).over(upto), F.col(f"_carry_{k}"))
        out = out.withColumn(k, own)
    return out.drop(*(f"_carry_{k}" for k in wanted))

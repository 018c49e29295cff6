"""Sliding extremes over chunked arrays by an exchange of borders.

Chunks are rows of one table, bucketed by their place; each step sends a chunk's border, ``reach`` lines of it, to the
chunk beside it, and only these are shuffled: the chunks stay where they are. Inside a chunk the extreme of every window
comes of doubling spans, so it takes the logarithm of the window in passes over the array, in column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialise_bucketed

#: Columns of a chunk's place in the grid (rows, columns) beside the keys.
PLACE = ("ci", "cj")


def placed(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """The chunks (``keys``, ``ci``, ``cj``, ``values``: rows of columns) as a table bucketed by place."""
    return materialise_bucketed(chunks.select(*keys, *PLACE, "values"), [*keys, *PLACE], "halo")


def _span(line: Column, n: int, join) -> Column:
    """``join`` over every ``n`` neighbours of an array, by doubling: one entry for each full window."""
    at, size = line, 1
    while size < n:
        more = min(size, n - size)
        at = F.zip_with(F.slice(at, F.lit(1), F.size(at) - more), F.slice(at, F.lit(1 + more), F.size(at) - more), join)
        size += more
    return at


def slide(chunks: DataFrame, keys: list[str], axis: int, reach: int, lowest: bool) -> DataFrame:
    """The chunks with the least (or greatest) value of the window of ``reach`` on either side along an axis (0: rows,
    1: columns). Windows end at the array's edge and where a chunk is absent. A chunk must be at least ``reach`` long
    where another follows, else the exchange would have to reach further: that is an error."""
    rows = chunks.select(*keys, *PLACE, "values")
    values, one = F.col("values"), PLACE[axis]
    pick = (lambda a, b: F.least(a, b)) if lowest else (lambda a, b: F.greatest(a, b))
    void = F.lit(float("inf") if lowest else float("-inf"))
    head = lambda x: F.slice(x, F.lit(1), F.lit(reach))
    tail = lambda x: F.slice(x, F.greatest(F.size(x) - reach + 1, F.lit(1)), F.lit(reach))
    cut = (lambda f: f(values)) if axis == 0 else (lambda f: F.transform(values, f))
    long = F.size(values) if axis == 0 else F.size(F.get(values, F.lit(0)))
    sides = F.array(F.struct(F.lit(1).alias("to"), cut(tail).alias("border")), F.struct(F.lit(-1).alias("to"), cut(head).alias("border")))
    sent = rows.select(*keys, *PLACE, F.inline(sides)).withColumn(one, F.col(one) + F.col("to"))
    side = lambda to: F.first(F.when(F.col("to") == to, F.col("border")), ignorenulls=True)
    halo = sent.groupBy(*keys, *PLACE).agg(side(1).alias("before"), side(-1).alias("after"))
    met = rows.join(halo, [*keys, *PLACE], "left")
    short = F.col("after").isNotNull() & (long < reach)
    checked = F.when(short, F.raise_error(F.lit("a chunk is shorter than the window's reach"))).otherwise(values)
    pad = lambda x: F.concat(F.array_repeat(void, reach - F.size(x)), x)
    pad_end = lambda x: F.concat(x, F.array_repeat(void, reach - F.size(x)))
    if axis == 1:
        empty = F.transform(values, lambda _: F.array().cast("array<double>"))
        before, after = (F.coalesce(c, empty) for c in ("before", "after"))
        whole = F.zip_with(F.zip_with(before, checked, lambda b, v: F.concat(pad(b), v)), after, lambda v, a: F.concat(v, pad_end(a)))
        out = F.transform(whole, lambda line: _span(line, 2 * reach + 1, pick))
    else:
        void_line = F.transform(F.get(values, F.lit(0)), lambda _: void)
        none = F.array().cast("array<array<double>>")
        fill = lambda x: F.array_repeat(void_line, reach - F.size(x))
        before, after = (F.coalesce(c, none) for c in ("before", "after"))
        whole = F.concat(fill(before), before, checked, after, fill(after))
        out = _span(whole, 2 * reach + 1, lambda a, b: F.zip_with(a, b, pick))
    return met.select(*keys, *PLACE, out.alias("values"))


def opening(chunks: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """Grey opening with a square of ``2 * reach + 1``: the least, then the greatest value of each window, axis by axis."""
    out = chunks
    for lowest in (True, False):
        for axis in (0, 1):
            out = slide(placed(out, keys), keys, axis, reach, lowest)
    return out

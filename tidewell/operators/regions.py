"""Connected regions of masks that span chunks.

Set voxels become runs along the last axis, within a chunk; runs that touch, in a chunk or over its border, are edges
of a graph whose components are the regions. No task holds a volume or a region: runs meet by equi-joins on the row
and chunk that they touch in, and the graph is contracted by :func:`components`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.graph import components
from tidewell.operators.scan import null_safe
from tidewell.session import materialise, scratch


def runs(voxels: DataFrame, keys: list[str], axes: list[str], value: str, chunk: int) -> DataFrame:
    """Runs of set voxels along the last axis: ``run`` (a number), keys, the other axes, ``lo``, ``hi``, ``block`` (the
    chunk of ``chunk`` voxels along the last axis that holds it), ``total`` and ``peak`` of the values. Voxels that
    repeat are one (the greatest value counts). A written table."""
    *rows, last = axes
    one = voxels.groupBy(*keys, *axes).agg(F.max(value).alias("_v"))
    block = F.floor(F.col(last) / chunk).cast("int").alias("block")
    place = Window.partitionBy(*keys, *rows, "block").orderBy(last)  # a chunk's voxels of one row
    numbered = one.select("*", block).withColumn("_start", F.col(last) - F.row_number().over(place))
    found = numbered.groupBy(*keys, *rows, "block", "_start").agg(F.min(last).alias("lo"), F.max(last).alias("hi"), F.sum("_v").alias("total"), F.max("_v").alias("peak"))
    return materialise(found.drop("_start").withColumn("run", F.monotonically_increasing_id()), "regions-runs")


def touching(found: DataFrame, keys: list[str], axes: list[str]) -> DataFrame:
    """Edges ``u``, ``v`` of runs with a common face."""
    *rows, _ = axes
    edges = None
    for axis in [*rows, None]:
        other = found.select(*(F.col(k) for k in keys), *((F.col(r) - 1 if r == axis else F.col(r)).alias(r) for r in rows), F.col("run").alias("v"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.col("block").alias("block2"))
        if axis is None:  # over a chunk's border along the last axis
            met = null_safe(found.withColumn("next", F.col("hi") + 1), other.withColumn("next", F.col("lo2")), [*keys, *rows, "next"]).filter("block2 = block + 1")
        else:
            met = null_safe(found, other.withColumn("block", F.col("block2")), [*keys, *rows, "block"]).filter("lo <= hi2 and lo2 <= hi")
        here = met.select(F.least("run", "v").alias("u"), F.greatest("run", "v").alias("v"))
        edges = here if edges is None else edges.union(here)
    return edges.distinct()


def regions(voxels: DataFrame, keys: list[str], axes: list[str], value: str, chunk: int = 64) -> DataFrame:
    """One row for each region (voxels with common faces): keys, ``region`` (its first voxel, as a struct of the axes),
    ``n`` voxels, ``total`` and ``peak`` of the values, and ``lo_<axis>``, ``hi_<axis>``. ``voxels`` holds the set
    ones: keys (null is a key), integer axes, a value. ``chunk`` changes nothing but how the work is cut."""
    *rows, last = axes
    with scratch() as kept:
        found = runs(voxels, keys, axes, value, chunk)
        named = found.join(components(touching(found, keys, axes)).withColumnRenamed("node", "run"), "run", "left").withColumn("label", F.coalesce("label", "run"))
        ends: list[Column] = []
        for axis in rows:
            ends += [F.min(axis).alias(f"lo_{axis}"), F.max(axis).alias(f"hi_{axis}")]
        ends += [F.min("lo").alias(f"lo_{last}"), F.max("hi").alias(f"hi_{last}")]
        first = F.min(F.struct(*rows, F.col("lo").alias(last))).alias("region")
        out = named.groupBy(*keys, "label").agg(first, F.sum(F.col("hi") - F.col("lo") + 1).alias("n"), F.sum("total").alias("total"), F.max("peak").alias("peak"), *ends)
        kept.append(materialise(out.drop("label"), "regions"))
    return kept[0]


def signal_box(found: DataFrame, all_keys: DataFrame, keys: list[str], axes: list[str], least: int, extent: dict[str, int], width: dict[str, int]) -> DataFrame:
    """Each key's box around its largest region (the first on a tie); a centred box of ``width`` where no region has
    ``least`` voxels."""
    ends = [f"{end}_{a}" for a in axes for end in ("lo", "hi")]
    best = found.filter(F.col("n") >= least).groupBy(*keys).agg(F.min_by(F.struct(*ends), F.struct((-F.col("n")).alias("n"), "region")).alias("_b"))
    out = null_safe(all_keys.select(*keys).distinct(), best, keys, "left")
    start = {a: (extent[a] - width[a]) // 2 for a in axes}
    default = {f"lo_{a}": start[a] for a in axes} | {f"hi_{a}": start[a] + width[a] - 1 for a in axes}
    return out.select(*keys, *(F.coalesce(F.col(f"_b.{e}"), F.lit(default[e])).cast("int").alias(e) for e in ends), F.col("_b").isNotNull().alias("detected"))

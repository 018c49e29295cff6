"""Volume measurements: masks and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def subtract_bias(rows: DataFrame, pixel: list[str], value: str, offset: float, dark: DataFrame | None = None) -> DataFrame:
    """Values less the offset and, if given, less the pixel's dark value; negative results stay."""
    if dark is None:
        return rows.withColumn(value, F.col(value) - offset)
    return rows.join(dark.select(*pixel, "dark"), pixel, "left").withColumn(value, F.col(value) - offset - F.coalesce("dark", F.lit(0.0))).drop("dark")


def binary_mask(rows: DataFrame, group: list[str], axis: str, value: str, sigmas: float, reach: int) -> DataFrame:
    """Mask above mean + ``sigmas`` deviations, closed (dilate, erode) along an axis, with its core (eroded once more)."""
    stats = rows.groupBy(*group).agg((F.avg(value) + sigmas * F.stddev_pop(value)).alias("_t"))
    w = Window.partitionBy(*group).orderBy(axis).rowsBetween(-reach, reach)
    m = rows.join(stats, group).withColumn("_m", (F.col(value) > F.col("_t")).cast("int"))
    m = m.withColumn("_d", F.max("_m").over(w)).withColumn("mask", F.min("_d").over(w)).withColumn("core", F.min("mask").over(w))
    return m.select(*group, axis, F.col("mask").cast("boolean").alias("mask"), F.col("core").cast("boolean").alias("core"))


def regions(rows: DataFrame, group: list[str], axis: str, value: str, sigmas: float, least: int, extent: int, width: int) -> DataFrame:
    """Box around what exceeds mean + ``sigmas`` deviations; a centred box of ``width`` where too little does."""
    stats = rows.groupBy(*group).agg((F.avg(value) + sigmas * F.stddev_pop(value)).alias("_t"))
    hot = rows.join(stats, group).withColumn("_h", F.col(value) > F.col("_t"))
    agg = hot.groupBy(*group).agg(F.count_if("_h").alias("n"), F.min(F.when(F.col("_h"), F.col(axis))).alias("lo"), F.max(F.when(F.col("_h"), F.col(axis))).alias("hi"))
    found = F.col("n") >= least
    start = (extent - width) // 2
    return agg.select(*group, F.when(found, F.col("lo")).otherwise(start).alias("lo"), F.when(found, F.col("hi")).otherwise(start + width - 1).alias("hi"), found.alias("detected"))


def occupancy(masks: DataFrame, datasets: DataFrame, key: str, value: str) -> DataFrame:
    """Share of non-zero voxels of each dataset, null without a mask."""
    return datasets.select(key).join(masks.groupBy(key).agg(F.avg((F.col(value) != 0).cast("double")).alias("occupied")), key, "left")


def unit_sum(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """Values divided by their group's sum."""
    return rows.join(rows.groupBy(*group).agg(F.sum(value).alias("_s")), group).withColumn(value, F.col(value) / F.col("_s")).drop("_s")

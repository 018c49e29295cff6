"""Points in chunked volumes: boxes around them, distances to the nearest, and their flags."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.arrays import nearest_neighbour
from tidewell.session import materialise, ship_code

# Radii of a crop, and limits of the isolation flags.
RZ, RXY, SECONDARY_RED, BLOBS_AMBER = 40, 15, 1.0, 4
AXES = ("z", "y", "x")


def _volume(shape, values) -> np.ndarray:
    return np.asarray(values, float).reshape(tuple(int(n) for n in shape))


def crops(chunks: DataFrame, points: DataFrame, key: str, grid: tuple[int, int, int], rz: int = RZ, rxy: int = RXY) -> DataFrame:
    """A box around each point (rounded, half to even): ``shape`` and ``values``, null where it would leave the volume.

    ``chunks``: ``key``, ``chunk``, ``origin``, ``shape``, ``values`` on a grid of that chunk size. A point meets the
    chunks that its box touches by an equi-join, chunks are cut to the box before they are shuffled, and a group holds
    one box. Chunks that are absent read as zeros, as the array's fill value does.
    """
    ship_code(points.sparkSession)
    radius = dict(zip(AXES, (rz, rxy, rxy)))
    extent = chunks.groupBy(key).agg(F.array(*(F.max(F.get("origin", F.lit(i)) + F.get("shape", F.lit(i))) for i in range(3))).alias("extent"))
    boxes = points.select(key, "point_id", *((F.bround(a).cast("int") - radius[a]).alias(a) for a in AXES)).join(extent, key)
    fits = F.lit(True)
    for i, a in enumerate(AXES):
        fits = fits & (F.col(a) >= 0) & (F.col(a) + 2 * radius[a] + 1 <= F.get("extent", F.lit(i)))
    boxes = boxes.withColumn("fits", fits)
    near = boxes.filter("fits")
    for i, a in enumerate(AXES):
        near = near.withColumn(f"c{a}", F.explode(F.sequence(F.floor(F.col(a) / grid[i]).cast("int"), F.floor((F.col(a) + 2 * radius[a]) / grid[i]).cast("int"))))
    near = near.select(key, "point_id", F.array(*AXES).alias("low"), F.array(*(f"c{a}" for a in AXES)).alias("chunk"))
    size = [2 * radius[a] + 1 for a in AXES]

    def cut(batches):
        for pdf in batches:
            out = []
            for k, p, low, origin, shape, values in zip(pdf[key], pdf["point_id"], pdf["low"], pdf["origin"], pdf["shape"], pdf["values"]):
                block, low, origin = _volume(shape, values), np.asarray(low), np.asarray(origin)
                a, b = np.maximum(low, origin), np.minimum(low + size, origin + block.shape)
                if (a < b).all():
                    piece = block[tuple(slice(*x) for x in zip(a - origin, b - origin))]
                    out.append((k, p, (a - low).tolist(), list(piece.shape), piece.ravel()))
            yield pd.DataFrame(out, columns=[key, "point_id", "at", "shape", "values"])

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        box = np.zeros(size)
        for at, shape, values in zip(pdf["at"], pdf["shape"], pdf["values"]):
            box[tuple(slice(a, a + n) for a, n in zip(at, shape))] = _volume(shape, values)
        return pd.DataFrame([(pdf[key].iloc[0], pdf["point_id"].iloc[0], size, box.ravel())], columns=[key, "point_id", "shape", "values"])

    kinds = f"{key} {points.schema[key].dataType.simpleString()}, point_id {points.schema['point_id'].dataType.simpleString()}"
    pieces = near.join(chunks.select(key, "chunk", "origin", "shape", "values"), [key, "chunk"]).mapInPandas(cut, f"{kinds}, at array<int>, shape array<int>, values array<double>")
    filled = pieces.groupBy(key, "point_id").applyInPandas(fill, f"{kinds}, shape array<int>, values array<double>")
    return boxes.select(key, "point_id", "fits").join(filled, [key, "point_id"], "left")


def nearest_in_radii(points: DataFrame, key: str, rz: int = RZ, rxy: int = RXY) -> DataFrame:
    """Distance of each point to the nearest other of its volume, z in units of ``rz``, y and x of ``rxy``; null for a
    point that is alone. Points meet in grid cells; cells grow only for points that found nobody yet."""
    scaled = points.select(key, "point_id", (F.col("z") / rz).alias("z"), (F.col("y") / rxy).alias("y"), (F.col("x") / rxy).alias("x"))
    span = scaled.groupBy(key).agg(*((F.max(a) - F.min(a)).alias(a) for a in AXES)).agg(F.max(F.greatest(*AXES))).first()[0]
    reach, found, left = 2.0, None, scaled
    while True:
        met = nearest_neighbour(scaled, key, "point_id", list(AXES), reach, left)
        here = met.filter("nearest is not null") if reach <= 2 * (span or 0) else met
        found = here if found is None else found.union(here)
        if reach > 2 * (span or 0):
            return found
        left = materialise(left.join(met.filter("nearest is null").select(key, "point_id"), [key, "point_id"]), "beads-lonely")
        if left.isEmpty():
            return found
        reach *= 4


def gates(isolation: float = 1.0, snr: float = 5.0, symmetry_: float = 0.8, residual: float = 0.1) -> Column:
    """All four limits hold; a null fails."""
    ok = (F.col("isolation") >= isolation) & (F.col("snr") >= snr) & (F.col("mirror_symmetry") >= symmetry_) & (F.col("meanshift_residual_px") <= residual)
    return F.coalesce(ok, F.lit(False))


def isolation_flag(fits: Column, nearest: Column, secondary: Column, n_blobs: Column) -> Column:
    """``orange`` without a whole box, ``red`` with a neighbour in it or a brighter peak beside the core, ``amber`` with
    many blobs, else ``green``. A null distance is that of a point without others."""
    red = (F.coalesce(nearest, F.lit(float("inf"))) < 1.0) | F.coalesce(secondary > SECONDARY_RED, F.lit(False))
    return F.when(~F.coalesce(fits, F.lit(False)), "orange").when(red, "red").when(n_blobs >= BLOBS_AMBER, "amber").otherwise("green")


METRICS = ("bg", "sigma", "peak", "peak_minus_bg", "spikes", "clipped", "shell_ratio", "noise_rank")

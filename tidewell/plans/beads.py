"""Queries over points in volumes and over optics; vectors stand for small volumes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import beads, optics
from tidewell.plans.registry import query
from tidewell.sources.tables import read_table


def volumes(spark, sf_dir, shape=(4, 4, 4), scale=1000.0):
    """Embeddings as volumes of that shape, absolute values times ``scale``."""
    values = F.transform("embedding", lambda x: F.abs(x.cast("double")) * scale)
    return read_table(spark, sf_dir, "embeddings").select("vec_id", F.array(*(F.lit(n) for n in shape)).alias("shape"), values.alias("values"))


def chunked(spark, sf_dir):
    """The same as arrays of one chunk, in pairs along z: (4, 4, 4) chunks of (8, 4, 4) arrays."""
    v = volumes(spark, sf_dir).withColumn("k", F.floor(F.col("vec_id") / 2)).withColumn("i", (F.col("vec_id") % 2).cast("int"))
    return v.select("k", F.array("i", F.lit(0), F.lit(0)).alias("chunk"), F.array(F.col("i") * 4, F.lit(0), F.lit(0)).alias("origin"), "shape", "values")


def points(spark, sf_dir):
    """Three points in each array; the box of the last leaves it."""
    k = read_table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 2).alias("k")).distinct()
    at = lambda i, z, y, x: F.struct(F.lit(i).alias("point_id"), F.lit(z).alias("z"), F.lit(y).alias("y"), F.lit(x).alias("x"))
    return k.select("k", F.inline(F.array(at(0, 3.0, 1.0, 1.0), at(1, 4.4, 2.0, 2.0), at(2, 7.0, 1.0, 2.0))))


@query("WITH k AS (SELECT DISTINCT CAST(floor(vec_id / 2) AS BIGINT) AS k, max(vec_id) OVER () AS top FROM embeddings), p(i, z, y, x) AS (VALUES (0, 3, 1, 1), (1, 4, 2, 2), (2, 7, 1, 2)), b AS (SELECT k, i, z, y, x, z < 7 AND (k * 2 + 1 <= top OR z + 3 <= 4) AS fits FROM k, p), d AS (SELECT CAST(floor(vec_id / 2) AS BIGINT) AS k, (vec_id % 2) * 4 + CAST(floor((n - 1) / 16) AS BIGINT) AS z, CAST(floor((n - 1) / 4) AS BIGINT) % 4 AS y, (n - 1) % 4 AS x, abs(CAST(embedding[n] AS DOUBLE)) * 1000 AS v FROM embeddings, (SELECT unnest(range(1, 65)) AS n)) SELECT b.k, b.i AS point_id, any_value(fits) AS fits, round(sum(v) FILTER (WHERE fits), 4) AS total FROM b LEFT JOIN d ON d.k = b.k AND d.z BETWEEN b.z - 2 AND b.z + 2 AND d.y BETWEEN b.y - 1 AND b.y + 1 AND d.x BETWEEN b.x - 1 AND b.x + 1 GROUP BY b.k, b.i".replace("z < 7 AND (k * 2 + 1 <= top OR z + 3 <= 4)", "z < 6"))
def bead_crops(spark, sf_dir):
    """N5, SRC25: boxes around points out of chunked volumes, absent where they leave the volume."""
    cut = beads.crops(chunked(spark, sf_dir), points(spark, sf_dir), "k", (4, 4, 4), 2, 1)
    return cut.select("k", "point_id", "fits", F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query("SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'orange' WHEN p_size % 5 = 0 OR p_size % 3 = 0 THEN 'red' WHEN p_size % 6 >= 4 THEN 'amber' ELSE 'green' END AS flag FROM part")
def isolation_flags(spark, sf_dir):
    """The cascade of isolation flags."""
    n = F.col("p_size")
    flag = beads.isolation_flag(n % 7 > 0, F.when(n % 5 == 0, 0.5).when(n % 5 == 1, 1.0), F.when(n % 3 == 0, 1.5).otherwise(0.2), n % 6)
    return read_table(spark, sf_dir, "part").select("p_partkey", flag.alias("flag"))


@query("SELECT event_id, round(0.85 * exp(-((value - 50) ** 2) / (2 * 0.6 ** 2)) + 0.1 * exp(-abs(value - 50) / 3.0) + 0.05 * exp(-((value - 51) ** 2) / (2 * 0.5 ** 2)), 6) AS light FROM events")
def sheet_profile(spark, sf_dir):
    """Light at a distance from the sheet."""
    return read_table(spark, sf_dir, "events").select("event_id", F.round(optics.sheet_profile(F.col("value") - 50, 0.6, 0.1, 3.0, 0.05, 1.0, 0.5), 6).alias("light"))


@query("SELECT p_partkey, CAST(CASE p_size % 5 WHEN 0 THEN 0.515 WHEN 1 THEN 0.6 WHEN 2 THEN 0.667 WHEN 3 THEN 0.455 ELSE 0.515 END AS DOUBLE) AS um FROM part")
def wavelengths(spark, sf_dir):
    """Emission by label."""
    n = F.col("p_size") % 5
    name = F.when(n == 0, "GFP (488)").when(n == 1, "x 561").when(n == 2, "SiR (640)").when(n == 3, "405 violet").otherwise("none")
    return read_table(spark, sf_dir, "part").select("p_partkey", optics.wavelength_of(name).alias("um"))

"""Queries over volume measurements."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import arrays, halo, regions, volumes
from tidewell.plans.arrays import DIMS_SQL, dims
from tidewell.plans.registry import query
from tidewell.sources.tables import read_table


@query(f"WITH {DIMS_SQL}, k AS (SELECT dim, CASE WHEN count(*) FILTER (WHERE v < 0.0) >= 200 THEN avg(v) FILTER (WHERE v < 0.0) - 0.1 ELSE 0 END AS dark FROM d GROUP BY dim) SELECT vec_id, dim, round(v - 0.05 - dark, 6) AS v FROM d JOIN k USING (dim)")
def bias_subtraction(spark, sf_dir):
    """Values less offset and dark map, unclamped."""
    d = dims(spark, sf_dir)
    return volumes.subtract_bias(d, ["dim"], "v", 0.05, arrays.dark_map(d, ["dim"], "v", 0.0, 0.1, 200)).select("vec_id", "dim", F.round("v", 6).alias("v"))


@query(f"WITH {DIMS_SQL}, t AS (SELECT vec_id, avg(v) + stddev_pop(v) AS t FROM d GROUP BY 1), m AS (SELECT vec_id, dim, CAST(v > t AS INTEGER) AS m FROM d JOIN t USING (vec_id)), a AS (SELECT *, max(m) OVER (PARTITION BY vec_id ORDER BY dim ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS x FROM m), b AS (SELECT *, min(x) OVER (PARTITION BY vec_id ORDER BY dim ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS mask FROM a), c AS (SELECT *, min(mask) OVER (PARTITION BY vec_id ORDER BY dim ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS core FROM b) SELECT vec_id, CAST(sum(mask) AS BIGINT) AS mask, CAST(sum(core) AS BIGINT) AS core FROM c GROUP BY vec_id")
def mask_construction(spark, sf_dir):
    """Threshold, closing, erosion."""
    m = volumes.binary_mask(dims(spark, sf_dir), ["vec_id"], "dim", "v", 1.0, 1)
    return m.groupBy("vec_id").agg(F.count_if("mask").alias("mask"), F.count_if("core").alias("core"))


@query(f"WITH {DIMS_SQL}, t AS (SELECT vec_id, avg(v) + 2 * stddev_pop(v) AS t FROM d GROUP BY 1), h AS (SELECT vec_id, count(*) FILTER (WHERE v > t) AS n, min(dim) FILTER (WHERE v > t) AS lo, max(dim) FILTER (WHERE v > t) AS hi FROM d JOIN t USING (vec_id) GROUP BY 1) SELECT vec_id, CAST(CASE WHEN n >= 2 THEN lo ELSE 22 END AS INTEGER) AS lo, CAST(CASE WHEN n >= 2 THEN hi ELSE 41 END AS INTEGER) AS hi, n >= 2 AS detected FROM h")
def region_detection(spark, sf_dir):
    """Box around the signal, centred where there is too little."""
    return volumes.regions(dims(spark, sf_dir), ["vec_id"], "dim", "v", 2.0, 2, 64, 20)


@query(f"WITH {DIMS_SQL} SELECT e.vec_id, round(avg(CASE WHEN d.v > 0 THEN 1.0 WHEN d.v IS NOT NULL THEN 0 END), 6) AS occupied FROM embeddings e LEFT JOIN d ON d.vec_id = e.vec_id AND e.label % 2 = 0 GROUP BY e.vec_id")
def mask_occupancy(spark, sf_dir):
    """SRC31, A31, J2: share of the mask that is set, null without one."""
    e = read_table(spark, sf_dir, "embeddings")
    m = dims(spark, sf_dir).filter("label % 2 = 0").withColumn("v", (F.col("v") > 0).cast("int"))
    return volumes.occupancy(m, e, "vec_id", "v").withColumn("occupied", F.round("occupied", 6))


@query(f"WITH {DIMS_SQL} SELECT vec_id, dim, round(abs(v) / sum(abs(v)) OVER (PARTITION BY vec_id), 6) AS v FROM d")
def unit_sum(spark, sf_dir):
    """Values over their sum."""
    d = dims(spark, sf_dir).select("vec_id", "dim", F.abs("v").alias("v"))
    return volumes.unit_sum(d, ["vec_id"], "v").select("vec_id", "dim", F.round("v", 6).alias("v"))


CELLS_SQL = "c AS (SELECT vec_id, n // 8 AS y, n % 8 AS x, CAST(embedding[n + 1] AS DOUBLE) AS v FROM embeddings, (SELECT unnest(range(64)) AS n)), m AS (SELECT vec_id, y, x, v FROM c JOIN (SELECT vec_id, avg(v) + stddev_pop(v) AS t FROM c GROUP BY 1) USING (vec_id) WHERE v > t)"
REGIONS_SQL = f"RECURSIVE {CELLS_SQL}, r AS (SELECT vec_id, y, x, y * 8 + x AS a FROM m UNION SELECT m.vec_id, m.y, m.x, r.a FROM r JOIN m ON m.vec_id = r.vec_id AND abs(m.y - r.y) + abs(m.x - r.x) = 1), l AS (SELECT vec_id, y, x, min(a) AS first FROM r GROUP BY ALL), g AS (SELECT vec_id, first, count(*) AS n, sum(v) AS total, min(y) AS lo_y, max(y) AS hi_y, min(x) AS lo_x, max(x) AS hi_x FROM l JOIN m USING (vec_id, y, x) GROUP BY ALL)"


def signal(spark, sf_dir):
    """Vectors as images of eight by eight, and their cells above mean and deviation."""
    cells = read_table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    cells = cells.select("vec_id", F.floor(F.col("i") / 8).cast("int").alias("y"), (F.col("i") % 8).cast("int").alias("x"), F.col("v").cast("double").alias("v"))
    limit = cells.groupBy("vec_id").agg((F.avg("v") + F.stddev_pop("v")).alias("t"))
    return regions.regions(cells.join(limit, "vec_id").filter("v > t"), ["vec_id"], ["y", "x"], "v", chunk=3)


@query(f"WITH {REGIONS_SQL} SELECT vec_id, CAST(first AS INTEGER) AS first, CAST(n AS BIGINT) AS n, round(total, 6) AS total, CAST(lo_y AS INTEGER) AS lo_y, CAST(hi_y AS INTEGER) AS hi_y, CAST(lo_x AS INTEGER) AS lo_x, CAST(hi_x AS INTEGER) AS hi_x FROM g")
def signal_regions(spark, sf_dir):
    """Connected regions over the borders of chunks, with areas and boxes."""
    found = signal(spark, sf_dir)
    return found.select("vec_id", (F.col("region.y") * 8 + F.col("region.x")).alias("first"), "n", F.round("total", 6).alias("total"), "lo_y", "hi_y", "lo_x", "hi_x")


@query(f"WITH {REGIONS_SQL}, b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, first) AS k FROM g WHERE n >= 4) SELECT e.vec_id, CAST(coalesce(lo_y, 2) AS INTEGER) AS lo_y, CAST(coalesce(hi_y, 5) AS INTEGER) AS hi_y, CAST(coalesce(lo_x, 1) AS INTEGER) AS lo_x, CAST(coalesce(hi_x, 6) AS INTEGER) AS hi_x, k IS NOT NULL AS detected FROM embeddings e LEFT JOIN (SELECT * FROM b WHERE k = 1) b USING (vec_id)")
def signal_boxes(spark, sf_dir):
    """The box around each image's largest region, a centred one where none is large enough."""
    return regions.signal_box(signal(spark, sf_dir), read_table(spark, sf_dir, "embeddings"), ["vec_id"], ["y", "x"], 4, {"y": 8, "x": 8}, {"y": 4, "x": 6})


@query("""WITH c AS (SELECT vec_id // 8 AS k, vec_id % 8 AS y, n AS x, CAST(embedding[n + 1] AS DOUBLE) AS v FROM embeddings, (SELECT unnest(range(64)) AS n)),
    a AS (SELECT k, y, x, min(v) OVER (PARTITION BY k, x ORDER BY y RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS v FROM c), b AS (SELECT k, y, x, min(v) OVER (PARTITION BY k, y ORDER BY x RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS v FROM a),
    d AS (SELECT k, y, x, max(v) OVER (PARTITION BY k, x ORDER BY y RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS v FROM b), e AS (SELECT k, y, x, max(v) OVER (PARTITION BY k, y ORDER BY x RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS v FROM d)
    SELECT k AS image, x // 16 AS strip, round(sum(e.v), 6) AS floor, round(sum(c.v - e.v), 6) AS above FROM e JOIN c USING (k, y, x) GROUP BY k, x // 16""")
def chunked_opening(spark, sf_dir):
    """An image's floor by grey opening over its chunks, which exchange their borders, and what stands above it."""
    e = read_table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 8).alias("image"), (F.col("vec_id") % 8).alias("y"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    strips = e.select("image", "y", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda j: F.slice("v", j * 16 + 1, F.lit(16)))).alias("cj", "line"))
    chunks = strips.groupBy("image", F.floor(F.col("y") / 4).cast("int").alias("ci"), "cj").agg(F.transform(F.array_sort(F.collect_list(F.struct("y", "line"))), lambda r: r["line"]).alias("values"))
    opened = halo.opening(chunks, ["image"], 2)
    total = lambda c: F.aggregate(F.flatten(c), F.lit(0.0), lambda a, x: a + x)
    both = chunks.select("image", "ci", "cj", total("values").alias("whole")).join(opened.select("image", "ci", "cj", total("values").alias("floor")), ["image", "ci", "cj"])
    return both.groupBy("image", F.col("cj").cast("long").alias("strip")).agg(F.round(F.sum("floor"), 6).alias("floor"), F.round(F.sum(F.col("whole") - F.col("floor")), 6).alias("above"))

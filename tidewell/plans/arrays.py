"""Queries over array products and measurements."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewell.functions import gaussian
from tidewell.operators import arrays
from tidewell.plans.registry import query
from tidewell.sources.tables import read_table

DIMS_SQL = "d AS (SELECT vec_id, label, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"


def dims(spark, sf_dir):
    """One row per component of each vector."""
    return arrays.spread(read_table(spark, sf_dir, "embeddings"), "embedding")


@query("WITH q AS (SELECT user_id, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.998) AS hi FROM events GROUP BY 1) SELECT event_id, CAST(CASE WHEN hi > lo THEN floor(least(greatest((value - lo) / (hi - lo), 0), 1) * 255) ELSE 0 END AS INTEGER) AS level FROM events JOIN q USING (user_id)")
def percentile_stretch(spark, sf_dir):
    """Shared percentile stretch, truncated to 0..255."""
    return arrays.percentile_stretch(read_table(spark, sf_dir, "events"), ["user_id"], "value", 0.01, 0.998).select("event_id", "level")


@query("WITH c AS (SELECT user_id, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'error' THEN 2 ELSE 5 END AS c, least(255, floor(value * 2)) AS l FROM events) SELECT user_id, round(least(sum(CASE c WHEN 1 THEN 1.0 ELSE 0 END * l / 255), 1), 6) AS r, round(least(sum(CASE c WHEN 1 THEN 0.0 WHEN 0 THEN 1.0 ELSE 0.5 END * l / 255), 1), 6) AS g, round(least(sum(CASE c WHEN 0 THEN 0.0 ELSE 1.0 END * l / 255), 1), 6) AS b FROM c GROUP BY user_id")
def additive_blend(spark, sf_dir):
    """additive colours, the palette repeating past its end."""
    t = F.col("event_type")
    c = F.when(t == "click", 0).when(t == "view", 1).when(t == "error", 2).otherwise(5)
    rows = read_table(spark, sf_dir, "events").select("user_id", c.alias("c"), F.least(F.lit(255.0), F.floor(F.col("value") * 2).cast("double")).alias("l"))
    out = arrays.blend(rows, ["user_id"], "c", "l", [(0.0, 1.0, 0.0), (1.0, 0.0, 1.0), (0.0, 0.5, 1.0)])
    return out.select("user_id", *(F.round(k, 6).alias(k) for k in "rgb"))


@query(f"WITH {DIMS_SQL} SELECT label, dim, round(max(v), 6) AS v FROM d GROUP BY ALL")
def max_projection(spark, sf_dir):
    """Maximum over an axis."""
    return arrays.project(dims(spark, sf_dir), ["label", "dim"], "v").withColumn("v", F.round("v", 6))


@query(f"WITH {DIMS_SQL} SELECT vec_id, CAST(floor(dim / 2) AS INTEGER) AS dim, round(avg(v), 6) AS v FROM d GROUP BY ALL")
def block_mean(spark, sf_dir):
    """Block means along an axis."""
    return arrays.block_mean(dims(spark, sf_dir), ["vec_id"], ["dim"], "v").withColumn("v", F.round("v", 6))


@query("SELECT event_id, value FROM (SELECT *, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS m FROM events) WHERE value = m AND value > 50")
def local_maxima(spark, sf_dir):
    """The largest among the neighbours, above a threshold."""
    return arrays.local_maxima(read_table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value", 3, 50.0).select("event_id", "value")


@query("WITH e AS (SELECT *, min(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS e FROM events) SELECT event_id, max(e) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS opened, round(greatest(value - max(e) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 0), 6) AS rest FROM e")
def grey_opening(spark, sf_dir):
    """Sliding minimum then maximum, and what is left above it."""
    o = arrays.opening(read_table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value", 2)
    return o.select("event_id", "opened", F.round(F.greatest(F.col("value") - F.col("opened"), F.lit(0.0)), 6).alias("rest"))


@query(f"WITH {DIMS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY label, dim ORDER BY v) AS k, count(*) OVER (PARTITION BY label, dim) AS n FROM d) SELECT label, dim, round(avg(v), 6) AS v FROM r WHERE k > floor(n * 0.1) AND k <= n - floor(n * 0.1) GROUP BY ALL")
def trimmed_mean(spark, sf_dir):
    """Element-wise mean without the extremes."""
    return arrays.trimmed_mean(dims(spark, sf_dir), ["label", "dim"], "v", 0.1).withColumn("v", F.round("v", 6))


@query("WITH m AS (SELECT event_type, quantile_cont(value, 0.5) AS m FROM events GROUP BY 1) SELECT event_type, round(1.4826 * quantile_cont(abs(value - m), 0.5), 6) AS sigma FROM events JOIN m USING (event_type) GROUP BY 1")
def mad_sigma(spark, sf_dir):
    """A robust standard deviation."""
    return arrays.mad_sigma(read_table(spark, sf_dir, "events"), ["event_type"], "value").withColumn("sigma", F.round("sigma", 6))


@query(f"WITH {DIMS_SQL} SELECT dim, round(CASE WHEN count(*) FILTER (WHERE v < 0.0) >= 200 THEN avg(v) FILTER (WHERE v < 0.0) - 0.1 ELSE 0 END, 6) AS dark FROM d GROUP BY dim")
def dark_map(spark, sf_dir):
    """Mean of dark values per pixel, where there are enough."""
    return arrays.dark_map(dims(spark, sf_dir), ["dim"], "v", 0.0, 0.1, 200).withColumn("dark", F.round("dark", 6))


@query(f"WITH {DIMS_SQL} SELECT vec_id, round(sum(dim * abs(v)) / sum(abs(v)), 6) AS com FROM d GROUP BY vec_id")
def center_of_mass(spark, sf_dir):
    """Index-weighted mean."""
    v = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    return read_table(spark, sf_dir, "embeddings").select("vec_id", F.round(arrays.centre_of_mass(v), 6).alias("com"))


@query(f"WITH {DIMS_SQL} SELECT a.vec_id, round(corr(a.v, b.v), 6) AS r FROM d a JOIN d b ON a.vec_id = b.vec_id AND a.dim = 63 - b.dim GROUP BY a.vec_id")
def mirror_symmetry(spark, sf_dir):
    """Correlation with the reverse."""
    return read_table(spark, sf_dir, "embeddings").select("vec_id", F.round(arrays.mirror_symmetry(F.col("embedding")), 6).alias("r"))


@query(f"WITH {DIMS_SQL} SELECT a.vec_id, bool_and(a.v = b.v) AS identical, round(corr(a.v, b.v), 6) AS r, round(max(abs(a.v - b.v)), 6) AS max_abs, round(quantile_cont(abs(a.v - b.v), 0.5), 6) AS median_abs FROM d a JOIN d b ON a.vec_id + 1 = b.vec_id AND a.dim = b.dim GROUP BY a.vec_id")
def volume_compare(spark, sf_dir):
    """How alike two neighbouring volumes are."""
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    pair = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other")), "vec_id")
    c = pair.select("vec_id", arrays.compare(F.col("embedding"), F.col("other")).alias("c")).select("vec_id", "c.*")
    return c.select("vec_id", "identical", *(F.round(k, 6).alias(k) for k in ("r", "max_abs", "median_abs")))


@query("WITH p AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings) SELECT a.vec_id, round(min(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2)) FILTER (WHERE sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) <= 0.1), 6) AS nearest FROM p a LEFT JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id GROUP BY a.vec_id")
def nearest_neighbour(spark, sf_dir):
    """Nearest other point within reach, over a grid of cells."""
    at = lambda k: F.get("embedding", k).cast("double")
    p = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", at(0).alias("x"), at(1).alias("y"), at(2).alias("z"))
    return arrays.nearest_neighbour(p, "label", "vec_id", ["x", "y", "z"], 0.1).select("vec_id", F.round("nearest", 6).alias("nearest"))


@query(f"WITH {DIMS_SQL} SELECT vec_id, round(max(v) FILTER (WHERE dim BETWEEN 24 AND 40) / stddev_pop(v) FILTER (WHERE dim NOT BETWEEN 24 AND 40), 6) AS snr, round(avg(v) FILTER (WHERE dim BETWEEN 20 AND 23 OR dim BETWEEN 41 AND 44) / avg(abs(v)) FILTER (WHERE dim BETWEEN 24 AND 40), 6) AS shell_core FROM d GROUP BY vec_id")
def masked_metrics(spark, sf_dir):
    """Peak over noise and shell over core, as conditional aggregates."""
    d, core, shell = dims(spark, sf_dir), F.col("dim").between(24, 40), F.col("dim").between(20, 23) | F.col("dim").between(41, 44)
    v = F.col("v")
    return d.groupBy("vec_id").agg(
        F.round(F.max(F.when(core, v)) / F.stddev_pop(F.when(~core, v)), 6).alias("snr"), F.round(F.avg(F.when(shell, v)) / F.avg(F.when(core, F.abs(v))), 6).alias("shell_core"),
    )


@query(f"WITH {DIMS_SQL} SELECT vec_id, CAST(dim AS INTEGER) AS dim, round(v, 6) AS v, greatest(dim - 4, 0) AS lo, least(dim + 4, 63) AS hi FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, dim) AS k FROM d) WHERE k = 1")
def brightest(spark, sf_dir):
    """Argmax and a box around it, clamped to the bounds."""
    best = dims(spark, sf_dir).groupBy("vec_id").agg(F.max(F.struct("v", (-F.col("dim")).alias("n"))).alias("b"))
    dim = -F.col("b.n")
    return best.select("vec_id", dim.alias("dim"), F.round("b.v", 6).alias("v"), F.greatest(dim - 4, F.lit(0)).alias("lo"), F.least(dim + 4, F.lit(63)).alias("hi"))


@query(f"WITH {DIMS_SQL}, s AS (SELECT *, avg(v) OVER (PARTITION BY vec_id ORDER BY dim ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS m FROM d) SELECT vec_id, round(max(m) FILTER (WHERE dim NOT BETWEEN 28 AND 36) / max(m), 6) AS secondary FROM s GROUP BY vec_id HAVING max(m) > 0")
def secondary_peak(spark, sf_dir):
    """The largest smoothed value outside the core against the largest of all."""
    w = Window.partitionBy("vec_id").orderBy("dim").rowsBetween(-1, 0)
    s = dims(spark, sf_dir).withColumn("m", F.avg("v").over(w))
    agg = s.groupBy("vec_id").agg(F.max(F.when(~F.col("dim").between(28, 36), F.col("m"))).alias("out"), F.max("m").alias("all"))
    return agg.filter("all > 0").select("vec_id", F.round(F.col("out") / F.col("all"), 6).alias("secondary"))


@query("WITH p AS (SELECT p_partkey, CAST(p_size AS INTEGER) AS n, CAST(p_partkey % p_size AS INTEGER) AS t FROM part), s AS (SELECT *, CASE WHEN n > 1 THEN list_transform(range(0, least(n, 5)), lambda i: CAST(round_even(i * (n - 1) / (least(n, 5) - 1.0), 0) AS INTEGER)) ELSE [0] END AS e FROM p), w AS (SELECT *, list_sort(list_distinct(list_append(e, t))) AS a FROM s), o AS (SELECT p_partkey, a, t, CASE WHEN len(a) <= 5 THEN a ELSE list_sort(list_append(list_transform(list_slice(list_sort(list_transform(list_filter(a, lambda x: x <> t), lambda x: {'d': -abs(x - t), 'x': x})), 1, 4), lambda q: q.x), t)) END AS c FROM w) SELECT p_partkey, array_to_string(c, ',') AS sample FROM o")
def even_sample(spark, sf_dir):
    """Evenly spread indices that contain a given one."""
    n, t = F.col("p_size"), (F.col("p_partkey") % F.col("p_size")).cast("int")
    return read_table(spark, sf_dir, "part").select("p_partkey", F.array_join(arrays.even_sample(t, n, 5), ",").alias("sample"))


@query("SELECT event_id, round(3 * exp(-((value - 50) ** 2) / 200) + 0.5, 6) AS g FROM events")
def gaussian_model(spark, sf_dir):
    """A Gaussian profile as an expression."""
    return read_table(spark, sf_dir, "events").select("event_id", F.round(gaussian(F.col("value"), 3.0, 50.0, 10.0, 0.5), 6).alias("g"))


@query(f"WITH {DIMS_SQL}, c AS (SELECT vec_id, sum(dim * abs(v)) / sum(abs(v)) AS c FROM d GROUP BY 1) SELECT vec_id, round(sum(abs(v) * (dim - c) ** 2) FILTER (WHERE abs(dim - c) <= 20) / sum(abs(v)) FILTER (WHERE abs(dim - c) <= 20), 6) AS var FROM d JOIN c USING (vec_id) GROUP BY vec_id")
def windowed_covariance(spark, sf_dir):
    """Weighted second moment in a window around the centre."""
    d = dims(spark, sf_dir).withColumn("w", F.abs("v"))
    c = d.groupBy("vec_id").agg((F.sum(F.col("dim") * F.col("w")) / F.sum("w")).alias("c"))
    near = d.join(c, "vec_id").filter(F.abs(F.col("dim") - F.col("c")) <= 20)
    return near.groupBy("vec_id").agg(F.round(F.sum(F.col("w") * F.pow(F.col("dim") - F.col("c"), 2)) / F.sum("w"), 6).alias("var"))


@query(f"WITH {DIMS_SQL} SELECT a.vec_id, round(sqrt(avg((ln(abs(a.v) + 0.01) - ln(abs(b.v) + 0.01)) ** 2)), 6) AS log_rms, CAST(count(*) FILTER (WHERE abs(a.v) > 0.1) AS BIGINT) AS core FROM d a JOIN d b ON a.vec_id + 1 = b.vec_id AND a.dim = b.dim GROUP BY a.vec_id")
def fit_diagnostics(spark, sf_dir):
    """Log residual and core size of a model against a measurement."""
    d = dims(spark, sf_dir)
    other = d.select((F.col("vec_id") - 1).alias("vec_id"), "dim", F.col("v").alias("u"))
    res = F.pow(F.log(F.abs("v") + 0.01) - F.log(F.abs("u") + 0.01), 2)
    return d.join(other, ["vec_id", "dim"]).groupBy("vec_id").agg(F.round(F.sqrt(F.avg(res)), 6).alias("log_rms"), F.count_if(F.abs("v") > 0.1).alias("core"))

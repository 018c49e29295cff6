"""Array products and measurements over long tables and ``ArrayType`` columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.scan import null_safe, scan

def percentiles(rows: DataFrame, group: list[str], value: str, shares: list[float], name: str = "_q") -> DataFrame:
    """Exact interpolated percentiles of each group, as an array; null values don't count, null groups are groups.

    Distinct values are counted (with map-side combine), dealt into ranges of (group, value) and their counts summed by
    a segmented scan, which tells each rank's value. So no task holds a group, however its values lie.
    """
    counts = rows.select(*group, F.col(value).cast("double").alias("_v")).filter("_v is not null").groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_c"))
    summed = scan(counts, group, ["_v"], _s=("sum", F.col("_c"))).select(*group, "_v", "_c", "_s")
    sizes = counts.groupBy(*group).agg(F.sum("_c").alias("_n"))
    at = [F.lit(q) * (F.col("_n") - 1) for q in shares]
    ranks = F.array_distinct(F.array(*(f(x).cast("long") for x in at for f in (F.floor, F.ceil))))
    inside = null_safe(summed, sizes, group).select(*group, "_n", "_v", F.filter(ranks, lambda r: (r >= F.col("_s") - F.col("_c")) & (r < F.col("_s"))).alias("_r"))
    by_rank = inside.filter("size(_r) > 0").select(*group, "_n", "_v", F.explode("_r").alias("_r")).groupBy(*group, "_n").agg(F.map_from_entries(F.collect_list(F.struct("_r", "_v"))).alias("_m"))
    one = lambda x, f: F.col("_m")[f(x).cast("long")]
    return by_rank.select(*group, F.array(*(one(x, F.floor) + (one(x, F.ceil) - one(x, F.floor)) * (x - F.floor(x)) for x in at)).alias(name))


def percentile_stretch(rows: DataFrame, group: list[str], value: str, low: float, high: float, name: str = "level") -> DataFrame:
    """Values scaled so that the group's low and high percentile become 0 and 255, clipped and truncated; 0 where the
    two coincide or the group has no values. Percentiles are joined back, so no group meets in one task."""
    q = percentiles(rows, group, value, [low, high]).select(*group, F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi"))
    scaled = F.floor(F.least(F.greatest((F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")), F.lit(0.0)), F.lit(1.0)) * 255)
    return null_safe(rows, q, group, "left").withColumn(name, F.when(F.col("_hi") > F.col("_lo"), scaled).otherwise(0).cast("int")).drop("_lo", "_hi")


def blend(rows: DataFrame, cell: list[str], channel: str, level: str, palette: list[tuple[float, float, float]]) -> DataFrame:
    """Additive colour blend: each channel's level (0 to 255) times its colour, summed and clipped at 1; colours repeat
    past the palette's end."""
    pick = F.pmod(F.col(channel), F.lit(len(palette)))
    part = lambda k: F.least(F.sum(F.get(F.array(*(F.lit(float(p[k])) for p in palette)), pick) * F.col(level) / 255.0), F.lit(1.0))
    return rows.groupBy(*cell).agg(part(0).alias("r"), part(1).alias("g"), part(2).alias("b"))


def project(rows: DataFrame, keep: list[str], value: str) -> DataFrame:
    """Maximum over all axes but ``keep``."""
    return rows.groupBy(*keep).agg(F.max(value).alias(value))


def block_mean(rows: DataFrame, keep: list[str], axes: list[str], value: str, size: int = 2) -> DataFrame:
    """Mean of blocks of ``size`` along ``axes``."""
    block = [F.floor(F.col(a) / size).cast("int").alias(a) for a in axes]
    return rows.groupBy(*keep, *block).agg(F.avg(value).alias(value))


def spread(rows: DataFrame, vector: str, dim: str = "dim", value: str = "v") -> DataFrame:
    """One row per component of an array column, as doubles."""
    rest = [c for c in rows.columns if c != vector]
    return rows.select(*rest, F.posexplode(F.col(vector).cast("array<double>")).alias(dim, value))


def local_maxima(rows: DataFrame, group: list[str], order: list[str], value: str, reach: int, threshold: float) -> DataFrame:
    """Rows above the threshold that are the largest among ``reach`` neighbours on either side."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(-reach, reach)
    return rows.withColumn("_m", F.max(value).over(w)).filter((F.col(value) == F.col("_m")) & (F.col(value) > threshold)).drop("_m")


def opening(rows: DataFrame, group: list[str], order: list[str], value: str, reach: int, name: str = "opened") -> DataFrame:
    """Grey opening along an order: sliding minimum, then sliding maximum."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(-reach, reach)
    return rows.withColumn("_e", F.min(value).over(w)).withColumn(name, F.max("_e").over(w)).drop("_e")


def trimmed_mean(rows: DataFrame, group: list[str], value: str, cut: float) -> DataFrame:
    """Mean without ``floor(cut * n)`` values at either end; ties make no difference to the value."""
    order = Window.partitionBy(*group).orderBy(value)
    n = Window.partitionBy(*group)
    ranked = rows.withColumn("_k", F.row_number().over(order)).withColumn("_n", F.count(F.lit(1)).over(n)).withColumn("_c", F.floor(F.col("_n") * cut))
    return ranked.filter((F.col("_k") > F.col("_c")) & (F.col("_k") <= F.col("_n") - F.col("_c"))).groupBy(*group).agg(F.avg(value).alias(value))


def mad_sigma(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """1.4826 times the median distance to the median."""
    mid = percentiles(rows, group, value, [0.5]).select(*group, F.get("_q", F.lit(0)).alias("_m"))
    far = null_safe(rows, mid, group).select(*group, F.abs(F.col(value) - F.col("_m")).alias("_d"))
    return percentiles(far, group, "_d", [0.5]).select(*group, (F.get("_q", F.lit(0)) * 1.4826).alias("sigma"))


def dark_map(rows: DataFrame, pixel: list[str], value: str, below: float, offset: float, support: int) -> DataFrame:
    """Per pixel the mean of dark values minus the offset; 0 with fewer than ``support`` of them."""
    dark = F.when(F.col(value) < below, F.col(value))
    return rows.groupBy(*pixel).agg(F.when(F.count(dark) >= support, F.avg(dark) - offset).otherwise(0.0).alias("dark"))


def centre_of_mass(vector: Column) -> Column:
    """Index-weighted mean of an array; null where it sums to about nothing."""
    v = F.transform(vector, lambda x: x.cast("double"))
    total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
    moment = F.aggregate(F.transform(v, lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.abs(total) > 1e-9, moment / total)


def correlation(a: Column, b: Column) -> Column:
    """Pearson r of two arrays of equal length; 0 if either is constant."""
    add = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    x, y = F.transform(a, lambda v: v.cast("double")), F.transform(b, lambda v: v.cast("double"))
    n = F.size(a)
    mx, my = add(x) / n, add(y) / n
    cov = add(F.zip_with(x, y, lambda p, q: (p - mx) * (q - my)))
    vx, vy = add(F.transform(x, lambda p: (p - mx) * (p - mx))), add(F.transform(y, lambda q: (q - my) * (q - my)))
    return F.when((vx > 0) & (vy > 0), cov / F.sqrt(vx * vy)).otherwise(0.0)


def mirror_symmetry(vector: Column) -> Column:
    """Pearson r of an array with its reverse."""
    return correlation(vector, F.reverse(vector))


def compare(a: Column, b: Column) -> Column:
    """``identical``, ``r``, ``max_abs``, ``median_abs`` of two arrays of equal length."""
    d = F.array_sort(F.zip_with(a, b, lambda p, q: F.abs(p.cast("double") - q.cast("double"))))
    n = F.size(d)
    median = (F.element_at(d, F.floor((n + 1) / 2).cast("int")) + F.element_at(d, F.floor((n + 2) / 2).cast("int"))) / 2
    return F.struct((F.array_max(d) == 0).alias("identical"), correlation(a, b).alias("r"), F.array_max(d).alias("max_abs"), median.alias("median_abs"))


def nearest_neighbour(points: DataFrame, group: str, key: str, coords: list[str], reach: float, asked: DataFrame | None = None) -> DataFrame:
    """Distance of each point (or of those ``asked`` about) to its nearest other within ``reach``, null beyond: a grid
    of cells of that size, each point asked about meets the 3^d cells around it."""
    asked = points if asked is None else asked
    cells = [F.floor(F.col(c) / reach).cast("long").alias(f"_g{i}") for i, c in enumerate(coords)]
    own, near = (df.select(group, key, *coords, *cells) for df in (points, asked))
    for i in range(len(coords)):
        near = near.withColumn(f"_g{i}", F.explode(F.array(*(F.col(f"_g{i}") + d for d in (-1, 0, 1)))))
    other = own.withColumnsRenamed({key: "_o", **{c: f"_{c}" for c in coords}})
    square = sum((F.pow(F.col(c) - F.col(f"_{c}"), 2) for c in coords), F.lit(0.0))
    met = near.join(other, [group, *(f"_g{i}" for i in range(len(coords)))]).filter(F.col(key) != F.col("_o")).withColumn("_d", F.sqrt(square)).filter(F.col("_d") <= reach)
    return asked.select(group, key).join(met.groupBy(group, key).agg(F.min("_d").alias("nearest")), [group, key], "left")


def quality_gates(**gates: tuple[str, Column]) -> Column:
    """All gates hold; a null fails."""
    out = F.lit(True)
    for c in gates.values():
        out = out & F.coalesce(c[1] if isinstance(c, tuple) else c, F.lit(False))
    return out


def even_sample(t_star: Column, n_available: Column, n: int) -> Column:
    """Up to ``n`` evenly spread indices of 0..n_available-1 that contain ``t_star``: round-half-even positions; if
    ``t_star`` isn't among them it joins, and the ones nearest to it leave until ``n`` are left."""
    count = F.least(n_available, F.lit(n))
    spread_ = F.when(count > 1, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(1))), lambda i: F.bround(i * (n_available - 1) / F.greatest(count - 1, F.lit(1)), 0).cast("int"))).otherwise(F.array(F.lit(0)))
    with_star = F.array_sort(F.array_distinct(F.array_append(spread_, t_star.cast("int"))))
    others = F.array_sort(F.transform(F.filter(with_star, lambda x: x != t_star), lambda x: F.struct((-F.abs(x - t_star)).alias("d"), x.alias("x"))))
    chosen = F.transform(F.slice(others, F.lit(1), F.lit(n - 1)), lambda s: s["x"])
    return F.when(F.size(with_star) <= n, with_star).otherwise(F.array_sort(F.array_append(chosen, t_star.cast("int"))))

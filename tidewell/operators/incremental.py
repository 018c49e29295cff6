"""Results kept up to date from the former result and a batch of changes, so that a day's change doesn't recompute all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.graph import components
from tidewell.operators.scan import null_safe
from tidewell.session import materialise, scratch


def updated_rollup(former: DataFrame, files: DataFrame, keys: list[str], size: str, stamp: str, added: DataFrame, removed: DataFrame) -> DataFrame:
    """The rollup (``keys``, ``bytes``, ``nfiles``, ``newest``) after rows were added and removed; ``files`` holds the rows
    as they are now. Sums take the difference only. A key's newest stamp is looked up among its rows where one as new as it
    was removed, else it follows from the former and the added ones. Keys without rows are gone; null keys are keys."""
    side = lambda rows, sign: rows.select(*keys, (F.col(size) * sign).alias("b"), F.lit(sign).alias("n"), F.col(stamp).alias("in" if sign > 0 else "out"))
    batch = side(added, 1).unionByName(side(removed, -1), allowMissingColumns=True)
    change = batch.groupBy(*keys).agg(F.sum("b").alias("b"), F.sum("n").alias("n"), F.max("in").alias("in"), F.max("out").alias("out"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"f.{k}").eqNullSafe(F.col(f"c.{k}"))
    both = former.withColumn("known", F.lit(True)).alias("f").join(change.withColumn("changed", F.lit(True)).alias("c"), on, "full")
    pick = [F.when(F.col("known"), F.col(f"f.{k}")).otherwise(F.col(f"c.{k}")).alias(k) for k in keys]
    total = lambda a, b: F.coalesce(F.col(a), F.lit(0)) + F.coalesce(F.col(b), F.lit(0))
    met = both.select(*pick, total("bytes", "b").alias("bytes"), total("nfiles", "n").alias("nfiles"), F.col("newest").alias("was"), "in", "out").filter("nfiles > 0")
    lost = F.coalesce(F.col("out") >= F.col("was"), F.lit(False))
    with scratch() as kept:
        met = materialise(met.withColumn("lost", lost), "rollup-met")
        newest = null_safe(files.select(*keys, stamp), met.filter("lost").select(*keys), keys).groupBy(*keys).agg(F.max(stamp).alias("now"))
        out = null_safe(met, newest, keys, "left").withColumn("newest", F.when(F.col("lost"), F.col("now")).otherwise(F.greatest("was", "in")))
        kept.append(materialise(out.select(*keys, "bytes", "nfiles", "newest"), "rollup"))
    return kept[0]


def updated_components(labels: DataFrame, edges: DataFrame, added: DataFrame, removed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``node``, ``label`` and the edges ``u < v`` after edges were added and removed, from those before.

    Components that lose an edge are taken apart and put together from the edges that they have left; others stand as one
    node, their label, in the graph of what is left and what is added, which is contracted alone."""
    with scratch() as kept:
        gone = removed.select("u", "v").distinct()
        now = materialise(edges.select("u", "v").join(gone, ["u", "v"], "left_anti").union(added.select("u", "v")).distinct(), "components-now")
        ends = gone.join(edges.select("u", "v"), ["u", "v"], "left_semi").select(F.explode(F.array("u", "v")).alias("node")).distinct()
        open_ = materialise(labels.join(ends, "node", "left_semi").select("label").distinct(), "components-open")
        loose = labels.join(open_, "label", "left_semi").select("node")  # nodes of components that are taken apart
        stable = labels.join(open_, "label", "left_anti").select("node", "label")
        loose, stable = materialise(loose, "components-loose"), materialise(stable, "components-stable")
        inside = now.join(loose.withColumnRenamed("node", "u"), "u", "left_semi").select("u", "v")
        graph = inside.union(added.select("u", "v")).distinct()
        for end in ("u", "v"):
            graph = graph.join(stable.select(F.col("node").alias(end), F.col("label").alias(f"_{end}")), end, "left").withColumn(end, F.coalesce(f"_{end}", end)).drop(f"_{end}")
        graph = graph.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        found = materialise(components(graph), "components-changed")
        moved = stable.join(found.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        fresh = found.join(stable.select("node"), "node", "left_anti")
        out = materialise(moved.union(fresh.select("node", "label")), "components-updated")
        kept += [out, now]
    return out, now

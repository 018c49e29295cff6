"""Hash trees over paths: folder digests from the leaves up, and comparisons that go down only where digests differ.

A node's digest is a sum, lane by lane, over its members of a hash of (name, digest); sums don't depend on order and
are combined before they are shuffled. Two 64-bit hashes in halves make four lanes, so a lane can't overflow below
2**31 members. Levels are built from the deepest up; a level's rows are shuffled once, by their parent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialise, scratch

LANES = ("d0", "d1", "d2", "d3")
_LOW = 0xFFFFFFFF


def lanes(*values: Column | str) -> list[Column]:
    """The four summed lanes of a multiset of rows (an aggregation); rows that repeat count as often."""
    seeded = [F.xxhash64(F.lit(s), *(F.col(v) if isinstance(v, str) else v for v in values)) for s in (1, 2)]
    halves = [half for h in seeded for half in (h.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(h, 32))]
    return [F.sum(h).alias(name) for h, name in zip(halves, LANES)]


def build(files: DataFrame, path: str, content: list[str]) -> DataFrame:
    """Nodes of the tree of ``files``: ``path``, ``parent`` (null at the top), ``depth`` (from 1), ``leaf``, ``n`` (files
    at or below) and the digest's lanes. Empty path components don't count; files of one path are one leaf, whose
    digest is that of their contents as a multiset; rows of null path are left out."""
    parts = F.filter(F.split(F.col(path), "/"), lambda x: x != "")
    rows = files.filter(F.col(path).isNotNull()).select(parts.alias("parts"), *content).filter("size(parts) > 0")
    leaves = rows.groupBy(F.array_join("parts", "/").alias("path")).agg(F.max(F.size("parts")).alias("depth"), F.count(F.lit(1)).alias("n"), *lanes(*content))
    with scratch() as kept:
        leaves = materialise(leaves.withColumn("leaf", F.lit(True)), "tree-leaves")
        deepest = leaves.agg(F.max("depth")).first()[0] or 0
        above = F.nullif(F.regexp_replace("path", r"/?[^/]*$", ""), F.lit(""))
        columns = ["path", "depth", "leaf", "n", *LANES]
        level, levels = None, []
        for depth in range(deepest, 0, -1):
            here = leaves.filter(F.col("depth") == depth).select(columns)
            here = (here if level is None else here.union(level)).withColumn("parent", above)
            here = materialise(here, f"tree-level{depth}")
            levels.append(here)
            name = F.substring_index("path", "/", -1)
            level = here.filter("parent is not null").groupBy(F.col("parent").alias("path")).agg(F.sum("n").alias("n"), *lanes(name, "leaf", *LANES))
            level = level.select("path", F.lit(depth - 1).alias("depth"), F.lit(False).alias("leaf"), "n", *LANES)
        out = levels[0] if levels else leaves.select(columns).withColumn("parent", F.lit(None).cast("string"))
        for more in levels[1:]:
            out = out.union(more)
        kept.append(materialise(out.select("path", "parent", "depth", "leaf", "n", *LANES), "tree"))
    return kept[0]


def differences(a: DataFrame, b: DataFrame) -> tuple[DataFrame, list[int]]:
    """Files of two trees that differ, as ``path`` and ``state`` (``missing``: only in ``a``; ``new``: only in ``b``;
    ``changed``), and how many nodes were compared at each depth.

    Level by level only the members of folders that differ are met; equal digests end the descent. So the work follows
    what has changed and the width of the folders it is in, not the size of the trees."""
    deepest = max(x.agg(F.max("depth")).first()[0] or 0 for x in (a, b))
    spark, open_, found, compared = a.sparkSession, None, [], []
    with scratch() as kept:
        for depth in range(1, deepest + 1):
            sides = []
            for side, tree in (("a", a), ("b", b)):
                rows = tree.filter(F.col("depth") == depth)
                rows = rows if open_ is None else rows.join(open_.select(F.col("path").alias("parent")), "parent", "left_semi")
                sides.append(rows.select("path", "leaf", F.struct(*LANES).alias(side)))
            met = sides[0].join(sides[1], ["path", "leaf"], "full")
            met = materialise(met.withColumn("same", F.col("a").eqNullSafe(F.col("b"))), f"tree-met{depth}")
            compared.append(met.count())
            state = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "new").otherwise("changed")
            found.append(met.filter("leaf and not same").select("path", state.alias("state")))
            open_ = met.filter("not leaf and not same").select("path").distinct()
            if open_.isEmpty():
                break
        out = found[0] if found else spark.createDataFrame([], "path string, state string")
        for more in found[1:]:
            out = out.union(more)
        kept.append(materialise(out, "tree-differences"))
    return kept[0], compared

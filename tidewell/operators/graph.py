"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import discard, materialise, scratch

#: Rounds after which the composed labels are written, so that no plan grows with their number; parts of a hot label.
COMPOSE, SALTS = 4, 16


def salted_join(rows: DataFrame, few: DataFrame, key: str, spread_by: str, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """``rows`` joined to ``few`` on ``key``, where one key may hold most rows: each key's rows are dealt into
    ``salts`` parts by a hash of ``spread_by``, and the other side is repeated as often. Spark guesses the size of what is
    repeated as if it weren't, so it is kept from being broadcast: each task would hold ``salts`` times what was meant."""
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    repeated = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(repeated.hint("merge"), [key, "_salt"], how).drop("_salt")


def _composed(labels: DataFrame | None, parents: list[DataFrame]) -> DataFrame:
    """``node``, ``label``: the labels so far, led on through the parents of later rounds."""
    for parent in parents:
        step = parent.select(F.col("node").alias("label"), "up")
        labels = parent.select("node", F.col("up").alias("label")) if labels is None else salted_join(labels, step, "label", "node", "left").select("node", F.coalesce("up", "label").alias("label"))
    return labels


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` (least node of its component) of every node that has an edge ``u < v``.

    Nodes have a random priority (a hash). In each round a node takes the neighbour of least priority as parent, or
    stays a root; parents are doubled twice, which leads nearly every node to its root, and the graph is contracted
    along them. On a chain two nodes of three go in a round, so rounds grow with the logarithm of the longest one.
    Every round is joins and aggregations over written tables: a lost executor costs one stage.
    """
    with scratch() as kept:
        kept.append(materialise(_contracted(edges), "components"))
    return kept[0]


def _contracted(edges: DataFrame) -> DataFrame:
    kind = edges.schema["u"].dataType.simpleString()
    edges, parents, labels = materialise(edges.select("u", "v"), "components-edges"), [], None
    spark = edges.sparkSession
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("x"))
        up = both.groupBy("u").agg(F.min(rank("v")).alias("m")).select(F.col("u").alias("node"), F.least(F.col("m"), rank("u"))["x"].alias("up"))
        for _ in range(2):
            up = materialise(up, "components-parents")
            up = up.join(up.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", F.col("top").alias("up"))
        parent = materialise(up, "components-parents")
        parents.append(parent)
        a, b = parent.select(F.col("node").alias("u"), F.col("up").alias("a")), parent.select(F.col("node").alias("v"), F.col("up").alias("b"))
        moved = edges.join(a, "u").join(b, "v").filter("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
        contracted = materialise(moved, "components-edges")
        discard(edges)
        edges = contracted
        if len(parents) == COMPOSE:
            labels, parents = materialise(_composed(labels, parents), "components-labels"), []
    labels = _composed(labels, parents)
    if labels is None:
        return spark.createDataFrame([], f"node {kind}, label {kind}")
    least = labels.groupBy("label").agg(F.min("node").alias("least"))
    return salted_join(labels, least, "label", "node").select("node", F.col("least").alias("label"))


def touched_components(labels: DataFrame, touched: DataFrame, key: str) -> DataFrame:
    """``node``, ``label`` of all members of the components that hold a key of ``touched``; keys without a component
    add nothing."""
    hit = labels.join(touched.select(F.col(key).alias("node")), "node", "left_semi").select("label").distinct()
    return labels.join(hit, "label", "left_semi").select("node", "label")

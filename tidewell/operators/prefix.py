"""Prefix joins by intervals.

A listed prefix is the interval of the strings that begin with it. Strings and prefixes are dealt into ranges of one
order in which a prefix comes right before what it covers. The last prefix that a string has before it is covered by
all the prefixes that cover the string, so the string needs that one only, with the prefixes that cover it in turn
(``covering``, by a segmented scan), or a stack of the open intervals (``nesting``, by a merge). A string is shuffled
twice, into its range and to the merge, whatever its depth and however many prefixes cover it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.scan import RANGE, ranged, scan
from tidewell.session import ship_code

#: Stands for the separator in the order: below every character of a name, so that a folder's members are together.
_SEP = "\x01"


def _key(text: Column, sep: str | None) -> Column:
    return text if sep is None else F.concat(F.replace(text, F.lit(sep), F.lit(_SEP)), F.lit(_SEP))


def _prefixes(key: Column, sep: str | None) -> Column:
    """All prefixes of a key that may be listed, the whole key included."""
    every = F.transform(F.sequence(F.lit(1), F.greatest(F.length(key), F.lit(1))), lambda i: F.substr(key, F.lit(1), i))
    return every if sep is None else F.filter(every, lambda p: F.endswith(p, F.lit(_SEP)))


def _listed(rows: DataFrame, prefix: str, sep: str | None) -> DataFrame:
    one = rows.select(F.col(prefix).cast("string").alias("_p")).filter("_p is not null and _p <> ''").distinct()
    return one.select(_key(F.col("_p"), sep).alias("_key"), "_p")


def covering(rows: DataFrame, text: str, listed: DataFrame, prefix: str, sep: str | None = "/", name: str = "within") -> DataFrame:
    """The rows with an array of the listed prefixes that cover their text, outermost first; a text is covered by
    itself. With a separator whole components count, without one characters. Null and empty prefixes cover nothing,
    a null text is covered by nothing; prefixes that repeat count once. Only the prefixes are spread to those that
    cover them, so they should be the smaller side."""
    folders = _listed(listed, prefix, sep)
    spread = folders.select(F.col("_key").alias("of"), F.explode(_prefixes(F.col("_key"), sep)).alias("_key"))
    chains = spread.join(folders, "_key").groupBy("of").agg(F.array_sort(F.collect_list(F.struct(F.col("_key").alias("k"), F.col("_p").alias("p")))).alias("_chain"))
    own = rows.select(_key(F.col(text).cast("string"), sep).alias("_key"), F.lit(1).alias("_kind"), F.struct(*(F.col(c) for c in rows.columns)).alias("_row"))
    opening = chains.select(F.col("of").alias("_key"), F.lit(0).alias("_kind"), F.lit(None).cast(own.schema["_row"].dataType).alias("_row"), "_chain")
    both = own.withColumn("_chain", F.lit(None).cast(chains.schema["_chain"].dataType)).union(opening).withColumn("_all", F.lit(0))
    seen = scan(both, ["_all"], ["_key", "_kind"], _last=("last", F.col("_chain"))).filter("_kind = 1")
    held = F.transform(F.filter("_last", lambda c: F.startswith(F.col("_key"), c["k"])), lambda c: c["p"])
    return seen.select("_row.*", F.coalesce(held, F.array().cast("array<string>")).alias(name))


def nesting(paths: DataFrame, path: str) -> DataFrame:
    """Pairs ``outer``, ``inner`` of distinct listed paths of which one lies below the other; null and empty paths are
    left out. Paths are all prefixes here, so each range is merged once with a stack of the paths that are open; those
    that are open where a range begins (no more than its first path has components) are added to it."""
    ship_code(paths.sparkSession)
    folders = _listed(paths, path, "/")
    dealt = ranged(folders, ["_key"], [])
    starts = dealt.groupBy(RANGE).agg(F.min("_key").alias("first")).select(RANGE, "first", F.explode(_prefixes(F.col("first"), "/")).alias("_key")).filter("_key <> first")
    carried = dealt.drop(RANGE).join(F.broadcast(starts), "_key").select("_key", "_p", RANGE, F.lit(True).alias("_again"))
    n = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = dealt.withColumn("_again", F.lit(False)).union(carried).repartitionById(n, RANGE).sortWithinPartitions(RANGE, "_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[tuple[str, str]] = []
        for batch in batches:
            outer, inner = [], []
            for key, own, again in zip(*(c.to_pylist() for c in batch.columns)):
                while open_ and not key.startswith(open_[-1][0]):
                    open_.pop()
                if not again:
                    outer += [p for _, p in open_]
                    inner += [own] * len(open_)
                open_.append((key, own))
            if outer:
                yield pa.RecordBatch.from_arrays([pa.array(outer), pa.array(inner)], ["outer", "inner"])

    return merged.select("_key", "_p", "_again").mapInArrow(run, "outer string, inner string")

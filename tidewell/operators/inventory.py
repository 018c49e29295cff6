"""File inventory: classes, deletable units, rollups, prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.prefix import covering, nesting
from tidewell.sources import layout


def parts_of(path: Column) -> Column:
    """Path components without empty ones."""
    return F.filter(F.split(path, "/"), lambda x: x != "")


def under(parts: Column, prefix: Column) -> Column:
    """Whether the components of ``prefix`` lead ``parts``; an empty prefix leads nothing."""
    return (F.size(prefix) > 0) & (F.slice(parts, 1, F.greatest(F.size(prefix), F.lit(1))) == prefix)


def relative_to(path: Column, root: Column) -> Column:
    """``path`` below ``root``, null if it isn't there."""
    return F.when(path == root, F.lit("")).when(F.startswith(path, F.concat(root, F.lit("/"))), F.substr(path, F.length(root) + 2))


def classify(parts: Column, final: Column) -> Column:
    """Byte class of a file from its components below the dataset; the first match wins."""
    top, last, n = F.get(parts, F.lit(0)), F.element_at(parts, -1), F.size(parts)
    record = last.rlike(layout.PROVENANCE_FILE)
    viewer = F.when(F.endswith(F.get(parts, F.lit(1)), F.lit(layout.VIEWER_STORE)), "viewer_export").otherwise("provenance")
    derived = F.when(F.array_contains(parts, layout.PROJECTIONS) | (record & ~F.endswith(last, F.lit(layout.FIRST_FRAME))), "provenance").otherwise("intermediate")
    return (
        F.when(n <= 0, "unknown")
        .when(F.coalesce(under(parts, final), F.lit(False)), "final")
        .when(n == 1, F.when(last.rlike(layout.RAW_FILE), "raw").when(record, "provenance").otherwise("unknown"))
        .when(top.isin(*layout.PROVENANCE_TOPS), "provenance")
        .when(top == layout.VIEWER_TOP, viewer)
        .when(top.isin(*layout.DERIVED_TOPS), derived)
        .otherwise("unknown")
    )


def unit_of(parts: Column) -> Column:
    """The deletable unit of a file: its folders down to the first that isn't a wrapper; ``dir/*`` for files loose in
    wrappers; a file at the top is its own unit."""
    folders = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    stop = F.array_position(F.transform(folders, lambda x: x.isin(*layout.WRAPPERS)), False).cast("int")
    return (
        F.when(F.size(parts) == 1, F.get(parts, F.lit(0)))
        .when(stop > 0, F.array_join(F.slice(folders, F.lit(1), F.greatest(stop, F.lit(1))), "/"))
        .otherwise(F.concat(F.array_join(folders, "/"), F.lit("/*")))
    )


def unit_rollup(files: DataFrame, keys: list[str], size: str, stamp: str) -> DataFrame:
    """Bytes, files and newest stamp per unit."""
    return files.groupBy(*keys).agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("nfiles"), F.max(stamp).alias("newest"))


def class_bytes(units: DataFrame, key: str, cls: str, size: str) -> DataFrame:
    """Bytes by class of each key, as a map from class to bytes with sorted keys."""
    by = units.groupBy(key, cls).agg(F.sum(size).alias("b"))
    return by.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(cls, "b")))).alias("class_bytes"))


def nested(paths: DataFrame, key: str = "path") -> DataFrame:
    """Pairs (outer, inner) of listed paths where one lies below the other, by a merge of intervals."""
    return nesting(paths.select(F.rtrim(F.col(key), F.lit("/")).alias(key)), key)


def longest_prefix(files: DataFrame, dirs: DataFrame, path: str = "path", directory: str = "dir") -> DataFrame:
    """Each file with the deepest listed directory above it, null if there is none, by a merge of intervals."""
    found = covering(files, path, dirs, directory, name="_within")
    return found.withColumn(directory, F.get(F.reverse(F.filter("_within", lambda d: d != F.col(path))), F.lit(0))).drop("_within")


def root_rank(path: Column) -> Column:
    """Preference of the root that a path names; the first listed wins, 9 for none."""
    out = F.lit(9)
    for rank, part in reversed(list(enumerate(layout.ROOT_RANKS))):
        out = F.when(F.contains(path, F.lit(part)), rank).otherwise(out)
    return out


def to_scan(registered: DataFrame, scanned: DataFrame, keys: list[str]) -> DataFrame:
    """Registered rows without a scan of the same keys."""
    return registered.join(scanned.select(*keys).distinct(), keys, "left_anti")


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")

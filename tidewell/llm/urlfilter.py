"""URL filters as a temporal list join.

A list is a table of dated entries: (kind, key, action, since). ``host`` keys are host names and hold for their
subdomains; ``path`` keys are ``host/segment/...`` and hold for everything below. The entries of a key, in order of
date, become validity intervals: an ``add`` is active until the key's next entry. Every capture is evaluated against
the entries active when it was fetched: its URL is spread into its host suffixes and path prefixes, as deep as the
list's deepest keys, which meet the intervals in an equi-join on the key with the time as a further condition. Of
several active entries the most specific is reported: paths before hosts, then the longest key.

Edge cases: null or malformed URLs and null fetch times match nothing, their rows stay; entries with a null field
don't count; of entries of one key and date ``remove`` is the last; repeated entries count once; repeated captures
give repeated results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and closing dot; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.nullif(F.regexp_replace(host, r"\.+$", ""), F.lit(""))


def segments_of(url: Column) -> Column:
    """Path segments, without empty ones."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda x: x != "")


def keys_of(url: Column, n_labels: int, n_segments: int) -> Column:
    """All (kind, key, weight) of at most so many labels and segments that can list a URL."""
    host, labels, segments = host_of(url), F.split(host_of(url), r"\."), segments_of(url)
    n, m = F.least(F.size(labels), F.lit(n_labels)), F.least(F.size(segments), F.lit(n_segments))
    hosts = F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: F.struct(F.lit("host").alias("kind"), F.array_join(F.slice(labels, -i, i), ".").alias("key"), i.alias("weight")))
    paths = F.transform(F.when(m > 0, F.sequence(F.lit(1), m)).otherwise(F.array().cast("array<int>")), lambda i: F.struct(F.lit("path").alias("kind"), F.concat_ws("/", host, F.slice(segments, 1, i)).alias("key"), (i + 1_000_000).alias("weight")))
    return F.when(host.isNotNull(), F.concat(hosts, paths))


def intervals(entries: DataFrame) -> DataFrame:
    """``kind``, ``key``, ``since``, ``until``: when each key is listed."""
    host, below = F.lower(F.regexp_extract("key", "^[^/]*", 0)), F.regexp_extract("key", "^[^/]*(.*)$", 1)  # paths keep their case
    rows = entries.select("kind", F.concat(host, below).alias("key"), "action", F.col("since").cast("timestamp").alias("since")).dropna().distinct()
    by_key = Window.partitionBy("kind", "key").orderBy("since", "action")
    rows = rows.withColumn("until", F.lead("since").over(by_key))
    return rows.filter((F.col("action") == "add") & (F.col("until").isNull() | (F.col("until") > F.col("since")))).drop("action")


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """``id_col``, ``url``, ``fetched``, ``blocked``, and ``kind``, ``key``, ``since`` of the deciding entry."""
    rows = captures.select(F.col(id_col), F.col(url_col).alias("url"), F.col(time_col).cast("timestamp").alias("fetched"))
    rows = rows.withColumn("u_", F.struct(id_col, "url", "fetched"))
    listed = intervals(entries)
    depth = lambda kind, sep: F.coalesce(F.max(F.when(F.col("kind") == kind, F.size(F.split("key", sep)))), F.lit(0))
    n_labels, n_segments = listed.agg(depth("host", r"\."), depth("path", "/") - 1).first()
    spread = rows.select("u_", "fetched", F.inline(keys_of(F.col("url"), n_labels, max(0, n_segments)))).distinct()
    active = spread.join(listed, ["kind", "key"]).filter((F.col("fetched") >= F.col("since")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))))
    best = active.groupBy("u_").agg(F.max(F.struct("weight", "kind", "key", "since")).alias("best"))
    best = best.select(F.col(f"u_.{id_col}").alias("i_"), F.col("u_.url").alias("url_"), F.col("u_.fetched").alias("f_"), "best")
    met = rows.join(best, F.col(id_col).eqNullSafe(F.col("i_")) & (F.col("url") == F.col("url_")) & (F.col("fetched") == F.col("f_")), "left")
    return met.select(id_col, "url", "fetched", F.col("best").isNotNull().alias("blocked"), F.col("best.kind").alias("kind"), F.col("best.key").alias("key"), F.col("best.since").alias("since"))

"""Queries over inventories: classes, units, prefixes, scalar functions.

The driver's tables have no folders, so line items stand for files: the order is the dataset, a path is picked from a
fixed list, the extended price is the size and the ship date the time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell import functions as fn
from tidewell.operators import figures, graph, incremental
from tidewell.operators import inventory as inv
from tidewell.plans.registry import query
from tidewell.sources import layout
from tidewell.sources.sinks import summary
from tidewell.sources.tables import read_table

#: Paths that line items stand for.
PATHS = (
    "cell_0.ome.tif", "AcqSettings.txt", "notes.json", "odd.bin", "processed_ngff/c0/x_T000.tif", "processed_ngff/c0/log.json",
    "decon_stage/a.tif", "decon_stage/run1/b.tif", "viewer/x_dsr.ome.zarr/0", "viewer/open.cxc", "decon_qc/q.png", "other/z.bin",
    "zarr_mirror/decon_stage/d.bin", "processed_ngff/MIPs/m.tif", "final/out.zarr/0.0",
)
FILES_SQL = f"""files AS (SELECT l_orderkey AS key, [{', '.join(f"'{p}'" for p in PATHS)}][CAST((l_partkey + l_linenumber) % {len(PATHS)} AS INTEGER) + 1] AS rel,
        CAST(floor(l_extendedprice) AS BIGINT) AS size, CAST(epoch(l_shipdate) AS BIGINT) AS stamp FROM lineitem),
    split AS (SELECT *, string_split(rel, '/') AS p FROM files),
    classed AS (SELECT *, CASE WHEN starts_with(rel, 'final/out.zarr/') THEN 'final'
        WHEN len(p) = 1 THEN CASE WHEN regexp_matches(rel, '(?i)(\\.ome\\.tiff?|\\.tiff?)$|_metadata\\.txt$|^AcqSettings\\.txt$') THEN 'raw' WHEN regexp_matches(rel, '(?i)\\.(json|txt|mat|log|cxc|csv|md)$') THEN 'provenance' ELSE 'unknown' END
        WHEN p[1] IN ('mip_movies', 'decon_qc') THEN 'provenance'
        WHEN p[1] = 'viewer' THEN CASE WHEN ends_with(p[2], '_dsr.ome.zarr') THEN 'viewer_export' ELSE 'provenance' END
        WHEN p[1] IN ('processed_ngff', 'processed_tiff_series_split', 'decon_stage', 'zarr_mirror') THEN
            CASE WHEN list_contains(p, 'MIPs') OR (regexp_matches(p[-1], '(?i)\\.(json|txt|mat|log|cxc|csv|md)$') AND NOT ends_with(p[-1], '_T000.tif')) THEN 'provenance' ELSE 'intermediate' END
        ELSE 'unknown' END AS cls,
        CASE WHEN len(p) = 1 THEN rel WHEN p[1] NOT IN ('processed_tiff_series_split', 'decon_stage', 'zarr_mirror', 'Decon') THEN p[1]
            WHEN len(p) = 2 THEN p[1] || '/*' WHEN p[2] NOT IN ('processed_tiff_series_split', 'decon_stage', 'zarr_mirror', 'Decon') THEN p[1] || '/' || p[2]
            ELSE p[1] || '/' || p[2] || '/*' END AS unit FROM split)""".replace("\\\\", "\\")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory with classes and units."""
    rel = F.get(F.array(*(F.lit(p) for p in PATHS)), ((F.col("l_partkey") + F.col("l_linenumber")) % len(PATHS)).cast("int"))
    rows = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), rel.alias("rel"), F.floor("l_extendedprice").cast("long").alias("size"), F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("stamp"))
    parts = inv.parts_of(F.col("rel"))
    return rows.withColumn("cls", inv.classify(parts, F.array(F.lit("final"), F.lit("out.zarr")))).withColumn("unit", inv.unit_of(parts))


@query("SELECT o_orderkey, o_orderstatus, l_partkey, CAST(l_quantity AS BIGINT) AS quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_linenumber = 1")
def registry_left_join(spark, sf_dir):
    """J1, SRC6: the constant predicate stays in the join."""
    o, li = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem").filter("l_linenumber = 1")
    return o.join(li, o.o_orderkey == li.l_orderkey, "left").select("o_orderkey", "o_orderstatus", "l_partkey", F.col("l_quantity").cast("long").alias("quantity"))


@query(f"WITH {FILES_SQL} SELECT cls, unit, CAST(count(*) AS BIGINT) AS n FROM classed GROUP BY ALL")
def byte_class_cascade(spark, sf_dir):
    """Class and unit of each file."""
    return files(spark, sf_dir).groupBy("cls", "unit").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {FILES_SQL} SELECT key, unit, cls, CAST(sum(size) AS BIGINT) AS bytes, CAST(count(*) AS BIGINT) AS nfiles, max(stamp) AS newest FROM classed GROUP BY ALL")
def unit_rollup(spark, sf_dir):
    """A1, SRC2: bytes, files and newest time per unit."""
    return inv.unit_rollup(files(spark, sf_dir), ["key", "unit", "cls"], "size", "stamp")


@query(f"WITH {FILES_SQL}, per AS (SELECT key, cls, CAST(sum(size) AS BIGINT) AS b FROM classed GROUP BY ALL) SELECT key, string_agg(cls || '=' || b, ',' ORDER BY cls) AS class_bytes FROM per GROUP BY key")
def class_bytes_map(spark, sf_dir):
    """Bytes by class as a map, here as text."""
    m = inv.class_bytes(files(spark, sf_dir), "key", "cls", "size")
    return m.select("key", F.array_join(F.transform(F.map_entries("class_bytes"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("class_bytes"))


@query(f"WITH {FILES_SQL} SELECT key, CAST(sum(size) AS BIGINT) AS total, CAST(coalesce(sum(size) FILTER (WHERE cls = 'raw'), 0) AS BIGINT) AS raw, CAST(greatest(0, sum(size) - coalesce(sum(size) FILTER (WHERE cls = 'intermediate'), 0)) AS BIGINT) AS kept FROM classed GROUP BY key")
def dataset_totals(spark, sf_dir):
    """Total, raw and kept bytes of each dataset."""
    of = lambda c: F.coalesce(F.sum(F.when(F.col("cls") == c, F.col("size"))), F.lit(0))
    return files(spark, sf_dir).groupBy("key").agg(F.sum("size").alias("total"), of("raw").alias("raw"), F.greatest(F.lit(0).cast("long"), F.sum("size") - of("intermediate")).alias("kept"))


@query(f"WITH {FILES_SQL}, t(tier) AS (VALUES ('A1'), ('A2'), ('A3'), ('B')), s AS (SELECT key, size, CASE cls WHEN 'intermediate' THEN 'A2' WHEN 'viewer_export' THEN 'A3' WHEN 'unknown' THEN 'B' END AS tier FROM classed) SELECT t.tier, CAST(count(s.key) AS BIGINT) AS n, CAST(count(DISTINCT s.key) AS BIGINT) AS keys, CAST(coalesce(sum(size), 0) AS BIGINT) AS bytes FROM t LEFT JOIN s USING (tier) GROUP BY t.tier")
def tier_summary(spark, sf_dir):
    """Totals per tier, empty tiers included."""
    tier = F.when(F.col("cls") == "intermediate", "A2").when(F.col("cls") == "viewer_export", "A3").when(F.col("cls") == "unknown", "B")
    return summary(files(spark, sf_dir).withColumn("tier", tier).filter("tier is not null"), "tier", ["A1", "A2", "A3", "B"], "key", "size")


@query(f"WITH {FILES_SQL} SELECT key, 'v1:' || count(*) || ':' || coalesce(sum(size), 0) || ':' || coalesce(max(stamp), 0) AS fingerprint FROM files GROUP BY key")
def inventory_fingerprint(spark, sf_dir):
    """A text that changes with count, bytes or newest time."""
    agg = files(spark, sf_dir).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("b"), F.coalesce(F.max("stamp"), F.lit(0)).alias("s"))
    return agg.select("key", fn.fingerprint(1, F.col("n"), F.col("b"), F.col("s")).alias("fingerprint"))


@query("WITH d AS (SELECT DISTINCT rtrim(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://', ''), '/') AS p FROM pages), top AS (SELECT DISTINCT regexp_extract(p, '^[^/]+/[^/]+') AS p FROM d), a AS (SELECT p FROM d UNION SELECT p FROM top) SELECT x.p AS outer_path, y.p AS inner_path FROM a x JOIN a y ON starts_with(y.p, x.p || '/') WHERE x.p <> ''")
def nested_prefix(spark, sf_dir):
    """J10, SRC5: listed paths below listed paths, by spread ancestors and an equi-join."""
    p = F.rtrim(F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), "^[a-z]+://", ""), F.lit("/"))
    d = read_table(spark, sf_dir, "pages").select(p.alias("path")).distinct()
    both = d.union(d.select(F.regexp_extract("path", "^[^/]+/[^/]+", 0))).distinct().filter("path <> ''")
    return inv.nested(both).select(F.col("outer").alias("outer_path"), F.col("inner").alias("inner_path"))


@query("WITH f AS (SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://', '') AS path FROM pages), d AS (SELECT DISTINCT regexp_extract(path, '^[^/]+') AS dir FROM f UNION SELECT DISTINCT regexp_extract(path, '^[^/]+/[^/]+') FROM f WHERE page_id % 2 = 0), m AS (SELECT page_id, dir, row_number() OVER (PARTITION BY page_id ORDER BY length(dir) DESC) AS k FROM f JOIN d ON starts_with(path, dir || '/')) SELECT f.page_id, m.dir FROM f LEFT JOIN (SELECT * FROM m WHERE k = 1) m USING (page_id)")
def longest_prefix(spark, sf_dir):
    """Each path with the deepest listed folder above it."""
    f = read_table(spark, sf_dir, "pages").select("page_id", F.regexp_replace(F.regexp_replace("url", r"[?#].*$", ""), "^[a-z]+://", "").alias("path"))
    d = f.select(F.regexp_extract("path", "^[^/]+", 0).alias("dir")).union(f.filter("page_id % 2 = 0").select(F.regexp_extract("path", "^[^/]+/[^/]+", 0)))
    return inv.longest_prefix(f, d).select("page_id", "dir")


@query("SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')")
def incremental_todo(spark, sf_dir):
    """What has no valid entry yet."""
    done = read_table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return inv.to_scan(read_table(spark, sf_dir, "orders").select("o_orderkey"), done, ["o_orderkey"])


@query("SELECT page_id, TRY_CAST(nullif(regexp_extract(url, 'page=(\\d+)', 1), '') AS INTEGER) AS page, nullif(regexp_extract(url, '^[a-z]+://([^/]+)', 1), '') AS host FROM pages")
def regex_frame_ids(spark, sf_dir):
    """F1, SRC16: numbers out of names, null where there is none."""
    (page,) = fn.regex_ints(F.col("url"), r"page=(\d+)", 1)
    return read_table(spark, sf_dir, "pages").select("page_id", page.alias("page"), F.nullif(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1), F.lit("")).alias("host"))


@query("SELECT p_partkey, concat_ws('|', " + ", ".join(f"CASE WHEN regexp_matches(lower(p_name || '_' || p_type), '{k}') THEN '{v}' END" for k, v in layout.FLUOROPHORES.items()) + ") AS labels FROM part")
def keyword_labels(spark, sf_dir):
    """Ordered keyword patterns give an array of labels."""
    name = F.concat_ws("_", "p_name", "p_type")
    return read_table(spark, sf_dir, "part").select("p_partkey", F.array_join(fn.keyword_labels(name, layout.FLUOROPHORES), "|").alias("labels"))


@query("SELECT doc_id, sha256(text) AS digest, length(text) AS n FROM documents")
def digest(spark, sf_dir):
    """F8: SHA-256 of whole contents."""
    return read_table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), F.length("text").cast("long").alias("n"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.missing'), 'p0') AS other FROM events")
def json_props(spark, sf_dir):
    """F15, SRC21, SRC23: JSON fields with defaults."""
    return read_table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), fn.json_field(F.col("props"), "$.missing", "p0").alias("other"))


@query("SELECT event_id, round((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(ts)) / 3.6e9, 6) AS hours, strftime(ts, '%Y-%m-%d') AS day FROM events")
def ts_age_hours(spark, sf_dir):
    """Ages in hours against a given time."""
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return read_table(spark, sf_dir, "events").select("event_id", F.round(fn.hours_between(now, F.col("ts")), 6).alias("hours"), F.date_format("ts", "yyyy-MM-dd").alias("day"))


@query("SELECT s_suppkey, CASE WHEN contains(s_name, '#000000001') THEN 0 WHEN contains(s_name, '#00000001') THEN 1 ELSE 9 END AS rank, CASE WHEN starts_with(s_name, 'Supplier#0000000') THEN 'near' ELSE 'far' END AS side FROM supplier")
def path_labels(spark, sf_dir):
    """Labels by prefix and substring, the first that fits."""
    name = F.col("s_name")
    rank = F.when(F.contains(name, F.lit("#000000001")), 0).when(F.contains(name, F.lit("#00000001")), 1).otherwise(9)
    return read_table(spark, sf_dir, "supplier").select("s_suppkey", rank.alias("rank"), F.when(F.startswith(name, F.lit("Supplier#0000000")), "near").otherwise("far").alias("side"))


@query("WITH a AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'), b AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error') SELECT user_id, 'both' AS side FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT user_id, 'first' FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT user_id, 'second' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)")
def set_difference(spark, sf_dir):
    """What two sets share and what only one has; one full outer join answers all."""
    e = read_table(spark, sf_dir, "events")
    a, b = (e.filter(F.col("event_type") == t).select("user_id").distinct() for t in ("purchase", "error"))
    both = a.withColumn("a", F.lit(1)).join(b.withColumn("b", F.lit(1)), "user_id", "full")
    return both.select("user_id", F.when(F.col("a").isNull(), "second").when(F.col("b").isNull(), "first").otherwise("both").alias("side"))


@query("SELECT tier, path, pos FROM (SELECT l_returnflag AS tier, CAST(l_partkey AS VARCHAR) AS path, l_orderkey AS pos, row_number() OVER (PARTITION BY l_returnflag, l_partkey ORDER BY l_orderkey, l_linenumber) AS k FROM lineitem) WHERE k = 1")
def ordered_distinct(spark, sf_dir):
    """T7, SNK5: distinct paths per tier, each at its first position; an aggregation, not a window."""
    li = read_table(spark, sf_dir, "lineitem")
    first = li.groupBy(F.col("l_returnflag").alias("tier"), "l_partkey").agg(F.min("l_orderkey").alias("pos"))
    return first.select("tier", F.col("l_partkey").cast("string").alias("path"), "pos")


@query("SELECT coalesce(nullif(lang, 'en'), 'unset') AS flag, source, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE n_chars > 1000) AS BIGINT) AS n_long, min(n_chars) AS least FROM documents GROUP BY ALL")
def grouped_counts(spark, sf_dir):
    """Counts, filtered counts and minima by coalesced labels."""
    flag = F.coalesce(F.nullif("lang", F.lit("en")), F.lit("unset"))
    return read_table(spark, sf_dir, "documents").groupBy(flag.alias("flag"), "source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_chars") > 1000).alias("n_long"), F.min("n_chars").alias("least"))


@query("SELECT conv_id, turn, t, dense_rank() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx FROM (SELECT conv_id, turn, length(text) AS t FROM conversations)")
def rank_compression(spark, sf_dir):
    """W5, W4, SNK9: array indices are ranks of what exists; the true numbers stay beside them."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    return read_table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").cast("long").alias("t"), (F.dense_rank().over(w) - 1).cast("long").alias("idx"))


@query("SELECT doc_id AS node, -(n_chars + 1) AS label FROM documents WHERE source = 'src0' OR lang <> 'es'")
def components_update(spark, sf_dir):
    """Groups of documents of one length after a source was added and a language's links were taken out."""
    d = read_table(spark, sf_dir, "documents").select((-F.col("n_chars") - 1).cast("long").alias("u"), F.col("doc_id").alias("v"), "source", "lang")
    before = d.filter("source <> 'src0'")
    labels, _ = incremental.updated_components(graph.components(before), before, d.filter("source = 'src0'"), before.filter("lang = 'es'"))
    return labels.filter("node >= 0").select("node", "label")


@query("SELECT lang, source, CAST(sum(n_chars) AS BIGINT) AS bytes, count(*) AS nfiles, max(doc_id) AS newest FROM documents WHERE source = 'src0' OR lang <> 'es' GROUP BY ALL")
def rollup_update(spark, sf_dir):
    """Unit sums after the same change."""
    d = read_table(spark, sf_dir, "documents").select("lang", "source", F.col("n_chars").cast("long").alias("n_chars"), "doc_id")
    before, added = d.filter("source <> 'src0'"), d.filter("source = 'src0'")
    former = inv.unit_rollup(before, ["lang", "source"], "n_chars", "doc_id")
    return incremental.updated_rollup(former, before.filter("lang <> 'es'").union(added), ["lang", "source"], "n_chars", "doc_id", added, before.filter("lang = 'es'"))


@query("SELECT CASE grouping(o_orderstatus) * 2 + grouping(o_orderpriority) WHEN 0 THEN 'cells' WHEN 1 THEN 'status' WHEN 2 THEN 'priority' ELSE 'all' END AS summary, o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY GROUPING SETS ((), (o_orderstatus), (o_orderpriority), (o_orderstatus, o_orderpriority))")
def summary_figures(spark, sf_dir):
    """SNK23, A5, A25, A27: a document's summaries out of one scan of the table."""
    sets = {"all": [], "status": ["o_orderstatus"], "priority": ["o_orderpriority"], "cells": ["o_orderstatus", "o_orderpriority"]}
    return figures.summaries(read_table(spark, sf_dir, "orders"), sets, n=F.count(F.lit(1)), total=F.round(F.sum("o_totalprice"), 2))

"""Queries over stores, exports and plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell import functions as fn
from tidewell.operators import exports
from tidewell.plans.inventory import FILES_SQL, files
from tidewell.plans.registry import query
from tidewell.sources.tables import read_table


@query("SELECT p_partkey, CAST(CASE WHEN p_size % 6 = 0 THEN NULL WHEN p_size % 5 <> 0 AND p_size % 6 <> p_size % 4 + 1 AND p_size % 7 = 0 THEN NULL ELSE p_size % 6 END AS INTEGER) AS n FROM part")
def store_channels(spark, sf_dir):
    """P13, SRC21: channels that metadata lists, checked against the array's shape."""
    n = F.col("p_size") % 6
    names = F.array_join(F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: F.concat(F.lit('"c'), i.cast("string"), F.lit('"'))), ",")
    axes = F.when(F.col("p_size") % 5 == 0, '["z"]').otherwise('["t","c"]')
    doc = F.concat(F.lit('{"omero":{"channels":['), names, F.lit(']},"multiscales":[{"axes":'), axes, F.lit("}]}"))
    shape = F.array(F.lit(3), F.when(F.col("p_size") % 7 == 0, F.col("p_size") % 4 + 1).otherwise(n))
    return read_table(spark, sf_dir, "part").select("p_partkey", exports.channel_count(doc, shape).alias("n"))


@query("WITH h AS (SELECT user_id, list(DISTINCT CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'error' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END) AS have FROM events WHERE value > 80 GROUP BY 1), u AS (SELECT DISTINCT user_id FROM events), j AS (SELECT u.user_id, user_id % 6 AS n, list_sort(list_filter(range(0, user_id % 6), lambda x: NOT list_contains(coalesce(have, []), x))) AS lack, have FROM u LEFT JOIN h USING (user_id)) SELECT user_id, CASE WHEN n < 1 THEN 'channel count unknown' WHEN have IS NULL THEN 'no frames' WHEN len(lack) > 0 THEN 'no frames of ' || array_to_string(lack, ',') END AS hold FROM j")
def viewer_hold(spark, sf_dir):
    """Why a viewer copy must stay."""
    e, t = read_table(spark, sf_dir, "events"), F.col("event_type")
    c = F.when(t == "click", 0).when(t == "view", 1).when(t == "error", 2).when(t == "signup", 3).otherwise(4)
    have = e.filter("value > 80").groupBy("user_id").agg(F.collect_set(c).alias("have"))
    u = e.select("user_id").distinct().join(have, "user_id", "left")
    return u.select("user_id", exports.hold_reason((F.col("user_id") % 6).cast("int"), F.col("have")).alias("hold"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 5 <> 0 AND o_orderkey % 4 = 1 THEN CASE WHEN o_orderkey % 1000 < 600 THEN 'arriving' ELSE 'abandoned' END WHEN o_custkey % 2000 < 900 THEN 'arriving' ELSE 'incomplete' END AS reason FROM orders")
def store_readiness(spark, sf_dir):
    """P19, ST15, ST16: ready, still arriving, or what is wrong."""
    k = F.col("o_orderkey")
    reason = exports.not_ready_reason(k % 3 == 0, k % 5 == 0, F.when(k % 4 == 1, k % 1000), F.col("o_custkey") % 2000)
    return read_table(spark, sf_dir, "orders").select("o_orderkey", reason.alias("reason"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'tiff' WHEN c_custkey % 4 = 1 THEN 'ome-zarr' WHEN c_nationkey % 3 = 0 THEN 'ome-zarr' ELSE 'both' END AS format FROM customer")
def export_format(spark, sf_dir):
    """The first known choice wins."""
    k = F.col("c_custkey") % 4
    own = F.when(k == 0, " TIFF ").when(k == 1, "ome-zarr").when(k == 2, "gif")
    return read_table(spark, sf_dir, "customer").select("c_custkey", exports.output_format(own, F.when(F.col("c_nationkey") % 3 == 0, "OME-ZARR")).alias("format"))


@query("SELECT conv_id, NOT bool_or(role = 'assistant' AND turn > 2) AND max(length(text)) <= 250 AS current FROM conversations GROUP BY conv_id")
def store_currency(spark, sf_dir):
    """Stored cells equal the frames and none is newer."""
    c = read_table(spark, sf_dir, "conversations")
    f = c.select("conv_id", "turn", F.length("text").alias("w"))
    s = c.filter("not (role = 'assistant' and turn > 2)").select("conv_id", "turn", F.lit(250).alias("u"))
    return exports.store_is_current(f, s, "conv_id", ["turn"], "w", "u")


@query("""WITH s AS (SELECT p_partkey AS k, p_size % 4 AS m, [('488', true, 0), ('405', false, 0), ('561', true, 1), ('640', false, 1)] AS l FROM part),
    one AS (SELECT k, x[1] AS name, x[2] AS top, x[3] AS raw, 0 AS c, CASE x[1] WHEN '488' THEN 1 WHEN '405' THEN 2 WHEN '561' THEN 3 ELSE 4 END AS o FROM (SELECT k, m, unnest([['488', 'true', '0'], ['405', 'false', '0'], ['561', 'true', '1'], ['640', 'false', '1']]) AS x FROM s WHERE m < 2) WHERE (m = 0 AND x[1] IN ('488', '561')) OR (m = 1 AND k % 5 > 0 AND x[1] IN ('640', '405')) OR (m = 1 AND k % 5 = 0 AND x[1] = '561')),
    many AS (SELECT k, x[1] AS name, x[2] AS top, CAST(CAST(x[3] AS INTEGER) + 2 * c AS VARCHAR) AS raw, c, CASE x[1] WHEN '488' THEN 1 WHEN '405' THEN 2 WHEN '561' THEN 3 ELSE 4 END AS o FROM (SELECT k, m, c, unnest([['488', 'true', '0'], ['405', 'false', '0'], ['561', 'true', '1'], ['640', 'false', '1']]) AS x FROM s, (VALUES (0), (1)) v(c) WHERE m >= 2) WHERE (c = 0 AND x[1] = '561') OR (c = 1 AND (x[1] = '488' OR (m = 3 AND x[1] = '640')))),
    a AS (SELECT * FROM one UNION ALL SELECT * FROM many)
    SELECT k AS p_partkey, CAST(raw AS INTEGER) AS raw, CAST(top AS BOOLEAN) AS top, name || 'nm' AS line, CAST(row_number() OVER (PARTITION BY k ORDER BY c, o) - 1 AS INTEGER) AS out FROM a""")
def extraction_plan(spark, sf_dir):
    """P32, W4, J21, SRC24, R7: channels of a sample with a running output index."""
    m = F.col("p_size") % 4
    configs = F.when(m < 2, F.array(F.lit("Laser all"))).when(m == 2, F.array(F.lit("Laser 561"), F.lit("LASER 488"))).otherwise(F.array(F.lit("Laser 561"), F.lit("Laser 488 and 640")))
    found = F.when(m == 0, F.array(F.lit("GFP (488)"), F.lit("x (561)"))).when((m == 1) & (F.col("p_partkey") % 5 == 0), F.array().cast("array<string>")).otherwise(F.array(F.lit("SiR (640)"), F.lit("DAPI (405)")))
    s = read_table(spark, sf_dir, "part").select("p_partkey", configs.alias("configs"), found.alias("found"), F.lit("cell_mScarlet_2").alias("folder"))
    return exports.extraction_plan(s, "p_partkey", "configs", "found", "folder")


@query("WITH m AS (SELECT doc_id, sha256(text) AS g FROM documents), l AS (SELECT doc_id, CASE max(quality) WHEN 1 THEN 'keep' ELSE 'delete' END AS label FROM labels GROUP BY 1), p AS (SELECT DISTINCT a.doc_id, b.doc_id AS k, l.label FROM m a JOIN m b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN l ON l.doc_id = b.doc_id) SELECT doc_id, string_agg(k || '=' || label, ',' ORDER BY k) AS siblings FROM p GROUP BY doc_id")
def sibling_labels(spark, sf_dir):
    """Labels of the copies of a dataset."""
    m = read_table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("g"))
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.when(F.max("quality") == 1, "keep").otherwise("delete").alias("label"))
    return exports.sibling_labels(m, labels, "doc_id", "g", "label")


@query(f"WITH {FILES_SQL}, a AS (SELECT key, cls AS tree, count(*) AS n, sum(size) AS bytes, CASE cls WHEN 'final' THEN 1 WHEN 'viewer_export' THEN 2 ELSE 3 END AS r FROM classed WHERE cls IN ('final', 'viewer_export', 'raw') GROUP BY key, cls) SELECT key, tree, CAST(n AS BIGINT) AS n, CAST(bytes AS BIGINT) AS bytes FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY r) AS k FROM a) WHERE k = 1")
def final_tree(spark, sf_dir):
    """J13, SRC3, R1: the first tree with files, in a fixed order."""
    return exports.first_tree(files(spark, sf_dir), "key", "cls", ["final", "viewer_export", "raw"]).withColumnRenamed("cls", "tree")


@query("WITH r AS (SELECT s_suppkey AS k, CASE s_suppkey % 3 WHEN 0 THEN 'n' || s_nationkey WHEN 1 THEN 'n' || s_nationkey || '/x' ELSE 'm/' || s_suppkey END AS p, s_suppkey % 40 AS i FROM supplier), e AS (SELECT least(a.k, b.k) AS a, greatest(a.k, b.k) AS b, 0 AS r FROM r a JOIN r b ON a.k <> b.k AND (a.p = b.p OR starts_with(b.p, a.p || '/')) UNION ALL SELECT least(a.k, b.k), greatest(a.k, b.k), 1 FROM r a JOIN r b ON a.k <> b.k AND a.i = b.i) SELECT a, b, CASE WHEN min(r) = 0 THEN 'path' ELSE 'inode' END AS why FROM e GROUP BY a, b")
def alias_pairs(spark, sf_dir):
    """Roots that are one another under another name."""
    suppliers = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    path = F.when(k % 3 == 0, F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))).when(k % 3 == 1, F.concat(F.lit("n"), F.col("s_nationkey").cast("string"), F.lit("/x"))).otherwise(F.concat(F.lit("m/"), k.cast("string")))
    r = suppliers.select(k.alias("k"), path.alias("p"), (k % 40).alias("i"))
    return exports.aliases(r, "k", "p", "i")


@query("WITH s AS (SELECT o_orderkey AS k, v.stage, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'failed' END AS status FROM orders, (VALUES ('crop'), ('deskew'), ('mip_encode')) v(stage)) SELECT k, stage, CASE WHEN k % 5 = 0 AND stage = 'deskew' THEN 'pending' WHEN k % 5 = 0 AND stage = 'mip_encode' THEN 'reset' ELSE status END AS status FROM s")
def resubmission(spark, sf_dir):
    """ST17, SNK1, SNK2: a resubmitted stage resets the one after it."""
    o = read_table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "done").otherwise("failed")
    s = o.select(F.col("o_orderkey").alias("k"), F.explode(F.array(*(F.lit(x) for x in ("crop", "deskew", "mip_encode")))).alias("stage"), status.alias("status"))
    return exports.resubmit(s, o.filter("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("k"), F.lit("deskew").alias("stage")), "k", "stage", "status", "mip_encode")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'live' WHEN o_orderstatus = 'F' AND o_custkey % 3 = 0 AND o_orderkey % 4 <> 0 THEN 'done' ELSE 'batch' END AS owner FROM orders")
def hand_off(spark, sf_dir):
    """ST13, ST7, ST10: who finishes a dataset."""
    s = F.when(F.col("o_orderstatus") == "O", "running").when(F.col("o_orderstatus") == "F", "complete").otherwise("stale")
    who = exports.owner(s, F.col("o_orderkey") % 2 == 0, F.col("o_custkey") % 3 == 0, F.col("o_orderkey") % 4 != 0)
    return read_table(spark, sf_dir, "orders").select("o_orderkey", who.alias("owner"))


@query("WITH d AS (SELECT doc_id, sha256(text) AS g, lang FROM documents), r AS (SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY g ORDER BY doc_id) AS k FROM d) WHERE k > 1) SELECT d.doc_id, CASE WHEN r.doc_id IS NOT NULL THEN 'DUP1' ELSE 'K0' END AS rule, 'KEEP' AS action, lang || CASE WHEN d.doc_id IN (3, 33) THEN '; inventory is stale' ELSE '' END AS reasons FROM d LEFT JOIN r USING (doc_id)")
def verdict_table(spark, sf_dir):
    """SNK6: redundant copies change their rule, not their action."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("g"), F.lit("K0").alias("rule"), F.lit("KEEP").alias("action"), F.array("lang").alias("reasons"))
    first = d.groupBy("g").agg(F.min("doc_id").alias("f"))
    return exports.verdicts(d, d.join(first, "g").filter("doc_id <> f"), "doc_id", ["3", "33"])


@query("WITH o AS (SELECT o_orderkey, coalesce(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM orders) SELECT o_orderkey, CAST(c AS BIGINT) AS start_s, c > 50000000 AS timed_out FROM o")
def throttle(spark, sf_dir):
    """F20, ST5, R17: start times under a rate, and what passes a deadline."""
    o = read_table(spark, sf_dir, "orders").withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("long"))
    o = exports.throttled_start(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "cents", 1.0)
    return o.select("o_orderkey", F.col("start_s").cast("long").alias("start_s"), (F.col("start_s") > 50_000_000).alias("timed_out"))


@query("SELECT l_returnflag AS tier, l_orderkey AS key, CAST(count(*) AS BIGINT) AS n, round(sum(l_extendedprice), 2) AS bytes, min(l_partkey) FILTER (WHERE l_linenumber = least) AS first_path FROM (SELECT *, min(l_linenumber) OVER (PARTITION BY l_returnflag, l_orderkey) AS least FROM lineitem) GROUP BY l_returnflag, l_orderkey")
def suggestion_groups(spark, sf_dir):
    """Sums and the first path of each tier and dataset."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_returnflag").alias("tier"), F.col("l_orderkey").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("bytes"), F.min(F.struct("l_linenumber", "l_partkey"))["l_partkey"].alias("first_path"))


@query("WITH p AS (SELECT regexp_extract(url, '//([^/]+)', 1) AS host, regexp_extract(url, '//[^/]+/([^/?#]*)', 1) AS top, length(html) AS n FROM pages) SELECT host, top, CAST(sum(n) AS BIGINT) AS bytes FROM p WHERE NOT EXISTS (SELECT 1 FROM (VALUES ('en'), ('de')) v(x) WHERE starts_with(top, x)) GROUP BY ALL")
def unregistered_size(spark, sf_dir):
    """SRC30, P3: what no registered prefix covers, and its size."""
    p = read_table(spark, sf_dir, "pages").select(F.regexp_extract("url", "//([^/]+)", 1).alias("host"), F.regexp_extract("url", r"//[^/]+/([^/?#]*)", 1).alias("top"), F.length("html").alias("n"))
    known = spark.createDataFrame([("en",), ("de",)], "x string")
    free = p.join(F.broadcast(known), F.startswith("top", "x"), "left_anti")  # a fixed list of two prefixes
    return free.groupBy("host", "top").agg(F.sum("n").alias("bytes"))


@query("WITH e AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) SELECT user_id, CAST(count(*) AS BIGINT) AS n, min(value) AS lo, max(value) AS hi, round(avg(value), 6) AS mean, round(min(value) FILTER (WHERE k = 1), 6) AS first, round(avg(value) FILTER (WHERE k > 1), 6) AS rest FROM e GROUP BY user_id")
def throughput_summary(spark, sf_dir):
    """A44, SNK21, SRC28: first against the rest."""
    e = read_table(spark, sf_dir, "events")
    agg = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.avg("value").alias("mean"), F.sum("value").alias("s"), F.min_by("value", F.struct("ts", "event_id")).alias("first"))
    rest = F.when(F.col("n") > 1, (F.col("s") - F.col("first")) / (F.col("n") - 1))
    return agg.select("user_id", "n", "lo", "hi", F.round("mean", 6).alias("mean"), F.round("first", 6).alias("first"), F.round(rest, 6).alias("rest"))


@query("SELECT p_partkey, TRY_CAST(nullif(regexp_extract(p_name || '_' || p_size || '.ome.tif', '_([0-9]+)\\.ome\\.tiff?$', 1), '') AS INTEGER) AS idx, rtrim(p_brand, '0123456789') AS label FROM part".replace("\\\\", "\\"))
def sequence_names(spark, sf_dir):
    """SRC19, S12, R18, R30, F4: numeric order out of names, labels without suffixes."""
    name = F.concat_ws("", "p_name", F.lit("_"), F.col("p_size").cast("string"), F.lit(".ome.tif"))
    return read_table(spark, sf_dir, "part").select("p_partkey", fn.sequence_index(name).alias("idx"), F.regexp_replace("p_brand", "[0-9]+$", "").alias("label"))

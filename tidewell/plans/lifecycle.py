"""Queries over completeness, stages and order."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewell.operators import completeness, lifecycle
from tidewell.plans.registry import query
from tidewell.sources import layout
from tidewell.sources.tables import read_table


@query("""WITH f AS (SELECT conv_id, role, turn, max(length(text)) AS s FROM conversations GROUP BY ALL), t AS (SELECT conv_id, turn, max(s) AS s FROM f GROUP BY ALL),
    a AS (SELECT conv_id, min(turn) AS lo, max(turn) AS hi, count(*) AS n, min(s) AS least FROM t GROUP BY conv_id)
    SELECT conv_id, CASE WHEN NOT (lo = 0 AND hi + 1 = n) THEN 'gap' WHEN least <= 0 THEN 'empty frame' WHEN conv_id % 4 + 3 <> n THEN 'wrong length' ELSE 'ok' END AS detail, CAST(n AS BIGINT) AS n_t FROM a""")
def series_complete(spark, sf_dir):
    """Contiguous, full, of the expected length."""
    c = read_table(spark, sf_dir, "conversations").select("conv_id", F.lit(0).alias("c"), "turn", F.length("text").alias("size"))
    return completeness.series(c, "conv_id", "c", "turn", "size", F.col("conv_id") % 4 + 3).select("conv_id", "detail", "n_t")


@query("SELECT a.user_id, b.event_type FROM (SELECT DISTINCT user_id FROM events WHERE value > 90) a CROSS JOIN (SELECT DISTINCT event_type FROM events) b WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.value > 90 AND e.user_id = a.user_id AND e.event_type = b.event_type)")
def grid_missing(spark, sf_dir):
    """Cells of the required grid without a row."""
    e = read_table(spark, sf_dir, "events")
    return completeness.grid_missing(e.filter("value > 90"), "user_id", "event_type", e.select("event_type").distinct())


@query("SELECT l_orderkey, count(*) FILTER (WHERE l_linenumber > 1) >= 2 AND coalesce(count(DISTINCT l_returnflag) FILTER (WHERE l_linenumber > 1), 0) = 1 AS blank FROM lineitem GROUP BY l_orderkey")
def constant_block(spark, sf_dir):
    """Enough non-empty blocks that are all alike."""
    li = read_table(spark, sf_dir, "lineitem").withColumn("size", F.when(F.col("l_linenumber") > 1, F.ascii("l_returnflag")).otherwise(0))
    return completeness.constant_blocks(li, "l_orderkey", "size", 2)


@query("SELECT p_partkey, CAST(ceil(p_size / 4.0) * ceil((p_size + 7) / 5.0) * 2 AS BIGINT) AS chunks FROM part")
def chunk_grid(spark, sf_dir):
    """Chunks that an array's shape asks for."""
    shape, chunks = F.array(F.col("p_size"), F.col("p_size") + 7, F.lit(2)), F.array(F.lit(4), F.lit(5), F.lit(1))
    return read_table(spark, sf_dir, "part").select("p_partkey", completeness.chunk_count(shape, chunks).alias("chunks"))


@query("SELECT l_orderkey, CAST(coalesce(min(least(l_linenumber * 3, l_quantity)), 1) AS BIGINT) AS usable, CAST(coalesce(max(l_linenumber * 3), 1) AS BIGINT) AS declared FROM lineitem GROUP BY l_orderkey")
def usable_length(spark, sf_dir):
    """Written length capped by the declared one, least over channels."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 3).cast("long").alias("d"), F.col("l_quantity").cast("long").alias("w"))
    return completeness.usable_length(li, "l_orderkey", "d", "w")


@query("WITH c AS (SELECT user_id, event_type, count(*) AS n, min(ts) AS t, min(event_id) AS i FROM events GROUP BY ALL) SELECT user_id, event_type, CAST(n AS BIGINT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, t, i) AS k FROM c) WHERE k = 1")
def mode_shape(spark, sf_dir):
    """The commonest value, first seen on a tie."""
    return completeness.modal(read_table(spark, sf_dir, "events"), "user_id", "event_type", ["ts", "event_id"])


@query("WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS UNBOUNDED PRECEDING) AS b FROM (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS l_quantity, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL)) SELECT l_orderkey, CAST(count(*) FILTER (WHERE b = 0) AS BIGINT) AS n_good, CAST(coalesce(sum(l_quantity) FILTER (WHERE b = 0), 0) AS BIGINT) AS pages, CAST(floor(coalesce(sum(l_quantity) FILTER (WHERE b = 0), 0) / 10) AS BIGINT) AS n_t FROM l GROUP BY l_orderkey")
def readable_prefix(spark, sf_dir):
    """What can be read before the first bad part."""
    li = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").cast("long").alias("pages"), F.max("l_returnflag").alias("flag"))
    return completeness.readable_prefix(li, "l_orderkey", "l_linenumber", F.col("flag") == "R", "pages", 10)


@query("SELECT d.doc_id, CASE WHEN l.q IS DISTINCT FROM 1 THEN false WHEN l.q IS NULL THEN true WHEN l.t IS NULL THEN true ELSE l.t = 0 END AS matches FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS q, max(nullif(toxic, 1)) AS t FROM labels GROUP BY 1) l USING (doc_id)")
def provenance_match(spark, sf_dir):
    """Null-safe provenance."""
    m = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"), F.max(F.nullif("toxic", F.lit(1))).alias("t"))
    ok = lifecycle.provenance_matches(F.col("q"), F.lit(1), F.col("t"), F.lit(0))
    return read_table(spark, sf_dir, "documents").join(m, "doc_id", "left").select("doc_id", ok.alias("matches"))


@query("SELECT o_orderkey, CAST(row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 2 ELSE 1 END, o_orderkey) AS BIGINT) AS position FROM orders")
def priority_queue(spark, sf_dir):
    """Position by priority, then key."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    rank = lifecycle.priority(F.col("o_orderstatus"), {"F": 0, "P": 2})
    return lifecycle.queue_position(o, [rank, F.col("o_orderkey")]).select("o_orderkey", F.col("position").cast("long").alias("position"))


@query(f"""WITH e AS (SELECT user_id, ts, event_id, event_type IN ('error', 'click') AS f FROM events), g AS (SELECT *, row_number() OVER w - sum(CAST(f AS INTEGER)) OVER w AS g FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    r AS (SELECT user_id, g, count(*) AS n FROM g WHERE f GROUP BY ALL) SELECT u.user_id, CAST(coalesce(max(n), 0) AS BIGINT) AS longest, coalesce(max(n), 0) >= {layout.GIVE_UP_AFTER} AS gave_up FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN r USING (user_id) GROUP BY u.user_id""")
def give_up(spark, sf_dir):
    """Too many failures in a row."""
    runs = lifecycle.longest_failure_run(read_table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], F.col("event_type").isin("error", "click"))
    return runs.select("user_id", "longest", (F.col("longest") >= layout.GIVE_UP_AFTER).alias("gave_up"))


@query("WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) SELECT user_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'done' WHEN 'signup' THEN CASE WHEN value > 50 THEN 'superseded' ELSE 'done' END WHEN 'view' THEN 'in flight' ELSE 'lost' END AS outcome, event_id FROM l WHERE k = 1")
def ticket_outcomes(spark, sf_dir):
    """ST3, P14, SRC23: the latest state of each ticket and what follows from it."""
    last = lifecycle.latest(read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value"), "user_id", ["ts", "event_id"])
    t = F.col("event_type")
    out = F.when(t == "error", "failed").when(t == "purchase", "done").when(t == "signup", F.when(F.col("value") > 50, "superseded").otherwise("done")).when(t == "view", "in flight").otherwise("lost")
    return last.select("user_id", out.alias("outcome"), "event_id")


@query("WITH a AS (SELECT user_id, max(ts) FILTER (WHERE event_type = 'signup') AS u, max(ts) FILTER (WHERE event_type = 'error') AS r FROM events GROUP BY 1) SELECT user_id, CASE WHEN u < r THEN 'stale' ELSE 'fresh' END AS state FROM a WHERE u IS NOT NULL")
def stale_labels(spark, sf_dir):
    """Labels older than the last processing."""
    at = lambda t: F.max(F.when(F.col("event_type") == t, F.col("ts")))
    a = read_table(spark, sf_dir, "events").groupBy("user_id").agg(at("signup").alias("u"), at("error").alias("r")).filter("u is not null")
    return lifecycle.stale_labels(a, "user_id", "u", "r")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS k FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE k = 1 OR p IS DISTINCT FROM event_type")
def notice_changes(spark, sf_dir):
    """W9, SNK18: notices that differ from the one before."""
    return lifecycle.changes(read_table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "event_type").select("user_id", "event_id", "event_type")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey LIMIT 13")
def admission(spark, sf_dir):
    """P27, S11, ST18: the head of a queue up to the cap."""
    o = read_table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'")
    return lifecycle.admitted(o, [F.desc("o_totalprice"), F.col("o_orderkey")], 20, 7).select("o_orderkey")


@query("WITH e AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) > 900000000 OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS f FROM events), s AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY user_id, k")
def idle_sessions(spark, sf_dir):
    """ST15: sessions split by more than 15 idle minutes."""
    s = lifecycle.idle_sessions(read_table(spark, sf_dir, "events"), "user_id", "ts", 900)
    return s.select("user_id", F.date_format("started", "yyyy-MM-dd HH:mm:ss").alias("started"), "n")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_linenumber) AS k FROM lineitem) WHERE k <= 2")
def top_lines(spark, sf_dir):
    """The top rows of each group."""
    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_partkey", "l_linenumber")
    return read_table(spark, sf_dir, "lineitem").withColumn("k", F.row_number().over(w)).filter("k <= 2").select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT c_mktsegment, c_custkey, round(sum(c_acctbal) OVER (PARTITION BY c_mktsegment), 2) AS total FROM customer")
def hash_order(spark, sf_dir):
    """Every member with its component's total, by which work is ordered."""
    c = read_table(spark, sf_dir, "customer")
    totals = c.groupBy("c_mktsegment").agg(F.round(F.sum("c_acctbal"), 2).alias("total"))
    return c.join(totals, "c_mktsegment").select("c_mktsegment", "c_custkey", "total")


def stages(spark, sf_dir):
    """Orders as stage rows: key, stage, status, ticket."""
    k = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "pending").otherwise("failed")
    stage = F.when(k % 3 == 0, "deskew").otherwise("roi_detect")
    return read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), stage.alias("stage"), status.alias("status"), F.when(k % 4 != 0, k).alias("ticket"))


@query("SELECT o_custkey AS key, o_orderkey AS ticket FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 3 = 0 AND o_orderkey % 4 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 10)")
def tickets_in_flight(spark, sf_dir):
    """J18, ST4: this pass's pending tickets."""
    ours = read_table(spark, sf_dir, "customer").filter("c_nationkey < 10").select(F.col("c_custkey").alias("key"))
    return lifecycle.in_flight(stages(spark, sf_dir), ours, "key", "deskew", "ticket").select("key", "ticket")


@query("SELECT c_custkey AS key FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 <> 0)")
def needs_triage(spark, sf_dir):
    """Datasets whose stage isn't done."""
    d = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    return lifecycle.needs_stage(d, stages(spark, sf_dir), "key", "roi_detect")


@query("WITH w AS (SELECT conv_id, turn, max(length(text)) AS n FROM conversations WHERE role <> 'system' GROUP BY ALL), p AS (SELECT conv_id, turn, 200 AS b FROM conversations WHERE conv_id % 3 <> 0 GROUP BY ALL) SELECT conv_id, turn, CASE WHEN n IS NULL THEN 'prune' WHEN b IS NULL OR b < n THEN 'build' ELSE 'keep' END AS what FROM w FULL JOIN p USING (conv_id, turn)")
def build_and_prune(spark, sf_dir):
    """SNK17, T10, R3, R6: what is missing, what is stale and what nobody wants."""
    c = read_table(spark, sf_dir, "conversations")
    want = c.filter("role <> 'system'").groupBy("conv_id", "turn").agg(F.max(F.length("text")).alias("n"))
    have = c.filter("conv_id % 3 <> 0").select("conv_id", "turn").distinct().withColumn("b", F.lit(200))
    return lifecycle.build_and_prune(want, have, ["conv_id", "turn"], "n", "b")


@query("SELECT event_type, 'k' AS name, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY event_type")
def json_map_sums(spark, sf_dir):
    """Sums over the entries of a JSON map column."""
    e = read_table(spark, sf_dir, "events").select("event_type", F.explode(F.from_json("props", "map<string,bigint>")).alias("name", "v"))
    return e.groupBy("event_type", "name").agg(F.sum("v").alias("total"))


@query("SELECT user_id, string_agg('open #' || lpad(CAST(c AS VARCHAR), 3, '0'), chr(10) ORDER BY c) AS script FROM (SELECT DISTINCT user_id, event_id % 4 AS c FROM events) GROUP BY user_id")
def open_script(spark, sf_dir):
    """SNK10, SNK7, F6: a text made from distinct channels."""
    e = read_table(spark, sf_dir, "events").select("user_id", (F.col("event_id") % 4).alias("c")).distinct()
    lines = F.transform(F.sort_array(F.collect_list("c")), lambda c: F.concat(F.lit("open #"), F.lpad(c.cast("string"), 3, "0")))
    return e.groupBy("user_id").agg(F.array_join(lines, "\n").alias("script"))


@query("WITH l AS (SELECT l_orderkey AS k, l_linenumber AS s, sum(l_quantity) AS p, max(l_returnflag) = 'R' AS bad FROM lineitem GROUP BY ALL), b AS (SELECT *, bool_or(bad) OVER (PARTITION BY k ORDER BY s ROWS UNBOUNDED PRECEDING) AS out FROM l) SELECT k AS l_orderkey, min_by(s || '.tif', s) FILTER (WHERE NOT out AND s = (SELECT min(s) FROM l x WHERE x.k = b.k)) AS path, CASE WHEN bool_or(out) THEN CAST(floor(coalesce(sum(p) FILTER (WHERE NOT out), 0) / 10) AS BIGINT) END AS actual_timepoints, coalesce(string_agg(s || '.tif', ',' ORDER BY s) FILTER (WHERE out), '') AS excluded FROM b GROUP BY k")
def readable_masters(spark, sf_dir):
    """The record of what can be read of each series."""
    li = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").cast("long").alias("pages"), F.max("l_returnflag").alias("flag"))
    parts = li.withColumn("name", F.concat(F.col("l_linenumber").cast("string"), F.lit(".tif")))
    found = completeness.readable_master(parts, "l_orderkey", "l_linenumber", "name", F.col("flag") == "R", "pages", 10)
    return found.withColumn("excluded", F.array_join("excluded", ","))

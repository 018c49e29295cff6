"""Queries over copies and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import arrays, dedup, hashtree, rules
from tidewell.plans.registry import query
from tidewell.sources.tables import read_table

LINES_SQL = "lines AS (SELECT doc_id, line, CAST(length(line) AS BIGINT) AS size FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents))"


def lines(spark, sf_dir):
    """Documents as datasets, their lines as files."""
    rows = read_table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return rows.withColumn("size", F.length("line").cast("long"))


@query(f"WITH {LINES_SQL}, t AS (SELECT doc_id, sum(size) AS total FROM lines GROUP BY 1), s AS (SELECT DISTINCT doc_id, size FROM lines WHERE size >= 40) SELECT a.doc_id AS a, b.doc_id AS b, CAST(sum(a.size) AS BIGINT) AS shared FROM s a JOIN s b ON a.size = b.size AND a.doc_id < b.doc_id JOIN t ta ON ta.doc_id = a.doc_id JOIN t tb ON tb.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id, ta.total, tb.total HAVING sum(a.size) >= 0.5 * least(ta.total, tb.total)")
def size_candidate_pairs(spark, sf_dir):
    """Pairs whose common sizes make up half of the smaller."""
    return dedup.candidate_pairs(lines(spark, sf_dir), "doc_id", "size", 40, 0.5)


@query("SELECT DISTINCT a.source AS a, b.source AS b FROM documents a JOIN documents b ON sha256(a.text) = sha256(b.text) AND a.source < b.source")
def content_sharing_pairs(spark, sf_dir):
    """Pairs that share a digest."""
    d = read_table(spark, sf_dir, "documents").select("source", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    return dedup.sharing_pairs(d, "source", ["sha"])


@query(f"""WITH {LINES_SQL}, f AS (SELECT doc_id, line, any_value(size) AS size, count(*) AS n FROM lines GROUP BY doc_id, line),
    pairs AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM f a JOIN f b ON a.line = b.line AND a.doc_id < b.doc_id WHERE a.size >= 20),
    al AS (SELECT a, b, sum(greatest(x.n - coalesce(y.n, 0), 0)) AS lacks FROM pairs JOIN f x ON x.doc_id = a LEFT JOIN f y ON y.doc_id = b AND y.line = x.line GROUP BY a, b),
    bl AS (SELECT a, b, sum(greatest(x.n - coalesce(y.n, 0), 0)) AS lacks FROM pairs JOIN f x ON x.doc_id = b LEFT JOIN f y ON y.doc_id = a AND y.line = x.line GROUP BY a, b)
    SELECT a, b, al.lacks = 0 AS a_in_b, bl.lacks = 0 AS b_in_a, CAST(bl.lacks AS BIGINT) AS unmatched FROM al JOIN bl USING (a, b)""")
def multiset_containment(spark, sf_dir):
    """Which of two datasets contains the other, as multisets of all files; a least size holds for the search of pairs only."""
    f = lines(spark, sf_dir).select("doc_id", "size", F.unhex(F.sha2(F.col("line").cast("binary"), 256)).alias("sha"))
    return dedup.sharing_containment(f, "doc_id", ["sha"], F.col("size") >= 20)


@query("WITH RECURSIVE d AS (SELECT doc_id, sha256(text) AS sha FROM documents), g AS (SELECT sha, min(doc_id) AS label, count(*) AS n FROM d GROUP BY sha) SELECT doc_id AS node, label FROM d JOIN g USING (sha) WHERE n > 1")
def dup_components(spark, sf_dir):
    """G1: components of documents linked by equal digests."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    return dedup.content_groups(d, "doc_id", ["sha"])


@query("""WITH RECURSIVE f AS (SELECT DISTINCT source AS k, concat_ws(':', lang, n_chars % 400) AS s FROM documents WHERE source IS NOT NULL),
    e AS (SELECT DISTINCT a.k AS u, b.k AS v FROM f a JOIN f b ON a.s = b.s AND a.k <> b.k), r(node, seen) AS (SELECT k, k FROM (SELECT DISTINCT u AS k FROM e) UNION SELECT r.node, e.v FROM r JOIN e ON e.u = r.seen)
    SELECT node, min(seen) AS label FROM r GROUP BY node""")
def chained_components(spark, sf_dir):
    """G1: components over chains of different links."""
    d = read_table(spark, sf_dir, "documents")
    return dedup.content_groups(d.select("source", F.concat_ws(":", "lang", F.col("n_chars") % 400).alias("s")), "source", ["s"])


@query("WITH d AS (SELECT doc_id, n_chars, sha256(text) AS sha FROM documents), k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY sha ORDER BY n_chars DESC, doc_id) AS keeper FROM d) SELECT doc_id, keeper, n_chars AS bytes, 'A1' AS tier, 'identical to ' || keeper AS evidence FROM k WHERE doc_id <> keeper")
def dup_suggestions(spark, sf_dir):
    """Flagship (rule DUP1): copies identical to a kept copy and the bytes they take."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    out = dedup.copies_of_keeper(d, "doc_id", "sha", "n_chars")
    return out.select("doc_id", "keeper", "bytes", F.lit("A1").alias("tier"), F.concat(F.lit("identical to "), F.col("keeper").cast("string")).alias("evidence"))


@query("SELECT source, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS k FROM documents) WHERE k = 1")
def keeper_rank(spark, sf_dir):
    """The preferred member of each group in a total order."""
    d = read_table(spark, sf_dir, "documents")
    return dedup.keeper(d.select("source", "doc_id", "n_chars"), ["source"], [F.desc("n_chars"), F.col("doc_id")]).filter("is_keeper").drop("is_keeper")


@query("SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'missing' WHEN c_custkey % 5 = 0 THEN 'size changed' WHEN c_custkey % 3 = 0 THEN 'time changed' END AS problem FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 5 = 0 OR c_custkey % 3 = 0")
def keeper_file_problems(spark, sf_dir):
    """Inventory against the present."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("size"), F.col("c_nationkey").alias("stamp"))
    now = c.filter("c_custkey % 7 <> 0").withColumn("size", F.when(F.col("c_custkey") % 5 == 0, F.col("size") + 1).otherwise(F.col("size"))).withColumn("stamp", F.when(F.col("c_custkey") % 3 == 0, F.col("stamp") + 1).otherwise(F.col("stamp")))
    return dedup.file_problems(c, now, "c_custkey", "size", "stamp").select("c_custkey", "problem")


@query("SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'missing' WHEN c_custkey % 4 = 0 THEN 'changed' WHEN c_custkey % 9 = 0 THEN 'other keeper' ELSE 'same' END AS outcome FROM customer")
def verify_diff(spark, sf_dir):
    """What became of each row of an older report."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("stamp"), F.col("c_nationkey").alias("kept"))
    new = c.filter("c_custkey % 11 <> 0").withColumn("stamp", F.when(F.col("c_custkey") % 4 == 0, -F.col("stamp") - 1).otherwise(F.col("stamp"))).withColumn("kept", F.when(F.col("c_custkey") % 9 == 0, F.col("kept") + 1).otherwise(F.col("kept")))
    new = new.union(c.withColumn("c_custkey", -F.col("c_custkey") - 1))  # rows that only the newer report has
    return rules.report_diff(c, new, ["c_custkey"], "stamp", "kept").select("c_custkey", "outcome")


FACTS_SQL = """facts AS (SELECT d.doc_id, CASE d.doc_id % 17 WHEN 0 THEN 'running' WHEN 1 THEN 'pending' ELSE 'done' END AS status,
        CASE d.doc_id % 5 WHEN 0 THEN 'dud' WHEN 1 THEN 'dead' ELSE 'ok' END AS signal_flag, CASE WHEN d.doc_id % 13 = 0 THEN 3 ELSE 40 END AS age,
        CASE l.quality * 2 + l.toxic WHEN 0 THEN 'delete' WHEN 1 THEN 'interrogate' WHEN 2 THEN CASE WHEN d.doc_id % 2 = 0 THEN 'delete' ELSE 'keep' END WHEN 3 THEN 'delete' END AS label,
        CASE WHEN d.doc_id % 19 = 0 THEN 'model' END AS label_source, d.doc_id % 23 = 0 AS late, CASE d.doc_id % 29 WHEN 0 THEN 'keep' WHEN 1 THEN 'delete' WHEN 2 THEN 'interrogate' END AS sibling,
        CASE WHEN d.source = 'src7' THEN 'pinned: src7' END AS pin, d.doc_id % 31 = 0 AS moved, CASE WHEN d.lang = 'es' THEN 'Bead_' ELSE 'cell_' END || d.doc_id AS name
        FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1) l USING (doc_id))"""


@query(f"""WITH {FACTS_SQL}, g AS (SELECT *, concat_ws('|', pin, CASE WHEN label = 'keep' THEN 'labelled keep' END, CASE WHEN sibling = 'keep' THEN 'a sibling copy is labelled keep' END) AS guarded,
        concat_ws('|', CASE WHEN label_source <> 'human' THEN 'label is not from a person' END, CASE WHEN sibling <> 'delete' THEN 'a sibling copy has another label' END,
            CASE WHEN late THEN 'label is older than the last processing' END, CASE WHEN moved THEN 'automatic triage saw motion' END, CASE WHEN name LIKE 'Bead%' THEN 'looks like a bead or PSF recording' END) AS problems FROM facts),
    d AS (SELECT *, CASE WHEN status IN ('running', 'pending') THEN 1 WHEN age < 14 THEN 2 WHEN guarded <> '' AND label = 'delete' THEN 3 WHEN guarded <> '' THEN 4 WHEN label = 'delete' AND problems <> '' THEN 5
        WHEN label = 'delete' THEN 6 WHEN label = 'interrogate' THEN 7 WHEN signal_flag IN ('dud', 'dead') AND label IS NULL THEN 8 ELSE 9 END AS k FROM g)
    SELECT doc_id, ['P2','P2','R1','P1','R1','D1','R1','R1','K0'][k] AS rule, ['KEEP','KEEP','REVIEW','KEEP','REVIEW','SUGGEST_DELETE','REVIEW','REVIEW','KEEP'][k] AS action,
        CASE k WHEN 1 THEN 'status is ' || status WHEN 2 THEN 'discovered recently' WHEN 3 THEN 'label is delete but dataset is protected|' || guarded WHEN 4 THEN guarded || '|protected: nothing derived from it is offered' WHEN 5 THEN problems
            WHEN 6 THEN 'labelled delete' WHEN 7 THEN 'labelled interrogate' WHEN 8 THEN 'signal is ' || signal_flag ELSE 'no evidence for deletion' END AS reasons FROM d""")
def rule_cascade(spark, sf_dir):
    """The ordered cascade with its reasons."""
    d, now = read_table(spark, sf_dir, "documents"), F.lit("2024-06-01 00:00:00").cast("timestamp")
    marks = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg((F.max("quality") * 2 + F.max("toxic")).alias("m"))
    i = F.col("doc_id")
    facts = d.join(marks, "doc_id", "left").select(
        i, F.when(i % 17 == 0, "running").when(i % 17 == 1, "pending").otherwise("done").alias("status"), F.when(i % 5 == 0, "dud").when(i % 5 == 1, "dead").otherwise("ok").alias("signal_flag"),
        F.when(i % 13 == 0, now - F.expr("INTERVAL 3 DAYS")).otherwise(now - F.expr("INTERVAL 40 DAYS")).alias("discovered_at"), F.when(i % 23 == 0, now).alias("reprocessed_at"),
        F.when(F.col("m") == 0, "delete").when(F.col("m") == 1, "interrogate").when(F.col("m") == 2, F.when(i % 2 == 0, "delete").otherwise("keep")).when(F.col("m") == 3, "delete").alias("label"),
        F.when(i % 19 == 0, "model").alias("label_source"), (now - F.expr("INTERVAL 1 DAY")).alias("label_at"),
        F.array_compact(F.array(F.when(i % 29 == 0, "keep").when(i % 29 == 1, "delete").when(i % 29 == 2, "interrogate"))).alias("siblings"),
        F.array_compact(F.array(F.when(F.col("source") == "src7", "pinned: src7"))).alias("protected"), F.when(i % 31 == 0, "keep").alias("auto_label"), F.when(i % 31 == 0, "motion_detected").alias("auto_reason"),
        F.concat(F.when(F.col("lang") == "es", "Bead_").otherwise("cell_"), i.cast("string")).alias("name"),
    )
    return facts.select("doc_id", *rules.decide(now)).withColumn("reasons", F.array_join("reasons", "|"))


@query("SELECT o_custkey, CASE WHEN bool_or(o_orderstatus = 'F') AND max(o_orderkey % 3) = 2 THEN 'blocked' WHEN bool_or(o_orderstatus = 'F') THEN 'failed' WHEN bool_or(o_orderpriority = '1-URGENT' AND o_orderstatus = 'O') THEN 'in_progress' ELSE 'in_progress' END AS overall FROM orders GROUP BY o_custkey")
def overall_status(spark, sf_dir):
    """One status out of a bag of stages."""
    o = read_table(spark, sf_dir, "orders").withColumn("status", F.when(F.col("o_orderstatus") == "F", "failed").otherwise("queued"))
    flag = F.when(F.col("o_orderkey") % 3 == 2, "blocked")
    return rules.overall_status(o, "o_custkey", "o_orderpriority", "status", "mip_encode", flag)


@query("WITH pins(pin) AS (VALUES ('Customer#00000001'), ('Customer#000000123'), ('Customer#0000005')), h AS (SELECT c_custkey, 'pinned: ' || pin AS why FROM customer JOIN pins ON starts_with(c_name, pin) UNION SELECT c_custkey, 'listed' FROM customer WHERE c_nationkey = 3) SELECT c.c_custkey, string_agg(why, '|' ORDER BY why) AS protected FROM customer c LEFT JOIN h USING (c_custkey) GROUP BY c.c_custkey")
def protected_reasons(spark, sf_dir):
    """P11, SRC11, SRC13: reasons by lookup and by pinned string prefix."""
    c = read_table(spark, sf_dir, "customer")
    pins = spark.createDataFrame([("Customer#00000001",), ("Customer#000000123",), ("Customer#0000005",)], "pin string")
    named = c.filter("c_nationkey = 3").select(F.col("c_custkey").alias("key"), F.lit("listed").alias("why"))
    out = rules.protected_reasons(c.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("path")), named, pins)
    return out.select(F.col("key").alias("c_custkey"), F.array_join("protected", "|").alias("protected"))


@query("SELECT p_partkey, CASE WHEN p_name LIKE '%a%' AND p_size > 10 AND p_retailprice > 1000 AND p_type IS NOT NULL THEN true ELSE false END AS accepted, CASE WHEN p_size < 10 THEN 'red' WHEN p_size < 20 THEN 'orange' WHEN p_size < 30 THEN 'amber' ELSE 'green' END AS flag FROM part")
def quality_gates(spark, sf_dir):
    """Independent thresholds, and a cascade of flags."""
    ok = arrays.quality_gates(name=F.col("p_name").contains("a"), size=F.col("p_size") > 10, price=F.col("p_retailprice") > 1000, kind=F.col("p_type").isNotNull())
    s = F.col("p_size")
    flag = F.when(s < 10, "red").when(s < 20, "orange").when(s < 30, "amber").otherwise("green")
    return read_table(spark, sf_dir, "part").select("p_partkey", ok.alias("accepted"), flag.alias("flag"))


@query("SELECT a.l_orderkey, a.l_partkey FROM lineitem a WHERE a.l_linenumber = 1 AND EXISTS (SELECT 1 FROM lineitem b WHERE b.l_linenumber = 2 AND b.l_orderkey = a.l_orderkey AND nullif(b.l_returnflag, 'R') IS NOT DISTINCT FROM nullif(a.l_returnflag, 'R'))")
def twin_files(spark, sf_dir):
    """Files of the keeper that the member has too, null-safe."""
    li = read_table(spark, sf_dir, "lineitem").withColumn("sha", F.nullif("l_returnflag", F.lit("R")))
    return dedup.twins(li.filter("l_linenumber = 1"), li.filter("l_linenumber = 2"), ["l_orderkey", "sha"]).select("l_orderkey", "l_partkey")


@query("WITH s AS (SELECT l_orderkey, l_linenumber, string_agg(l_returnflag || l_linestatus, ',' ORDER BY l_returnflag, l_linestatus) AS sig FROM lineitem GROUP BY ALL) SELECT l_orderkey FROM s GROUP BY l_orderkey HAVING count(DISTINCT sig) > 1")
def differing_groups(spark, sf_dir):
    """Orders as reported groups, whose lines no longer agree in their flags."""
    return dedup.differing_groups(read_table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", ["l_returnflag", "l_linestatus"])


def order_files(orders):
    """Orders as files in folders of year, month, day."""
    path = F.concat(F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit("/"), F.col("o_orderkey").cast("string"))
    return orders.select(path.alias("path"), "o_totalprice")


@query("""WITH o AS (SELECT strftime(o_orderdate, '%Y/%m/%d') || '/' || o_orderkey AS path, * FROM orders)
    SELECT path, CASE WHEN o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01' AND o_orderstatus = 'P' THEN 'missing' ELSE 'changed' END AS state FROM o
        WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01' AND o_orderstatus IN ('P', 'F')
    UNION ALL SELECT '2099/01/01/' || o_orderkey, 'new' FROM orders WHERE o_totalprice > 490000""")
def tree_differences(spark, sf_dir):
    """Inventory against the present, by hash trees; only folders that differ are gone into."""
    o = read_table(spark, sf_dir, "orders")
    month = F.date_trunc("month", "o_orderdate") == F.expr("timestamp'1997-03-01'")
    now = o.filter(~(month & (F.col("o_orderstatus") == "P"))).withColumn("o_totalprice", F.when(month & (F.col("o_orderstatus") == "F"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    new = o.filter("o_totalprice > 490000").withColumn("o_orderdate", F.expr("timestamp'2099-01-01'"))
    trees = [hashtree.build(order_files(x), "path", ["o_totalprice"]) for x in (o, now.unionByName(new))]
    return hashtree.differences(*trees)[0]

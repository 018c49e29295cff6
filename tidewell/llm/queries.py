"""Queries of the operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import ann, bpe, convtrie, decontam, divergence, langid, linededup, minhash, simhash, substrdedup, tokencounts, toxicity, urlfilter
from tidewell.llm.common import fold
from tidewell.sources.tables import read_table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    return bpe.digests(read_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated list by rule: a third of the hosts come, go and come again; some paths and a domain are listed too."""
    hosts = read_table(spark, sf_dir, "pages").select(urlfilter.host_of(F.col("url")).alias("h")).dropna().distinct()
    n = F.pmod(F.length("h") * 37 + F.ascii("h"), F.lit(90))
    day = lambda k: F.expr("timestamp'2024-01-01 00:00:00'") + F.make_dt_interval(days=(n + k).cast("int"))
    entry = lambda kind, key, action, since: F.struct(F.lit(kind).alias("kind"), key.alias("key"), F.lit(action).alias("action"), since.alias("since"))
    third = F.filter(F.array(entry("host", F.col("h"), "add", day(0)), entry("host", F.col("h"), "remove", day(60)), entry("host", F.col("h"), "add", day(120))), lambda _: F.pmod(F.length("h") + F.ascii("h"), F.lit(3)) == 0)
    paths = F.filter(F.array(entry("path", F.concat("h", F.lit("/en")), "add", F.expr("timestamp'2024-04-01 00:00:00'"))), lambda _: F.pmod(F.length("h"), F.lit(5)) == 0)
    fixed = "VALUES ('host', 'example.org', 'add', timestamp'2024-06-01'), ('host', 'example.org', 'remove', timestamp'2024-07-01'), ('host', 'spam-farm.example.org', 'add', timestamp'2024-02-01') AS t(kind, key, action, since)"
    return hosts.select(F.inline(F.concat(third, paths))).union(spark.sql(f"SELECT * FROM {fixed}"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries active when it was fetched (a time by rule from the id)."""
    pages = read_table(spark, sf_dir, "pages")
    at = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(cast(page_id * 37 % 366 as int), cast(page_id % 24 as int))")
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return urlfilter.evaluate(pages.withColumn("fetched", at), url_list(spark, sf_dir)).select("page_id", "url", text("fetched"), "blocked", "kind", "key", text("since"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four folds in five."""
    docs = read_table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs)).select("doc_id", (fold("doc_id") == 0).alias("held_out"), "lang_pred", "score")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later occurrences of three-line windows."""
    found = linededup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", F.col("n_lines_").alias("n_lines"), F.col("n_removed_").alias("n_removed"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without passages that occur earlier; spans in characters of the original."""
    return substrdedup.dedup_substrings(read_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every document."""
    return tokencounts.count_tokens(read_table(spark, sf_dir, "documents"), PIECES)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontam.scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every hundredth vector among all others."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter("vec_id % 100 = 0"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of four folds in five."""
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def conversation_nodes(conversations: DataFrame) -> DataFrame:
    """The trie of conversations that each begin as the one whose id is the next lower multiple of five."""
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return convtrie.trie(convtrie.rebuilt(convtrie.turns(conversations), F.col("conv_id") - F.col("conv_id") % 5, taken, 8))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the conversations."""
    found = conversation_nodes(read_table(spark, sf_dir, "conversations"))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source of a language against the others, and the terms that it has more of than its language."""
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document, over two-word shingles."""
    found = minhash.near_duplicates(read_table(spark, sf_dir, "documents"), size=2)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_url_filter, op3_simhash, op4_language_id, op5_line_dedup, op6_substring_dedup, op7_token_counts, op8_decontamination, op9_nearest_neighbours, op10_toxicity, op11_conversation_trie, op12_source_divergence, op13_minhash)}

ORACLES: dict[str, str] = {
    "op2_url_filter": r"""
        WITH u AS (SELECT page_id, url, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(page_id * 37 % 366 AS INTEGER)) + to_hours(CAST(page_id % 24 AS INTEGER)) AS fetched,
                nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.+$', ''), '') AS h,
                list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS seg FROM pages),
            hosts AS (SELECT DISTINCT h, (length(h) * 37 + ascii(h)) % 90 AS n FROM u WHERE h IS NOT NULL),
            entries AS (
                SELECT 'host' AS kind, h AS key, a AS action, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(n + k AS INTEGER)) AS since
                    FROM hosts, (VALUES ('add', 0), ('remove', 60), ('add', 120)) v(a, k) WHERE (length(h) + ascii(h)) % 3 = 0
                UNION ALL SELECT 'path', h || '/en', 'add', TIMESTAMP '2024-04-01 00:00:00' FROM hosts WHERE length(h) % 5 = 0
                UNION ALL VALUES ('host', 'example.org', 'add', TIMESTAMP '2024-06-01 00:00:00'), ('host', 'example.org', 'remove', TIMESTAMP '2024-07-01 00:00:00'), ('host', 'spam-farm.example.org', 'add', TIMESTAMP '2024-02-01 00:00:00')),
            spans AS (SELECT kind, key, action, since, lead(since) OVER (PARTITION BY kind, key ORDER BY since, action) AS until FROM (SELECT DISTINCT * FROM entries)),
            met AS (SELECT u.page_id, s.kind, s.key, s.since, row_number() OVER (PARTITION BY u.page_id ORDER BY s.kind DESC, length(s.key) DESC) AS k
                FROM u JOIN spans s ON s.action = 'add' AND u.fetched >= s.since AND (s.until IS NULL OR u.fetched < s.until)
                    AND ((s.kind = 'host' AND (u.h = s.key OR ends_with(u.h, '.' || s.key)))
                      OR (s.kind = 'path' AND starts_with(u.h || '/' || array_to_string(u.seg, '/') || '/', s.key || '/'))))
        SELECT page_id, url, strftime(fetched, '%Y-%m-%d %H:%M:%S') AS fetched, m.key IS NOT NULL AS blocked, m.kind AS kind, m.key AS key, strftime(m.since, '%Y-%m-%d %H:%M:%S') AS since
        FROM u LEFT JOIN (SELECT * FROM met WHERE k = 1) m USING (page_id)""",
    "op5_line_dedup": r"""
        WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS x FROM documents),
            p AS (SELECT doc_id, x, unnest(range(1, len(x) - 1)) AS i FROM l WHERE len(x) >= 3),
            w AS (SELECT doc_id, i, x[i] AS a, x[i + 1] AS b, x[i + 2] AS c FROM p),
            later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS k
                FROM w WHERE trim(a) <> '' OR trim(b) <> '' OR trim(c) <> '') WHERE k > 1),
            gone AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS p FROM later),
            lines AS (SELECT doc_id, unnest(x) AS line, unnest(range(1, len(x) + 1)) AS p FROM l),
            kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS text, count(*) AS n FROM lines ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT l.doc_id, CASE WHEN l.text IS NOT NULL THEN coalesce(k.text, '') END AS text, CAST(coalesce(len(x), 0) AS BIGINT) AS n_lines,
            CAST(coalesce(len(x), 0) - coalesce(k.n, 0) AS BIGINT) AS n_removed
        FROM l LEFT JOIN kept k ON l.doc_id = k.doc_id""",
    "op8_decontamination": r"""
        WITH low AS (SELECT doc_id, row_number() OVER () AS rid,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
            items AS (SELECT item_id,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
            spread AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0),
            windows AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 9), ' ') AS win, len(list_slice(w, i, i + 9)) AS n FROM spread),
            sizes AS (SELECT DISTINCT n FROM windows),
            starts AS (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM low, sizes WHERE len(w) >= n),
            hits AS (SELECT DISTINCT a.rid, a.i, a.n, a.win FROM (SELECT rid, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win FROM starts) a
                SEMI JOIN windows x ON a.win = x.win),
            covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
            owners AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
                FROM hits JOIN windows USING (win) GROUP BY rid)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM low LEFT JOIN covered USING (rid) LEFT JOIN owners USING (rid)""",
    "op11_conversation_trie": r"""
        WITH RECURSIVE t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
            d AS (SELECT conv_id, turn, strlen(text) AS bytes, sha256(strlen(role)::VARCHAR || ':' || role || text) AS x FROM t),
            c AS (SELECT conv_id, list({'x': x, 'b': bytes} ORDER BY turn NULLS FIRST, x) AS own FROM d GROUP BY conv_id),
            h AS (SELECT conv_id, own, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda u: ascii(u)::BIGINT)),
                lambda a, u: list_reduce(list_prepend(xor(a, u), range(8)), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)) AS crc FROM c),
            b AS (SELECT h.conv_id, coalesce(list_slice(o.own, 1, xor(h.crc, 4294967295) % 9), []) || list_slice(h.own, xor(h.crc, 4294967295) % 9 + 1, len(h.own)) AS seq
                FROM h LEFT JOIN h o ON o.conv_id = h.conv_id - h.conv_id % 5),
            p AS (SELECT conv_id, d, array_to_string(list_transform(list_slice(seq, 1, d), lambda u: u.x), '') AS k, CASE WHEN d > 0 THEN seq[d].b ELSE 0 END AS bytes, d = len(seq) AS ends,
                CASE WHEN d > 0 THEN array_to_string(list_transform(list_slice(seq, 1, d - 1), lambda u: u.x), '') END AS pk
                FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM b)),
            n AS (SELECT d, k, any_value(pk) AS pk, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS own,
                sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends FROM p GROUP BY d, k),
            m AS (SELECT n.*, (SELECT count(*) FROM n c WHERE c.pk = n.k) AS kids FROM n),
            s AS (SELECT a.k, sum(m.own) AS saved, count(*) FILTER (WHERE m.kids = 0) AS leaves FROM m JOIN p a ON a.conv_id = m.conv_id AND a.d <= m.d GROUP BY a.k)
        SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, CAST(m.n_convs AS BIGINT) AS n_convs, CAST(m.kids AS BIGINT) AS n_children,
            CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, m.ends AS ends_sha256
        FROM m JOIN s USING (k) LEFT JOIN n q ON q.k = m.pk""",
    "op12_source_divergence": r"""
        WITH r AS (SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
            w AS (SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM r),
            kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= 30),
            c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
            v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
            g AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang, source FROM r) LEFT JOIN c USING (lang, source) GROUP BY ALL),
            d AS (SELECT lang, source, n + 5 * coalesce(v, 0) AS d, sum(n) OVER (PARTITION BY lang) + 5 * coalesce(v, 0) AS dl FROM g LEFT JOIN v USING (lang)),
            l AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
            p AS (SELECT d.lang, d.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)::HUGEINT) // d.d::HUGEINT AS p,
                1 + (1000000000::HUGEINT * (l.n + 5)::HUGEINT) // d.dl::HUGEINT AS q FROM d JOIN kept k ON k.lang = d.lang LEFT JOIN c ON c.lang = d.lang AND c.source = d.source AND c.term = k.term JOIN l ON l.lang = d.lang AND l.term = k.term),
            s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
            f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM d a JOIN d b ON a.lang = b.lang AND a.source <> b.source
                    LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
                UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(k AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS k FROM f) WHERE part = 'pair' OR k <= 50""",
}

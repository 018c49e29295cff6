"""Queries that run a stream to its end and read what it emitted."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewell.plans.registry import query
from tidewell.session import discard_path, shared_dir
from tidewell.sources.tables import read_table
from tidewell.streaming import sessions, tickets


def event_stream(spark, sf_dir):
    """The events table as a file stream; a folder of its own holds a copy, since a stream source reads folders."""
    events = read_table(spark, sf_dir, "events")
    path = f"{shared_dir(spark)}/tidewell/events-{uuid.uuid4().hex}"
    events.withColumn("ts", F.col("ts").cast("timestamp")).repartitionByRange(4, "ts").write.parquet(path)
    discard_path(spark, path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


@query("WITH b AS (SELECT user_id AS key, epoch_ms(ts) AS ms, event_id, event_type = 'error' AND value > 90 AS f FROM events), e AS (SELECT *, coalesce(sum(CAST(f AS INTEGER)) OVER (PARTITION BY key ORDER BY ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended FROM b) SELECT key, CAST(count(*) FILTER (WHERE ended = 0) AS BIGINT) AS n, CASE WHEN bool_or(f) THEN 'failed' ELSE 'running' END AS status FROM e GROUP BY key")
def live_session_state(spark, sf_dir):
    """ST6 to ST10: the state of each session after all its heartbeats, kept by a stateful stream operator."""
    kind = F.when((F.col("event_type") == "error") & (F.col("value") > 90), "fail").otherwise("beat")
    beats = event_stream(spark, sf_dir).select(F.col("user_id").alias("key"), F.unix_millis("ts").alias("ms"), kind.alias("kind"), "value", F.col("event_id").alias("seq"))
    out = sessions.run_available(spark, sessions.session_states(beats), f"live-{uuid.uuid4().hex}")
    last = out.groupBy("key").agg(F.max(F.struct("epoch", "count", "status")).alias("s"))
    return last.select("key", F.col("s.count").alias("n"), F.col("s.status").alias("status"))


@query("SELECT event_type, strftime(time_bucket(INTERVAL '1 day', ts), '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL")
def daily_counts(spark, sf_dir):
    """ST19: windowed counts under a watermark; the last update of each window counts."""
    counted = sessions.windowed_counts(event_stream(spark, sf_dir), "ts", ["event_type"], "60 days", "1 day")
    out = sessions.run_available(spark, counted.select("event_type", F.date_format("window.start", "yyyy-MM-dd").alias("day"), "n"), f"daily-{uuid.uuid4().hex}")
    return out.groupBy("event_type", "day").agg(F.max("n").alias("n"))


@query("""WITH e AS (SELECT user_id AS k, epoch_us(ts) // 1000 AS ms FROM events), f AS (SELECT *, coalesce(CAST(ms - lag(ms) OVER (PARTITION BY k ORDER BY ms) > 900000 AS INTEGER), 1) AS f FROM e),
    s AS (SELECT *, sum(f) OVER (PARTITION BY k ORDER BY ms RANGE UNBOUNDED PRECEDING) AS i FROM f)
    SELECT k AS user_id, min(ms) AS started, max(ms) AS ended, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY k, i HAVING max(ms) + 900000 < (SELECT max(ms) - 7200000 FROM e)""")
def closed_sessions(spark, sf_dir):
    """ST6, ST15: sessions that 15 idle minutes of event time have ended, by timers and without later events."""
    closed = sessions.closed_sessions(event_stream(spark, sf_dir).select(F.col("user_id").alias("key"), "ts"), "ts", 900_000, "2 hours")
    out = sessions.run_available(spark, closed, f"closed-{uuid.uuid4().hex}", "append")
    return out.select(F.col("key").alias("user_id"), "started", "ended", "n")


@query("""WITH s AS (SELECT user_id AS k, event_id AS i, ts FROM events WHERE event_type = 'signup'), c AS (SELECT user_id AS k, event_id AS i, ts FROM events WHERE event_type = 'purchase'),
    w AS (SELECT least((SELECT max(ts) FROM s), (SELECT max(ts) FROM c)) - INTERVAL 3 HOUR AS wm), p AS (SELECT s.k, s.i AS submitted, c.i AS completed FROM s JOIN c ON s.k = c.k AND c.ts >= s.ts AND c.ts <= s.ts + INTERVAL 6 HOUR)
    SELECT k AS user_id, submitted, completed, 'done' AS outcome FROM p
    UNION ALL SELECT k, i, NULL, CASE WHEN ts + INTERVAL 6 HOUR < wm THEN 'lost' ELSE 'in flight' END FROM s, w WHERE i NOT IN (SELECT submitted FROM p)
    UNION ALL SELECT k, NULL, i, 'late' FROM c, w WHERE ts < wm AND i NOT IN (SELECT completed FROM p)""")
def ticket_fates(spark, sf_dir):
    """ST3, ST4, ST14: done, lost, late and waiting tickets out of a join of two streams."""
    side = lambda rows, kind: rows.filter(F.col("event_type") == kind).select(F.col("user_id").alias("key"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("at"))
    stream = event_stream(spark, sf_dir)
    found = tickets.fates(side(stream, "signup"), side(stream, "purchase"), "6 HOURS", "3 hours")
    out = sessions.run_available(spark, found, f"tickets-{uuid.uuid4().hex}", "append")
    return tickets.with_in_flight(out, side(read_table(spark, sf_dir, "events"), "signup")).withColumnRenamed("key", "user_id")


@query("SELECT f.user_id, f.event_id AS stage, c.event_id AS store FROM events f JOIN events c ON f.user_id = c.user_id AND f.event_type = 'purchase' AND c.event_type = 'error' AND c.ts > f.ts AND c.ts <= f.ts + INTERVAL 5 HOUR")
def reopened_stages(spark, sf_dir):
    """ST14, ST16: stages to do again since their store was completed later, out of a join of two streams."""
    side = lambda rows, kind: rows.filter(F.col("event_type") == kind).select(F.col("user_id").alias("key"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("at"))
    stream = event_stream(spark, sf_dir)
    found = tickets.reopened(side(stream, "purchase"), side(stream, "error"), "5 HOURS", "1 hour")
    out = sessions.run_available(spark, found, f"reopened-{uuid.uuid4().hex}", "append")
    return out.select(F.col("key").alias("user_id"), F.col("id").alias("stage"), F.col("completed").alias("store"))

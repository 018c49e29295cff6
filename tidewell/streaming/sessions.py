"""Live following: sessions kept by a stateful processor with timers, and windowed counts (watch passes: ``watch``)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewell.session import discard_path, shared_dir, ship_code

#: A live session is forgotten that long after it was first seen, by the clock of the workers; that it ended or was
#: forgotten is remembered that long (milliseconds).
FORGET_MS, REMEMBER_MS = 3_600_000, 7 * 86_400_000
LIVE = "first_seen long, last_seen long, count long, total double, seen_at long"
ENDED = "status string"
OUTPUT = "key long, first_seen long, last_seen long, count long, status string"
OPEN = "started long, ended long, n long"
CLOSED = "key long, started long, ended long, n long"
#: State of timers, TTL and lists needs this store.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _until_end(batches: Iterator[pd.DataFrame]) -> tuple[int | None, int | None, int, float, str | None]:
    """First and last time of one key's rows, how many rows come up to its first ending event and their sum, and that
    event's kind. Rows come in chunks of any order, so the end is known after the last one; until then each chunk
    leaves 24 bytes for a row that isn't yet known to follow an end."""
    first = last = end = kind_at_end = None
    kept: list[np.ndarray] = []
    for pdf in batches:
        if not len(pdf):
            continue
        ms = pdf["ms"].to_numpy(np.int64)
        seq = pdf["seq"].to_numpy(np.int64)
        first, last = int(ms.min()) if first is None else min(first, int(ms.min())), int(ms.max()) if last is None else max(last, int(ms.max()))
        rows = np.empty(len(pdf), [("ms", np.int64), ("seq", np.int64), ("value", np.float64)])
        rows["ms"], rows["seq"], rows["value"] = ms, seq, np.nan_to_num(pdf["value"].to_numpy(np.float64, na_value=np.nan))
        kept.append(rows)
        ends = pdf["kind"].isin(["finish", "fail"]).to_numpy()
        for at, kind in sorted(zip(zip(ms[ends].tolist(), seq[ends].tolist()), pdf["kind"].to_numpy()[ends]))[:1]:
            if end is None or (at, kind) < (end, kind_at_end):
                end, kind_at_end = at, kind
                kept = [x[(x["ms"] < at[0]) | ((x["ms"] == at[0]) & (x["seq"] <= at[1]))] for x in kept]
        if end is not None:
            x = kept[-1]
            kept[-1] = x[(x["ms"] < end[0]) | ((x["ms"] == end[0]) & (x["seq"] <= end[1]))]
    return first, last, sum(map(len, kept)), float(sum(x["value"].sum() for x in kept)), kind_at_end


class LiveSession(StatefulProcessor):
    """One key's heartbeats: counts are emitted when they change; ``finish`` events end a session, ``fail`` events end
    it as failed. A session that still runs ``forget_ms`` after it was first seen is forgotten by a timer, whatever
    came since. After either its counts go; that it is over stays for ``remember_ms``, so that nothing re-opens it,
    and then goes too, so state follows the live and the recently ended sessions."""

    def __init__(self, forget_ms: int = FORGET_MS, remember_ms: int = REMEMBER_MS):
        self.forget_ms, self.remember_ms = forget_ms, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.live = handle.getValueState("live", LIVE)
        self.ended = handle.getValueState("ended", ENDED, self.remember_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.ended.exists():
            return
        low, high, n, value, kind = _until_end(rows)
        if low is None:
            return
        now = timerValues.getCurrentProcessingTimeInMs()
        first, last, count, total, seen_at = self.live.get() if self.live.exists() else (low, high, 0, 0.0, now)
        before, status = count, {"finish": "complete", "fail": "failed"}.get(kind, "running")
        first, last, count, total = min(first, low), max(last, high), count + n, total + value
        if status != "running":
            self._end(status)
        else:
            if count == n:
                self.handle.registerTimer(now + self.forget_ms)
            self.live.update((first, last, count, total, seen_at))
        if count != before or status != "running":
            yield _row(OUTPUT, key[0], first, last, count, status)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.live.exists():
            first, last, count, _, _ = self.live.get()
            self._end("forgotten")
            yield _row(OUTPUT, key[0], first, last, count, "forgotten")

    def _end(self, status: str) -> None:
        self.ended.update((status,))
        if self.live.exists():
            self.live.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def close(self) -> None:
        pass


class IdleSession(StatefulProcessor):
    """One key's sessions by event time: events at most ``gap_ms`` apart are one. Open sessions are a list, since events
    may come late within the watermark and join two of them; a timer at the first one's end closes all that the watermark
    has passed by then, without any later event of the key, and they leave the state; the next timer stands at the first
    end that is left. So a key has one timer, however many sessions are open."""

    def __init__(self, gap_ms: int):
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", OPEN)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        spans = [tuple(map(int, s)) for s in self.open.get()]
        for pdf in rows:
            ms = np.sort(pdf["ms"].to_numpy(np.int64))
            cuts = np.flatnonzero(np.diff(ms) > self.gap_ms) + 1
            spans = merged([*spans, *((int(x[0]), int(x[-1]), x.size) for x in np.split(ms, cuts) if x.size)], self.gap_ms)
        self._keep(spans)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        spans = [tuple(map(int, s)) for s in self.open.get()]
        over = [s for s in spans if s[1] + self.gap_ms < now]
        self._keep([s for s in spans if s[1] + self.gap_ms >= now])
        if over:
            yield pd.DataFrame([(key[0], *s) for s in over], columns=[c.split()[0] for c in CLOSED.split(", ")])

    def _keep(self, spans: list[tuple[int, int, int]]) -> None:
        if spans:
            self.open.put(spans)
        elif self.open.exists():
            self.open.clear()
        due = min((e for _, e, _ in spans), default=None)
        known = list(self.handle.listTimers())
        at = None if due is None else due + self.gap_ms + 1
        for timer in known:
            if timer != at:
                self.handle.deleteTimer(timer)
        if at is not None and at not in known:
            self.handle.registerTimer(at)

    def close(self) -> None:
        pass


def merged(spans: list[tuple[int, int, int]], gap_ms: int) -> list[tuple[int, int, int]]:
    """Spans (start, end, n) at most ``gap_ms`` apart made one, in order."""
    out: list[tuple[int, int, int]] = []
    for s, e, n in sorted(spans):
        if out and s - out[-1][1] <= gap_ms:
            out[-1] = (out[-1][0], max(out[-1][1], e), out[-1][2] + n)
        else:
            out.append((s, e, n))
    return out


def _row(schema: str, *values) -> pd.DataFrame:
    return pd.DataFrame([values], columns=[c.split()[0] for c in schema.split(", ")])


def session_states(beats: DataFrame, forget_ms: int = FORGET_MS, remember_ms: int = REMEMBER_MS) -> DataFrame:
    """``beats``: a stream with ``key long, ms long, kind string, value double`` and, where times can tie, ``seq long``
    that orders beats of one time. Emits a key's state on change. Rows of null key are left out."""
    ship_code(beats.sparkSession)
    seq = F.col("seq").cast("long") if "seq" in beats.columns else F.lit(0).cast("long")
    rows = beats.filter("key is not null").withColumn("seq", F.coalesce(seq, F.lit(0).cast("long")))
    return rows.groupBy("key").transformWithStateInPandas(LiveSession(forget_ms, remember_ms), OUTPUT, "Update", "ProcessingTime")


def closed_sessions(events: DataFrame, ts: str, gap_ms: int, late: str) -> DataFrame:
    """``events``: a stream with ``key long`` and a timestamp. Emits ``key``, ``started``, ``ended`` (milliseconds) and
    ``n`` of each session once the watermark (``late`` behind the latest event) has passed its end by the gap. Rows of
    null key or time are left out; rows behind the watermark are late and left out by it."""
    ship_code(events.sparkSession)
    rows = events.filter(F.col("key").isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, late).select("key", ts, F.unix_millis(ts).alias("ms"))
    return rows.groupBy("key").transformWithStateInPandas(IdleSession(gap_ms), CLOSED, "Append", "EventTime")


def start_available(stream: DataFrame, base: str, mode: str = "update", idle_batches: bool | None = None):
    """Start draining what is there now into ``base``/out, by batch; a restart goes on from ``base``/checkpoint."""
    spark = stream.sparkSession

    def sink(df: DataFrame, epoch: int) -> None:
        df.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{base}/out/epoch={epoch:09d}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).foreachBatch(sink)
    settings = {"spark.sql.streaming.noDataMicroBatches.enabled": str(mode != "update" if idle_batches is None else idle_batches).lower(), STORE[0]: STORE[1]}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return writer.start()  # takes a copy of the session's settings
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_available(spark: SparkSession, stream: DataFrame, name: str, mode: str = "update", idle_batches: bool | None = None) -> DataFrame:
    """Drain what is there now (a restart goes on from the checkpoint) and return all that was emitted, by batch.

    In update mode there are no batches without data: with processing-time timers they would never end. Timers that
    are due then fire along with the next data. What was emitted and the checkpoint go when the driver's JVM ends."""
    base = f"{shared_dir(spark)}/tidewell/stream-{name}"
    query = start_available(stream, base, mode, idle_batches)
    query.awaitTermination()
    discard_path(spark, base)
    schema = T.StructType([*stream.schema.fields, T.StructField("epoch", T.IntegerType())])
    out = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{base}/out")
    out._tidewell_progress = query.recentProgress
    return out


def windowed_counts(events: DataFrame, ts: str, keys: list[str], late: str, size: str, slide: str | None = None) -> DataFrame:
    """Counts and sums by event-time window and keys under a watermark."""
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return rows.groupBy(F.window("_ts", size, slide), *keys).agg(F.count(F.lit(1)).alias("n"))

"""Stateful sessions and joined streams: chunks of any order, timers, restarts, and what stays in the state."""

import random
import uuid
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest

from tidewell.streaming import sessions, tickets


def beats(rows):
    return pd.DataFrame(rows, columns=["ms", "seq", "kind", "value"])


def test_end_is_found_over_all_chunks():
    rows = [(t // 2, t, "fail" if t in (61, 90) else "beat", 1.0 if t % 3 else None) for t in range(100)]
    for size in (1, 7, 100):
        for seed in range(5):
            random.Random(seed).shuffle(rows)
            got = sessions._until_end(beats(rows[i : i + size]) for i in range(0, 100, size))
            assert got == (0, 49, 62, sum(1.0 for t in range(62) if t % 3), "fail")


def test_spans_merge():
    assert sessions.merged([(10, 12, 2), (0, 3, 1), (5, 7, 4)], 2) == [(0, 7, 5), (10, 12, 2)]
    assert sessions.merged([(0, 9, 1), (2, 3, 1)], 0) == [(0, 9, 2)] and sessions.merged([], 1) == []


class Feed:
    """A folder that a stream reads, one file for each call."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema = spark, str(folder), schema

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.folder)


def rows_in_state(out):
    return sum(s["numRowsTotal"] for s in out._tidewell_progress[-1]["stateOperators"])


def test_forgotten_by_a_timer_and_remembered_for_a_while(spark, tmp_path):
    feed, name = Feed(spark, tmp_path / "in", "key long, ms long, kind string, value double"), uuid.uuid4().hex
    feed.add([(k, 1, "beat", 1.0) for k in range(5)] + [(7, 5, "finish", 1.0), (None, 1, "beat", 1.0)])
    run = lambda: sessions.run_available(spark, sessions.session_states(feed.stream(), 1, 1), name)
    assert sorted((r.key, r["count"], r.status) for r in run().collect()) == [*((k, 1, "running") for k in range(5)), (7, 1, "complete")]
    feed.add([(9, 3, "beat", 1.0)])
    out = run()
    assert sorted((r.key, r.status) for r in out.filter("epoch = 1").collect()) == [*((k, "forgotten") for k in range(5)), (9, "running")]
    feed.add([(7, 9, "beat", 1.0)])  # its end is no longer remembered
    assert [(r.key, r["count"], r.status) for r in run().filter("epoch = 2 and key = 7").collect()] == [(7, 1, "running")]


def test_an_end_is_remembered(spark, tmp_path):
    feed, name = Feed(spark, tmp_path / "in", "key long, ms long, kind string, value double"), uuid.uuid4().hex
    for rows in ([(1, 1, "beat", 1.0), (1, 2, "fail", 1.0)], [(1, 0, "beat", 1.0), (2, 1, "beat", 1.0)], [(2, 2, "beat", 1.0)]):
        feed.add(rows)
        out = sessions.run_available(spark, sessions.session_states(feed.stream()), name)
    assert sorted((r.epoch, r.key, r["count"], r.status) for r in out.collect()) == [(0, 1, 2, "failed"), (1, 2, 1, "running"), (2, 2, 2, "running")]


def at(minutes):
    return datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(minutes=minutes)


def test_sessions_close_without_later_events_and_leave_the_state(spark, tmp_path):
    feed, name = Feed(spark, tmp_path / "in", "key long, ts timestamp"), uuid.uuid4().hex
    run = lambda: sessions.run_available(spark, sessions.closed_sessions(feed.stream(), "ts", 600_000, "30 minutes"), name, "append")
    feed.add([(1, at(0)), (1, at(9)), (2, at(30)), (None, at(1)), (3, at(60))])
    assert [(r.key, r.n) for r in run().collect()] == [(1, 2)]  # the watermark stands at 30
    feed.add([(2, at(37)), (2, at(45)), (3, at(50)), (3, at(70)), (1, at(2))])  # 2 joins over what came, 3 joins before; 1 is late
    assert sorted((r.key, r.n) for r in run().collect()) == [(1, 2)]
    feed.add([(4, at(1000))])
    out = run()
    minutes = lambda ms: (ms - at(0).timestamp() * 1000) / 60_000
    got = sorted((r.key, minutes(r.started), minutes(r.ended), r.n) for r in out.collect())
    assert got == [(1, 0, 9, 2), (2, 30, 45, 3), (3, 50, 70, 3)]
    few = rows_in_state(out)
    for k in range(5):
        feed.add([(100 * k + i, at(2000 + 1000 * k)) for i in range(10, 40)])
        out = run()
    assert out.count() == 4 + 30 * 4 and rows_in_state(out) <= 30 * max(1, few)  # what is closed has left


def test_tickets_over_a_restart(spark, tmp_path):
    """A submission and its completion in different runs still meet; lost and late ones come out once nothing can follow."""
    schema = "key long, id long, at timestamp"
    s, c, name = Feed(spark, tmp_path / "s", schema), Feed(spark, tmp_path / "c", schema), uuid.uuid4().hex
    run = lambda: sessions.run_available(spark, tickets.fates(s.stream(), c.stream(), "60 MINUTES", "10 minutes"), name, "append")
    s.add([(1, 1, at(0)), (2, 2, at(5)), (3, 3, at(55)), (None, 99, at(5))])
    c.add([(1, 11, at(30)), (9, 19, at(31))])
    assert sorted(tuple(r)[:4] for r in run().collect()) == [(1, 1, 11, "done")]
    s.add([(4, 4, at(200))])
    c.add([(3, 13, at(70)), (4, 14, at(300))])
    got = run()
    rows = {tuple(r)[:4] for r in got.collect()}
    assert rows == {(1, 1, 11, "done"), (2, 2, None, "lost"), (3, 3, 13, "done"), (9, None, 19, "late")}
    table = spark.read.parquet(str(tmp_path / "s"))
    assert (4, 4, None, "in flight") in {tuple(r) for r in tickets.with_in_flight(got, table).collect()}


@pytest.mark.parametrize("rows", [32, 256, 10_000])
def test_batches_of_any_size(spark, sf, rows):
    from tests.oracle import same
    from tidewell.plans import registry

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        same(registry.QUERIES["live_session_state"](spark, sf), registry.ORACLES["live_session_state"], sf)
    finally:
        spark.conf.set(key, before)


def test_a_key_of_many_open_sessions_has_one_timer():
    class State(list):
        def get(self):
            return iter(self)

        def put(self, spans):
            self[:] = spans

        def exists(self):
            return bool(self)

    class Handle:
        def __init__(self):
            self.timers = []

        def getListState(self, *_):
            return State()

        def listTimers(self):
            return iter(list(self.timers))

        def registerTimer(self, at):
            self.timers.append(at)

        def deleteTimer(self, at):
            self.timers.remove(at)

    class Now:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):
            return self.ms

    keeper, handle = sessions.IdleSession(10), Handle()
    keeper.init(handle)
    list(keeper.handleInputRows((1,), iter([pd.DataFrame({"ms": [100 * k for k in range(50)]})]), Now(0)))
    assert handle.timers == [11]
    out = list(keeper.handleExpiredTimer((1,), Now(2000), None))
    assert len(out) == 1 and out[0]["started"].tolist() == [100 * k for k in range(20)] and set(out[0]["n"]) == {1} and handle.timers == [2011]
    assert len(list(keeper.handleExpiredTimer((1,), Now(9999), None))[0]) == 30 and not handle.timers

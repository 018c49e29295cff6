"""Open-schema triage tables, session documents as a stream, re-opened stages, records and bounds."""

import json
import uuid
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidewell.operators import completeness, decisions
from tidewell.sources import files
from tidewell.streaming import sessions, tickets


def test_auto_triage_of_any_age(spark, tmp_path):
    path = str(tmp_path / "auto")
    assert files.auto_triage(spark, path).collect() == []
    spark.createDataFrame([("a", "keep", 1), ("b", "delete", 1), (None, "x", 9)], "dataset_key string, label string, at int").write.parquet(path)
    spark.createDataFrame([("b", "keep", 2, 0.5)], "dataset_key string, label string, at int, score double").write.mode("append").parquet(path)
    got = {r.dataset_key: (r.label, r["at"], r.score) for r in files.auto_triage(spark, path, order="at").collect()}
    assert got == {"a": ("keep", 1, None), "b": ("keep", 2, 0.5)}
    assert files.auto_triage(spark, path).count() == 2


def test_sessions_as_a_stream(spark, tmp_path):
    folder = tmp_path / "docs"
    folder.mkdir()
    put = lambda name, text: (folder / name).write_text(text)
    put("1.json", json.dumps({"session_id": "s1", "state": "running",
                              "n_t": 3}, indent=1))
    put("2.json", "{broken")
    put("3.json", "[1, 2]")
    put("4.json", json.dumps({"state": "no id"}))
    name = uuid.uuid4().hex
    run = lambda: sessions.run_available(spark, files.session_stream(spark, str(folder)).select("session_id", "state", "n_t"), name, "append")
    assert [(r.session_id, r.state, r.n_t) for r in run().collect()] == [("s1", "running", 3)]
    put("5.json", json.dumps({"session_id": "s1", "state": "complete"}))
    assert [(r.state, r.epoch) for r in run().orderBy("epoch").collect()] == [("running", 0), ("complete", 1)]


def test_reopened_over_a_restart(spark, tmp_path):
    at = lambda m: datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(minutes=m)
    schema, name = "key long, id long, at timestamp", uuid.uuid4().hex
    add = lambda side, rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / side))
    stream = lambda side: spark.readStream.schema(schema).parquet(str(tmp_path / side))
    run = lambda: sessions.run_available(spark, tickets.reopened(stream("f"), stream("c"), "60 MINUTES", "30 minutes"), name, "append")
    add("f", [(1, 1, at(10)), (2, 2, at(10)), (None, 9, at(1))])
    add("c", [(1, 11, at(5)), (3, 13, at(20))])
    assert run().count() == 0
    add("c", [(1, 12, at(40)), (2, 14, at(71))])
    add("f", [(3, 3, at(15))])
    assert sorted((r.key, r.id, r.completed) for r in run().collect()) == [(1, 1, 12), (3, 3, 13)]


def test_record_of_a_readable_master(spark):
    rows = [("a", 0, "a0", False, 25), ("a", 1, "a1", True, 10), ("a", 2, "a2", False, 10), ("b", 0, "b0", None, 7), ("c", 0, "c0", True, 9)]
    df = spark.createDataFrame(rows, "k string, s int, n string, bad boolean, p int")
    got = {r.k: (r.path, r.actual_timepoints, r.excluded) for r in completeness.readable_master(df, "k", "s", "n", F.col("bad"), "p", 10).collect()}
    assert got == {"a": ("a0", 2, ["a1", "a2"]), "b": ("b0", None, []), "c": (None, 0, ["c0"])}


def test_three_layouts_and_a_bound(spark, monkeypatch):
    cases = [(False, None, "/s/x/DSR/f"), (None, 4, "/s/x/DSR/f"), (True, None, "/s/x/Decon_v/DSR/f"), (True, 0, "/s/x/Decon_v/DSR/f"), (True, 4, "/s/pad4_v/Decon_v/DSR/f")]
    df = spark.createDataFrame([(i, d, p) for i, (d, p, _) in enumerate(cases)], "i int, d boolean, p int")
    path = decisions.variant_path(F.lit("/s/x"), F.lit("v"), F.lit("f"), F.col("d"), F.col("p"))
    assert [r[0] for r in df.orderBy("i").select(path).collect()] == [want for _, _, want in cases]
    monkeypatch.setattr(decisions, "MAX_SUMMARY", 4)
    with pytest.raises(ValueError):
        decisions.document({"cases": df})

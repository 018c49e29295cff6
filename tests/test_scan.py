"""Segmented scans against plain ones; a hot key spans tasks; percentiles whatever the spread of values."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators import arrays, completeness, lifecycle
from tidewell.operators.scan import RANGE, ranged, scan


@pytest.mark.parametrize("hot", [0.0, 0.9])
def test_scan_equals_one_pass(spark, hot):
    rng = random.Random(7)
    rows = [(None if rng.random() < 0.02 else 1 if rng.random() < hot else rng.randrange(6), i, rng.choice([None, 1, 2, 5, -3])) for i in range(3000)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "k int, i int, v int")
    got = scan(df, ["k"], ["i"], s=("sum", F.col("v")), lo=("min", F.col("v")), hi=("max", F.col("v")), b=("before", F.col("v")))
    state, want = {}, []
    for k, i, v in rows:
        s, lo, hi, b = state.get(k, (None, None, None, None))
        if v is not None:
            s, lo, hi = (s or 0) + v, v if lo is None else min(lo, v), v if hi is None else max(hi, v)
        want.append((k, i, v, s, lo, hi, b))
        state[k] = s, lo, hi, (v,)
    assert sorted(((r.k, r.i, r.v, r.s, r.lo, r.hi, None if r.b is None else (r.b.v,)) for r in got.collect()), key=lambda r: r[1]) == want


def test_a_hot_key_spans_tasks(spark):
    """One key holds 90 % of the rows: no task of the scan has over twice the mean."""
    df = spark.range(40_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("k"), "id")
    out = scan(df, ["k"], ["id"], n=("sum", F.lit(1)))
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 2 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in plan.split("Window")[0] and out.filter("k = -1").agg(F.max("n")).first()[0] == 36_000
    assert ranged(df, ["k"], ["id"]).filter("k = -1").select(RANGE).distinct().count() > 2


def test_ordered_operators(spark):
    rng = random.Random(2)
    rows = [(0 if rng.random() < 0.8 else rng.randrange(5), t, rng.choice("aab"), rng.random() < 0.6) for t in range(800)]
    df = spark.createDataFrame(rng.sample(rows, 800), "k int, t int, v string, f boolean")
    longest, run, last, changed = {}, {}, {}, []
    for k, t, v, f in rows:
        run[k] = run.get(k, 0) + 1 if f else 0
        longest[k] = max(longest.get(k, 0), run[k])
        if last.get(k) != v:
            changed.append((k, t))
        last[k] = v
    assert {r.k: r.longest for r in lifecycle.longest_failure_run(df, "k", ["t"], F.col("f")).collect()} == longest
    found = lifecycle.changes(df, "k", ["t"], "v")
    assert sorted((r.k, r.t) for r in found.collect()) == sorted(changed) and found.columns == df.columns
    good = {}
    for k, t, _, f in rows:
        if t > 50 and rng.random() < 0:
            break
        good.setdefault(k, [0, True])
        good[k][1] = good[k][1] and not (t > 300 and f)
        good[k][0] += good[k][1]
    lead = completeness.readable_prefix(df, "k", "t", (F.col("t") > 300) & F.col("f"), "t", 10)
    assert {r.k: r.n_good for r in lead.collect()} == {k: n for k, (n, _) in good.items()}
    times = df.select("k", F.timestamp_seconds(F.col("t") * F.when(F.col("t") > 400, 50).otherwise(1)).alias("ts"))
    ends = {}
    for k, t, *_ in rows:
        s = t * 50 if t > 400 else t
        if k not in ends or s - ends[k][-1][1] > 60:
            ends.setdefault(k, []).append([s, s, 0])
        ends[k][-1][1], ends[k][-1][2] = s, ends[k][-1][2] + 1
    got = lifecycle.idle_sessions(times, "k", "ts", 60).select("k", F.unix_timestamp("started").alias("a"), F.unix_timestamp("ended").alias("z"), "n")
    assert sorted(tuple(r) for r in got.collect()) == sorted((k, *s) for k, x in ends.items() for s in x)


def test_percentiles_with_an_outlier_and_null_groups(spark):
    """All values but one lie in a narrow band; no range holds most of them."""
    df = spark.range(20_000).select(F.when(F.col("id") < 19_990, F.lit("a")).alias("g"), F.when(F.col("id") == 5, 1e12).otherwise(F.col("id") / 1e6).alias("v"))
    got = {r.g: r._q for r in arrays.percentiles(df, ["g"], "v", [0.01, 0.5, 0.999]).collect()}
    for g, values in (("a", [1e12 if i == 5 else i / 1e6 for i in range(19_990)]), (None, [i / 1e6 for i in range(19_990, 20_000)])):
        assert np.allclose(got[g], np.quantile(values, [0.01, 0.5, 0.999]), rtol=1e-12)
    parts = [r["count"] for r in ranged(df, ["g"], ["v"]).groupBy(RANGE).count().collect()]
    assert max(parts) <= 2 * sum(parts) / len(parts)


def test_stretch_keeps_every_row(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (None, 5.0), ("a", 2.0), ("a", 2.0), ("b", None), ("c", None), ("c", 1.0), ("c", 2.0)], "g string, v double")
    got = sorted(((r.g or "", r.v or -1.0, r.level) for r in arrays.percentile_stretch(df, ["g"], "v", 0.0, 1.0).collect()))
    assert got == [("", 1.0, 0), ("", 3.0, 127), ("", 5.0, 255), ("a", 2.0, 0), ("a", 2.0, 0), ("b", -1.0, 0), ("c", -1.0, 0), ("c", 1.0, 0), ("c", 2.0, 255)]


def test_grid_has_a_bound(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (3, None)], "k int, v string")
    side = spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    got = sorted((r.k, r.v) for r in completeness.grid_missing(df, "k", "v", side).collect())
    assert got == [(1, "b"), (1, "c"), (2, "a"), (2, "c"), (3, "a"), (3, "b"), (3, "c")]
    monkeypatch.setattr(completeness, "MAX_SIDE", 2)
    with pytest.raises(ValueError):
        completeness.grid_missing(df, "k", "v", side)

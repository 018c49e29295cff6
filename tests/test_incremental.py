"""Results after batches of changes against full runs; figures of one pass."""

import random

from pyspark.sql import functions as F

from tidewell.operators import figures, graph, incremental, inventory


def test_components_after_random_batches(spark):
    rng = random.Random(6)
    pair = lambda: tuple(sorted(rng.sample(range(60), 2)))
    frame = lambda e: spark.createDataFrame(sorted(e), "u long, v long")
    have = {pair() for _ in range(25)}
    labels, edges = graph.components(frame(have)), frame(have)
    for _ in range(10):
        added, removed = {pair() for _ in range(rng.randrange(6))}, set(rng.sample(sorted(have), min(len(have), rng.randrange(6)))) | {pair()}
        have = (have - removed) | added
        labels, edges = incremental.updated_components(labels, edges, frame(added), frame(removed))
        assert {tuple(r) for r in edges.collect()} == have
        want = {r.node: r.label for r in graph.components(frame(have)).collect()}
        got = labels.collect()
        assert {r.node: r.label for r in got} == want and len(got) == len(want)


def test_rollup_after_random_batches(spark):
    rng = random.Random(3)
    row = lambda: (rng.choice(["a", "b", None]), rng.choice("xy"), rng.randrange(100), rng.randrange(50))
    frame = lambda rows: spark.createDataFrame(rows, "d string, u string, size long, t long")
    full = lambda rows: inventory.unit_rollup(frame(rows), ["d", "u"], "size", "t")
    rows = [row() for _ in range(12)]
    now = full(rows)
    for _ in range(5):
        rng.shuffle(rows)
        removed, rows, added = rows[:7], rows[7:], [row() for _ in range(rng.randrange(8))]
        rows += added
        now = incremental.updated_rollup(now, frame(rows), ["d", "u"], "size", "t", frame(added), frame(removed))
        key = lambda df: sorted((str(r.d), r.u, r.bytes, r.nfiles, r.newest) for r in df.collect())
        assert key(now) == key(full(rows))


def test_summaries_and_observed_figures(spark, tmp_path):
    rows = [("a", "x", 1), ("a", None, 2), ("b", "x", 3), (None, "y", 4)]
    df = spark.createDataFrame(rows, "p string, q string, n int")
    got = {(r.summary, r.p, r.q): (r.n_rows, r.total) for r in figures.summaries(df, {"all": [], "p": ["p"], "q": ["q"], "both": ["p", "q"]}, n_rows=F.count(F.lit(1)), total=F.sum("n")).collect()}
    assert got == {("all", None, None): (4, 10), ("p", "a", None): (2, 3), ("p", "b", None): (1, 3), ("p", None, None): (1, 4), ("q", None, "x"): (2, 4), ("q", None, None): (1, 2), ("q", None, "y"): (1, 4), **{("both", p, q): (1, n) for p, q, n in rows}}
    plan = figures.summaries(df, {"all": [], "p": ["p"]}, n=F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    out, seen = figures.observed(df, n=F.count(F.lit(1)), top=F.max("n"))
    out.write.parquet(str(tmp_path / "o"))
    assert seen.get == {"n": 4, "top": 4}

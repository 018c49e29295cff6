"""Deadlines, late data, and a whole pass over small tables."""

from tidewell.streaming import watch


def test_a_pass(spark):
    df = spark.createDataFrame
    found = df([(k, "precropped" if k == "p" else "tiff") for k in "abcdefp"], "key string, kind string")
    registered = df([("a", "dud"), ("b", "ok"), ("c", "ok"), ("d", None), ("e", "ok"), ("p", "ok")], "key string, flag string")
    stages = df([("a", "roi_detect", "done"), ("b", "deskew", "pending"), ("c", "deskew", "pending"), ("d", "deskew", "done"), ("e", "mip_encode", "done")], "key string, stage string, status string")
    tickets = df([("b", "done"), ("c", "lost"), ("p", "in flight")], "key string, outcome string")
    failures = df([("e", 3), ("a", 2)], "key string, n int")
    plan = watch.plan_pass(found, registered, stages, tickets, failures, {"ok": 0, "unknown": 1, "dud": 2}, 3, 3)
    keys = lambda name: sorted(r.key for r in plan[name].collect())
    assert keys("register") == ["f"] and keys("dropped") == ["e"] and keys("triage") == ["b", "c", "d", "f"]
    assert sorted(tuple(r) for r in plan["collect"].collect()) == [("b", "done", "done"), ("c", "lost", "pending")]
    assert keys("submit") == ["c", "f"]  # two of three are free; c is ok, f unknown, a dud
    assert keys("finish") == ["b", "d"]
    after = watch.commit_pass(stages, plan)
    rows = sorted(tuple(r) for r in after.collect())
    assert ("b", "deskew", "done") in rows and ("f", "deskew", "pending") in rows and len(rows) == 6
    assert sorted(tuple(r) for r in watch.commit_pass(after, plan).collect()) == rows


def test_deadlines_late_data_and_sessions(spark):
    df = spark.createDataFrame
    t = df([(1, 0.0, 50.0), (2, 0.0, 150.0), (3, 80.0, None), (4, 10.0, None)], "k int, s double, f double")
    assert {r.k: r.state for r in watch.timed_out(t, "s", "f", 150.0, 100.0).collect()} == {1: "done", 2: "timed out", 3: "running", 4: "timed out"}
    stages = df([("a", "deskew", "done", 10), ("a", "mip_encode", "done", 12), ("a", "crop", "done", 1), ("b", "deskew", "done", 10), ("b", "mip_encode", "done", 11), ("c", "deskew", "failed", 5)], "k string, stage string, status string, finished_at int")
    done = df([("a", 11), ("b", 10), ("c", 99)], "k string, completed_at int")
    got = sorted(tuple(r) for r in watch.late_data(stages, done, "k", "deskew", ["mip_encode"]).collect())
    assert got == [("a", "crop", "done", 1), ("a", "deskew", "pending", None), ("b", "deskew", "done", 10), ("b", "mip_encode", "done", 11), ("c", "deskew", "failed", 5)]
    s = df([("1", "/r/x/cell_dsr.ome.zarr", ["m", "g"]), ("2", "/other/cell_dsr.ome.zarr", []), ("3", None, None), ("4", "/r/cell.zarr", [])], "session_id string, store string, channel_labels array<string>")
    assert [(r.session_id, r.leaf, r.root, r.raw) for r in watch.session_dataset(s, ["/q", "/r"]).collect()] == [("1", "/r/x/cell", "/r", ["/r/x/cell_g.ome.zarr", "/r/x/cell_m.ome.zarr"])]

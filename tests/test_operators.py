"""Small cases with literal results: rules one by one, odd rows, sources and sinks."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell import functions as fn
from tidewell.operators import arrays, completeness, dedup, graph, inventory, lifecycle, rules
from tidewell.session import materialise
from tidewell.sources import files, listing, sinks

NOW = datetime(2026, 11, 1)


@pytest.mark.parametrize(
    "path,cls,unit",
    [
        ("a.ome.tif", "raw", "a.ome.tif"), ("b_metadata.txt", "raw", "b_metadata.txt"), ("x.JSON", "provenance", "x.JSON"), ("x.bin", "unknown", "x.bin"), ("decon_qc/q.png", "provenance", "decon_qc"),
        ("viewer/s_dsr.ome.zarr/0", "viewer_export", "viewer"), ("viewer/s.png", "provenance", "viewer"), ("processed_ngff/MIPs/a.tif", "provenance", "processed_ngff"),
        ("decon_stage/a_T000.tif", "intermediate", "decon_stage/*"), ("decon_stage/run/log.txt", "provenance", "decon_stage/run"), ("zarr_mirror/Decon/x.tif", "intermediate", "zarr_mirror/Decon/*"),
        ("other/x", "unknown", "other"), ("fin/out/x", "final", "fin"), ("finish/out/x", "unknown", "finish"),
    ],
)
def test_classes_and_units(spark, path, cls, unit):
    p = inventory.parts_of(F.lit(path))
    row = spark.range(1).select(inventory.classify(p, F.array(F.lit("fin"), F.lit("out"))).alias("c"), inventory.unit_of(p).alias("u")).first()
    assert (row.c, row.u) == (cls, unit)


def fact(**over):
    base = dict(status="done", signal_flag="ok", discovered_at=NOW - timedelta(days=30), reprocessed_at=None, label=None, label_source=None, label_at=None, siblings=[], protected=[], auto_label=None, auto_reason=None, name="cell_1")
    return base | over


SCHEMA = "status string, signal_flag string, discovered_at timestamp, reprocessed_at timestamp, label string, label_source string, label_at timestamp, siblings array<string>, protected array<string>, auto_label string, auto_reason string, name string"


@pytest.mark.parametrize(
    "over,rule,action",
    [
        ({}, "K0", "KEEP"), ({"status": "running", "label": "delete"}, "P2", "KEEP"), ({"discovered_at": NOW - timedelta(days=13)}, "P2", "KEEP"), ({"discovered_at": NOW - timedelta(days=14)}, "K0", "KEEP"),
        ({"discovered_at": None}, "K0", "KEEP"), ({"protected": ["pinned"]}, "P1", "KEEP"), ({"label": "keep"}, "P1", "KEEP"), ({"siblings": ["keep"]}, "P1", "KEEP"), ({"siblings": None}, "K0", "KEEP"),
        ({"protected": ["pinned"], "label": "delete"}, "R1", "REVIEW"), ({"label": "delete"}, "D1", "SUGGEST_DELETE"), ({"label": "delete", "label_source": "model"}, "R1", "REVIEW"),
        ({"label": "delete", "siblings": ["interrogate"]}, "R1", "REVIEW"), ({"label": "delete", "siblings": ["delete"]}, "D1", "SUGGEST_DELETE"),
        ({"label": "delete", "label_at": NOW - timedelta(days=9), "reprocessed_at": NOW - timedelta(days=2)}, "R1", "REVIEW"), ({"label": "delete", "auto_label": "keep", "auto_reason": "motion_detected"}, "R1", "REVIEW"),
        ({"label": "delete", "name": "PSF_3"}, "R1", "REVIEW"), ({"label": "interrogate"}, "R1", "REVIEW"), ({"signal_flag": "dead"}, "R1", "REVIEW"), ({"signal_flag": None, "status": None}, "K0", "KEEP"),
    ],
)
def test_rules(spark, over, rule, action):
    df = spark.createDataFrame([tuple(fact(**over).values())], SCHEMA)
    row = df.select(*rules.decide(F.lit(NOW))).first()
    assert (row.rule, row.action) == (rule, action) and (row.reasons or rule == "K0")


def test_components_long_chain_and_empty(spark):
    edges = spark.range(1, 300).selectExpr("id - 1 as u", "id as v")
    assert {r.label for r in graph.components(edges).collect()} == {0}
    assert graph.components(edges.limit(0)).count() == 0


def test_salted_join_does_not_broadcast_what_it_repeats(spark, capsys):
    rows = spark.createDataFrame([(k % 3, k) for k in range(90)] + [(7, 90)], "label int, node int")
    few = materialise(spark.createDataFrame([(0, 10), (1, 11), (2, 12), (5, 15)], "label int, up int"), "test-few")  # Spark knows its size: small
    for how, more in (("inner", []), ("left", [(7, 90, None)])):
        got = graph.salted_join(rows, few, "label", "node", how)
        got.explain()
        assert "Broadcast" not in capsys.readouterr().out
        assert sorted(map(tuple, got.collect())) == sorted([(k % 3, k, 10 + k % 3) for k in range(90)] + more)


def test_series(spark):
    rows = [("ok", 0, 0, 5), ("ok", 0, 1, 5), ("gap", 0, 0, 5), ("gap", 0, 2, 5), ("zero", 0, 0, 0), ("uneven", 0, 0, 1), ("uneven", 1, 0, 1), ("uneven", 1, 1, 1), ("short", 0, 0, 1), ("dup", 0, 0, 0), ("dup", 0, 0, 4)]
    df = spark.createDataFrame(rows, "k string, c int, t int, s int")
    want = F.when(F.col("k") == "short", 2).otherwise(0)
    got = {r.k: r.detail for r in completeness.series(df, "k", "c", "t", "s", want).collect()}
    assert got == {"ok": "ok", "gap": "gap", "zero": "empty frame", "uneven": "unequal channels", "short": "wrong length", "dup": "ok"}


def test_containment_is_of_multisets_and_needs_all_digests(spark):
    rows = [("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("c", "x"), ("c", None)]
    df = spark.createDataFrame(rows, "k string, sha string")
    got = {(r.a, r.b): (r.a_in_b, r.b_in_a, r.unmatched) for r in dedup.containment(dedup.sharing_pairs(df, "k", ["sha"]), df, "k", ["sha"]).collect()}
    assert got == {("a", "b"): (False, True, 0), ("a", "c"): (False, False, 1), ("b", "c"): (False, False, 1)}


def test_even_sample(spark):
    f = lambda t, n, k=5: spark.range(1).select(arrays.even_sample(F.lit(t), F.lit(n), k).alias("x")).first().x
    assert f(0, 1) == [0] and f(2, 3) == [0, 1, 2] and f(50, 100) == [0, 25, 50, 74, 99] and 7 in f(7, 100) and len(f(7, 100)) == 5


def test_provenance(spark):
    t = lambda a, b, c, d, strict=False: spark.range(1).select(lifecycle.provenance_matches(*(F.lit(x).cast("string") for x in (a, b, c, d)), strict).alias("x")).first().x
    assert t(None, None, None, "p") and not t("a", None, None, None) and t("a", "a", None, "p") and not t("a", "a", None, "p", True) and t("a", "a", "p", "p") and not t("a", "a", "q", "p")


def test_scalar_functions(spark):
    row = spark.range(1).select(fn.parse_time(F.lit("2026-10-14T10:00:00Z")).alias("a"), fn.parse_time(F.lit("soon")).alias("b"), fn.sequence_index(F.lit("x_12.ome.tif")).alias("c"), fn.sequence_index(F.lit("x.ome.tif")).alias("d"), fn.json_field(F.lit("{"), "$.a", "?").alias("e")).first()
    assert row.a == datetime(2026, 10, 14, 10) and row.b is None and (row.c, row.d, row.e) == (12, 0, "?")


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "t/sub").mkdir(parents=True)
    (tmp_path / "t/a.tif").write_bytes(b"abc")
    (tmp_path / "t/sub/b.json").write_text('{"scans": ["p", "q"]}')
    (tmp_path / "t/sub/c.json").write_text("{broken")
    (tmp_path / "pins.txt").write_text("# note\n\n /a/b \n")
    assert sorted((r.rel, r["size"]) for r in listing.scan_tree(spark, str(tmp_path / "t")).collect())[0] == ("a.tif", 3)
    assert sorted(r.scan for r in files.manifests(spark, str(tmp_path / "t/sub/*.json")).collect()) == ["p", "q"]
    assert [r.pin for r in files.pins(spark, str(tmp_path / "pins.txt")).collect()] == ["/a/b"]
    assert files.empty_if_absent(spark, str(tmp_path / "none"), "a int").count() == 0
    old = spark.createDataFrame([("k", "keep", "t")], "dataset_key string, label string, updated_at string")
    assert files.labels(old).first().source == "human"
    names = spark.createDataFrame([("a_C1_T02.tif",), ("a_C1_T02_MIP.tif",), ("x",)], "name string")
    assert [(r.c, r.t) for r in files.frames(names).collect()] == [(1, 2)]
    docs = spark.createDataFrame([('{"session_id": "s", "state": "running"}',), ("[]",), ("{}",)], "value string")
    assert [r.session_id for r in files.sessions(docs).collect()] == ["s"]
    a, b = (spark.createDataFrame(x, "k int, v int") for x in ([(1, 1), (2, 2)], [(2, 9), (3, 3)]))
    sinks.upsert(spark, a, str(tmp_path / "u"), ["k"])
    assert sorted(map(tuple, sinks.upsert(spark, b, str(tmp_path / "u"), ["k"]).collect())) == [(1, 1), (2, 9), (3, 3)]
    sinks.replace_keys(a, str(tmp_path / "r"), "k")
    sinks.replace_keys(b, str(tmp_path / "r"), "k")
    assert sorted((r.k, r.v) for r in spark.read.parquet(str(tmp_path / "r")).collect()) == [(1, 1), (2, 9), (3, 3)]
    assert sinks.remove_verified(a, a, ["k"], "v").count() == 2
    with pytest.raises(Exception, match="differs"):
        sinks.remove_verified(a, b, ["k"], "v").collect()


def test_stream_restart(spark, tmp_path):
    """A second run goes on from the checkpoint: rows that arrived since are counted, old ones aren't counted again."""
    from tidewell.streaming.sessions import run_available, session_states

    schema = "key long, ms long, kind string, value double"
    put = lambda rows, k: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    put([(1, 1, "beat", 1.0), (2, 1, "beat", None)], 0)
    name = f"restart-{tmp_path.name}-{id(tmp_path)}"
    read = lambda: session_states(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")))
    run_available(spark, read(), name)
    put([(1, 5, "finish", 1.0), (1, 9, "beat", 1.0)], 1)
    out = run_available(spark, read(), name)
    last = {r.key: (r["count"], r.status) for r in out.orderBy("epoch").collect()}
    assert last == {1: (2, "complete"), 2: (1, "running")}


def test_percentiles_are_exact(spark):
    rng = np.random.default_rng(11)
    groups = {"a": rng.normal(size=501), "b": np.repeat([1.0, 2.0, 2.0, 7.0], 25), "c": np.array([3.0]), "d": np.concatenate((rng.normal(size=300), [1e9])), "e": np.full(9, -2.0)}
    df = spark.createDataFrame([(k, float(v)) for k, x in groups.items() for v in x] + [("a", None)], "g string, v double")
    shares = [0.0, 0.01, 0.5, 0.998, 1.0]
    got = {r.g: r["_q"] for r in arrays.percentiles(df, ["g"], "v", shares).collect()}
    assert set(got) == set(groups) and all(np.allclose(got[k], np.quantile(x, shares)) for k, x in groups.items())


def test_candidate_pairs_with_a_hot_size(spark):
    rng = np.random.default_rng(12)
    files_ = [(k, 100) for k in range(40)] + [(k, int(s)) for k in range(40) for s in rng.integers(10, 160, rng.integers(0, 6))] + [(99, 7)]
    df = spark.createDataFrame(files_, "k int, size long")
    total, own = {}, {}
    for k, s in files_:
        total[k] = total.get(k, 0) + s
        if s >= 20:
            own.setdefault(k, set()).add(s)
    want = {(a, b, sum(own[a] & own[b])) for a in own for b in own if a < b and own[a] & own[b] and sum(own[a] & own[b]) >= 0.5 * min(total[a], total[b])}
    got = {tuple(r) for r in dedup.candidate_pairs(df, "k", "size", 20, 0.5).collect()}
    assert got == want and len(want) > 50


def test_differing_groups_by_counted_items(spark):
    rows = [("g", 1, "x"), ("g", 1, "y"), ("g", 2, "y"), ("g", 2, "x"), ("h", 1, "x"), ("h", 2, "x"), ("h", 2, "x"), ("i", 1, "x"), (None, 1, "x"), (None, 2, "z")]
    df = spark.createDataFrame(rows, "g string, m int, i string")
    assert sorted((r.g or "") for r in dedup.differing_groups(df, ["g"], "m", ["i"]).collect()) == ["", "h"]


def test_differing_groups_in_parts_that_do_not_grow(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(int(g) if g else None, int(m) if m else None, "ab"[i] if i < 2 else None) for g, m, i in zip(rng.integers(0, 120, 600), rng.integers(0, 3, 600), rng.integers(0, 3, 600))]
    rows += [(200 + g, m, i) for g in range(300) for m in (1, None) for i in ("a", "a", None)]  # these agree
    rows += [(1000, m, i) for m in range(400) for i in "ab"] + [(1001, m, "a") for m in range(800)] + [(1001, 7, "a")]  # large ones: one agrees, one doesn't
    bags = {}
    for g, m, i in rows:
        bags.setdefault(g, {}).setdefault(m, []).append(str(i))
    want = {g for g, of in bags.items() if len({tuple(sorted(x)) for x in of.values()}) > 1}
    for name, value in (("GROUP_ROWS", 500), ("UNSORTED", 3)):
        monkeypatch.setattr(dedup, name, value, raising=False)
    df = spark.createDataFrame(rows, "g long, m int, i string")
    for part in (df, df.filter("g < 1000 or g is null")):
        got = [r.g for r in dedup.differing_groups(part, ["g"], "m", ["i"]).collect()]
        assert len(got) == len(set(got)) and set(got) == want - ({1000, 1001} if part is not df else set())
    assert 1001 in want and 1000 not in want and None in want
    few, many = (dedup.differing_groups(spark.range(n).selectExpr("id div 4 g", "id % 2 m", "id % 3 i"), ["g"], "m", ["i"]).rdd.getNumPartitions() for n in (4000, 40000))
    assert (few, many) == (8, 80)  # as many parts as the rows need

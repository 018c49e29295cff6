"""Listings, versioned tables, reports, images, settings and profiler pages."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.sources import chunks, files, images, listing, sinks


def test_listing_is_complete(spark, tmp_path, monkeypatch):
    names = [".zarray", "_metadata.txt", "a.tif", "s (1)/b+c.tif", "s (1)/.hidden/_d", *(f"p{k}/q{k}/r.bin" for k in range(60))]
    for n in names:
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_bytes(b"x" * (len(n) % 7))
    os.symlink(tmp_path, tmp_path / "loop")
    os.symlink(tmp_path / "gone", tmp_path / "dangling")
    rows = {r.rel: r for r in listing.scan_tree(spark, str(tmp_path), "leaf").collect()}
    assert set(rows) == {*names, "loop", "dangling"} and all(rows[n]["size"] == len(n) % 7 and rows[n].error is None for n in names)
    assert rows["a.tif"].modified is not None and rows["a.tif"].tree == "leaf"
    (got,) = listing.entries(*listing.opened(str(tmp_path)), "nothing here")
    assert got[2] == -1 and got[4]
    assert listing.listing(spark, f"file://{tmp_path}").filter("is_dir").count() == 2 + 120


def test_listing_of_a_folder_with_most_files(spark, tmp_path, monkeypatch):
    """As the file system has it, batch by batch; a store's own listing gives the same; skipped folders are left out."""
    from pyarrow import fs

    for k in range(3000):
        path = tmp_path / ("big" if k % 10 else f"d{k % 7}/e{k % 3}") / f"f{k}"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * (k % 5))
    want = {(os.path.relpath(os.path.join(at, n), tmp_path), os.path.getsize(os.path.join(at, n))) for at, _, names in os.walk(tmp_path) for n in names}
    found = listing.listing(spark, str(tmp_path))
    assert {(r.rel, r["size"]) for r in found.filter("not is_dir").collect()} == want
    store = fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())
    level, rows = [""], []
    while level:
        rows += (here := [r for folder in level for r in listing.entries(store, "", folder)])
        level = [r[0] for r in here if r[1]]
    assert {(r[0], r[2]) for r in rows if not r[1]} == want and all(r[3] > 0 for r in rows)
    skip = spark.createDataFrame([(str(tmp_path), "big"), (str(tmp_path), "d1/e1"), ("other", "d2")], "root string, rel string")
    roots = spark.createDataFrame([("t", str(tmp_path))], "tag string, root string")
    left = {r.rel for r in listing.spread(roots, skip).filter("not is_dir").collect()}
    assert left == {p for p, _ in want if not p.startswith(("big/", "d1/e1/"))}


def test_upsert_survives_a_crash_and_a_race(spark, tmp_path, monkeypatch):
    a, b, c = (spark.createDataFrame(x, "k int, v int") for x in ([(1, 1), (2, 2)], [(2, 9), (3, 3)], [(4, 4)]))
    path = str(tmp_path / "u")
    rows = lambda: sorted(map(tuple, sinks.current(spark, path).collect()))
    assert sinks.current(spark, path, "k int, v int").count() == 0
    sinks.upsert(spark, a, path, ["k"])
    real = sinks.Folder.write

    def crash(*_, **__):
        raise OSError("crash before the pointer turns")

    monkeypatch.setattr(sinks.Folder, "write", crash)
    with pytest.raises(OSError):
        sinks.upsert(spark, b, path, ["k"])
    assert rows() == [(1, 1), (2, 2)]
    raced = []

    def race(self, name, text, instead_of=None):
        if not raced and name == sinks.POINTER:  # another writer is first
            raced.append(1)
            monkeypatch.setattr(sinks.Folder, "write", real)
            sinks.upsert(spark, c, path, ["k"])
        return real(self, name, text, instead_of)

    monkeypatch.setattr(sinks.Folder, "write", race)
    sinks.upsert(spark, b, path, ["k"], delay=0.0)
    assert rows() == [(1, 1), (2, 9), (3, 3), (4, 4)] and raced
    monkeypatch.setattr(sinks.Folder, "write", real)
    reader = sinks.current(spark, path)
    sinks.upsert(spark, a, path, ["k"])
    assert reader.count() == 4  # the version before stays for its readers
    monkeypatch.setattr(sinks.Folder, "write", lambda *_, **__: False)
    with pytest.raises(TimeoutError):
        sinks.upsert(spark, b, path, ["k"], attempts=2, delay=0.0)


def test_report_folder(spark, tmp_path):
    schema = "tier string, rule string, dataset_key string, path string, bytes long, nfiles long, paths array<string>, class_bytes map<string,long>"
    s = spark.createDataFrame([("A1", "DUP1", "/m/a", "/m/a", 10, 1, [], {"raw": 10}), ("A1", "DUP1", "/n/b", "/n/b", 30, 2, ["/n/b/x", "/n/b/y"], {}), ("B", "I1a", "/m/a", "/m/a/z", 5, 1, ["/m/a/z"], {})], schema)
    review = spark.createDataFrame([("R1", 1, "/m/c", ["p", "q"]), ("R1", 9, "/m/d", [])], "rule string, bytes long, dataset_key string, reasons array<string>")
    verdicts = spark.createDataFrame([("K0",), ("K0",), ("R1",)], "rule string")
    path = sinks.unique_dir(spark, str(tmp_path), "report")
    assert sinks.unique_dir(spark, str(tmp_path), "report").endswith("report-2") and sinks.unique_dir(spark, str(tmp_path), "report").endswith("report-3")
    out = sinks.report(s, review, ["one", "two"], path, {"A1": "copies", "A2": "other", "B": "small"}, verdicts, ["P2", "R1", "K0"], {"dup_clusters": 1})
    assert out == json.loads((tmp_path / "report/summary.json").read_text()) and (tmp_path / "report/notes.txt").read_text() == "one\ntwo\n"
    assert out["tiers"]["A1"] == {"what": "copies", "rows": 2, "datasets": 2, "bytes": 40, "by_filesystem": {"/m": 10, "/n": 30}} and out["tiers"]["A2"]["rows"] == 0
    assert out["verdicts"] == {"P2": 0, "R1": 1, "K0": 2} and out["review_queue"] == {"datasets": 2, "bytes": 10} and out["dup_clusters"] == 1
    csv = lambda name: spark.read.option("header", "true").csv(f"{path}/{name}").collect()
    assert [r.path for r in csv("suggestions")] == ["/n/b", "/m/a", "/m/a/z"] and [(r.dataset_key, r.reasons) for r in csv("review_queue")][1] == ("/m/c", "p | q")
    assert sorted(r.value for r in spark.read.text(f"{path}/paths/tier=A1").collect()) == ["/m/a", "/n/b/x", "/n/b/y"]


def test_tiff_headers(spark):
    heads = spark.createDataFrame([(b"II*\0rest",), (b"MM\0+",), (b"II",), (None,)], "c binary")
    assert [r[0] for r in heads.select(images.has_tiff_header(F.col("c"))).collect()] == [True, True, False, False]


def test_settings_tickets_sessions_and_cohort(spark):
    docs = spark.createDataFrame([("b", "s1/x/AcqSettings.txt", '{"channels": [{"config": "GFP 488"}, {"config": "Laser 640 sir"}]}'), ("b", "s1/y/AcqSettings.txt", "{}"), ("b", "cell_mscarlet/img.tif", ""), ("b", "s3/AcqSettings.txt", "{broken")], "base string, rel string, text string")
    got = {r.folder: (r.source, r.configs, r.detected) for r in files.sample_settings(docs).collect()}
    assert got["s1"] == ("s1/x/AcqSettings.txt", ["GFP 488", "Laser 640 sir"], ["GFP/mNG (488)", "CF647/SiR (640)"])
    assert got["cell_mscarlet"] == ("folder name", [], ["mScarlet/CF568/TdTomato (561)"]) and got["s3"][2] == []
    t = spark.createDataFrame([('{"parameters": {"psf_path": "p", "b": 1, "a": "x"}}',), ('{"parameters": {"psf_path": ""}}',), ('{"parameters": [1]}',), ("{broken",), ("{}",), (None,)], "doc string")
    assert [tuple(r) for r in t.select(*files.finished_ticket(F.col("doc"))).collect()] == [("p", "a=x;b=1"), (None, ""), *[("?", "?")] * 4]
    s = spark.createDataFrame([("k", 1, '{"session_id": "a"}'), ("k", 2, '{"session_id": "b", "store": "/r/x_dsr.ome.zarr"}'), ("l", 1, '{"session_id": "c"}'), ("l", 2, "[]"), ("m", 1, '{"session_id": ""}')], "k string, n int, value string")
    assert [(r.k, r.session_id) for r in files.latest_session(s, ["k"], ["n"]).collect()] == [("k", "b")]
    steps = spark.createDataFrame([("/s/g1", 0.4)], "store string, step double")
    table = spark.createDataFrame([("c1", '{"t": 3, "membrane_ch": 0, "z_step_um": null, "raw": {"G": "/s/g1", "M": "/s/m1"}}'), ("c2", '{"t": 4, "membrane_ch": 0, "z_step_um": 0.5, "raw": {"G": "/s/g2"}}')], "cell string, doc string")
    assert sorted(map(tuple, files.cohort(table, steps, ["G", "M"], [0]).collect())) == [("c1", 3, ["/s/g1"], 0.4), ("c2", 4, ["/s/g2"], 0.5)]
    bad = spark.createDataFrame([("c3", '{"t": 3, "membrane_ch": 1, "z_step_um": 1.0, "raw": {"G": "/s/g1"}}')], "cell string, doc string")
    with pytest.raises(Exception, match="c3: membrane"):
        files.cohort(bad, steps, ["G", "M"], [0]).collect()


def test_profiler_pages(spark):
    row = '<tr><td class="td-linebottomrt"><a href="file{k}.html">f{k}</a>{x}</td><td class="td-linebottomrt">{k}</td><td class="td-linebottomrt">{k}.5 s</td><td class="td-linebottomrt">0.25 s</td></tr>'
    html = row.format(k=1, x=" (MEX-file)") + "\n" + row.format(k=2, x="&gt;g")
    pages = spark.createDataFrame([("p", html)], "job string, html string")
    assert sorted(tuple(r) for r in files.profile_functions(pages, ["job"]).collect()) == [("p", "file1.html", "f1 (MEX-file)", 1, 1.5, 0.25), ("p", "file2.html", "f2>g", 2, 2.5, 0.25)]
    lines = '<tr><td>0.5</td><td>3</td><td><a name="Line7"></a>7</td><td>x = <b>1</b>;</td></tr><tr><td>1</td></tr><tr><td>&nbsp;</td><td></td><td><a name="Line9">9</a></td><td>y</td></tr>'
    got = files.profile_lines(spark.createDataFrame([("p", lines)], "job string, html string"), ["job"]).collect()
    assert [tuple(r) for r in got] == [("p", 0.5, 3, 7, "x = 1;"), ("p", 0.0, None, 9, "y")]


def test_projections_points_manifests_and_times(spark, tmp_path):
    names = spark.createDataFrame([("d", f"a_C{c}_T{t:03d}_MIP_z.tif") for c in (0, 1) for t in (2, 0, 1)] + [("d", "a_C0_T000.tif")], "k string, name string")
    got = {r.c: [f.t for f in r.frames] for r in files.projections(names, ["k"]).collect()}
    assert got == {0: [0, 1, 2], 1: [0, 1, 2]}
    (tmp_path / "p.csv").write_text("1,2,3\n4,5,x\n7,8,9\n")
    p = files.points(spark, str(tmp_path / "p.csv"))
    files.save_points(p, str(tmp_path / "q"))
    assert [tuple(r) for r in files.points(spark, str(tmp_path / "q")).orderBy("point_id").collect()] == [(0, 1.0, 2.0, 3.0), (1, 7.0, 8.0, 9.0)]
    arm = lambda *rows: spark.createDataFrame(list(rows), "name string, v int")
    got = sinks.merge_manifest(arm(("a", 1), ("b", 1), ("c", 1)), arm(("b", 2), ("d", 2)), arm(("a", 0), ("b", 0), ("d", 0)), "name")
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("b", 2), ("d", 2)]
    stored = spark.createDataFrame([(0,), (1,), (2,)], "t int")
    for raw, want in (([(0, 9), (1, 19)], "acquisition times of 2 of 3 frames"), ([(9, 9)], "no acquisition times"), ([(k, k) for k in range(3)], "acquisition times of all frames")):
        assert sinks.times_note(stored, spark.createDataFrame(raw, "t int, ms long"), "t", "ms")[1] == want
    sinks.fill_template(spark, "<x>DATA</x>", "DATA", {"n": 1}, str(tmp_path), "n.html")
    assert (tmp_path / "n.html").read_text() == '<x>{"n": 1}</x>'


def test_store_of_frames(spark, tmp_path):
    rng = np.random.default_rng(0)
    vols = {(t, c): rng.integers(0, 999, (2, 3, 4)) for t in (2, 5) for c in (1, 3) if (t, c) != (5, 3)}
    df = spark.createDataFrame([(t, c, v.ravel().astype(float).tolist()) for (t, c), v in vols.items()], "t int, c int, values array<double>")
    path = chunks.write_store(df, str(tmp_path / "s.ome.zarr"), (2, 3, 4), "<u2", ["g", "m"], 0.1)
    assert chunks.write_store(df, str(tmp_path / "s.ome.zarr"), (2, 3, 4), "<u2", ["g", "m"], 0.1) == path
    back = {(r.chunk[0], r.chunk[1]): r["values"] for r in chunks.read_chunks(spark, f"{path}/0").collect()}
    assert back == {((2, 5).index(t), (1, 3).index(c)): v.ravel().astype(float).tolist() for (t, c), v in vols.items()}
    attributes = json.loads((tmp_path / "s.ome.zarr/.zattrs").read_text())
    assert attributes["progress"]["done"] == [[0, 0], [0, 1], [1, 0]] and attributes["omero"]["channels"][1]["label"] == "m" and attributes["multiscales"][0]["name"] == "s"
    assert chunks.declared_and_written(spark, f"{path}/0") == (2, 2)
    assert chunks.read_chunks(spark, f"{path}/0", {0: (7, 9)}).count() == 0
    view = chunks.mirror_view(chunks.read_chunks(spark, f"{path}/0").withColumn("ch", F.lit("x")), "ch", "t").collect()
    assert {(r.t, len(r["shape"])) for r in view} == {(0, 4), (1, 4)}
    grid = spark.createDataFrame([("s", [2, 2]), ("e", [1, 3])], "k string, counts array<int>")
    have = spark.createDataFrame([("s", [0, 0]), ("s", [0, 0]), ("s", [1, 1]), ("s", [2, 0])], "k string, chunk array<int>")
    assert sorted(map(tuple, chunks.missing_chunks(grid, have, ["k"]).collect())) == [("e", 3, 3), ("s", 4, 2)]


def test_dataset_of_three_trees(spark, tmp_path):
    for n in ("leaf/a.tif", "mirror/m/b.tif", "raw/x_g_488.ome.zarr/.zarray", "raw/x_m_561.ome.zarr/0/0"):
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_bytes(b"x")
    stores = [str(tmp_path / "raw" / s) for s in ("x_g_488.ome.zarr", "x_m_561.ome.zarr")]
    got = listing.scan_dataset(spark, str(tmp_path / "leaf"), str(tmp_path / "mirror"), stores).collect()
    assert sorted((r.tree, r.rel) for r in got) == [("leaf", "a.tif"), ("master", "x_g_488.ome.zarr/.zarray"), ("master", "x_m_561.ome.zarr/0/0"), ("mirror", "m/b.tif")]
    assert listing.scan_dataset(spark, str(tmp_path / "leaf")).count() == 1

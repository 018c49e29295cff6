"""Jobs over folders: what a scan finds, what is hashed, what a stale inventory refuses."""

import hashlib
import os

import pytest

from tidewell import jobs
from tidewell.sources import sinks


@pytest.fixture
def place(spark, tmp_path):
    def put(rel, data):
        path = tmp_path / "data" / rel
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)

    put("a/x.tif", b"1" * 4000)
    put("a/.hidden/y.tif", b"2")
    put("a/AcqSettings.txt", b"s")
    put("a/sub/x.tif", b"1" * 4000)
    put("b/x.tif", b"3" * 4000)
    put("c/z.tif", b"4" * 10)
    (tmp_path / "data" / "empty").mkdir()
    rows = [(k, f"{tmp_path}/data/{d}") for k, d in (("A", "a"), ("S", "a/sub"), ("B", "b/"), ("C", "c"), ("E", "empty"), ("gone", "nowhere"), ("none", None))]
    return put, spark.createDataFrame([(k, None if k == "none" else p) for k, p in rows], "dataset_key string, leaf_dir string"), str(tmp_path / "work")


def files(spark, work):
    return sorted((r.dataset_key, r.rel, r.size) for r in sinks.current(spark, f"{work}/files", jobs.FILES).collect())


def test_scan_lists_each_dataset_once(spark, place):
    put, registry, work = place
    assert jobs.scan(spark, registry, work, tasks=2) == 7
    want = [("A", ".hidden/y.tif", 1), ("A", "AcqSettings.txt", 1), ("A", "x.tif", 4000), ("B", "x.tif", 4000), ("C", "z.tif", 10), ("S", "x.tif", 4000), ("gone", "", -1)]
    assert files(spark, work) == want
    put("c/new.tif", b"5")
    assert jobs.scan(spark, registry, work, tasks=2) == 0 and files(spark, work) == want
    put("d/w.tif", b"6")
    more = registry.union(spark.createDataFrame([("D", registry.first().leaf_dir[:-1] + "d")], registry.schema))
    assert jobs.scan(spark, more, work, tasks=2) == 1 and ("D", "w.tif", 1) in files(spark, work) and len(files(spark, work)) == 8
    os.remove(registry.first().leaf_dir + "/x.tif")
    assert jobs.scan(spark, more, work, refresh=True, tasks=2) == 8
    assert ("C", "new.tif", 1) in files(spark, work) and ("A", "x.tif", 4000) not in files(spark, work)
    assert jobs.scan(spark, registry.limit(0), work) == 0


def test_hashing_covers_candidates_and_resumes(spark, place):
    put, registry, work = place
    jobs.scan(spark, registry, work, tasks=2)
    run = lambda **kw: jobs.hash_files(spark, registry, work, min_size=100, tasks=2, **kw)
    assert run(dry_run=True) == {"pairs": 3, "files": 4, "bytes": 12001, "failed": 0}
    put("b/x.tif", b"3" * 4001)
    assert run(rounds=3) == {"pairs": 3, "files": 4, "bytes": 12001, "failed": 1}
    shas = {r.dataset_key + "/" + os.path.basename(r.path): r.sha for r in jobs.raw_files(spark, registry, work).collect()}
    one = hashlib.sha256(b"1" * 4000).hexdigest()
    assert shas == {"A/x.tif": one, "S/x.tif": one, "A/AcqSettings.txt": hashlib.sha256(b"s").hexdigest(), "B/x.tif": None, "C/z.tif": None}
    jobs.scan(spark, registry, work, refresh=True, tasks=2)
    assert run() == {"pairs": 1, "files": 0, "bytes": 0, "failed": 0}


def test_stale_inventory_refuses_suggestions(spark, place):
    _, registry, work = place
    s = spark.createDataFrame([("A1", "DUP1", "A", "/m/a", 10, 1, [], {"raw": 10})], "tier string, rule string, dataset_key string, path string, bytes long, nfiles long, paths array<string>, class_bytes map<string,long>")
    review = spark.createDataFrame([("R1", 1, "B", ["p"])], "rule string, bytes long, dataset_key string, reasons array<string>")
    verdicts = spark.createDataFrame([("K0",), ("R1",)], "rule string")
    run = lambda **kw: jobs.report(spark, registry, work, s, review, verdicts, {"A1": "copies"}, ["R1", "K0"], "r", **kw)
    assert run()["oldest_scan_age_hours"] is None  # never scanned
    jobs.scan(spark, registry, work, tasks=2)
    assert run()["stale_datasets"] == 0
    sinks.upsert(spark, spark.createDataFrame([("A", "2020-01-01 00:00:00")], jobs.SCANS), f"{work}/scans", ["dataset_key"])
    with pytest.raises(jobs.StaleInventory):
        run()
    out = run(allow_stale=True)
    assert out["stale_datasets"] == 1 and out["report_dir"].endswith("/r-3") and sinks.Folder(spark, out["report_dir"]).read("notes.txt").startswith("inventory: 1 ")
    assert run(rescan=True)["stale_datasets"] == 0


def test_command_line(spark, place, tmp_path, capsys):
    _, registry, work = place
    registry.write.parquet(f"{tmp_path}/registry")
    jobs.main(["scan", "--registry", f"{tmp_path}/registry", "--work", work])
    jobs.main(["hash", "--registry", f"{tmp_path}/registry", "--work", work, "--dry-run"])
    assert capsys.readouterr().out.splitlines() == ['{"scanned": 7}', '{"pairs": 0, "files": 0, "bytes": 0, "failed": 0}']
    with pytest.raises(SystemExit):
        jobs.main(["report", "--registry", "r", "--work", work])

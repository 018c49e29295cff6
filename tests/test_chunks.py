import json
import zlib

import numpy as np
import pytest

from tidewell.operators import arrays
from tidewell.sources import chunks


@pytest.mark.parametrize("sep,codec", [(".", None), ("/", {"id": "zlib"})])
def test_chunked_array(spark, tmp_path, sep, codec):
    full = np.arange(3 * 7 * 5, dtype="<u2").reshape(3, 7, 5)
    size = (1, 4, 5)
    (tmp_path / ".zarray").write_text(json.dumps({"shape": full.shape, "chunks": size, "dtype": "<u2", "order": "C", "compressor": codec, "zarr_format": 2}))
    for t in range(3):
        for y in range(2):
            if (t, y) == (2, 1):
                continue  # never arrived
            block = np.zeros(size, "<u2")
            part = full[t : t + 1, y * 4 : y * 4 + 4]
            block[:, : part.shape[1]] = part
            path = tmp_path / sep.join(map(str, (t, y, 0)))
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(zlib.compress(block.tobytes()) if codec else block.tobytes())
    rows = chunks.read_chunks(spark, str(tmp_path))
    assert rows.count() == 5
    cells = {(r.t, r.y, r.x): r.v for r in chunks.voxels(rows, ["t", "y", "x"]).collect()}
    assert cells == {(t, y, x): float(full[t, y, x]) for t in range(3) for y in range(7) for x in range(5) if not (t == 2 and y >= 4)}
    assert chunks.read_chunks(spark, str(tmp_path), {0: (1, 2)}).count() == 2
    top = {(r.y, r.x): r.v for r in arrays.project(chunks.voxels(rows, ["t", "y", "x"]), ["y", "x"], "v").collect()}
    assert top[(0, 0)] == full[:, 0, 0].max() and top[(6, 4)] == full[:2, 6, 4].max()


def store(folder, broken=()):
    """Ten by eight in chunks of two by three, one absent, some broken."""
    full = np.arange(80, dtype="<i4").reshape(10, 8)
    (folder / ".zarray").write_text(json.dumps({"shape": full.shape, "chunks": [2, 3], "dtype": "<i4", "order": "C", "compressor": {"id": "zlib"}, "zarr_format": 2}))
    for y in range(5):
        for x in range(3):
            block = np.zeros((2, 3), "<i4")
            part = full[y * 2 : y * 2 + 2, x * 3 : x * 3 + 3]
            block[:, : part.shape[1]] = part
            if (y, x) != (4, 0):
                (folder / f"{y}.{x}").write_bytes(b"broken" if (y, x) in broken else zlib.compress(block.tobytes()))
    return str(folder), full


def test_ranges_reach_the_source(spark, tmp_path):
    """A filter on a place bounds what is tried: broken chunks outside it are never opened, and the plan shows it."""
    path, full = store(tmp_path, broken=[(0, 0), (0, 1), (4, 2)])
    rows = chunks.chunk_table(spark, path, group=2).filter("c0 >= 1 and c0 < 4 and c1 = 2")
    assert "c0" in rows._jdf.queryExecution().executedPlan().toString().split("BatchScan")[-1] or rows.rdd.getNumPartitions() == 2
    got = {tuple(r.chunk): (r["values"], r.error) for r in rows.collect()}
    assert got == {(y, 2): (full[2 * y : 2 * y + 2, 6:8].ravel().astype(float).tolist(), None) for y in (1, 2, 3)}
    assert rows.rdd.getNumPartitions() == 2  # three places, two to a task
    reader = chunks.ChunkReader(path, json.loads((tmp_path / ".zarray").read_text()), 4)
    left = list(reader.pushFilters([chunks.GreaterThan(("c0",), 3), chunks.EqualTo(("c1",), 0), chunks.EqualTo(("error",), "x"), chunks.LessThan(("origin", "c0"), 1)]))
    assert reader.bounds == [[4, 5], [0, 1]] and len(left) == 2 and [(p.low, p.high) for p in reader.partitions()] == [(0, 1)]
    assert list(reader.pushFilters([chunks.LessThan(("c0",), 2)])) == [] and [(p.low, p.high) for p in reader.partitions()] == [(0, 0)]
    within = chunks.read_chunks(spark, path, {0: (2, 8), 1: (0, 6)})
    assert sorted(tuple(r.chunk) for r in within.collect()) == [(y, x) for y in (1, 2, 3) for x in (0, 1)]
    with pytest.raises(Exception, match="chunk"):
        chunks.read_chunks(spark, path).collect()


def test_occupancy_of_masks(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    path, full = store(tmp_path / "a")
    assert chunks.occupancy(spark, path) == pytest.approx((79 - 6) / 80)  # one zero, six in the absent chunk
    assert chunks.occupancy(spark, store(tmp_path / "b", broken=[(2, 1)])[0]) == -1.0


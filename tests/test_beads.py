"""Boxes out of chunks against slices of the whole volume, and nearest neighbours at any distance."""

import numpy as np

from tidewell.operators import beads


def test_boxes_equal_slices(spark):
    vol = np.random.default_rng(2).normal(size=(20, 24, 24))
    size, rows = (8, 16, 16), []
    for i, z in enumerate(range(0, 20, 8)):
        for j, y in enumerate(range(0, 24, 16)):
            for k, x in enumerate(range(0, 24, 16)):
                part = vol[z : z + 8, y : y + 16, x : x + 16]
                rows.append((1, [i, j, k], [z, y, x], list(part.shape), part.ravel().tolist()))
    chunks = spark.createDataFrame(rows, "k int, chunk array<int>, origin array<int>, shape array<int>, values array<double>")
    at = [(9, 14, 15), (3, 3, 3), (16, 20, 3), (1, 12, 12)]
    points = spark.createDataFrame([(1, n, *map(float, p)) for n, p in enumerate(at)], "k int, point_id int, z double, y double, x double")
    got = {r.point_id: r for r in beads.crops(chunks, points, "k", size, 3, 3).collect()}
    for n, (z, y, x) in enumerate(at[:3]):
        assert np.array_equal(np.reshape(got[n]["values"], (7, 7, 7)), vol[z - 3 : z + 4, y - 3 : y + 4, x - 3 : x + 4])
    assert not got[3].fits and got[3]["values"] is None


def test_nearest_grows_its_reach(spark):
    rows = [("a", i, float(z), 0.0, 0.0) for i, z in enumerate((0, 1, 40, 4000))] + [("b", 0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, point_id int, z double, y double, x double")
    got = {(r.k, r.point_id): r.nearest for r in beads.nearest_in_radii(df, "k", 1, 1).collect()}
    assert got == {("a", 0): 1.0, ("a", 1): 1.0, ("a", 2): 39.0, ("a", 3): 3960.0, ("b", 0): None}

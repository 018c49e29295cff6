"""Regions and openings over chunk borders against the same over whole arrays."""

import numpy as np
import pytest

from tidewell.operators import halo, regions


def labelled(mask):
    """Sets of cells with common faces."""
    left, out = {tuple(p) for p in np.argwhere(mask)}, []
    while left:
        todo, own = [min(left)], set()
        while todo:
            p = todo.pop()
            if p in left:
                left.remove(p)
                own.add(p)
                todo += [tuple(np.add(p, d)) for k in range(mask.ndim) for d in (np.eye(mask.ndim, dtype=int)[k], -np.eye(mask.ndim, dtype=int)[k])]
        out.append(own)
    return out


@pytest.mark.parametrize("shape,chunk", [((9, 23), 5), ((4, 7, 12), 4), ((30,), 3), ((9, 23), 64)])
def test_regions_equal_flood_fill(spark, shape, chunk):
    rng = np.random.default_rng(chunk)
    axes, rows, want = ["z", "y", "x"][-len(shape) :], [], []
    for key in (1, None):
        image = rng.random(shape).round(3)
        mask = image > 0.45
        rows += [(key, *map(int, p), float(image[tuple(p)])) for p in np.argwhere(mask)]
        for own in labelled(mask):
            at = np.array(sorted(own))
            want.append((key, tuple(at[0].tolist()), len(own), round(sum(image[p] for p in own), 6), max(image[p] for p in own), at.min(axis=0).tolist(), at.max(axis=0).tolist()))
    df = spark.createDataFrame(rows + rows[:5], ", ".join(["k int", *(f"{a} int" for a in axes), "v double"]))
    got = [(r.k, tuple(r.region), r.n, round(r.total, 6), r.peak, [r[f"lo_{a}"] for a in axes], [r[f"hi_{a}"] for a in axes]) for r in regions.regions(df, ["k"], axes, "v", chunk).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_a_region_over_many_chunks_and_none_at_all(spark):
    snake = [(y, x) for y in range(0, 21, 2) for x in range(40)] + [(y, 39 if y % 4 == 1 else 0) for y in range(1, 20, 2)]
    df = spark.createDataFrame([(1, y, x, 1.0) for y, x in snake], "k int, y int, x int, v double")
    (r,) = regions.regions(df, ["k"], ["y", "x"], "v", 4).collect()
    assert (r.n, r.hi_y, r.hi_x) == (len(snake), 20, 39)
    none = regions.regions(df.limit(0), ["k"], ["y", "x"], "v", 4)
    assert none.count() == 0
    box = regions.signal_box(none, df, ["k"], ["y", "x"], 1, {"y": 40, "x": 40}, {"y": 10, "x": 20}).first()
    assert (box.lo_y, box.hi_y, box.lo_x, box.hi_x, box.detected) == (15, 24, 10, 29, False)


def chunked(spark, image, size, keys=(1,)):
    rows = []
    for k in keys:
        for i in range(0, image.shape[0], size[0]):
            for j in range(0, image.shape[1], size[1]):
                rows.append((k, i // size[0], j // size[1], image[i : i + size[0], j : j + size[1]].tolist()))
    return spark.createDataFrame(rows, "k int, ci int, cj int, values array<array<double>>")


def whole(chunks, shape, size):
    out = np.full(shape, np.nan)
    for r in chunks.collect():
        v = np.array(r["values"])
        out[r.ci * size[0] : r.ci * size[0] + v.shape[0], r.cj * size[1] : r.cj * size[1] + v.shape[1]] = v
    return out


def plain(image, reach):
    at = lambda a, f: np.array([[f(a[max(0, i - reach) : i + reach + 1, max(0, j - reach) : j + reach + 1]) for j in range(a.shape[1])] for i in range(a.shape[0])])
    return at(at(image, np.min), np.max)


@pytest.mark.parametrize("size,reach", [((4, 6), 2), ((4, 6), 1), ((20, 20), 3), ((3, 3), 3)])
def test_opening_over_chunks_equals_the_whole(spark, size, reach):
    image = np.random.default_rng(reach).random((11, 16)).round(2)
    got = whole(halo.opening(chunked(spark, image, size), ["k"], reach), image.shape, size)
    assert np.array_equal(got, plain(image, reach))


def test_only_borders_are_shuffled(spark):
    image = np.random.default_rng(3).random((64, 64))
    placed = halo.placed(chunked(spark, image, (32, 32)), ["k"])
    out = halo.slide(placed, ["k"], 0, 1, True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan  # that of the borders' rows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = halo.slide(placed, ["k"], 0, 1, True)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_window_that_reaches_beyond_the_neighbour_is_an_error(spark):
    with pytest.raises(Exception, match="shorter than the window"):
        halo.slide(chunked(spark, np.ones((6, 4)), (2, 4)), ["k"], 0, 3, True).collect()

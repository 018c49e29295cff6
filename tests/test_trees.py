"""Hash trees against full joins, and prefix joins against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators import hashtree, inventory
from tidewell.operators.prefix import covering, nesting
from tidewell.operators.scan import ranged


def files(rng, n=400):
    return {"/".join(rng.choice("abc") + str(rng.randrange(3)) for _ in range(rng.randrange(1, 6))) + f"/f{i}": rng.randrange(5) for i in range(n)}


def frame(spark, rows):
    return spark.createDataFrame([(f"/{p}", v) for p, v in rows], "path string, v int")


def changed(old, new):
    return sorted((p, "missing" if p not in new else "new" if p not in old else "changed") for p in old.keys() | new.keys() if old.get(p) != new.get(p))


def test_differences_equal_the_full_join(spark):
    rng = random.Random(4)
    old = files(rng)
    new = {p: v for p, v in old.items() if rng.random() > 0.02} | {"zz/new/x": 1, "a1": 7}
    for p in rng.sample(sorted(new), 6):
        new[p] = 9
    a, b = (hashtree.build(frame(spark, x.items()), "path", ["v"]) for x in (old, new))
    found, _ = hashtree.differences(a, b)
    assert sorted(map(tuple, found.collect())) == changed(old, new)
    assert a.filter("leaf").count() == len(old) and a.filter("parent is null").agg(F.sum("n")).first()[0] == len(old)


def test_only_folders_that_differ_are_gone_into(spark):
    old = {f"d{i}/e{j}/f{k}": 1 for i in range(10) for j in range(10) for k in range(10)}
    new = old | {"d3/e4/f5": 2}
    a, b = (hashtree.build(frame(spark, x.items()), "path", ["v"]) for x in (old, new))
    found, compared = hashtree.differences(a, b)
    assert [tuple(r) for r in found.collect()] == [("d3/e4/f5", "changed")] and compared == [10, 10, 10]
    assert hashtree.differences(a, a)[1] == [10]


def test_repeated_null_and_empty_paths(spark):
    a = hashtree.build(spark.createDataFrame([("a//b/", 1), ("a/b", 1), (None, 3), ("/", 4), ("c", None)], "path string, v int"), "path", ["v"])
    b = hashtree.build(spark.createDataFrame([("a/b", 1), ("c", 0), ("c/d", 1)], "path string, v int"), "path", ["v"])
    got = sorted(map(tuple, hashtree.differences(a, b)[0].collect()))
    assert got == [("a/b", "changed"), ("c", "changed"), ("c/d", "new")]
    none = hashtree.build(spark.createDataFrame([], "path string, v int"), "path", ["v"])
    assert hashtree.differences(none, none)[0].count() == 0 and hashtree.differences(none, b)[0].count() == 3


def paths(rng, n):
    part = lambda: rng.choice(["a", "b", "a-b", "a b", "ab", "é", "a.b"])
    return ["/".join(part() for _ in range(rng.randrange(1, 5))) for _ in range(n)]


@pytest.mark.parametrize("sep", ["/", None])
def test_covering_equals_all_pairs(spark, sep):
    rng = random.Random(8)
    texts, listed = paths(rng, 300) + [None, "", "a/"], set(paths(rng, 40)) | {"a", "", None}
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("_p", F.lit("clash")).repartition(7)
    got = {r.i: (r.within, r._p) for r in covering(rows, "t", spark.createDataFrame([(p,) for p in listed], "p string"), "p", sep).collect()}
    for i, t in enumerate(texts):
        want = [p for p in sorted(x for x in listed if x) if t is not None and (t == p or t.startswith(p + "/") if sep else t.startswith(p))]
        assert got[i] == (want, "clash"), t


def test_nesting_equals_all_pairs(spark):
    rng = random.Random(9)
    listed = set(paths(rng, 200))
    df = spark.createDataFrame([(p,) for p in [*listed, *listed, None, ""]], "path string").repartition(5)
    want = sorted((a, b) for a in listed for b in listed if b.startswith(a + "/"))
    assert sorted(map(tuple, nesting(df, "path").collect())) == want == sorted(map(tuple, inventory.nested(df.withColumn("path", F.concat("path", F.lit("/")))).collect()))


def test_a_path_is_shuffled_as_often_whatever_its_depth(spark):
    """Rows that the ranges hold: one for each path, none for its ancestors."""
    deep = spark.range(100).select(F.concat(F.lit("a/" * 40), F.col("id").cast("string")).alias("path"))
    assert ranged(deep, ["path"], []).count() == 100
    plan = nesting(deep, "path")._jdf.queryExecution().optimizedPlan().toString()
    assert "_again" in plan and nesting(deep, "path").count() == 0

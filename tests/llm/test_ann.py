import numpy as np
import pytest

from tidewell.llm import ann, queries


def brute(ids, x, q, k=10):
    d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
    d[ids == q] = np.inf
    order = np.lexsort((ids, d))[:k]
    return [(int(ids[i]), d[i]) for i in order if np.isfinite(d[i])]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in queries.op9_nearest_neighbours(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = 0
    for q in ids[ids % 100 == 0]:
        want = brute(ids, x, q)
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 11)) and [m[1:] for m in mine] == sorted((m[1:] for m in mine), key=lambda m: (m[1], m[0]))
        for _, v, s in mine:
            assert abs(s - np.linalg.norm(x[ids == v][0] - x[ids == q][0])) < 1e-12
        hit += len({w[0] for w in want} & {m[1] for m in mine}) / len(want)
    assert hit / len(got) >= 0.9 and set(got) == set(ids[ids % 100 == 0].tolist())


def test_odd_rows(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(60)] + [(3, [3.0, 1.0])] * 3 + [(100, None), (101, [0.0, 0.0]), (102, [float("nan"), 1.0]), (103, [None, 1.0]), (104, [1.0]), (None, [1.0, 1.0]), (105, []), (106, [float("inf"), 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as v", "3 as part")
    got = ann.search(df, df.filter("vec_id < 2"), k=3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 7, 0.0), (0, 2, 14, 0.0), (0, 3, 21, 0.0), (1, 1, 8, 0.0), (1, 2, 15, 0.0), (1, 3, 22, 0.0)]
    few = df.filter("vec_id < 3")
    assert [r.vec_id for r in ann.search(few, few.filter("vec_id = 0"), k=10).orderBy("rank").collect()] == [1, 2]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0
    assert ann.search(df, df.limit(0)).count() == 0


def test_other_lengths_are_searched_too(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(1000 + i, rng.normal(size=3 + i % 2).tolist()) for i in range(80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(df, df.filter("vec_id in (1000, 1001, 1050)"), k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q in (1000, 1001, 1050):
        same = [(i, v) for i, v in rows if len(v) == len(dict(rows)[q])]
        ids, x = np.array([i for i, _ in same]), np.array([v for _, v in same])
        want = brute(ids, x, q, 5)
        assert [i for i, _ in got[q]] == [i for i, _ in want] and np.allclose([s for _, s in got[q]], [s for _, s in want])


def test_parts_follow_the_data(monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(64, 16)) * 6
    x = centres[rng.integers(64, size=4096)] + rng.normal(size=(4096, 16))
    for parts in (16, 64):
        router, probes = ann.fit(x, parts)
        assert probes <= parts // 4  # with structure few parts are probed


def test_hot_vector_is_spread(spark):
    df = spark.range(12000).selectExpr("id as vec_id", "if(id % 3 = 0, array(1D, 1D, 1D, 1D), array(cos(id), sin(id), cos(id * 7), sin(id * 3))) as embedding")
    got = ann.search(df, df.filter("vec_id = 0")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(3 * k, 0.0) for k in range(1, 11)]

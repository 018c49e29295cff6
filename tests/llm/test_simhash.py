import random
import re

import numpy as np
import pytest
import xxhash

from tidewell.llm import simhash

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not words:
        return 0
    runs = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fs = sorted(parent)
    for i, a in enumerate(fs):
        for b in fs[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {f: root(f) for f in fs}


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "one TWO", "É b\x0bc d É b c d", "a " * 70000, "x y z w"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain(text)


def test_levels_cover_every_pair():
    rng = random.Random(5)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(1, 4)):
            b ^= 1 << bit
        for embedded, masks, _ in simhash.LEVELS:
            x, y = (a, b) if not embedded else (therm(a), therm(b))
            assert any((x ^ y) & m == 0 for m in masks)


def therm(x):
    low, high = x & simhash._EVEN, x >> 1 & simhash._EVEN
    return low | high | (low & high) << 1


@pytest.mark.parametrize("hot", [1, 6, 512])
def test_links_and_components(spark, hot):
    rng = random.Random(hot)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for f in list(fps[:20]):
        for _ in range(rng.randrange(12)):
            g = rng.choice([f, fps[-1]])
            for bit in rng.sample(range(64), rng.randrange(1, 5)):
                g ^= 1 << bit
            fps.append(g)
    fps += [0, 1, 1 << 63, (1 << 63) | 7]
    signed = lambda x: (x ^ (1 << 63)) - (1 << 63)
    want = plain_components(fps)
    df = spark.createDataFrame([(signed(f),) for f in set(fps)], "fp long")
    edges = simhash.links(df, hot)
    assert all(((r.u ^ r.v) & (2**64 - 1)).bit_count() <= 3 for r in edges.collect())
    got = {r.node: r.label for r in simhash.components(edges).collect()}
    groups = {}
    for f in set(fps):
        groups.setdefault(want[f], set()).add(signed(f))
    for members in groups.values():
        assert {got.get(m, m) for m in members} == {min(members)}


def test_documents(spark):
    base = "the quick brown fox jumps over the lazy dog again and again while nobody looks " * 20
    rows = [(5, base), (3, base), (9, base + "end"), (4, None), (8, ""), (2, "unlike any other text here"), (None, base), (2, "unlike any other text here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as fp", "1 as first", "2 as label")
    got = [(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(df).collect()]
    comp = plain_components([plain(t) for _, t in rows])
    want = [(i, plain(t), min(j for j, u in rows if j is not None and comp[plain(u)] == comp[plain(t)])) for i, t in rows]
    key = lambda x: (x[0] or 0, x[1])
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = simhash.keep_one(df).collect()
    assert sorted(r.doc_id for r in kept) == sorted({w[2] for w in want}) and kept[0].__fields__ == df.columns
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    a, b = "the quick brown fox jumps over the lazy dog " * 9, "nothing of the kind stands in this text at all " * 7
    rows = [(3, a, "x"), (5, a, "y"), (5, b, "z"), (3, a, "x"), (None, b, "n"), (None, "only here, without an id, once or twice", "m"), (None, "only here, without an id, once or twice", "m")]
    df = spark.createDataFrame(rows, "doc_id long, text string, th string")
    got = sorted((r.doc_id is None, r.doc_id, r.text, r.th) for r in simhash.keep_one(df).collect())
    assert got == [(False, 3, a, "x"), (False, 5, b, "z"), (True, None, rows[5][1], "m")]
    assert simhash.keep_one(df.withColumn("doc_id", df.doc_id.cast("string"))).count() == 3


def test_forest_spans_dense_cells():
    rng = np.random.default_rng(1)
    fps = [int(x) for x in rng.choice(1 << 12, 800, replace=False)]
    edges = simhash.forest(fps)
    comp = plain_components(fps)
    assert len(edges) == len(fps) - len(set(comp.values()))

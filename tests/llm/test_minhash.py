import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import minhash, queries
from tidewell.sources.tables import read_table

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text, size=2):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def plain(rows, size=2, percent=80):
    """(id, set size, component) by comparing all pairs."""
    sets = [plain_set(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc_id)
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return [(doc_id, len(s), least[root(i)]) for i, ((doc_id, _), s) in enumerate(zip(rows, sets))]


def edited(rng, words, share):
    return [rng.choice("pqrstuvw") + str(rng.randrange(10**6)) if rng.random() < share else w for w in words]


def corpus(seed, groups=25):
    """Copies of several texts with edits around the bound, a passage in many texts, a hot pair of words, short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, passage = [], rng.choices(vocabulary, k=60)
    for _ in range(groups):
        words = rng.choices(vocabulary, k=rng.choice([3, 5, 12, 40, 70, 150, 400]))
        for _ in range(rng.choice([1, 2, 6, 14])):
            rows.append(" ".join(edited(rng, words, rng.choice([0, 0.02, 0.05, 0.08]))))
    rows += [" ".join(passage + rng.choices(vocabulary, k=rng.choice([0, 8, 12, 40, 300]))) for _ in range(40)]
    rows += [f"same start {rng.choice(vocabulary)} {rng.choice('xy')}" for _ in range(60)]
    rows += [None, "", " \n", "one", "ONE", "two words", "Two  words", rows[0], rows[0].upper()]
    rng.shuffle(rows)
    return [(k * 3 + 1, t) for k, t in enumerate(rows)]


def found(df, **how):
    return sorted((tuple(r) for r in minhash.near_duplicates(df, **how).collect()), key=str)


@pytest.mark.parametrize("short,cell", [(0, 4), (1, 512), (32, 512)])
def test_equals_all_pairs(spark, short, cell):
    rows = corpus(cell + short)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x")).withColumn("label", F.lit(1)).withColumn("value", F.lit(2))
    assert found(df, size=2, short=short, cell=cell) == sorted(plain(rows), key=str)


def test_five_words_and_repeated_and_null_ids(spark):
    rows = corpus(5, 8)
    rows += [rows[0], rows[0], (rows[1][0], "something else entirely in this one"), (None, rows[2][1]), (None, "nobody has this text but these rows here"), (None, "nobody has this text but these rows here")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(plain(rows, 5), key=str)


def test_a_star_of_copies_that_only_link_to_their_original(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(edited(rng, words, 0.045)) for _ in range(60)]
    texts.insert(31, " ".join(words))
    rows = [(k, t) for k, t in enumerate(texts)]
    want = plain(rows)
    assert sum(c == 0 for _, _, c in want) > 50
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), size=2) == sorted(want, key=str)


@pytest.mark.parametrize("cell", [6, 512])
def test_refined_lists_find_every_link(spark, cell):
    rng = random.Random(cell)
    texts = [t for _, t in corpus(cell, 12) if t] + [" ".join(edited(rng, [f"v{k}" for k in range(90)], rng.choice([0.02, 0.06, 0.12, 0.2]))) for _ in range(60)]
    sets = sorted({tuple(s) for s in (x.tolist() for x in minhash.shingles(texts, 2)) if s})
    df = spark.createDataFrame([(k, list(s), minhash.full_map(np.array(s)).tolist()) for k, s in enumerate(sets)], "cid long, set array<long>, map array<long>")
    got = {tuple(r) for r in minhash._verified(minhash._meet_refined(minhash.refined(df, 80), df, spark.createDataFrame([], "node long, label long"), 80, cell), df, 80).collect()}
    full = [set(s) for s in sets]
    assert got == {(i, j) for j in range(len(full)) for i in range(j) if 100 * len(full[i] & full[j]) >= 80 * len(full[i] | full[j])}


def test_maps_bound_what_is_lacking():
    rng = np.random.default_rng(5)
    for n in (1, 50, 3000):
        a, b = (np.unique(rng.integers(-(2**62), 2**62, n)) for _ in range(2))
        b = np.union1d(a[: n // 2], b)
        x, y = minhash.full_map(a).view(np.uint64), minhash.full_map(b).view(np.uint64)
        assert np.bitwise_count(x & ~y).sum() <= np.setdiff1d(a, b).size and np.bitwise_count(x).sum() <= a.size


def test_least_shared():
    rng = np.random.default_rng(3)
    t = minhash.least_shared()
    assert 20 < t < 36 and rng.binomial(64, 0.8, 200_000).min() >= t


def test_query_keeps_one_of_each_component(spark, sf):
    docs = read_table(spark, sf, "documents")
    got = queries.op13_minhash(spark, sf).collect()
    want = {(i, n, c) for i, n, c in plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])}
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == want and all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0

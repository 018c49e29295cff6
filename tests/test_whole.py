"""Queries over whole tables: rows that a filter on ids or sizes would hide."""

import re

import pytest

from tidewell.plans import registry


def run(spark, path, name, table, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{table}.parquet")
    return registry.QUERIES[name](spark, str(path))


def test_containment_sees_short_lines(spark, tmp_path):
    long = "a line of more than twenty characters"
    rows = [(1, f"{long}\nshort"), (2, f"{long}\nother\nother"), (3, f"{long}\nshort\n"), (4, "short")]
    got = run(spark, tmp_path, "multiset_containment", "documents", rows, "doc_id long, text string").collect()
    assert sorted((r.a, r.b, r.a_in_b, r.b_in_a, r.unmatched) for r in got) == [(1, 2, False, False, 2), (1, 3, True, False, 1), (2, 3, False, False, 2)]


def test_components_and_groups_see_every_document(spark, tmp_path):
    schema = "doc_id long, source string, lang string, n_chars long"
    rows = [(2, "a", "en", 10), (4, "b", "en", 410), (1, "b", "de", 20), (6, "c", "de", 420), (3, "d", "fr", 30)]
    got = run(spark, tmp_path / "c", "chained_components", "documents", rows, schema).collect()
    assert sorted(map(tuple, got)) == [("a", "a"), ("b", "a"), ("c", "a")]
    rows = [(1, 1, "A", "F"), (1, 2, "A", "O"), (2, 1, "A", "F"), (2, 2, "A", "F"), (3, 1, "N", "O"), (3, 1, "N", "O"), (3, 2, "N", "O"), (5, 1, "N", "O")]
    got = run(spark, tmp_path / "d", "differing_groups", "lineitem", rows, "l_orderkey long, l_linenumber int, l_returnflag string, l_linestatus string").collect()
    assert sorted(map(tuple, got)) == [(1,), (3,)]


def test_aliases_order_and_comparison_see_every_row(spark, tmp_path, sf):
    rows = [(201, 7), (204, 7), (205, 7), (301, 8), (341, 9)]
    got = run(spark, tmp_path, "alias_pairs", "supplier", rows, "s_suppkey long, s_nationkey long").collect()
    assert sorted(map(tuple, got)) == [(201, 204, "path"), (201, 205, "path"), (204, 205, "path"), (301, 341, "inode")]
    count = lambda name: spark.read.parquet(f"{sf}/{name}.parquet").count()
    assert registry.QUERIES["hash_order"](spark, sf).count() == count("customer")
    assert registry.QUERIES["volume_compare"](spark, sf).count() == count("embeddings") - 1


def test_touched_components_come_whole(spark):
    from tidewell.operators import graph

    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (7, 6)], "node long, label long")
    touched = spark.createDataFrame([(2,), (3,), (7,), (99,), (None,)], "k long")
    assert sorted(map(tuple, graph.touched_components(labels, touched, "k").collect())) == [(1, 1), (2, 1), (3, 1), (6, 6), (7, 6)]


def test_settings_of_keys_whose_digits_name_a_label(spark, tmp_path):
    from tests.oracle import same

    keys = [0, 1, 2, 568, 1647, 2568, 5680, 5682, 6470, 6471, 16470, 900647, 10**12 + 5680]
    got = run(spark, tmp_path, "sample_settings", "customer", [(k,) for k in keys], "c_custkey long")
    assert {r.c_custkey for r in got.filter("source = 'folder name'").collect()} >= {1647, 2568, 5682}
    same(got, registry.ORACLES["sample_settings"], str(tmp_path))


@pytest.mark.parametrize("name", ["size_candidate_pairs", "multiset_containment", "alias_pairs"])
def test_pairs_are_not_shuffled(spark, sf, name):
    """What the join of pairs gives goes through no exchange, aggregation or further join."""
    lines = registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if re.search(r"Join .*\(\w+#\d+L < \w+#\d+L\)", line))
    depth, above = lines[at].index("+-"), []
    for line in reversed(lines[1:at]):
        if "+-" in line and line.index("+-") < depth:
            depth = line.index("+-")
            above.append(line[depth:].split()[1])
    assert set(above) <= {"Project", "Union"}, above


def test_pairs_of_a_size_in_blocks(spark, monkeypatch):
    from tidewell.operators import dedup

    monkeypatch.setattr(dedup, "BLOCK", 7)
    rows = [(k, 50 + k % 3) for k in range(40)] + [(k, 60) for k in range(0, 40, 2)] + [(k, 100 + k) for k in range(0, 40, 5)] + [(k, 45) for k in range(40)]
    sets, total = {}, {}
    for k, s in rows:
        sets.setdefault(k, set()).add(s)
        total[k] = total.get(k, 0) + s
    got = dedup.candidate_pairs(spark.createDataFrame(rows, "k long, s long"), "k", "s", 46, 0.5)
    have = {k: {s for s in v if s >= 46} for k, v in sets.items()}
    want = sorted((a, b, sum(have[a] & have[b])) for a in have for b in have if a < b and sum(have[a] & have[b]) >= 0.5 * min(total[a], total[b]))
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_pairs_that_cannot_hold_are_told_by_bits(spark, monkeypatch):
    """Most met pairs whose sizes don't sum up are known by their masks; none that holds is lost, of few sizes or many."""
    import random

    from pyspark.sql import functions as F
    from tidewell.operators import dedup

    pick, sets = random.Random(4), {}
    for k in range(160):
        sets[k] = set(pick.sample(range(46, 130), pick.choice([1, 2, 3, 5, 6, 9, 25, 70])))
        if k % 8 == 7:
            sets[k] = set(pick.sample(sorted(sets[k - 1]), 1 + len(sets[k - 1]) * 2 // 3)) | {200 + k}
    met, meet = {}, dedup.meet
    monkeypatch.setattr(dedup, "meet", lambda x, y, on, condition: met.update(x=x, y=y) or meet(x, y, on, condition))
    got = dedup.candidate_pairs(spark.createDataFrame([(k, s) for k, v in sets.items() for s in v], "k long, s long"), "k", "s", 46, 0.5)
    want = sorted((a, b, sum(sets[a] & sets[b])) for a in sets for b in sets if a < b and sum(sets[a] & sets[b]) >= 0.5 * min(sum(sets[a]), sum(sets[b])))
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100
    rows = meet(met["x"], met["y"], "i", F.col("x.k") != F.col("y.k")).select((dedup._common_bits() >= F.col("x.need")).alias("may"), F.col("x.t").alias("t"), F.array_intersect("x.rest", "y.rest").alias("common")).collect()
    holds = [(r.may, sum(r.common) >= 0.5 * r.t) for r in rows]
    assert all(may for may, hold in holds if hold)
    told = [not may for may, hold in holds if not hold]
    assert sum(told) > 0.8 * len(told) > 1000


def test_containment_of_classes_in_parts_and_blocks(spark, monkeypatch):
    """Copies, classes that share a file, null digests and keys, files in several copies; tables are read once, before pairs are met."""
    import random
    from collections import Counter

    from tidewell.operators import dedup

    monkeypatch.setattr(dedup, "CLASS", 3)
    monkeypatch.setattr(dedup, "MEMBERS", 5)
    pick, bags = random.Random(5), {}
    for k in range(60):
        bags[k] = ["hot"] * (k % 7 != 0) + [f"f{pick.randrange(9)}" for _ in range(k % 4)] + [f"own{k}"] * (k % 5 == 0) + ["mute"] * (k % 3)
        if k % 6 == 5:
            bags[k] = [*bags[k - 2]]
        if k % 17 == 16:
            bags[k].append(None)
    bags[100] = bags[101] = bags[102] = bags[103] = [f"copy{i}" for i in range(12)] + ["copy0"]
    rows = [(k, s) for k, v in bags.items() for s in v] + [(None, "hot"), (None, "hot")]
    files = spark.createDataFrame(rows, "k long, s string")
    got = dedup.sharing_containment(files, "k", ["s"], files.s != "mute")
    want, whole = [], {k: Counter(s for s in v if s is not None) for k, v in bags.items()}
    for a in bags:
        for b in bags:
            if a < b and (set(whole[a]) & set(whole[b])) - {"mute"}:
                both, known = sum((whole[a] & whole[b]).values()), None not in bags[a] and None not in bags[b]
                want.append((a, b, known and both == len(bags[a]), known and both == len(bags[b]), len(bags[b]) - both))
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 1000
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in text and "ExistingRDD" not in text

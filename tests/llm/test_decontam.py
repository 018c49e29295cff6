import random
import re

import pytest

from tests.oracle import same
from tidewell.llm import decontam, queries

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOW))


def brute(docs, items, n):
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, it in items:
            x = words(it)
            wins = {tuple(x[i : i + n]) for i in range(max(1, len(x) - n + 1))} if x else set()
            for i in range(len(w)):
                for win in wins:
                    if tuple(w[i : i + len(win)]) == win:
                        hit.update(range(i, i + len(win)))
                        if item_id is not None:
                            found.add(str(item_id))
        yield doc_id, len(w), len(hit), sorted(found)


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(3)
    pool = ["Ab", "c", "É", "漢", "x1", "zz"]
    docs = [(i, " ".join(r.choice(pool) for _ in range(r.randrange(0, 60)))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, "!!"), (5, docs[5][1]), (None, "c c c"), (63, "ab, C; É\n漢 " * 400)]
    items = [(i, " ".join(r.choice(pool) for _ in range(r.randrange(1, 9)))) for i in range(12)] + [(12, None), (13, ""), (None, "zz zz zz zz"), (2, "c c c")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'q' as item_id", "1 as n_words", "2 as row", "3 as window")
    return docs, items, d, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("bound", [decontam.MAX_BROADCAST, 0])
def test_scan_equals_brute_force(tables, bound):
    docs, items, d, b = tables
    got = decontam.scan(d, b, n=4, max_broadcast=bound).collect()
    key = lambda x: (x[0] or -1, x[1:])
    assert sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got], key=key) == sorted(brute(docs, items, 4), key=key)


def test_empty_tables(tables):
    _, _, d, b = tables
    assert decontam.scan(d.limit(0), b).count() == 0
    assert decontam.scan(d, b.limit(0)).filter("n_hit > 0").count() == 0


def test_spans_and_drop(spark):
    text = "start É one two. THREE four five tail"
    d = spark.createDataFrame([(1, text), (2, "clean text"), (3, None)], "doc_id long, text string")
    b = spark.createDataFrame([(9, "one two three four five")], "item_id long, text string")
    row = decontam.scan(d, b, n=4).filter("doc_id = 1").first()
    assert decontam.cut_spans(text, [tuple(s) for s in row.spans]) == "start É  tail"
    assert sorted(r.doc_id for r in decontam.drop_contaminated(d, b, n=4).collect()) == [2, 3]


def test_shuffled_way_gives_the_same_spans(tables):
    _, _, d, b = tables
    got = [[(r.doc_id, r.n_words, r.n_hit, list(r["items"]), [tuple(s) for s in r.spans]) for r in decontam.scan(d, b, n=4, max_broadcast=k).collect()] for k in (decontam.MAX_BROADCAST, 0)]
    assert any(x[4] for x in got[0])
    assert sorted(map(repr, got[0])) == sorted(map(repr, got[1]))


@pytest.mark.parametrize("bound", [decontam.MAX_BROADCAST, 0])
def test_rows_are_dropped_for_themselves(spark, bound):
    text = "start É one two. THREE four five tail"
    rows = [(1, text), (1, "clean"), (2, "clean"), (2, "clean"), (None, text), (None, "clean"), (None, None), (3, text)]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "2 as doc")
    b = spark.createDataFrame([(9, "one two three four five")], "item_id long, text string")
    out = decontam.drop_contaminated(d, b, n=4, max_broadcast=bound)
    assert out.columns == d.columns
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(repr((*r, 1, 2)) for r in rows if r[1] != text)
    spans = decontam.scan(d, b, n=4, max_broadcast=bound).filter("doc_id = 3").first().spans
    assert decontam.cut_spans(text, [tuple(s) for s in spans]) == "start É  tail"


def test_oracle(spark, sf):
    same(queries.QUERIES["op8_decontamination"](spark, sf), queries.ORACLES["op8_decontamination"], sf)

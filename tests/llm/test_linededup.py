import pytest

from tests.oracle import same
from tidewell.llm import linededup, queries


def plain(docs, size=3):
    places = {}
    for i, t in docs:
        x = t.split("\n") if t is not None else []
        for p in range(len(x) - size + 1):
            if any(s.strip(" ") for s in x[p : p + size]):
                places.setdefault(tuple(x[p : p + size]), []).append((i, p))
    gone = {(i, p + k) for at in places.values() for i, p in sorted(at)[1:] for k in range(size)}
    return {i: t if t is None else "\n".join(s for p, s in enumerate(t.split("\n")) if (i, p) not in gone) for i, t in docs}


@pytest.fixture(scope="module")
def docs():
    return [
        (1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "b\nc\nd\na\nb\nc"), (4, None), (5, ""), (6, "a\nb"), (7, "a\na\na\na\na"),
        (8, "\n\n\n\nq"), (9, "\n\n\n\nr"), (10, "a\nb\nc\nd"), (11, "\n".join(f"l{k}" for k in range(3000))), (12, "\n".join(f"l{k}" for k in range(500, 3500))),
    ]


def test_equals_brute_force(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as id", "2 as th", "3 as pos", "4 as starts", "5 as n", "6 as row", "7 as kept", "8 as n_lines_", "9 as l", "10 as h", "11 as i", "12 as t")
    got = linededup.dedup_lines(df).collect()
    assert {r.doc_id: r.text for r in got} == plain(docs)
    assert all((r.n_lines_ - r.n_removed_) == (0 if not r.text and r.n_removed_ else len(r.text.split("\n"))) for r in got if r.text is not None)
    assert linededup.dedup_lines(df.limit(0)).count() == 0


def test_repeated_rows_are_one_place(spark):
    df = spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "p\nq\nr"), (2, "p\nq\nr")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in linededup.dedup_lines(df).collect()) == [(0, "p\nq\nr"), (1, "a\nb\nc"), (1, "a\nb\nc"), (2, "")]


def test_oracle(spark, sf):
    same(queries.QUERIES["op5_line_dedup"](spark, sf), queries.ORACLES["op5_line_dedup"], sf)

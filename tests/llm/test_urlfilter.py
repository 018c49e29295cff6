from datetime import datetime

import pytest

from tests.oracle import same
from tidewell.llm import queries, urlfilter

ENTRIES = [
    ("host", "b.com", "add", "2024-01-10"), ("host", "b.com", "remove", "2024-02-01"), ("host", "b.com", "add", "2024-03-01"), ("host", "b.com", "add", "2024-03-01"),
    ("host", "a.b.com", "add", "2024-01-15"), ("path", "c.org/x/y", "add", "2024-01-01"), ("path", "C.org/Up", "add", "2024-01-01"), ("host", "same.net", "add", "2024-01-01"), ("host", "same.net", "remove", "2024-01-01"),
    ("host", None, "add", "2024-01-01"), ("host", "UP.com", "add", "2024-01-01"), ("path", "deep.net/" + "/".join("q" * 90), "add", "2024-01-01"),
]


@pytest.mark.parametrize(
    "url,day,want",
    [
        ("http://b.com/", "2024-01-09", None), ("http://b.com/", "2024-01-10", "b.com"), ("https://u@Z.B.com:80/q", "2024-01-31", "b.com"), ("http://b.com", "2024-02-01", None),
        ("http://b.com?x", "2024-05-01", "b.com"), ("http://a.b.com./", "2024-01-20", "a.b.com"), ("http://xb.com/", "2024-01-20", None), ("http://c.org/x/y/z?q#f", "2024-06-01", "c.org/x/y"),
        ("http://c.org/x", "2024-06-01", None), ("http://c.org/Up/z", "2024-06-01", "c.org/Up"), ("http://c.org/up/z", "2024-06-01", None), ("http://c.org/x/yy", "2024-06-01", None), ("http://same.net", "2024-06-01", None), (None, "2024-06-01", None), ("", "2024-06-01", None), ("not a url", "2024-06-01", None),
        ("http://b.com/", None, None), ("http://up.com/" + "p/" * 3000, "2024-06-01", "up.com"),
        ("http://deep.net/" + "q/" * 95, "2024-06-01", "deep.net/" + "/".join("q" * 90)), ("http://deep.net/" + "q/" * 89, "2024-06-01", None),
    ],
)
def test_as_of(spark, url, day, want):
    row = next(r for r in _all(spark) if (r.url, r.fetched) == (url, day and datetime.fromisoformat(day)))
    assert row.key == want and row.blocked == (want is not None)


_CACHE = []


def _all(spark):
    if not _CACHE:
        cases = [m for m in test_as_of.pytestmark if m.name == "parametrize"][0].args[1]
        caps = spark.createDataFrame([(i % 7 or None, u, d and datetime.fromisoformat(d)) for i, (u, d, _) in enumerate(cases + cases[:2])], "page_id long, url string, fetched timestamp").selectExpr("*", "'k' as key", "1 as weight", "'z' as since")
        entries = spark.createDataFrame([(k, x, a, datetime.fromisoformat(s)) for k, x, a, s in ENTRIES], "kind string, key string, action string, since timestamp")
        _CACHE.extend(urlfilter.evaluate(caps, entries).collect())
        assert len(_CACHE) == len(cases) + 2
        assert urlfilter.evaluate(caps.limit(0), entries).count() == 0
        assert urlfilter.evaluate(caps, entries.limit(0)).filter("blocked").count() == 0
    return _CACHE


def test_oracle(spark, sf):
    same(queries.QUERIES["op2_url_filter"](spark, sf), queries.ORACLES["op2_url_filter"], sf)

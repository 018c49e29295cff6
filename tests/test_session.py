"""Intermediate tables go when their reader is done."""

import os

from tidewell.session import materialise, scratch


def there(df):
    return os.path.exists(df._tidewell_path.removeprefix("file://"))


def test_scratch_keeps_what_it_is_told(spark):
    with scratch() as outer:
        with scratch() as inner:
            a, b = materialise(spark.range(3), "a"), materialise(spark.range(3), "b")
            inner.append(b)
        assert not there(a) and there(b)
        c = materialise(spark.range(3), "c")
        outer.append(c)
    assert not there(b) and there(c) and c.count() == 3


def test_scratch_cleans_up_after_an_error(spark):
    try:
        with scratch():
            a = materialise(spark.range(3), "a")
            raise ValueError
    except ValueError:
        pass
    assert not there(a)

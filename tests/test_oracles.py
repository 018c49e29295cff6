import pytest

from tests.oracle import same
from tidewell.plans import registry


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, sf, name):
    df = registry.QUERIES[name](spark, sf)
    if name in registry.ORACLES:
        same(df, registry.ORACLES[name], sf)
    else:
        assert df.count() > 0

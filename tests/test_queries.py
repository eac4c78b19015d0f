"""Every registered query of the engine against its SQL; those without SQL must run and give rows."""

import pytest
from tests.conftest import SF, same

from tideframe.plans import registry


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    if name in registry.ORACLE_SQL:
        same(df, duck.sql(registry.ORACLE_SQL[name]))
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "log_return" in df.columns
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

"""Every query with an oracle gives DuckDB's rows; those without give rows."""

import pytest
from conftest import SF, same_rows

from spanlake.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_duckdb(spark, duck, name):
    assert same_rows(registry.QUERIES[name](spark, SF), duck.sql(registry.ORACLES[name]))


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_gives_rows(spark, name):
    assert registry.QUERIES[name](spark, SF).limit(1).count() == 1


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

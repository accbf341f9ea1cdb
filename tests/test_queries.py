import pytest
from compare import duckdb_rows, rows_of

from sheafwork import registry
from sheafwork.plans import catalog_queries  # noqa: F401


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_same_rows_as_sql(spark, sf_dir, name):
    got = rows_of(registry.QUERIES[name](spark, sf_dir).toPandas())
    assert got == duckdb_rows(registry.ORACLES[name], sf_dir)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

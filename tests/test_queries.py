"""Every query against its DuckDB SQL on the smallest tables."""

import pytest

from canvass.plans import catalog

from .oracle import difference


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_matches_sql(spark, sf_dir, name):
    assert difference(spark, catalog.QUERIES[name], catalog.ORACLE_SQL[name], sf_dir) == ""


def test_all_but_the_solver_have_sql():
    assert set(catalog.QUERIES) - set(catalog.ORACLE_SQL) == {"exact_partition"}


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns[0] == "area" and df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())

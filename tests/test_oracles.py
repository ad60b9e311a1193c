"""Every linkage query that has SQL gives the same rows as DuckDB; the others run."""

import pytest

from kinfold.plans.queries import QUERIES, SQL

SLOW = {"gbt_score", "pair_features_all"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(name, spark, sf, duck, same):
    same(QUERIES[name](spark, sf).toPandas(), duck(SQL[name]))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_runs(name, spark, sf):
    assert QUERIES[name](spark, sf).count() > 0


def test_columns_without_tables_of_other_packages():
    import __spark_entry__ as entry

    assert set(SQL) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())

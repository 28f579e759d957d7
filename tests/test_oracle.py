"""Every registered query against its SQL twin on the whole given tables."""

import pytest
from oracle import connect, difference

import __spark_entry__ as entry

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    """Those of the corpus package are tested with it, some against brute force."""
    assert set(entry.queries()) - set(entry.CORPUS) == set(SQL) - set(entry.CORPUS)
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(SQL) - set(entry.CORPUS)))
def test_matches_sql(spark, sf_dir, duck, name):
    ours = entry.queries()[name](spark, sf_dir)
    assert difference(ours, duck.execute(SQL[name])) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 20

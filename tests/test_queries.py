"""Every registered query against its SQL counterpart, or run in full where none exists."""

import oracle
import pytest

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, sf_dir, con, name):
    assert oracle.differences(contract.queries()[name](spark, sf_dir), con, contract.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_runs_without_sql(spark, sf_dir, name):
    assert contract.queries()[name](spark, sf_dir).count() > 0


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_gives_the_whole_grid(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 100 and sum(r.n for r in rows) > 0

"""Every registered query against the same query in SQL."""

import compare
import pytest

import __spark_entry__ as entry
from changeloom.plans.oracle import ORACLE
from changeloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == []


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())

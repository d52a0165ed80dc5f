"""Every registered query against its DuckDB oracle on the smallest driver tables, plus a
check that none goes without.  (The driver repeats the oracle comparison at sf0.01.)"""

import pytest

import __spark_entry__ as E
from tessera.plans.registry import QUERIES as BASE
from tools.check_oracle import compare, duck_connect

from .conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


def test_every_oracle_key_is_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_every_query_has_an_oracle():
    assert set(BASE) == set(BASE) & set(ORACLE)


def test_entry_is_the_flagship(spark, duck):
    n, issues = compare(E.entry(spark), duck, ORACLE["category_revenue_year"])
    assert n > 0 and not issues, issues


@pytest.mark.parametrize("key", sorted(set(ORACLE) & set(BASE)))
def test_query_matches_oracle(spark, duck, key):
    n, issues = compare(QUERIES[key](spark, SF_SMALL), duck, ORACLE[key])
    assert not issues, issues

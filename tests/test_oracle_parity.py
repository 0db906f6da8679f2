"""Every registered query with an oracle agrees with DuckDB (sf0.001)."""

import pytest

from tests.conftest import SF_SMALL
from penmark.plans.catalog import ORACLE, QUERIES, load_all
from tests.oracle import compare, duck

load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), ORACLE[name], con)
    assert ok, msg


def test_every_query_has_a_callable():
    assert set(ORACLE) <= set(QUERIES)

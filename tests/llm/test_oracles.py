"""Queries with SQL equal it on the whole tables."""

import pytest

from penmark.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    ok, why = compare(QUERIES[name](spark, SF_SMALL), ORACLE[name], duck(SF_SMALL))
    assert ok, why

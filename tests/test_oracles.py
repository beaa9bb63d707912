"""Every query of the library against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import difference, oracle
from conftest import SF

from chronoweave.plans.registry import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert not difference(QUERIES[name](spark, SF).toPandas(), oracle(ORACLE_SQL[name], SF))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0

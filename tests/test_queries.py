import os

import pytest

from compare import DATA, connect, same
from corpusmill.plans import catalog

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    same(spark, duck, catalog.queries()[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(SQL) - {"vec_v6_kmeans_sweep"}))
def test_query_without_sql_has_rows(spark, name):
    assert catalog.queries()[name](spark, DATA).count() > 0

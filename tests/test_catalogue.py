import pytest

from conftest import SF
from onoma.plans import catalogue
from oracle import connect, same


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_sql(spark, con, name):
    same(spark, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name], SF, con)

import pytest

from chatnorm.queries import all_queries, all_sql
from oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_sql(spark, duck, name):
    mine = all_queries()[name](spark, SF_DIR).toPandas()
    assert differences(mine, duck.execute(all_sql()[name]).df()) is None

import pytest

from colloquy.plans import registry
from tests.oracle import connect, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_rows_as_sql(spark, con, name):
    assert rows(registry.QUERIES[name](spark, SF).toPandas()) == rows(con.execute(registry.ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_other_queries_run(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0

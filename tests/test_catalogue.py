import pytest

from itemforge.plans import catalogue, pages  # noqa: F401
from tests import oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_equals_sql(spark, con, name):
    oracle.compare(spark, con, SF, catalogue.QUERIES[name], catalogue.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_gives_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() >= 0

import pytest

from tests.compare import database, differences
from tickforge.plans.oracles import ORACLES
from tickforge.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, db, name):
    assert differences(QUERIES[name](spark, SF), db, ORACLES[name]) == ""

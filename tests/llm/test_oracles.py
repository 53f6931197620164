import pytest

from tests.compare import database, differences
from tickforge.llm.oracles import ORACLES
from tickforge.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    return database(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, db, name):
    assert differences(QUERIES[name](spark, SF), db, ORACLES[name]) == ""

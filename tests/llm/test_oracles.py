import pytest
from duck import connect, rows

from factloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf, name):
    assert rows(QUERIES[name](spark, sf).toPandas()) == rows(connect(sf).execute(ORACLES[name]).fetchdf())

import pytest
from duck import connect, rows

from factloom.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf, name):
    got = catalogue.QUERIES[name](spark, sf).toPandas()
    if name in catalogue.ORACLES:
        assert rows(got) == rows(connect(sf).execute(catalogue.ORACLES[name]).fetchdf())
    else:
        assert len(got)


def test_flagship_is_registered():
    assert catalogue.FLAGSHIP in catalogue.QUERIES

import sys

import pytest

import __spark_entry__ as contract
from checks.oracles import ORACLES
from checks.queries import QUERIES
from checks.compare import connect, difference
from hazemill.functions import aqi

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_a_missing_library_leaves_the_queries_of_the_engine(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert set(contract.queries()) == set(QUERIES) and set(contract.oracle_sql()) == set(ORACLES)


def test_a_changed_band_is_noticed(spark, connection, monkeypatch):
    bands = aqi.CONCENTRATION_BANDS | {"pm25": ((0, 34), *aqi.CONCENTRATION_BANDS["pm25"][1:])}
    monkeypatch.setattr(aqi, "CONCENTRATION_BANDS", bands)
    assert difference(spark, connection, SMALL, "aqi_subindex_pm25") is not None


def test_entry(spark):
    found = contract.entry(spark)
    assert found.columns == ["city_id", "city_name", "hour", "aqi", "rank_aqi"]
    assert found.count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    assert difference(spark, connection, SMALL, name) is None

"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as entry_points
from compare import compare, duck
from tripflow.plans import catalog, oracle, stored

QUERIES = catalog.QUERIES | stored.QUERIES
ORACLE = oracle.ORACLE | stored.ORACLE

SF = "/root/testdata/sf0.001"
# At this scale one pair of rows shares the whole row key.
LARGER = {"sample_large": "/root/testdata/sf0.01"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    sf_dir = LARGER.get(name, SF)
    assert compare(spark, duck(sf_dir), sf_dir, name) is None


def test_contract(spark):
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())
    assert entry_points.entry(spark).count() > 0


def test_known_counts(spark):
    """Counts fixed when the adapter was designed."""
    queries, sf_dir = entry_points.queries(), "/root/testdata/sf0.01"
    shares = {r.kind: (r.trips, r.valid_trips) for r in queries["valid_share"](spark, sf_dir).collect()}
    assert shares == {"yellow": (60_000, 28_916), "green": (15_000, 11_221)}
    bands = {r.band: (r.trips, r.total_amount) for r in queries["fare_band"](spark, sf_dir).collect()}
    assert bands["High Fare Trips"] == (29_150, 1_998_769.25) and bands["Default"][0] == 586

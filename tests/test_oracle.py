"""Every registered query that SQL can express against its SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from workloads.compare import connection, difference

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="benchmark tables absent")


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert difference(contract.queries()[name](spark, SF), con, contract.oracle_sql()[name]) == ""


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and df.columns[:3] == ["demand_date", "nyiso_zone", "nyiso_zone_name"]

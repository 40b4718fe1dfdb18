import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from zephyrload.session import local_session

    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session("tests", "4", **{"spark.sql.warehouse.dir": str(warehouse)})
    yield session
    session.stop()


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Tokyo"])
def session_zone(spark, request):
    """Results must not depend on the zone of the session."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def ordered(tuples):
    """Sorted by value, None last."""
    return sorted(tuples, key=lambda t: [(v is None, "" if v is None else v) for v in t])


def rows(df, *columns):
    """Sorted plain tuples."""
    df = df.select(*columns) if columns else df
    return ordered(tuple(r) for r in df.collect())

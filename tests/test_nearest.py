import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from zephyrload.operators.nearest import nearest_station

POINT = "id int, latitude double, longitude double"
STATION = "station_id string, station_name string, station_latitude double, station_longitude double"


def haversine(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(lon2) - math.radians(lon1)) / 2) ** 2
    return 2 * 6371 * math.asin(min(1.0, math.sqrt(h)))


def by_comparing_all(points, stations):
    best = {}
    for key, lat, lon in points:
        best[key] = min((haversine(lat, lon, s[2], s[3]), s[0]) for s in stations)
    return best


def scattered(draw, n):
    return [(draw.uniform(-90, 90), draw.uniform(-180, 180)) for _ in range(n)]


def clustered(draw, n):
    centres = [(42.0, -75.0), (42.0001, -75.0001), (-89.9, 10.0), (10.0, 179.999), (10.0, -179.999)]
    return [(c[0] + draw.gauss(0, 1e-3), c[1] + draw.gauss(0, 1e-3)) for c in (draw.choice(centres) for _ in range(n))]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("n_stations", [1, 40, 400])
def test_matches_comparing_all(spark, seed, n_stations):
    draw = random.Random(seed)
    spread = [scattered, clustered][seed % 2]
    stations = [(f"S{i:04d}", f"n{i}", lat, lon) for i, (lat, lon) in enumerate(spread(draw, n_stations))]
    points = [(i, lat, lon) for i, (lat, lon) in enumerate(scattered(draw, 60) + clustered(draw, 60))]
    found = nearest_station(spark.createDataFrame(points, POINT), spark.createDataFrame(stations, STATION), digits=None)
    want = by_comparing_all(points, stations)
    got = {r.id: (r.distance_km, r.station_id) for r in found.collect()}
    assert got.keys() == want.keys()
    for key, (km, station) in want.items():
        assert got[key][0] == pytest.approx(km, abs=1e-6)
        assert got[key][1] == station


def test_ties_copies_and_missing_places(spark):
    stations = [("B", "b", 0.0, 10.0), ("A", "a", 0.0, -10.0), ("A2", "copy", 0.0, -10.0), ("Z", "none", None, 1.0)]
    points = [(1, 0.0, 0.0), (2, 0.0, 9.0), (3, None, 0.0), (4, 0.0, 0.0)]
    found = nearest_station(spark.createDataFrame(points, POINT), spark.createDataFrame(stations, STATION))
    assert rows(found, "id", "station_id", "station_name", "distance_km") == [
        (1, "A", "a", 1111.9), (2, "B", "b", 111.2), (3, None, None, None), (4, "A", "a", 1111.9),
    ]


def test_no_stations(spark):
    found = nearest_station(spark.createDataFrame([(1, 0.0, 0.0)], POINT), spark.createDataFrame([], STATION))
    assert rows(found, "id", "station_id", "distance_km") == [(1, None, None)]


def test_plan_has_no_pairing_of_everything(spark):
    stations = spark.range(2000).select(
        F.col("id").cast("string").alias("station_id"), F.lit("s").alias("station_name"),
        (F.rand(1) * 180 - 90).alias("station_latitude"), (F.rand(2) * 360 - 180).alias("station_longitude"),
    ).cache()
    points = spark.range(500).select(F.col("id").cast("int"), (F.rand(3) * 180 - 90).alias("latitude"), (F.rand(4) * 360 - 180).alias("longitude"))
    plan = nearest_station(points, stations)._jdf.queryExecution().executedPlan().toString()
    stations.unpersist()
    assert "Cartesian" not in plan and "NestedLoop" not in plan

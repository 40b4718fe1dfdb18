import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_readers import ZONES, station
from tests.test_records import envelope, record, response
from zephyrload.plans import loads
from zephyrload.sources import readers, tables


def test_weather_from_files_to_bronze(spark, tmp_path):
    tables.create_layers(spark)
    for name in ("zones", "stations", "first", "second"):
        (tmp_path / name).mkdir()
    (tmp_path / "zones" / "z.txt").write_text(ZONES)
    features = [station("JFK", "1950-01-01", None, -73.8, 40.6), station("BUF", "1950-01-01", None, -78.7, 42.9), station("OFF", "1950-01-01", "2020-01-01", -73.97, 40.78)]
    (tmp_path / "stations" / "s.json").write_text(json.dumps({"features": features}))
    counties = readers.state_zone_counties(readers.read_zone_counties(spark, str(tmp_path / "zones")))
    served = loads.zone_station_map(counties, readers.read_stations(spark, str(tmp_path / "stations")))
    assert rows(served, "fips", "nyiso_zone", "station_id", "distance_km") == [
        ("36061", "J", "JFK", 24.6), ("36063", "A", "BUF", 34.3), ("36999", None, "BUF", 22.2)
    ]
    path = str(tmp_path / "map")
    tables.save_zone_station_map(served, path)
    served = spark.read.parquet(path)
    head = "station,valid,tmpf,sped\n"
    (tmp_path / "first" / "a.csv").write_text(head + "JFK,2024-12-31 23:51,1,1\nJFK,2026-07-01 00:51,70,5\nBUF,2026-07-01 00:54,60,M\nBUF,2026-07-01 01:54,M,M\n")
    (tmp_path / "second" / "a.csv").write_text(head + "JFK,2026-07-01 00:51,99,9\nJFK,2026-07-01 00:11,98,9\nJFK,2026-07-02 00:51,71,6\nBUF,2026-07-01 00:54,60,M\n")
    at = datetime(2026, 7, 1, 0, 51)

    def load(name):
        summary = loads.load_readings(spark, readers.read_observations(spark, str(tmp_path / name)), served, table="bronze.weather_loads")
        return rows(summary, "station_id", "previous_max", "new_rows")

    assert load("first") == [("BUF", None, 1), ("JFK", None, 1)]
    stored = spark.table("bronze.weather_loads")
    assert rows(stored, "fips", "temperature") == [("36061", 70.0), ("36063", 60.0), ("36999", 60.0)]
    assert load("second") == [("BUF", at + timedelta(minutes=3), 0), ("JFK", at, 1)]
    assert load("second") == [("BUF", at + timedelta(minutes=3), 0), ("JFK", at + timedelta(days=1), 0)]
    assert rows(spark.table("bronze.weather_loads"), "fips", "temperature") == [("36061", 70.0), ("36061", 71.0), ("36063", 60.0), ("36999", 60.0)]


def test_responses_from_files_to_landing(spark, tmp_path):
    tables.create_layers(spark)

    def load(name, item, **options):
        (tmp_path / name).mkdir()
        (tmp_path / name / "r.json").write_text(json.dumps(item))
        return rows(loads.load_responses(spark, str(tmp_path / name), "landing.loads", **options), "target_dt", "status_code", "record_count")

    good = envelope(record(), record())
    assert load("a", response(0, 200, good)) == [("2026-07-01T04", 200, 2)]
    assert load("b", response(0, 500, "busy"), keep_good=True) == [("2026-07-01T04", 200, 2)]
    assert load("c", response(0, 500, "busy")) == [("2026-07-01T04", 500, 0)]
    assert load("d", response(0, 200, good)) == [("2026-07-01T04", 200, 2)]


def test_loads_replace_only_changed_days(spark, tmp_path):
    """A batch leaves the files of other days and of unchanged days as they are."""
    tables.create_layers(spark)

    def load(name, *items, **options):
        (tmp_path / name).mkdir()
        (tmp_path / name / "r.json").write_text("\n".join(map(json.dumps, items)))
        stored = loads.load_responses(spark, str(tmp_path / name), "landing.by_day", **options)
        files = {r[0]: r[1] for r in stored.select(F.col("utc_day").cast("string"), F.input_file_name()).distinct().collect()}
        return files, rows(stored, "target_dt", "page", "record_count")

    def at(day, page, count):
        return response(5000 * page, 200, envelope(*[record() for _ in range(count)]), f"2026-07-0{day}T04")

    before, _ = load("a", at(1, 0, 1), at(2, 0, 1), at(2, 1, 1), at(3, 0, 1))
    after, stored = load("b", at(2, 0, 2), at(3, 0, 1), at(4, 0, 1))
    assert [r[2] for r in stored] == [1, 2, 1, 1, 1] and len(stored) == 5
    assert {d for d in after if before.get(d) != after[d]} == {"2026-07-02", "2026-07-04"}
    cut = response(0, 200, '{"response": {"da', "2026-07-02T04")
    _, kept = load("c", cut, strict=False, keep_good=True)
    assert kept == stored
    _, failed = load("d", cut, strict=False)
    assert [r[2] for r in failed] == [1, 0, 1, 1, 1]

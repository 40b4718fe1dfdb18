"""State that loads keep: the ledger, shared hours, newest moments, compacted days, one-step days."""

import random
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_records import envelope, response, responses
from tests.test_refresh_days import FEEDS
from workloads import feeds, kept
from zephyrload import schemas
from zephyrload.operators import gaps, lookups, quality, steps
from zephyrload.plans import gold, loads, refresh
from zephyrload.session import fresh_path
from zephyrload.sources import ledger, tables
from zephyrload.streaming import incremental

KEYS = ["target_dt", "page"]


@pytest.fixture
def layers(spark, request):
    """A set of layers of the test's own."""
    prefix = f"{request.node.name.split('[')[0]}_"
    with tables.layers_named(prefix):
        tables.create_layers(spark)
        yield prefix


def arrive(spark, pages):
    """Save pages, (hour, page) to the records' (hour, value), and load them into every landing table."""
    for table, fields in FEEDS.items():
        path = fresh_path(spark, "arrivals")
        saved = [
            response(5000 * page, 200, envelope(*[{**fields, "period": h, "value": str(v), "value-units": "MWh"} for h, v in held]), hour)
            for (hour, page), held in pages.items()
        ]
        responses(spark, *saved).write.json(path)
        loads.load_responses(spark, path, table)


def weather(spark, hours):
    frame = spark.createDataFrame([(h,) for h in hours], "h string").select(
        F.lit("NYZ072").alias("state_zone"), F.lit("New York").alias("zone_name"), F.lit("New York").alias("county"), F.lit("36061").alias("fips"),
        F.lit("J").alias("nyiso_zone"), F.lit("N.Y.C.").alias("nyiso_zone_name"), F.lit("NYC").alias("station_id"), F.lit("Park").alias("station_name"),
        F.lit(1.0).alias("distance_km"), F.concat("h", F.lit(":05")).cast("timestamp_ntz").alias("observed_at_utc"), F.lit(80.0).alias("temperature"),
        F.lit("F").alias("temperature_unit"), F.lit(4.0).alias("wind_speed"), F.lit("mph").alias("wind_speed_unit"), F.current_timestamp().alias("ingested_at_utc"),
    )
    tables.publish(schemas.conform(frame, schemas.WEATHER_BRONZE.schema), schemas.WEATHER_BRONZE.name)


def shown(spark):
    stamps = [f"{layer}_processed_timestamp" for layer in ("bronze", "silver", "gold")]
    names = [c.name for c in [schemas.FACT_DEMAND, schemas.FACT_OPERATIONS, schemas.GOLD_DAILY_BY_ZONE, schemas.GOLD_NYC_DAILY, schemas.GOLD_NYC_BANDS]]
    return {n: rows(tables.stored(spark, n).drop(*stamps)) for n in [*names, refresh.DEMAND_HOURS, refresh.ZONE_HOURS, refresh.DEMAND_PRESENT]}


def files(spark, name, day):
    fact = tables.stored(spark, name).filter(F.col("utc_day") == F.lit(day))
    return {r[0] for r in fact.select(F.input_file_name()).distinct().collect()}


def test_pending_loads_are_refreshed_without_dates(spark, layers):
    """Corrected, added, withdrawn and day-crossing pages; a page whose record has no hour."""
    hours = [f"2026-07-0{d}T{h:02d}" for d in (1, 2, 3) for h in range(24)]
    weather(spark, hours)
    pages = {(h, 1): [(h, 10)] for h in hours}
    pages["2026-07-01T05", 2] = [("2026-07-02T05", 5)]  # lies on 1 July, holds a record of 2 July
    arrive(spark, pages)
    refresh.refresh_pending(spark)
    assert ledger.pending(spark, refresh.MODEL) == ([], [])
    first = files(spark, schemas.FACT_DEMAND.name, date(2026, 7, 1))

    arrive(spark, {("2026-07-02T00", 1): [("2026-07-02T00", 11)]})  # only 2 July changes
    assert refresh.refresh_pending(spark) == [date(2026, 7, 2)]
    total = tables.stored(spark, schemas.FACT_DEMAND.name).filter("utc_day = '2026-07-02'").agg(F.count("*"), F.sum("value_mwh"))
    assert rows(total) == [(25, 246.0)]
    assert files(spark, schemas.FACT_DEMAND.name, date(2026, 7, 1)) == first

    changes = {
        ("2026-07-01T05", 2): [("2026-07-03T05", 6)],  # its record moves from 2 to 3 July
        ("2026-07-03T07", 1): [],  # withdrawn
        ("2026-07-04T01", 1): [("2026-07-04T01", 7)],  # added
    }
    arrive(spark, changes)
    assert refresh.refresh_pending(spark) == [date(2026, 7, d) for d in (2, 3, 4)]
    by_ledger = shown(spark)
    assert files(spark, schemas.FACT_DEMAND.name, date(2026, 7, 1)) == first
    refresh.refresh_all(spark)
    assert shown(spark) == by_ledger
    assert refresh.refresh_pending(spark) == []


def test_pages_of_an_hour_keep_their_own_numbers(spark, layers, tmp_path):
    """Several pages an hour, of fewer records than the service's own pages have, and pages astray beside them."""
    ids = [0, 1, 999, 1000, 4999, 5000, 9_999_999, 10_000_000, 10_000_001, 10_001_000]
    events = [(i, datetime(2024, 1, 3, 5, n), 7, "view", float(n), '{"k": 1}') for n, i in enumerate(ids)]
    kinds = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, kinds).write.parquet(str(tmp_path / "events.parquet"))
    chunks = {i // feeds.PAGE for i in ids}
    held = []
    for batch in kept._deliveries(spark, str(tmp_path)):
        kept._load_pages(spark, batch)
        for name in FEEDS:
            landed = tables.stored(spark, name)
            assert landed.count() == landed.select(*schemas.LANDING_KEY).distinct().count() == 2 * len(chunks)
            held.append(landed.agg(F.sum("record_count")).first()[0])
    assert held == [2 * len(ids)] * 3 + [len(ids)] * 3  # the second load withdraws the pages astray


def test_a_page_asked_for_again_has_the_same_text(spark, tmp_path):
    """Whatever order its events are read in, also such without an id or with the same one."""
    ids = [None, 3, 3, *range(40)]
    events = [(i, datetime(2024, 1, 3, 5, n), n % 5, "view", float(n), '{"k": 1}') for n, i in enumerate(ids)]
    kinds = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    found = []
    for name, order in (("up", events), ("down", events[::-1])):
        spark.createDataFrame(order, kinds).coalesce(1).write.parquet(str(tmp_path / name / "events.parquet"))
        found.append(rows(feeds.saved_responses(spark, str(tmp_path / name)), "target_dt", "offset_start", "body"))
    assert found[0] == found[1] and len(found[0]) == 2


def test_spans_keep_records_of_pages_outside(spark, layers):
    """``refresh_days`` of 2 July keeps the record that a page of 1 July holds."""
    hours = [f"2026-07-0{d}T{h:02d}" for d in (1, 2) for h in range(24)]
    weather(spark, hours)
    arrive(spark, {(h, 1): [(h, 10)] for h in hours} | {("2026-07-01T05", 2): [("2026-07-02T05", 5)]})
    refresh.refresh_all(spark)
    before = shown(spark)
    refresh.refresh_days(spark, date(2026, 7, 2), date(2026, 7, 2))
    assert shown(spark) == before


def test_a_load_that_was_not_confirmed_is_renewed_again(spark, layers):
    weather(spark, ["2026-07-01T00"])
    arrive(spark, {("2026-07-01T00", 1): [("2026-07-01T00", 1)]})
    refresh.refresh_pending(spark)
    pairs = spark.createDataFrame([(date(2026, 7, 1), date(2026, 7, 1))], "page_day date, record_day date")
    load = ledger.begin(pairs, refresh.LANDING_DEMAND)
    for _ in range(2):
        assert refresh.refresh_pending(spark) == [date(2026, 7, 1)]
    ledger.confirm(spark, load)
    assert refresh.refresh_pending(spark) == [date(2026, 7, 1)] and refresh.refresh_pending(spark) == []


def test_reports_read_stored_hours(spark, layers):
    hours = [f"2026-07-0{d}T{h:02d}" for d in (1, 2) for h in range(24)]
    weather(spark, hours)
    arrive(spark, {(h, 1): [(h, 10)] for h in hours})
    refresh.refresh_all(spark)
    demand, readings, zones = (tables.stored(spark, c.name) for c in (schemas.FACT_DEMAND, schemas.FACT_WEATHER, schemas.DIM_COMBINED_ZONE))
    for contract, made in (
        (schemas.GOLD_DAILY_BY_ZONE, gold.daily_demand_weather(demand, readings, zones)),
        (schemas.GOLD_NYC_DAILY, gold.trailing_daily(demand, readings, zones)),
        (schemas.GOLD_NYC_BANDS, gold.demand_by_band(demand, readings)),
        (schemas.GOLD_DAILY_WEATHER, gold.daily_weather(readings, zones)),
        (schemas.GOLD_MONTHLY_TEMPERATURE, gold.monthly_temperature(readings, zones)),
    ):
        found = tables.stored(spark, contract.name).drop("gold_processed_timestamp")
        assert rows(found) == rows(made.drop("gold_processed_timestamp"))
    plan = gold.daily_demand_weather(*(tables.stored(spark, n) for n in (refresh.DEMAND_HOURS, refresh.ZONE_HOURS)), zones)
    assert "fact_" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_partial_means_merge(spark):
    grain = ["k"]
    parts = [spark.createDataFrame(p, "k string, x double") for p in ([("a", 1.0), ("a", None)], [("a", 4.0), ("b", None)], [])]
    made = [steps.partial_means(p, grain, {"m": "x"}) for p in parts]
    merged = steps.merged_partials(made, grain)
    assert rows(merged) == [("a", 5.0, 2), ("b", None, 0)]
    assert rows(steps.means_of(merged, grain, ["m"])) == [("a", 2.5), ("b", None)]


def reading(station, at):
    return (station, at, "70", "3")


def test_kept_high_water(spark, layers):
    """Equal to the newest stored moments after every load, without the history being read."""
    def zone_stations(names):
        columns = ["state_zone", "zone_name", "county", "fips", "nyiso_zone", "nyiso_zone_name", "station_id", "station_name"]
        return spark.createDataFrame([(*(f"{c} {n}" for c in columns[:6]), n, n, 1.0) for n in names], [*columns, "distance_km"])

    served = zone_stations(["A", "B"])

    def load(*read):
        frame = spark.createDataFrame(list(read), "station_id string, observed_at_utc string, temperature string, wind_speed string")
        frame = frame.select("station_id", F.col("observed_at_utc").cast("timestamp_ntz"), F.col("temperature").cast("double"), F.col("wind_speed").cast("double"))
        frame = frame.withColumns({"temperature_unit": F.lit("F"), "wind_speed_unit": F.lit("mph")})
        return loads.load_readings(spark, frame, served, since="2026-01-01")

    name = schemas.WEATHER_BRONZE.name
    load(reading("A", "2026-07-01 00:05"), reading("A", "2026-07-01 02:05"), reading("C", "2026-07-01 02:05"))
    load(reading("A", "2026-07-01 01:05"), reading("A", "2026-07-01 03:05"), reading("B", "2026-07-01 00:05"))
    newest = tables.stored(spark, name).groupBy("station_id").agg(F.max("observed_at_utc").alias("previous_max"))
    assert rows(loads.high_water(spark)) == rows(newest)
    assert {r.station_id for r in newest.collect()} == {"A", "B"}
    plan = loads.high_water(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert "observed_at_utc" not in plan
    # a station served later is taken from its start
    served = zone_stations(["A", "B", "C"])
    load(reading("C", "2026-07-01 02:05"), reading("C", "2026-06-30 02:05"))
    assert tables.stored(spark, name).filter("station_id = 'C'").select("observed_at_utc").distinct().count() == 2
    kept = rows(loads.high_water(spark))
    assert rows(loads.rebuild_high_water(spark)) == kept


def test_days_are_replaced_in_one_step(spark, layers):
    """A reader sees old or new days, never some of each; a load that fails leaves the old."""
    days = [date(2026, 7, d) for d in (1, 2, 3)]
    frame = spark.createDataFrame([(d, 1) for d in days] + [(None, 1)], "utc_day date, v int")
    tables.publish(frame, "silver.steps", "three days", ("utc_day",))
    old = tables.stored(spark, "silver.steps")
    with pytest.raises(Exception):  # noqa: B017, PT011
        tables.publish_days(frame.withColumn("v", F.raise_error(F.lit("lost")).cast("int")), "silver.steps")
    assert rows(tables.stored(spark, "silver.steps").select("utc_day", "v")) == rows(frame)
    kept = files(spark, "silver.steps", days[0])
    changed = spark.createDataFrame([(days[1], 2)], "utc_day date, v int")
    tables.publish_days(changed, "silver.steps", days=[days[1], days[2], None], properties={"upto": "7"})
    assert rows(tables.stored(spark, "silver.steps").select("utc_day", "v")) == [(days[0], 1), (days[1], 2)]
    assert rows(old.select("utc_day", "v")) == rows(frame)  # planned before, still whole
    assert files(spark, "silver.steps", days[0]) == kept
    assert tables.property_of(spark, "silver.steps", "upto") == "7"
    for n in range(3):  # places that no generation points at are deleted, the kept day stays
        tables.publish_days(changed.withColumn("v", F.lit(n).cast("int")), "silver.steps")
    assert rows(tables.stored(spark, "silver.steps").select("utc_day", "v")) == [(days[0], 1), (days[1], 2)]


def scanned(df):
    """Rows that came out of the files of a collected frame that needs no shuffle."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_one_zone_reads_few_rows_of_clustered_days(spark, layers):
    """Pages without the zone asked for are skipped, also in days replaced later and in tables without days."""
    n, first = 60_000, date(2026, 7, 1)
    zone = F.expr("substring('ABCDEFGHIJK', cast(id % 11 as int) + 1, 1)")
    day = F.date_add(F.lit(first), (F.col("id") / n).cast("int"))
    facts = spark.range(2 * n).select(F.when(F.col("id") % 97 > 0, zone).alias("zone"), F.col("id").alias("hour"), day.alias("utc_day"))
    by = ("zone", "hour")
    tables.publish(facts, "silver.plain", "", ("utc_day",))
    tables.publish(facts, "silver.clustered", "", ("utc_day",), cluster_by=by)
    tables.publish(facts, "silver.flat", "", cluster_by=by)

    def asked(name):
        found = tables.stored(spark, name).filter("zone = 'J'").select("hour", "utc_day")
        return rows(found), scanned(found)

    expected, every = asked("silver.plain")
    assert every == 2 * n and len(expected) > 10_000
    found, read = asked("silver.clustered")
    assert found == expected and read < n
    found, read = asked("silver.flat")
    assert found == expected and read < n
    for _ in range(2):
        later = facts.filter(F.col("utc_day") > F.lit(first))
        tables.publish_days(later, "silver.clustered")
        found, read = asked("silver.clustered")
        assert found == expected and read < n
    assert tables.stored(spark, "silver.clustered").filter("zone is null").count() == facts.filter("zone is null").count()


def delivered(spark, root, pages):
    responses(spark, *pages).write.mode("append").json(f"{root}/arrivals")
    incremental.append_new_responses(spark, f"{root}/arrivals", f"{root}/log", f"{root}/checkpoint")


def test_compacted_log_equals_the_whole_log(spark, layers):
    """Corrections, failures, new days, repeats and a late row between compactions."""
    root = fresh_path(spark, "stream")
    start = datetime(2026, 7, 10)

    def page(hour, value, at):
        body = envelope({"period": hour, "value": str(value)}) if value is not None else None
        saved = response(0, 200 if value is not None else 500, body or "down", hour)
        return {**saved, "request_timestamp": f"{(start + timedelta(hours=at)).isoformat()}Z"}

    def same():
        whole = incremental.current_rows(incremental.read_log(spark, f"{root}/log"), KEYS)
        columns = ["target_dt", "page", "status_code", "response_hash", "request_timestamp"]
        found = incremental.current_from_compacted(spark, f"{root}/log", "landing.current", KEYS)
        assert rows(found, *columns) == rows(whole, *columns)

    delivered(spark, root, [page("2026-07-01T00", 1, 0), page("2026-07-02T00", 1, 0)])
    incremental.compact(spark, f"{root}/log", "landing.current", KEYS)
    same()
    for batch in (
        [page("2026-07-01T00", 2, 1)],
        [page("2026-07-01T00", 2, 2), page("2026-07-03T00", None, 2)],
        [page("2026-07-01T00", 1, 3), page("2026-07-03T00", 5, 3)],
    ):
        delivered(spark, root, batch)
        same()
    for _ in range(2):
        incremental.compact(spark, f"{root}/log", "landing.current", KEYS)
        same()
    delivered(spark, root, [page("2026-07-02T00", 9, -1), page("2026-07-02T00", 1, 5)])  # older than what is kept
    same()
    incremental.compact(spark, f"{root}/log", "landing.current", KEYS)
    same()


def test_the_log_has_small_row_groups(spark, tmp_path):
    """A reader takes up to 4,096 rows of a row group at once, each with its payload."""
    pages = [response(5000 * n, 200, envelope({"period": "2026-07-01T00", "value": n}), "2026-07-01T00") for n in range(200)]
    responses(spark, *pages).coalesce(1).write.json(str(tmp_path / "arrivals"))
    incremental.append_new_responses(spark, *(str(tmp_path / name) for name in ("arrivals", "log", "checkpoint")))
    assert incremental.read_log(spark, str(tmp_path / "log")).count() == 200
    files = [pq.read_metadata(p) for p in (tmp_path / "log").rglob("*.parquet")]
    groups = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert sum(groups) == 200 and max(groups) <= int(tables.PAYLOAD_GROUPS["parquet.block.row.count.limit"])


SPAN = ("2024-01-02T05", "2024-01-06T03")


@pytest.mark.parametrize("span", [SPAN, ("2024-01-03T00", "2024-01-03T00"), ("2023-12-30T00", "2023-12-31T05"), ("2024-02-01T00", "2024-02-01T02")])
def test_gaps_of_kept_hours_are_those_of_the_records(spark, span):
    r = random.Random(7)
    hours = [f"2024-01-{d:02d}T{h:02d}" for d in (1, 2, 3, 5, 6) for h in range(24)]
    records = [(s, h) for s in ("a", "b", "c") for h in r.choices(hours, k={"a": 200, "b": 30, "c": 1}[s])]
    records += [("whole", h) for h in hours] + [(None, hours[0]), ("d", None)]
    facts = spark.createDataFrame(records, "s string, k string")
    want = rows(gaps.missing_hours(facts, ["s"], "k", *span))
    present = gaps.present_hours(facts, ["s"], "k")
    assert rows(gaps.missing_from_present(present, ["s"], "k", *span)) == want
    early = F.col("k") < "2024-01-03T11"
    parts = [gaps.present_hours(f, ["s"], "k") for f in (facts.filter(early), facts.filter(~early), facts.sample(0.3, seed=1))]
    merged = gaps.merged_present(parts, ["s"])
    assert rows(gaps.missing_from_present(merged, ["s"], "k", *span)) == want
    assert gaps.missing_from_present(present.limit(0), ["s"], "k", *span).count() == 0


def test_kept_hours_follow_withdrawn_records(spark, layers):
    arrive(spark, {("2024-07-01T00", 0): [(f"2024-07-01T{h:02d}", 10) for h in range(24)], ("2024-07-02T00", 0): [("2024-07-02T03", 5)]})
    weather(spark, ["2024-07-01T00"])
    refresh.refresh_pending(spark)
    span = ("2024-07-01T00", "2024-07-02T04")
    assert [r.period_timestamp for r in refresh.demand_gaps(spark, *span).orderBy("period_timestamp").collect()] == [
        "2024-07-02T00", "2024-07-02T01", "2024-07-02T02", "2024-07-02T04",
    ]
    arrive(spark, {("2024-07-01T00", 0): [(f"2024-07-01T{h:02d}", 10) for h in range(22)]})
    refresh.refresh_pending(spark)
    facts = tables.stored(spark, schemas.FACT_DEMAND.name)
    want = rows(gaps.missing_hours(facts, ["sub_ba_code"], "period_timestamp", *span))
    assert len(want) == 6 and rows(refresh.demand_gaps(spark, *span)) == want


def test_sketches_of_days_are_the_sketch_of_the_whole(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("v"), (F.col("id") % 30).alias("day"), F.lit(None).cast("int").alias("none"))
    days = lookups.distinct_sketches(df, ["v", "none"], ["day"])
    united = lookups.united_counts(days, ["v", "none"]).first()
    whole = lookups.united_counts(lookups.distinct_sketches(df, ["v", "none"], []), ["v", "none"]).first()
    assert united == whole and united.distinct_none == 0
    assert abs(united.distinct_v / 20_000 - 1) < 4 * 1.04 / 2**7
    some = lookups.united_counts(days.filter("day < 10"), ["v"]).first().distinct_v
    exact = df.filter("day < 10").select("v").distinct().count()
    assert abs(some / exact - 1) < 4 * 1.04 / 2**7


@pytest.mark.parametrize("by", [(), ("day",)])
def test_violations_are_counted_while_publishing(spark, layers, by):
    df = spark.createDataFrame([(k, k if k % 3 else None, date(2024, 1, 1 + k % 2)) for k in range(20)], "id int, v int, day date")
    rules = {"known": "v IS NOT NULL", "small": "v < 15"}
    kept = quality.publish_expected(df, "silver.checked", rules, "Checked", by)
    assert rows(kept) == rows(quality.expect(df, rules))
    assert quality.kept_violations(spark, "silver.checked") == quality.violations(df, rules).first().asDict()
    quality.publish_expected(df.limit(0), "silver.checked", rules, "Checked", by)
    assert set(quality.kept_violations(spark, "silver.checked").values()) == {0}


def test_key_audit_of_no_tables(spark):
    assert quality.contract_key_audit([]).count() == 0

"""Bronze, silver and gold models on the benchmark tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from workloads import feeds
from workloads.feeds import table
from zephyrload import schemas
from zephyrload.functions import measures
from zephyrload.functions.records import row_key, zone_letter
from zephyrload.functions.timekeys import hour_key, local_date, nearest_hour_key
from zephyrload.operators import lookups
from zephyrload.operators.steps import TrailingWindow, demand_measures, hourly_demand
from zephyrload.plans import bronze, gold, loads, refresh, silver
from zephyrload.plans.bronze import bronze_feed
from zephyrload.session import fresh_path
from zephyrload.sources.tables import create_layers

DIGITS = 9
_STAMPS = (
    "processed_timestamp", "ingested_at_utc", "bronze_processed_timestamp",
    "silver_processed_timestamp", "gold_processed_timestamp",
)


def unstamped(df):
    """Results are compared without their clock columns."""
    return df.drop(*_STAMPS)


def rounded(df, *names):
    return df.withColumns({n: F.round(n, DIGITS) for n in names})


# --- SQL building blocks -----------------------------------------------------

HOUR = "strftime(ts, '%Y-%m-%dT%H')"
NEAREST = "strftime(ts + interval 30 minute, '%Y-%m-%dT%H')"
WIND = "cast(json_extract_string(props, '$.k') as double)"
USER_ZONE = "chr(cast(65 + user_id % 25 as integer))"


def local_day(key: str) -> str:
    utc = f"strptime({key}, '%Y-%m-%dT%H')"
    return f"cast(timezone('America/New_York', timezone('UTC', {utc})) as date)"


def letter(code: str) -> str:
    return f"string_split({code}, 'N')[2]"


def type_case(zones: dict[str, str]) -> str:
    arms = " ".join(f"when '{kind}' then '{zone}'" for kind, zone in zones.items())
    return f"case event_type {arms} end"


def rnd(expression: str, name: str) -> str:
    return f"round({expression}, {DIGITS}) as {name}"


def weather_steps(zone: str, station_filter: str = "true") -> str:
    """Station-hour then zone-hour means of the readings feed."""
    return f"""
station_hour as (
  select {NEAREST} as h, {zone} as z, user_id, avg(value) as t, avg({WIND}) as w
  from events where {station_filter} group by 1, 2, 3),
zone_hour as (select h, z, avg(t) as t, avg(w) as w from station_hour group by 1, 2)"""


DAY_WEATHER = f"""
zone_day as (
  select {local_day('h')} as d, z, avg(t) as avg_t, min(t) as min_t, max(t) as max_t,
         avg(w) as avg_w, count(t) as hours
  from zone_hour group by 1, 2)"""

ZONE_DIM = "zones as (select chr(65 + n_nationkey) as z, n_name from nation)"

DEGREES = f"""
  case when avg_t is not null then round(greatest(65 - avg_t, 0), {DIGITS}) end as heating_degree_days,
  case when avg_t is not null then round(greatest(avg_t - 65, 0), {DIGITS}) end as cooling_degree_days"""


# --- bronze ------------------------------------------------------------------


def b1_operations(spark, sf):
    return unstamped(bronze_feed(feeds.landing(spark, sf), bronze.OPERATIONS))


def b2_generation(spark, sf):
    return unstamped(bronze_feed(feeds.landing(spark, sf), bronze.GENERATION))


def b3_subregion_demand(spark, sf):
    return unstamped(bronze_feed(feeds.landing(spark, sf), bronze.SUBREGION_DEMAND))


def p1_explode_payload(spark, sf):
    """Envelopes, some of them of failed requests, back to records per hour."""
    landed = feeds.landing_rows(feeds.saved_responses(spark, sf, failing_hours=True), page_size=feeds.PAGE)
    period = F.variant_get("record", "$.period", "string").alias("period")
    return (
        bronze.payload_records(landed).select(period).groupBy("period").agg(F.count(F.lit(1)).alias("records"))
    )


def b4_weather(spark, sf):
    """Readings fanned out to the zone-counties of their station."""
    return unstamped(bronze.bronze_weather(_station_readings(spark, sf), zone_stations(spark, sf), feeds.load_time()))


def b4_load_readings(spark, sf):
    """The same through two incremental loads, the second overlapping the first."""
    create_layers(spark, fresh_path(spark, "layers"))
    name = f"bronze.weather_{uuid.uuid4().hex[:8]}"
    readings, served = _station_readings(spark, sf), zone_stations(spark, sf)
    early = readings.filter(F.col("observed_at_utc") < F.lit("2024-01-16").cast("timestamp_ntz"))
    for batch in (early, readings):
        loads.load_readings(spark, batch, served, "2024-01-01", name, feeds.load_time())
    return unstamped(spark.table(name).drop("utc_day"))


def _station_readings(spark, sf):
    return table(spark, sf, "events").select(
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("station_id"),
        F.col("ts").alias("observed_at_utc"),
        F.col("value").alias("temperature"),
        F.lit("F").alias("temperature_unit"),
        feeds.wind().alias("wind_speed"),
        F.lit("mph").alias("wind_speed_unit"),
    )


def zone_stations(spark, sf):
    """Zone-county map: three counties for every user seen as a station."""
    station = F.concat(F.lit("S"), F.col("user_id").cast("string"))
    users = table(spark, sf, "events").select("user_id").distinct()
    return users.select(
        F.concat(F.lit("NY"), feeds.user_zone()).alias("state_zone"),
        F.concat(F.lit("Zone "), feeds.user_zone()).alias("zone_name"),
        F.explode(feeds.county_rows(station)).alias("fips"),
        feeds.user_zone().alias("nyiso_zone"),
        F.concat(F.lit("Load "), feeds.user_zone()).alias("nyiso_zone_name"),
        station.alias("station_id"),
        F.concat(F.lit("Station "), F.col("user_id").cast("string")).alias("station_name"),
        F.lit(1.0).alias("distance_km"),
    ).withColumn("county", F.concat(F.lit("County "), F.col("fips")))


def _bronze_sql(key: str, key_parts: str, code: str, name: str) -> str:
    return f"""
select md5(concat_ws('-', {HOUR}, {key_parts})) as {key}, {HOUR} as period,
       cast(user_id as varchar) as ba_code, 'User ' || user_id as ba_name,
       event_type as {code}, upper(event_type) as {name},
       value as value_mwh, 'megawatthours' as value_units
from events"""


WEATHER_BRONZE_SQL = f"""
select 'NY' || {USER_ZONE} as state_zone, 'Zone ' || {USER_ZONE} as zone_name,
       'County S' || user_id || '-' || i as county, 'S' || user_id || '-' || i as fips,
       {USER_ZONE} as nyiso_zone, 'Load ' || {USER_ZONE} as nyiso_zone_name,
       'S' || user_id as station_id, 'Station ' || user_id as station_name,
       cast(1.0 as double) as distance_km, ts as observed_at_utc, value as temperature,
       'F' as temperature_unit, {WIND} as wind_speed, 'mph' as wind_speed_unit
from events cross join (values (0), (1), (2)) c(i)
qualify row_number() over (partition by state_zone, fips, ts order by station_id, value, wind_speed) = 1"""


# --- silver ------------------------------------------------------------------


def d1_balancing_authority(spark, sf):
    return silver.dim_balancing_authority(
        feeds.operations_bronze(spark, sf), feeds.demand_bronze(spark, sf), feeds.generation_bronze(spark, sf)
    )


def u1_union_entities(spark, sf):
    """Distinct nation keys of three tables."""
    frames = [
        table(spark, sf, name).select(F.col(column).alias("nationkey"))
        for name, column in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"))
    ]
    return lookups.union_of_entities(frames, ["nationkey"])


def d2_energy_source(spark, sf):
    return silver.dimension(feeds.generation_bronze(spark, sf), schemas.DIM_ENERGY_SOURCE)


def d3_metric_type(spark, sf):
    return silver.dimension(feeds.operations_bronze(spark, sf), schemas.DIM_METRIC_TYPE)


def d4_subregion(spark, sf):
    return silver.dim_subregion(feeds.demand_bronze(spark, sf))


def d5_county(spark, sf):
    return silver.dimension(feeds.weather_bronze(spark, sf, feeds.user_zone()), schemas.DIM_COUNTY)


def d6_nyiso_zone(spark, sf):
    return silver.dimension(feeds.weather_bronze(spark, sf, feeds.user_zone()), schemas.DIM_NYISO_ZONE)


def d7_weather_station(spark, sf):
    return silver.dimension(feeds.weather_bronze(spark, sf, feeds.user_zone()), schemas.DIM_WEATHER_STATION)


def d8_combined_zone(spark, sf):
    return silver.dim_combined_zone(d4_subregion(spark, sf), d6_nyiso_zone(spark, sf))


def c1_fact_operations(spark, sf):
    return unstamped(silver.electricity_fact(feeds.operations_bronze(spark, sf), schemas.FACT_OPERATIONS, feeds.load_time()))


def c2_fact_generation(spark, sf):
    return unstamped(silver.electricity_fact(feeds.generation_bronze(spark, sf), schemas.FACT_GENERATION, feeds.load_time()))


def c3_fact_demand(spark, sf):
    return unstamped(feeds.demand_fact(spark, sf))


def c4_fact_weather(spark, sf):
    return unstamped(feeds.weather_fact(spark, sf))


def v1_hourly_zone_mean(spark, sf):
    hourly = silver.hourly_zone_weather(feeds.weather_fact(spark, sf))
    return rounded(hourly, "avg_temperature_f", "avg_wind_speed_mph")


def _fact_sql(key: str, key_parts: str, code: str, code_value: str) -> str:
    return f"""
select md5(concat_ws('-', {HOUR}, {key_parts})) as {key}, {HOUR} as period_timestamp,
       cast(user_id as varchar) as ba_code, {code_value} as {code}, value as value_mwh
from events"""


# --- gold --------------------------------------------------------------------


def g1_daily_demand_weather(spark, sf):
    return unstamped(
        gold.daily_demand_weather(
            feeds.demand_fact(spark, sf), feeds.weather_fact(spark, sf), feeds.nation_zones(spark, sf), digits=DIGITS
        )
    )


def _type_feeds(spark, sf):
    demand = feeds.demand_fact(spark, sf, "type_subba")
    return demand, feeds.weather_fact(spark, sf, feeds.type_zone(feeds.WEATHER_ZONES))


def g2_trailing_window(spark, sf):
    demand, weather = _type_feeds(spark, sf)
    return unstamped(
        gold.trailing_daily(demand, weather, feeds.nation_zones(spark, sf), window_days=14, digits=DIGITS)
    )


def g2_missing_zone_name(spark, sf):
    """The zone has no dimension row: days stay, the name is NULL."""
    demand, weather = _type_feeds(spark, sf)
    others = feeds.nation_zones(spark, sf).filter("nyiso_zone <> 'J'")
    return unstamped(gold.trailing_daily(demand, weather, others, window_days=365, digits=DIGITS))


def g3_band_uplift(spark, sf):
    demand, weather = _type_feeds(spark, sf)
    return unstamped(gold.demand_by_band(demand, weather, digits=DIGITS))


def g3_band_uplift_20_hours(spark, sf):
    demand, weather = _type_feeds(spark, sf)
    return unstamped(gold.demand_by_band(demand, weather, window_days=14, complete_hours=20, digits=DIGITS))


def g4_month_statewide(spark, sf):
    return unstamped(
        gold.monthly_temperature(feeds.weather_fact(spark, sf), feeds.nation_zones(spark, sf), digits=DIGITS)
    )


def g5_daily_zone(spark, sf):
    return unstamped(
        gold.daily_weather(feeds.weather_fact(spark, sf), feeds.nation_zones(spark, sf), digits=DIGITS)
    )


G1_SQL = f"""
with {weather_steps(USER_ZONE)}, {ZONE_DIM},
joined as (
  select {local_day(HOUR)} as d, {letter(f"'ZON' || {USER_ZONE}")} as z, value, t, w
  from events left join zone_hour on h = {HOUR} and zone_hour.z = {letter(f"'ZON' || {USER_ZONE}")}),
daily as (
  select d, z, sum(value) as total, avg(value) as mean, max(value) as peak, count(value) as known,
         avg(t) as avg_t, min(t) as min_t, max(t) as max_t, avg(w) as avg_w, count(t) as hours
  from joined group by 1, 2)
select d as demand_date, daily.z as nyiso_zone, n_name as nyiso_zone_name,
  {rnd('total', 'total_demand_mwh')}, {rnd('mean', 'avg_hourly_demand_mwh')},
  {rnd('peak', 'peak_hourly_demand_mwh')}, known as demand_hours,
  {rnd('avg_t', 'avg_temperature_f')}, {rnd('min_t', 'min_temperature_f')},
  {rnd('max_t', 'max_temperature_f')}, {rnd('avg_w', 'avg_wind_speed_mph')},
  hours as weather_hours, {DEGREES}, known >= 23 as is_complete_day
from daily left join zones on daily.z = zones.z"""


def _one_zone_sql(demand_filter: str = "true") -> str:
    zone = type_case(feeds.WEATHER_ZONES)
    return f"""
demand_hour as (
  select {local_day(HOUR)} as d, value from events
  where {type_case(feeds.DEMAND_ZONES)} = 'J' and {demand_filter}),
span as (select max(d) as last_day from demand_hour),
demand_day as (
  select d, sum(value) as total, avg(value) as mean, max(value) as peak, count(value) as known
  from demand_hour group by 1),
{weather_steps(zone, f"{zone} = 'J'")}, {DAY_WEATHER}"""


def _g2_sql(days: int, name: str) -> str:
    return f"""
with {_one_zone_sql()}, {ZONE_DIM},
daily as (
  select coalesce(demand_day.d, zone_day.d) as day, total, mean, peak, coalesce(known, 0) as known,
         avg_t, min_t, max_t, avg_w, coalesce(hours, 0) as hours
  from demand_day full join zone_day on demand_day.d = zone_day.d)
select day as report_date, 'J' as nyiso_zone, {name} as nyiso_zone_name,
  {rnd('total', 'total_demand_mwh')}, {rnd('mean', 'avg_hourly_demand_mwh')},
  {rnd('peak', 'peak_hourly_demand_mwh')}, known as demand_hours,
  {rnd('avg_t', 'avg_temperature_f')}, {rnd('min_t', 'min_temperature_f')},
  {rnd('max_t', 'max_temperature_f')}, {rnd('avg_w', 'avg_wind_speed_mph')},
  hours as weather_hours, {DEGREES}, known >= 23 as is_complete_demand_day
from daily, span where day between last_day - {days - 1} and last_day"""


def _g3_sql(days: int, hours: int) -> str:
    return f"""
with {_one_zone_sql('value is not null')},
daily as (
  select demand_day.d as day, total, peak, avg_t, avg_w, greatest(65 - avg_t, 0) as hdd,
         greatest(avg_t - 65, 0) as cdd, cast(floor(avg_t / 5) * 5 as integer) as low
  from demand_day join zone_day on demand_day.d = zone_day.d, span
  where known >= {hours} and avg_t is not null and demand_day.d between last_day - {days - 1} and last_day),
bands as (
  select low, count(*) as n, min(day) as first_day, max(day) as last_day, avg(total) as mean,
         min(total) as least, max(total) as most, avg(peak) as peak, avg(avg_t) as t, avg(avg_w) as w,
         avg(hdd) as hdd, avg(cdd) as cdd
  from daily group by 1),
base as (select low as base_low, mean as base_mean from bands order by mean, low limit 1)
select low as temperature_band_low_f, low + 5 as temperature_band_high_f,
  low || '-' || (low + 5) || 'F' as temperature_band, n as day_count, first_day as first_date,
  last_day as last_date, {rnd('mean', 'avg_daily_demand_mwh')}, {rnd('least', 'min_daily_demand_mwh')},
  {rnd('most', 'max_daily_demand_mwh')}, {rnd('peak', 'avg_peak_hourly_demand_mwh')},
  {rnd('t', 'avg_temperature_f')}, {rnd('w', 'avg_wind_speed_mph')},
  {rnd('hdd', 'avg_heating_degree_days')}, {rnd('cdd', 'avg_cooling_degree_days')},
  base_low || '-' || (base_low + 5) || 'F' as baseline_temperature_band,
  {rnd('mean - base_mean', 'demand_uplift_vs_baseline_mwh')},
  {rnd('(mean - base_mean) / nullif(base_mean, 0) * 100', 'demand_uplift_vs_baseline_pct')}
from bands, base"""


G4_SQL = f"""
with {weather_steps(USER_ZONE)}, {DAY_WEATHER}, {ZONE_DIM},
monthly as (
  select cast(date_trunc('month', d) as date) as m, z, avg(avg_t) as mean, min(avg_t) as least,
         max(avg_t) as most, count(avg_t) as days
  from zone_day group by 1, 2),
beside as (select *, avg(mean) over (partition by m) as statewide from monthly)
select m as month_start_date, beside.z as nyiso_zone, n_name as nyiso_zone_name,
  {rnd('mean', 'avg_temperature_f')}, {rnd('least', 'min_daily_avg_temperature_f')},
  {rnd('most', 'max_daily_avg_temperature_f')}, days as days_observed,
  {rnd('statewide', 'statewide_avg_temperature_f')}
from beside left join zones on beside.z = zones.z"""

G5_SQL = f"""
with {weather_steps(USER_ZONE)}, {DAY_WEATHER}, {ZONE_DIM}
select d as observation_date, zone_day.z as nyiso_zone, n_name as nyiso_zone_name,
  {rnd('avg_t', 'avg_temperature_f')}, {rnd('min_t', 'min_temperature_f')},
  {rnd('max_t', 'max_temperature_f')}, {rnd('avg_w', 'avg_wind_speed_mph')},
  hours as weather_hours, hours >= 23 as is_complete_day
from zone_day left join zones on zone_day.z = zones.z"""


def s13_refresh_models(spark, sf):
    """Landing pages to published gold: all layers written and read back."""
    create_layers(spark, fresh_path(spark, "layers"))
    landed = feeds.landing(spark, sf)
    for name in (refresh.LANDING_OPERATIONS, refresh.LANDING_GENERATION, refresh.LANDING_DEMAND):
        refresh.publish(landed, name)
    weather = feeds.weather_bronze(spark, sf, feeds.user_zone())
    refresh.publish(weather, schemas.WEATHER_BRONZE.name)
    refresh.refresh_all(spark)
    published = spark.table(schemas.GOLD_DAILY_BY_ZONE.name)
    return published.select("demand_date", "nyiso_zone", "nyiso_zone_name", "demand_hours", "weather_hours", "is_complete_day")


S13_SQL = f"""
with {weather_steps(USER_ZONE)},
joined as (
  select {local_day(HOUR)} as d, {letter(f"'ZON' || {USER_ZONE}")} as z, value, t
  from events left join zone_hour on h = {HOUR} and zone_hour.z = {letter(f"'ZON' || {USER_ZONE}")})
select d as demand_date, z as nyiso_zone, 'Area ZON' || case when z = '' then 'N' else z end as nyiso_zone_name,
  count(value) as demand_hours, count(t) as weather_hours, count(value) >= 23 as is_complete_day
from joined group by 1, 2, 3"""


# --- single steps ------------------------------------------------------------


def p5_row_key(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        row_key(
            hour_key(F.col("ts")), F.col("user_id"), F.when(F.col("event_type") != "error", F.col("event_type"))
        ).alias("record_key"),
    )


def p7_code_split(spark, sf):
    code = F.concat(F.lit("Z"), F.col("c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", code.alias("code"), zone_letter(code).alias("letter"))


def p8_nearest_hour(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", hour_key(F.col("ts")).alias("hour_started"), nearest_hour_key(F.col("ts")).alias("hour_nearest")
    )


def p9_local_date(spark, sf):
    """Local days over years of order and shipping dates, clock changes included."""
    at = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber") + 1)
    key = hour_key(at)
    return (
        table(spark, sf, "lineitem")
        .select(key.alias("hour_key"))
        .groupBy("hour_key")
        .agg(F.count(F.lit(1)).alias("items"))
        .withColumn("local_day", local_date(F.col("hour_key")))
    )


def p13_p17_measures(spark, sf):
    """Degree days, bands, flags, uplift and rounding over account balances.

    Eighths lie halfway between two hundredths, on both sides of zero.
    """
    balance = F.col("c_acctbal") / 64
    eighths = F.floor(F.col("c_acctbal")) / 8
    return table(spark, sf, "customer").select(
        "c_custkey",
        measures.heating_degree_days(F.when(balance > 0, balance)).alias("heating"),
        measures.cooling_degree_days(F.when(balance > 0, balance)).alias("cooling"),
        measures.band_low(balance).alias("band_low"),
        measures.band_label(measures.band_low(balance)).alias("band"),
        measures.is_complete(F.col("c_nationkey")).alias("complete"),
        measures.uplift(balance, F.col("c_nationkey")).alias("uplift"),
        measures.uplift_percent(balance, F.col("c_nationkey")).alias("uplift_percent"),
        measures.rounded(eighths).alias("rounded"),
    )


def a4_demand_daily(spark, sf):
    hourly = hourly_demand(feeds.demand_fact(spark, sf), ["period_timestamp", "sub_ba_code"])
    by_day = hourly.withColumn("local_day", local_date(F.col("period_timestamp")))
    daily = by_day.groupBy("local_day", "sub_ba_code").agg(*demand_measures())
    return rounded(daily, "total_demand_mwh", "avg_hourly_demand_mwh")


def a5_weather_daily(spark, sf):
    daily = gold.zone_day_weather(feeds.weather_fact(spark, sf), "America/New_York")
    return rounded(daily, "avg_temperature_f", "min_temperature_f", "max_temperature_f", "avg_wind_speed_mph")


def _order_hours(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", hour_key(F.col("o_orderdate") + F.expr("INTERVAL 12 HOURS")).alias("hour_key")
    )


def a7_window_bounds(spark, sf):
    return TrailingWindow(_order_hours(spark, sf), "hour_key", 365).bounds()


def f4_within_window(spark, sf):
    """Orders of the last 365 days with orders."""
    hours = _order_hours(spark, sf)
    return TrailingWindow(hours, "hour_key", 365).only(hours, "hour_key")


def f1_zone_filter(spark, sf):
    """Demand of one zone, hours and values known (F1, F2)."""
    fact = feeds.demand_fact(spark, sf, "type_subba")
    return unstamped(
        fact.filter(F.col("sub_ba_code") == "J").dropna(subset=["period_timestamp", "value_mwh"])
    )


QUERIES = {
    "b1_operations": b1_operations,
    "b2_generation": b2_generation,
    "b3_subregion_demand": b3_subregion_demand,
    "b4_weather": b4_weather,
    "b4_load_readings": b4_load_readings,
    "p1_explode_payload": p1_explode_payload,
    "p5_row_key": p5_row_key,
    "p7_code_split": p7_code_split,
    "p8_nearest_hour": p8_nearest_hour,
    "p9_local_date": p9_local_date,
    "p13_p17_measures": p13_p17_measures,
    "f1_zone_filter": f1_zone_filter,
    "f4_within_window": f4_within_window,
    "a4_demand_daily": a4_demand_daily,
    "a5_weather_daily": a5_weather_daily,
    "a7_window_bounds": a7_window_bounds,
    "u1_union_entities": u1_union_entities,
    "d1_balancing_authority": d1_balancing_authority,
    "d2_energy_source": d2_energy_source,
    "d3_metric_type": d3_metric_type,
    "d4_subregion": d4_subregion,
    "d5_county": d5_county,
    "d6_nyiso_zone": d6_nyiso_zone,
    "d7_weather_station": d7_weather_station,
    "d8_combined_zone": d8_combined_zone,
    "c1_fact_operations": c1_fact_operations,
    "c2_fact_generation": c2_fact_generation,
    "c3_fact_demand": c3_fact_demand,
    "c4_fact_weather": c4_fact_weather,
    "v1_hourly_zone_mean": v1_hourly_zone_mean,
    "g1_daily_demand_weather": g1_daily_demand_weather,
    "g2_trailing_window": g2_trailing_window,
    "g2_missing_zone_name": g2_missing_zone_name,
    "g3_band_uplift": g3_band_uplift,
    "g3_band_uplift_20_hours": g3_band_uplift_20_hours,
    "g4_month_statewide": g4_month_statewide,
    "g5_daily_zone": g5_daily_zone,
    "s13_refresh_models": s13_refresh_models,
}

_DEMAND_CODE = f"'ZON' || {USER_ZONE}"
ORACLE = {
    "b1_operations": _bronze_sql("rom_id", "user_id, event_type", "type_code", "type_name"),
    "b2_generation": _bronze_sql("ges_id", "user_id, event_type", "fuel_code", "fuel_name"),
    "b3_subregion_demand": f"""
select md5(concat_ws('-', {HOUR}, {_DEMAND_CODE}, user_id)) as srd_id, {HOUR} as period,
       cast(user_id as varchar) as ba_code, 'User ' || user_id as ba_name,
       {_DEMAND_CODE} as sub_ba_code, 'Area ' || {_DEMAND_CODE} as sub_ba_name,
       value as value_mwh, 'megawatthours' as value_units
from events""",
    "b4_weather": WEATHER_BRONZE_SQL,
    "b4_load_readings": WEATHER_BRONZE_SQL,
    "p1_explode_payload": f"select {HOUR} as period, count(*) as records from events where hour(ts) <> 10 group by 1",
    "p5_row_key": f"""
select event_id, md5({HOUR} || '-' || user_id || '-' || case when event_type <> 'error' then event_type else '' end)
  as record_key from events""",
    "p7_code_split": """
select c_custkey, 'Z' || c_mktsegment as code, string_split('Z' || c_mktsegment, 'N')[2] as letter
from customer""",
    "p8_nearest_hour": f"select event_id, {HOUR} as hour_started, {NEAREST} as hour_nearest from events",
    "p9_local_date": f"""
with k as (select strftime(l_shipdate + to_hours(l_linenumber + 1), '%Y-%m-%dT%H') as hour_key from lineitem)
select hour_key, count(*) as items, {local_day('hour_key')} as local_day from k group by 1""",
    "p13_p17_measures": """
with b as (select c_custkey, c_nationkey, c_acctbal / 64 as x, floor(c_acctbal) / 8 as e from customer),
l as (select *, cast(floor(x / 5) * 5 as integer) as low from b)
select c_custkey, case when x > 0 then greatest(65 - x, 0) end as heating,
  case when x > 0 then greatest(x - 65, 0) end as cooling, low as band_low,
  low || '-' || (low + 5) || 'F' as band, c_nationkey >= 23 as complete, x - c_nationkey as uplift,
  (x - c_nationkey) / nullif(c_nationkey, 0) * 100 as uplift_percent, round(e, 2) as rounded
from l""",
    "f1_zone_filter": f"""
select md5(concat_ws('-', {HOUR}, 'ZONJ', user_id)) as srd_id, {HOUR} as period_timestamp,
       cast(user_id as varchar) as ba_code, 'J' as sub_ba_code, value as value_mwh
from events where event_type = 'purchase' and value is not null""",
    "f4_within_window": """
select o_orderkey, strftime(o_orderdate + interval 12 hour, '%Y-%m-%dT%H') as hour_key from orders
where o_orderdate between (select max(o_orderdate) - interval 364 day from orders)
  and (select max(o_orderdate) from orders)""",
    "a4_demand_daily": f"""
select {local_day(HOUR)} as local_day, {letter(_DEMAND_CODE)} as sub_ba_code,
  {rnd('sum(value)', 'total_demand_mwh')}, {rnd('avg(value)', 'avg_hourly_demand_mwh')},
  max(value) as peak_hourly_demand_mwh, count(value) as demand_hours
from events group by 1, 2""",
    "a5_weather_daily": f"""
with {weather_steps(USER_ZONE)}, {DAY_WEATHER}
select d as local_day, z as nyiso_zone, {rnd('avg_t', 'avg_temperature_f')}, {rnd('min_t', 'min_temperature_f')},
  {rnd('max_t', 'max_temperature_f')}, {rnd('avg_w', 'avg_wind_speed_mph')}, hours as weather_hours
from zone_day""",
    "a7_window_bounds": """
select cast(max(o_orderdate) as date) - 364 as start_date, cast(max(o_orderdate) as date) as end_date from orders""",
    "u1_union_entities": """
select c_nationkey as nationkey from customer union select s_nationkey from supplier
union select n_nationkey from nation""",
    "d1_balancing_authority": """
select distinct cast(user_id as varchar) as ba_code, 'User ' || user_id as ba_name from events""",
    "d2_energy_source": "select distinct event_type as fuel_code, upper(event_type) as fuel_name from events",
    "d3_metric_type": "select distinct event_type as type_code, upper(event_type) as type_name from events",
    "d4_subregion": f"""
select distinct {letter(_DEMAND_CODE)} as sub_ba_code, 'Area ' || {_DEMAND_CODE} as sub_ba_name from events""",
    "d5_county": f"""
select distinct state_zone, zone_name, county, fips from ({WEATHER_BRONZE_SQL})""",
    "d6_nyiso_zone": f"""
select distinct {USER_ZONE} as nyiso_zone, 'Load ' || {USER_ZONE} as nyiso_zone_name from events""",
    "d7_weather_station": """
select distinct 'S' || user_id as station_id, 'Station ' || user_id as station_name from events""",
    "d8_combined_zone": f"""
with s as (select distinct {letter(_DEMAND_CODE)} as code, 'Area ' || {_DEMAND_CODE} as name from events),
z as (select distinct {USER_ZONE} as code from events)
select s.code as nyiso_zone, s.name as nyiso_zone_name from s left join z on z.code = s.code""",
    "c1_fact_operations": _fact_sql("rom_id", "user_id, event_type", "type_code", "event_type"),
    "c2_fact_generation": _fact_sql("ges_id", "user_id, event_type", "fuel_code", "event_type"),
    "c3_fact_demand": _fact_sql("srd_id", f"{_DEMAND_CODE}, user_id", "sub_ba_code", letter(_DEMAND_CODE)),
    "c4_fact_weather": f"""
select 'NY' || {USER_ZONE} as state_zone, 'S' || user_id || '-' || i as fips, {USER_ZONE} as nyiso_zone,
       'S' || user_id as station_id, cast(1.0 as double) as distance_km, ts as observed_at_utc,
       {NEAREST} as observation_hour, value as temperature, {WIND} as wind_speed
from events cross join (values (0), (1), (2)) c(i)""",
    "v1_hourly_zone_mean": f"""
with {weather_steps(USER_ZONE)}
select h as observation_hour, z as nyiso_zone, {rnd('t', 'avg_temperature_f')}, {rnd('w', 'avg_wind_speed_mph')}
from zone_hour""",
    "g1_daily_demand_weather": G1_SQL,
    "g2_trailing_window": _g2_sql(14, "(select n_name from zones where z = 'J')"),
    "g2_missing_zone_name": _g2_sql(365, "cast(null as varchar)"),
    "g3_band_uplift": _g3_sql(365, 23),
    "g3_band_uplift_20_hours": _g3_sql(14, 20),
    "g4_month_statewide": G4_SQL,
    "g5_daily_zone": G5_SQL,
    "s13_refresh_models": S13_SQL,
}

"""Landing, source files, upserts and incremental loads on the benchmark tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workloads import feeds
from workloads.feeds import table
from workloads.models import HOUR, USER_ZONE, WIND, zone_stations
from zephyrload.functions.records import number_or_null
from zephyrload.functions.timekeys import hour_key, hour_spine
from zephyrload.operators import dedupe, gaps, lookups, upserts
from zephyrload.operators.nearest import nearest_station
from zephyrload.session import fresh_path
from zephyrload.sources import landing, readers, tables
from zephyrload.streaming import incremental

# --- landing -----------------------------------------------------------------


def s1_landing_rows(spark, sf):
    """Response pages saved as JSON lines, some of failed requests, landed."""
    path = fresh_path(spark, "responses")
    feeds.saved_responses(spark, sf, failing_hours=True).write.json(path)
    landed = landing.landing_rows(landing.read_saved_responses(spark, path), page_size=feeds.PAGE)
    return landed.select(
        "run_id", "target_dt", "page", "offset_start", "status_code", "status", "error_msg", "record_count",
        (F.col("response_hash") == F.md5(F.lit("{}"))).alias("is_empty_object"),
    )


def s2_parse_payload(spark, sf):
    """JSON text to VARIANT and back to fields; text that is no JSON is NULL."""
    text = F.when(F.col("event_type") == "error", F.lit("{not json")).otherwise(F.col("props"))
    parsed = landing.parse_payload(text, strict=False)
    return table(spark, sf, "events").select(
        "event_id", F.try_variant_get(parsed, "$.k", "double").alias("k"), parsed.isNull().alias("is_bad")
    )


def s11_upsert_changed(spark, sf):
    target, source = _order_pages(spark, sf), _order_refetch(spark, sf)
    return upserts.upsert_if_changed(target, source, ["o_orderkey"])


def s11_keep_good(spark, sf):
    """The same batch, but failed pages may not replace good ones."""
    target, source = _order_pages(spark, sf), _order_refetch(spark, sf)
    return upserts.upsert_if_changed(
        target, source, ["o_orderkey"], keep_good=F.col("o_orderstatus") == "O"
    )


def s11_load_changed(spark, sf):
    """The upsert through a published table, its second batch delivered twice."""
    tables.create_layers(spark, fresh_path(spark, "layers"))
    name = f"landing.order_pages_{uuid.uuid4().hex[:8]}"
    upserts.load_changed(spark, _order_pages(spark, sf), name, ["o_orderkey"])
    for _ in range(2):
        loaded = upserts.load_changed(spark, _order_refetch(spark, sf), name, ["o_orderkey"])
    return loaded


def s11_load_by_day(spark, sf):
    """The upsert into a table stored by a day that follows from the key."""
    tables.create_layers(spark, fresh_path(spark, "layers"))
    name = f"landing.order_days_{uuid.uuid4().hex[:8]}"
    years = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("known"), F.to_date(F.trunc("o_orderdate", "year")).alias("first_day")
    )

    def dated(pages):
        known = F.when(F.col("o_orderkey") < 0, -F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey"))
        return pages.withColumn("known", known).join(years, "known").drop("known")

    for batch in (_order_pages(spark, sf), _order_refetch(spark, sf), _order_refetch(spark, sf)):
        loaded = upserts.load_changed(spark, dated(batch), name, ["o_orderkey"], day_column="first_day")
    return loaded.drop("first_day")


def _order_pages(spark, sf):
    """Orders as stored pages: key, payload, hash of the payload."""
    return _hashed(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"))


def _order_refetch(spark, sf):
    """The same orders fetched again: O has a new price, P a new key."""
    orders = table(spark, sf, "orders")
    status = F.col("o_orderstatus")
    again = orders.select(
        F.when(status == "P", -F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        status,
        F.when(status == "O", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
    )
    return _hashed(again)


def _hashed(pages):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    return pages.withColumn("response_hash", F.md5(F.concat_ws("-", "o_orderstatus", cents)))


_HASH_SQL = "md5(o_orderstatus || '-' || cast(round(o_totalprice * 100) as bigint))"


def _upsert_sql(may_replace: str) -> str:
    return f"""
with s as (
  select case when o_orderstatus = 'P' then -o_orderkey - 1 else o_orderkey end as o_orderkey, o_orderstatus,
         case when o_orderstatus = 'O' then o_totalprice + 1 else o_totalprice end as o_totalprice
  from orders),
source as (select *, {_HASH_SQL} as response_hash from s),
target as (select o_orderkey, o_orderstatus, o_totalprice, {_HASH_SQL} as response_hash from orders)
select coalesce(t.o_orderkey, s.o_orderkey) as o_orderkey,
  case when take then s.o_orderstatus else t.o_orderstatus end as o_orderstatus,
  case when take then s.o_totalprice else t.o_totalprice end as o_totalprice,
  case when take then s.response_hash else t.response_hash end as response_hash
from (select t, s, t.o_orderkey is null or (s.o_orderkey is not null and t.response_hash <> s.response_hash
        and {may_replace}) as take
      from target t full join source s on t.o_orderkey = s.o_orderkey)"""


def s12_insert_only(spark, sf):
    target, source = _stored_and_redelivered(spark, sf)
    return upserts.insert_only(target, source, ["user_id", "ts"])


def s10_load_new(spark, sf):
    """Insert-only loads into a table: created, extended, and the batch repeated."""
    tables.create_layers(spark, fresh_path(spark, "layers"))
    name = f"bronze.readings_{uuid.uuid4().hex[:8]}"
    target, source = (
        part.withColumn("utc_day", F.to_date("ts")) for part in _stored_and_redelivered(spark, sf)
    )
    for batch in (target, source, source):
        loaded = upserts.load_new(spark, batch, name, ["user_id", "ts"], "utc_day")
    return loaded.drop("utc_day")


def _stored_and_redelivered(spark, sf):
    """Readings up to the 16th, and readings from the 10th with other values."""
    events = table(spark, sf, "events").select("user_id", "ts", "value")
    target = events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    source = events.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    return target, source.withColumn("value", F.col("value") + 1000)


_INSERT_ONLY_SQL = """
select user_id, ts, case when ts < timestamp '2024-01-16' then value else value + 1000 end as value from events"""


def f9_high_water(spark, sf):
    stored, arriving = _stored_history(spark, sf)
    latest = upserts.latest_per_series(stored, "user_id", "ts")
    return upserts.newer_than_stored(arriving, latest, "user_id", "ts", "2024-01-05")


def a10_latest(spark, sf):
    return upserts.latest_per_series(_stored_history(spark, sf)[0], "user_id", "ts")


def a12_load_summary(spark, sf):
    stored, arriving = _stored_history(spark, sf)
    latest = upserts.latest_per_series(stored, "user_id", "ts")
    loaded = upserts.newer_than_stored(arriving, latest, "user_id", "ts", "2024-01-05")
    return upserts.load_summary(loaded, latest, "user_id", "ts")


def _stored_history(spark, sf):
    """Stations stopped loading on different days, some before their first reading."""
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    stopped = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'") + F.make_dt_interval((F.col("user_id") % 40).cast("int"))
    return events.filter(F.col("ts") < stopped), events


_HISTORY_SQL = """
latest as (
  select user_id, max(ts) as previous_max from events
  where ts < timestamp '2024-01-01' + to_days(cast(user_id % 40 as integer)) group by 1),
fresh as (
  select e.event_id, e.user_id, e.ts, e.value from events e left join latest l on l.user_id = e.user_id
  where case when previous_max is null then ts >= timestamp '2024-01-05' else ts > previous_max end)"""


def r_inc(spark, sf):
    """Three deliveries through the file stream; the second has failed hours."""
    root = fresh_path(spark, "stream")
    for day, failing in ((1, False), (2, True), (3, False)):
        at = F.expr(f"TIMESTAMP'2024-02-0{day} 00:00:00'")
        feeds.saved_responses(spark, sf, failing, at).write.mode("append").json(f"{root}/arrivals")
        incremental.append_new_responses(
            spark, f"{root}/arrivals", f"{root}/log", f"{root}/checkpoint", feeds.PAGE
        )
    current = incremental.current_rows(incremental.read_log(spark, f"{root}/log"), ["target_dt", "page"])
    return current.select("target_dt", "page", "status_code", "record_count", F.to_date("request_timestamp").alias("fetched"))


# --- source files ------------------------------------------------------------


def s3_zone_counties(spark, sf):
    """Customers written as pipe-delimited zone-county text, read and filtered."""
    path = fresh_path(spark, "zone-counties")
    key = F.col("c_custkey").cast("string")
    balance = F.col("c_acctbal").cast("string")
    text = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("NY")).otherwise(F.lit("XX")),
        F.col("c_nationkey").cast("string").alias("zone"),
        F.lit("OKX").alias("cwa"),
        F.concat(F.lit("Zone "), F.col("c_nationkey").cast("string")).alias("zone_name"),
        F.concat(F.lit("NYZ"), F.col("c_nationkey").cast("string")).alias("state_zone"),
        F.concat(F.lit("County "), key).alias("county"),
        F.floor(F.col("c_custkey") / 40).cast("string").alias("fips"),
        F.lit("E").alias("time_zone"),
        F.lit("se").alias("fe_area"),
        F.when(F.col("c_acctbal") < 0, F.lit("unknown")).otherwise(balance).alias("latitude"),
        F.concat(F.lit("-"), key).alias("longitude"),
    )
    text.write.csv(path, sep="|", header=False)
    return readers.state_zone_counties(readers.read_zone_counties(spark, path))


_ZONE_COUNTY_SQL = """
select 'NY' as state, cast(c_nationkey as varchar) as zone, 'OKX' as cwa, 'Zone ' || c_nationkey as zone_name,
  'NYZ' || c_nationkey as state_zone, 'County ' || c_custkey as county, cast(c_custkey // 40 as varchar) as fips,
  'E' as time_zone, 'se' as fe_area, c_acctbal as latitude, cast(-c_custkey as double) + 0.0 as longitude
from customer where c_mktsegment = 'BUILDING' and c_acctbal >= 0
qualify row_number() over (partition by c_nationkey, c_custkey // 40 order by 'County ' || c_custkey) = 1"""


def s4_stations(spark, sf):
    """Vectors written as GeoJSON collections of 100 features, active ones read."""
    path = fresh_path(spark, "stations")
    label = F.col("label")
    feature = F.struct(
        F.struct(
            F.concat(F.lit("V"), F.col("vec_id").cast("string")).alias("sid"),
            F.concat(F.lit("Label "), label.cast("string")).alias("sname"),
            F.date_format(F.date_add(F.lit("2024-12-30").cast("date"), label), "yyyy-MM-dd").alias("archive_begin"),
            F.when(label == 1, F.lit("2025-06-01")).alias("archive_end"),
        ).alias("properties"),
        F.struct(F.array(*_place("embedding", 0)[::-1]).alias("coordinates")).alias("geometry"),
    )
    collections = (
        table(spark, sf, "embeddings")
        .groupBy(F.floor(F.col("vec_id") / 100).alias("part"))
        .agg(F.collect_list(feature).alias("features"))
    )
    collections.select(F.to_json(F.struct("features"))).write.text(path)
    stations = readers.read_stations(spark, path, multi_line=False)
    return readers.active_stations(stations, "2025-01-01")


def _place(vector: str, first: int):
    """Latitude and longitude from two entries of a vector."""
    return [
        F.col(vector)[first].cast("double") + 42.0,
        F.col(vector)[first + 1].cast("double") - 75.0,
    ]


def s5_observations(spark, sf):
    """Readings written as CSV files with M for missing values, read and typed."""
    path = fresh_path(spark, "observations")
    kind = F.col("event_type")
    table(spark, sf, "events").repartition(4).select(
        F.col("user_id").alias("station"),
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("valid"),
        F.when(kind.isin("error", "signup"), F.lit("M")).otherwise(F.col("value").cast("string")).alias("tmpf"),
        F.when(kind == "error", F.lit("M")).when(kind == "click", F.lit("trace"))
        .otherwise(feeds.wind().cast("string")).alias("sped"),
    ).write.csv(path, header=True)
    return readers.measured(readers.read_observations(spark, path))


def f10_numbers(spark, sf):
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.lit("n/a"))
        .when(kind == "signup", F.col("props"))
        .when(kind == "view", F.concat(F.lit(" "), F.col("value").cast("string")))
        .otherwise(F.get_json_object("props", "$.k"))
    )
    return table(spark, sf, "events").select("event_id", number_or_null(text).alias("number"))


# --- joins, dedupe, order ----------------------------------------------------


def j9_fanout(spark, sf):
    readings = table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("station_id")
    )
    return lookups.fan_out(readings, zone_stations(spark, sf)).select("event_id", "station_id", "fips", "nyiso_zone")


def _mapped_customers(spark, sf):
    counties = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("fips"))
    county_zones = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("fips"),
        F.when(F.col("n_regionkey") != 3, F.col("n_regionkey")).alias("nyiso_zone"),
    )
    names = table(spark, sf, "region").select(
        F.col("r_regionkey").alias("nyiso_zone"), F.col("r_name").alias("nyiso_zone_name")
    )
    return lookups.add_zone(counties, county_zones, names)


def j10_lookup(spark, sf):
    return _mapped_customers(spark, sf)


def q5_unmapped(spark, sf):
    return lookups.unmapped(_mapped_customers(spark, sf), "nyiso_zone", ["fips"])


def j11_nearest(spark, sf):
    """The closest of all places in one pair of entries to all in another."""
    found = _nearest(spark, sf, None)
    return found.select(
        "vec_id", "station_id", "station_name",
        F.round("distance_km", 9).alias("distance_km"), F.bround("distance_km", 1).alias("distance_rounded"),
    )


def _nearest(spark, sf, digits):
    vectors = table(spark, sf, "embeddings")
    lat, lon = _place("embedding", 0)
    points = vectors.select("vec_id", lat.alias("latitude"), lon.alias("longitude"))
    lat, lon = _place("embedding", 2)
    stations = vectors.select(
        F.col("vec_id").alias("station_id"),
        F.concat(F.lit("Station "), F.col("vec_id").cast("string")).alias("station_name"),
        lat.alias("station_latitude"),
        lon.alias("station_longitude"),
    )
    return nearest_station(points, stations, digits=digits)


def s9_zone_station_map(spark, sf):
    """The nearest-station map written and read back."""
    path = fresh_path(spark, "zone-station-map")
    tables.save_zone_station_map(_nearest(spark, sf, 1).select("vec_id", "station_id", "distance_km"), path)
    return spark.read.parquet(path)


_NEAREST_SQL = """
with v as (
  select vec_id, cast(embedding[1] as double) + 42.0 as lat, cast(embedding[2] as double) - 75.0 as lon,
         cast(embedding[3] as double) + 42.0 as slat, cast(embedding[4] as double) - 75.0 as slon
  from embeddings),
pairs as (
  select p.vec_id, s.vec_id as station_id,
    pow(sin((radians(s.slat) - radians(p.lat)) / 2), 2)
      + cos(radians(p.lat)) * cos(radians(s.slat)) * pow(sin((radians(s.slon) - radians(p.lon)) / 2), 2) as h
  from v p cross join v s),
best as (
  select vec_id, station_id, 2 * 6371 * asin(least(1.0, sqrt(h))) as km from pairs
  qualify row_number() over (partition by vec_id order by h, station_id) = 1)"""


def w2_keep_first(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return dedupe.keep_first(items, ["l_orderkey", "l_suppkey"])


def o2_sorted_by_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return dedupe.sorted_by_key(orders, ["o_custkey", "o_orderdate", "o_orderkey"])


def o3_station_list(spark, sf):
    return dedupe.distinct_sorted(table(spark, sf, "events"), "user_id")


def o4_export_order(spark, sf):
    """Operating metrics in the order pages are asked for."""
    metrics = feeds.operations_bronze(spark, sf).select("period", "ba_code", "type_code", "value_mwh")
    return dedupe.export_order(metrics, ["period", "ba_code", "type_code"])


def a11_distinct_counts(spark, sf):
    return lookups.distinct_counts(table(spark, sf, "lineitem"), ["l_suppkey", "l_partkey"])


def u2_concat(spark, sf):
    """Frames of events with a low value, a high one and none, put together again."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    low = F.col("value") < 50
    parts = [events.filter(low), events.filter(~low), events.filter(low.isNull())]
    return reduce(DataFrame.unionByName, parts)


# --- hours -------------------------------------------------------------------


def hour_span(spark, sf):
    ends = table(spark, sf, "events").agg(hour_key(F.min("ts")).alias("a"), hour_key(F.max("ts")).alias("b")).first()
    return ends.a, ends.b


def t_spine(spark, sf):
    return hour_spine(spark, *hour_span(spark, sf))


def t_gap_hours(spark, sf):
    return gaps.missing_hours(feeds.operations_bronze(spark, sf), ["type_code", "ba_code"], "period", *hour_span(spark, sf))


def t_dst_days(spark, sf):
    """All hours of the UTC days with shipments, over years with clock changes."""
    days = table(spark, sf, "lineitem").select("l_returnflag", "l_shipdate").distinct()
    hours = days.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    at = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("hour"))
    return gaps.hours_per_local_day(
        hours.select("l_returnflag", hour_key(at).alias("period")), ["l_returnflag"], "period"
    )


_SPINE_SQL = f"""
spine as (
  select strftime(h, '%Y-%m-%dT%H') as hour_key
  from (select unnest(generate_series(date_trunc('hour', min(ts)), max(ts), interval 1 hour)) as h from events))"""

QUERIES = {
    "s1_landing_rows": s1_landing_rows,
    "s2_parse_payload": s2_parse_payload,
    "s3_zone_counties": s3_zone_counties,
    "s4_stations": s4_stations,
    "s5_observations": s5_observations,
    "s9_zone_station_map": s9_zone_station_map,
    "s10_load_new": s10_load_new,
    "s11_upsert_changed": s11_upsert_changed,
    "s11_keep_good": s11_keep_good,
    "s11_load_changed": s11_load_changed,
    "s11_load_by_day": s11_load_by_day,
    "s12_insert_only": s12_insert_only,
    "r_inc": r_inc,
    "f9_high_water": f9_high_water,
    "f10_numbers": f10_numbers,
    "a10_latest": a10_latest,
    "a11_distinct_counts": a11_distinct_counts,
    "a12_load_summary": a12_load_summary,
    "j9_fanout": j9_fanout,
    "j10_lookup": j10_lookup,
    "j11_nearest": j11_nearest,
    "q5_unmapped": q5_unmapped,
    "w2_keep_first": w2_keep_first,
    "o2_sorted_by_key": o2_sorted_by_key,
    "o3_station_list": o3_station_list,
    "o4_export_order": o4_export_order,
    "u2_concat": u2_concat,
    "t_spine": t_spine,
    "t_gap_hours": t_gap_hours,
    "t_dst_days": t_dst_days,
}

ORACLE = {
    "s1_landing_rows": f"""
select 'run-1' as run_id, {HOUR} as target_dt, event_id // 1000 + 1 as page, event_id // 1000 * 1000 as offset_start,
  cast(case when hour(ts) = 10 then 500 else 200 end as bigint) as status_code,
  case when hour(ts) = 10 then 'Server Error' else 'OK' end as status,
  case when hour(ts) = 10 then 'upstream failed' else 'None' end as error_msg,
  case when hour(ts) = 10 then 0 else count(*) end as record_count, hour(ts) = 10 as is_empty_object
from events group by {HOUR}, event_id // 1000, hour(ts)""",
    "s2_parse_payload": f"""
select event_id, case when event_type <> 'error' then {WIND} end as k, event_type = 'error' as is_bad from events""",
    "s3_zone_counties": _ZONE_COUNTY_SQL,
    "s4_stations": """
select 'V' || vec_id as station_id, 'Label ' || label as station_name,
  strftime(date '2024-12-30' + label, '%Y-%m-%d') as archive_begin, cast(null as varchar) as archive_end,
  cast(embedding[2] as double) - 75.0 as station_longitude, cast(embedding[1] as double) + 42.0 as station_latitude
from embeddings where label <= 2 and label <> 1""",
    "s5_observations": f"""
select cast(user_id as varchar) as station_id, date_trunc('minute', ts) as observed_at_utc,
  case when event_type <> 'signup' then value end as temperature, 'F' as temperature_unit,
  case when event_type <> 'click' then {WIND} end as wind_speed, 'mph' as wind_speed_unit
from events where event_type <> 'error'""",
    "s9_zone_station_map": f"{_NEAREST_SQL} select vec_id, station_id, round_even(km, 1) as distance_km from best",
    "s10_load_new": _INSERT_ONLY_SQL,
    "s11_upsert_changed": _upsert_sql("true"),
    "s11_keep_good": _upsert_sql("s.o_orderstatus <> 'O'"),
    "s11_load_changed": _upsert_sql("true"),
    "s11_load_by_day": _upsert_sql("true"),
    "s12_insert_only": _INSERT_ONLY_SQL,
    "r_inc": f"""
select {HOUR} as target_dt, event_id // 1000 + 1 as page, cast(200 as bigint) as status_code,
  count(*) as record_count, case when hour(ts) = 10 then date '2024-02-03' else date '2024-02-01' end as fetched
from events group by {HOUR}, event_id // 1000, hour(ts)""",
    "f9_high_water": f"with {_HISTORY_SQL} select * from fresh",
    "f10_numbers": f"""
select event_id, case event_type when 'error' then null when 'signup' then null when 'view' then value
  else {WIND} end as number from events""",
    "a10_latest": f"with {_HISTORY_SQL} select * from latest",
    "a11_distinct_counts": """
select count(distinct l_suppkey) as distinct_l_suppkey, count(distinct l_partkey) as distinct_l_partkey from lineitem""",
    "a12_load_summary": f"""
with {_HISTORY_SQL}, loaded as (select user_id, max(ts) as current_max, count(*) as new_rows from fresh group by 1)
select coalesce(latest.user_id, loaded.user_id) as user_id, previous_max, current_max, coalesce(new_rows, 0) as new_rows
from latest full join loaded on latest.user_id = loaded.user_id""",
    "j9_fanout": f"""
select event_id, 'S' || user_id as station_id, 'S' || user_id || '-' || i as fips, {USER_ZONE} as nyiso_zone
from events cross join (values (0), (1), (2)) c(i)""",
    "j10_lookup": """
select c_custkey, c_nationkey as fips, r_regionkey as nyiso_zone, r_name as nyiso_zone_name
from customer left join nation on n_nationkey = c_nationkey
  left join region on r_regionkey = n_regionkey and r_regionkey <> 3""",
    "j11_nearest": f"""
{_NEAREST_SQL} select vec_id, station_id, 'Station ' || station_id as station_name,
  round(km, 9) as distance_km, round_even(km, 1) as distance_rounded from best""",
    "q5_unmapped": """
select distinct c_nationkey as fips from customer join nation on n_nationkey = c_nationkey where n_regionkey = 3""",
    "w2_keep_first": """
select l_orderkey, l_suppkey, l_linenumber, l_partkey, l_extendedprice from lineitem
qualify row_number() over (partition by l_orderkey, l_suppkey order by l_linenumber, l_partkey, l_extendedprice) = 1""",
    "o2_sorted_by_key": "select o_custkey, o_orderdate, o_orderkey, o_totalprice from orders",
    "o3_station_list": "select distinct user_id from events order by 1",
    "o4_export_order": f"""
select {HOUR} as period, cast(user_id as varchar) as ba_code, event_type as type_code, value as value_mwh from events""",
    "u2_concat": "select event_id, event_type, value from events",
    "t_spine": f"with {_SPINE_SQL} select hour_key from spine",
    "t_gap_hours": f"""
with {_SPINE_SQL},
seen as (select distinct event_type, cast(user_id as varchar) as u, {HOUR} as h from events),
series as (select distinct event_type, u from seen)
select event_type as type_code, u as ba_code, hour_key as period from series, spine
where not exists (
  select 1 from seen where seen.event_type = series.event_type and seen.u = series.u and h = hour_key)""",
    "t_dst_days": f"""
with d as (select distinct l_returnflag, l_shipdate from lineitem),
h as (select l_returnflag, unnest(generate_series(l_shipdate, l_shipdate + interval 23 hour, interval 1 hour)) as started from d)
select l_returnflag,
  cast(timezone('America/New_York', timezone('UTC', started)) as date) as local_day, count(*) as hours_present,
  count(*) >= 23 as is_complete_day
from h group by 1, 2""",
}

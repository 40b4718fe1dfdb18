"""Expectations, key audits and acceptance on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from workloads import feeds, models
from workloads.feeds import table
from workloads.models import G1_SQL, USER_ZONE, letter
from zephyrload import schemas
from zephyrload.operators import quality
from zephyrload.plans import silver

RULES = {
    "valid_type": "kind IS NOT NULL",
    "valid_value": "value IS NOT NULL",
    "valid_user": "user_id >= 0",
}


def holed_events(spark, sf):
    """Events whose error types and round values are missing."""
    return table(spark, sf, "events").select(
        "event_id", "user_id",
        F.nullif("event_type", F.lit("error")).alias("kind"),
        F.when(F.col("value") != F.floor("value"), F.col("value")).alias("value"),
    )


def f3_expect(spark, sf):
    return quality.expect(holed_events(spark, sf), RULES)


def q1_violations(spark, sf):
    return quality.violations(holed_events(spark, sf), RULES)


def q2_key_audit(spark, sf):
    return quality.key_audit(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q2_demand_key_audit(spark, sf):
    """Demand keys repeat when a zone reports several records for an hour."""
    return quality.key_audit(feeds.demand_fact(spark, sf), ["period_timestamp", "sub_ba_code"])


def q2_contract_keys(spark, sf):
    """All declared keys of the dimensions; a county lies in the zones of all its event types."""
    weather = feeds.weather_bronze(spark, sf, feeds.type_zone(feeds.WEATHER_ZONES))
    return quality.contract_key_audit(
        [
            (schemas.DIM_BALANCING_AUTHORITY, models.d1_balancing_authority(spark, sf)),
            (schemas.DIM_ENERGY_SOURCE, models.d2_energy_source(spark, sf)),
            (schemas.DIM_METRIC_TYPE, models.d3_metric_type(spark, sf)),
            (schemas.DIM_SUBREGION, models.d4_subregion(spark, sf)),
            (schemas.DIM_COUNTY, silver.dimension(weather, schemas.DIM_COUNTY)),
            (schemas.DIM_NYISO_ZONE, models.d6_nyiso_zone(spark, sf)),
            (schemas.DIM_WEATHER_STATION, models.d7_weather_station(spark, sf)),
            (schemas.DIM_COMBINED_ZONE, models.d8_combined_zone(spark, sf)),
        ]
    )


def q3_reference_audit(spark, sf):
    suppliers = table(spark, sf, "supplier")
    return quality.reference_audit(table(spark, sf, "events"), "user_id", suppliers, "s_suppkey")


def q3_contract_references(spark, sf):
    """All declared references of the demand fact."""
    dims = {
        schemas.DIM_BALANCING_AUTHORITY.name: table(spark, sf, "supplier").select(
            F.col("s_suppkey").cast("string").alias("ba_code")
        ),
        schemas.DIM_COMBINED_ZONE.name: feeds.nation_zones(spark, sf),
    }
    return quality.contract_reference_audit(feeds.demand_fact(spark, sf), schemas.FACT_DEMAND, dims)


def q4_acceptance(spark, sf):
    """Daily demand and weather checked before it is published."""
    return quality.acceptance(
        models.g1_daily_demand_weather(spark, sf), ["demand_date", "nyiso_zone"], "demand_date", 31,
        join_key="nyiso_zone", dim=feeds.nation_zones(spark, sf), dim_key="nyiso_zone",
    )


QUERIES = {
    "f3_expect": f3_expect,
    "q1_violations": q1_violations,
    "q2_key_audit": q2_key_audit,
    "q2_demand_key_audit": q2_demand_key_audit,
    "q2_contract_keys": q2_contract_keys,
    "q3_reference_audit": q3_reference_audit,
    "q3_contract_references": q3_contract_references,
    "q4_acceptance": q4_acceptance,
}

_HOLED = """
holed as (
  select event_id, user_id, nullif(event_type, 'error') as kind, case when value <> floor(value) then value end as value
  from events)"""
_ZONE = letter(f"'ZON' || {USER_ZONE}")

_COUNTY = "select distinct 'S' || user_id || '-' || i as code, event_type from events cross join (values (0), (1), (2)) c(i)"
_DIMENSIONS = {
    "dim_balancing_authority": ("ba_code", models.ORACLE["d1_balancing_authority"]),
    "dim_energy_source": ("fuel_code", models.ORACLE["d2_energy_source"]),
    "dim_metric_type": ("type_code", models.ORACLE["d3_metric_type"]),
    "dim_subregion": ("sub_ba_code", models.ORACLE["d4_subregion"]),
    "dim_county": ("code", _COUNTY),
    "dim_nyiso_zone": ("nyiso_zone", models.ORACLE["d6_nyiso_zone"]),
    "dim_weather_station": ("station_id", models.ORACLE["d7_weather_station"]),
    "dim_combined_zone": ("nyiso_zone", models.ORACLE["d8_combined_zone"]),
}

ORACLE = {
    "q2_contract_keys": "\nunion all ".join(
        f"""
select 'silver.{name}' as table_name, coalesce(cast({key} as varchar), '') as key_values, count(*) as row_count
from ({sql}) group by {key} having count(*) > 1"""
        for name, (key, sql) in _DIMENSIONS.items()
    ),
    "f3_expect": f"with {_HOLED} select * from holed where kind is not null and value is not null and user_id >= 0",
    "q1_violations": f"""
with {_HOLED}
select count(*) filter (kind is null) as valid_type, count(*) filter (value is null) as valid_value,
  count(*) filter (user_id < 0) as valid_user,
  count(*) filter (kind is null or value is null or user_id < 0) as dropped_rows, count(*) as all_rows
from holed""",
    "q2_key_audit": """
select l_orderkey, l_linenumber, count(*) as row_count from lineitem group by 1, 2 having count(*) > 1""",
    "q2_demand_key_audit": f"""
select {models.HOUR} as period_timestamp, {_ZONE} as sub_ba_code, count(*) as row_count
from events group by 1, 2 having count(*) > 1""",
    "q3_reference_audit": """
select user_id, count(*) as orphan_rows from events where user_id not in (select s_suppkey from supplier) group by 1""",
    "q3_contract_references": f"""
select 'ba_code -> silver.dim_balancing_authority' as reference, cast(user_id as varchar) as code, count(*) as orphan_rows
from events where user_id not in (select s_suppkey from supplier) group by 2
union all
select 'sub_ba_code -> silver.dim_combined_zone', {_ZONE}, count(*)
from events where {_ZONE} not in (select chr(65 + n_nationkey) from nation) group by 2""",
    "q4_acceptance": f"""
with model as ({G1_SQL}),
grain as (select demand_date, nyiso_zone, count(*) as n from model group by 1, 2)
select 'not_empty' as check_name, count(*) > 0 as passed, count(*) as detail from model
union all select 'one_row_per_grain', count(*) = 0, count(*) from grain where n > 1
union all select 'grain_known', count(*) = 0, count(*) from grain where demand_date is null or nyiso_zone is null
union all select 'no_overall_row', count(*) = 0, count(*) from grain where upper(nyiso_zone) = 'OVERALL'
union all select 'expected_days', count(distinct demand_date) = 31, count(distinct demand_date) from model
union all select 'keys_matched', count(*) = 0, count(*) from model
  where nyiso_zone not in (select chr(65 + n_nationkey) from nation)""",
}

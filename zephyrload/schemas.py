"""Declared table contracts: columns, comments, keys, references, expectations.

The contracts are data only. ``conform`` applies the columns, ``operators.quality``
checks the rest; nothing here is enforced by storage.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Reference:
    """A foreign key that storage does not enforce."""

    column: str
    table: str
    target: str


@dataclass(frozen=True)
class Contract:
    """What a published table promises."""

    name: str
    comment: str
    schema: T.StructType | None = None
    required: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    references: tuple[Reference, ...] = field(default=())

    @property
    def expectations(self) -> dict[str, str]:
        """Rule name to predicate; a row breaking any of them is dropped."""
        return {f"valid_{column}": f"{column} IS NOT NULL" for column in self.required}


def _columns(*specs: tuple[str, str, str]) -> T.StructType:
    types = {
        "string": T.StringType(),
        "double": T.DoubleType(),
        "bigint": T.LongType(),
        "utc": T.TimestampNTZType(),
        "instant": T.TimestampType(),
        "date": T.DateType(),
        "variant": T.VariantType(),
    }
    return T.StructType(
        [
            T.StructField(name, types[kind], True, {"comment": comment} if comment else None)
            for name, kind, comment in specs
        ]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order, cast, with their comments."""
    return df.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata or {})
            for f in schema.fields
        ]
    )


# --- landing -----------------------------------------------------------------

SAVED_RESPONSE = _columns(
    ("run_id", "string", "load run"),
    ("request_timestamp", "instant", "time of the request"),
    ("target_dt", "string", "requested hour key"),
    ("offset_start", "bigint", "first record asked for"),
    ("status_code", "bigint", "HTTP status"),
    ("status", "string", "HTTP reason"),
    ("body", "string", "response text as received"),
)

LANDING = _columns(
    ("run_id", "string", "load run"),
    ("request_timestamp", "instant", "time of the request"),
    ("target_dt", "string", "requested hour key"),
    ("page", "bigint", "1-based page of the hour"),
    ("offset_start", "bigint", "first record asked for"),
    ("status_code", "bigint", "HTTP status"),
    ("status", "string", "HTTP reason"),
    ("raw_response", "variant", "payload, an empty object after a failed request"),
    ("response_hash", "string", "hash of the payload, for change detection"),
    ("error_msg", "string", "response text of a failed request"),
    ("record_count", "bigint", "records in the payload"),
)
LANDING_KEY = ("target_dt", "page")

# --- weather sources ---------------------------------------------------------

ZONE_COUNTY_TEXT = _columns(
    *[
        (name, "string", "")
        for name in (
            "state", "zone", "cwa", "zone_name", "state_zone", "county",
            "fips", "time_zone", "fe_area", "latitude", "longitude",
        )
    ]
)

STATION_COLLECTION = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "properties",
                            T.StructType(
                                [
                                    T.StructField("sid", T.StringType()),
                                    T.StructField("sname", T.StringType()),
                                    T.StructField("archive_begin", T.StringType()),
                                    T.StructField("archive_end", T.StringType()),
                                ]
                            ),
                        ),
                        T.StructField(
                            "geometry",
                            T.StructType(
                                [T.StructField("coordinates", T.ArrayType(T.DoubleType()))]
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)

OBSERVATION_COLUMNS = ("station", "valid", "tmpf", "sped")
OBSERVATIONS = _columns(
    ("station_id", "string", ""),
    ("observed_at_utc", "utc", ""),
    ("temperature", "double", ""),
    ("temperature_unit", "string", ""),
    ("wind_speed", "double", ""),
    ("wind_speed_unit", "string", ""),
)

WEATHER_BRONZE = Contract(
    "bronze.bronze_weather_data",
    "Station readings repeated for every zone-county the station serves",
    _columns(
        ("state_zone", "string", "forecast zone"),
        ("zone_name", "string", "forecast zone name"),
        ("county", "string", "county name"),
        ("fips", "string", "county code"),
        ("nyiso_zone", "string", "load zone letter"),
        ("nyiso_zone_name", "string", "load zone name"),
        ("station_id", "string", "nearest station"),
        ("station_name", "string", "nearest station name"),
        ("distance_km", "double", "distance to the station"),
        ("observed_at_utc", "utc", "time of the reading, UTC"),
        ("temperature", "double", "air temperature"),
        ("temperature_unit", "string", "unit of temperature"),
        ("wind_speed", "double", "wind speed"),
        ("wind_speed_unit", "string", "unit of wind speed"),
        ("ingested_at_utc", "instant", "load time"),
    ),
)
WEATHER_KEY = ("state_zone", "fips", "observed_at_utc")

# --- silver dimensions -------------------------------------------------------


def _dimension(name: str, comment: str, key: str, *columns: tuple[str, str]) -> Contract:
    schema = _columns(*[(column, "string", text) for column, text in columns])
    return Contract(f"silver.{name}", comment, schema, required=(key,), key=(key,))


DIM_BALANCING_AUTHORITY = _dimension(
    "dim_balancing_authority", "Balancing authorities", "ba_code",
    ("ba_code", "authority code"), ("ba_name", "authority name"),
)
DIM_ENERGY_SOURCE = _dimension(
    "dim_energy_source", "Energy sources", "fuel_code",
    ("fuel_code", "fuel code"), ("fuel_name", "fuel name"),
)
DIM_METRIC_TYPE = _dimension(
    "dim_metric_type", "Operating metrics", "type_code",
    ("type_code", "metric code"), ("type_name", "metric name"),
)
DIM_SUBREGION = _dimension(
    "dim_subregion", "Sub-areas by zone letter", "sub_ba_code",
    ("sub_ba_code", "zone letter"), ("sub_ba_name", "sub-area name"),
)
DIM_COUNTY = _dimension(
    "dim_county", "Forecast zones and their counties", "fips",
    ("state_zone", "forecast zone, unrelated to load zones"),
    ("zone_name", "forecast zone name"), ("county", "county name"), ("fips", "county code"),
)
DIM_NYISO_ZONE = _dimension(
    "dim_nyiso_zone", "Load zones seen in weather", "nyiso_zone",
    ("nyiso_zone", "zone letter"), ("nyiso_zone_name", "zone name"),
)
DIM_WEATHER_STATION = _dimension(
    "dim_weather_station", "Weather stations", "station_id",
    ("station_id", "station"), ("station_name", "station name"),
)
DIM_COMBINED_ZONE = _dimension(
    "dim_combined_zone", "Zones shared by demand and weather", "nyiso_zone",
    ("nyiso_zone", "zone letter"), ("nyiso_zone_name", "zone name"),
)

# --- silver facts ------------------------------------------------------------


def _electricity_fact(
    name: str, comment: str, key: str, code: str, code_text: str, code_reference: Reference
) -> Contract:
    return Contract(
        f"silver.{name}",
        comment,
        _columns(
            (key, "string", "record key"),
            ("period_timestamp", "string", "hour key, UTC"),
            ("ba_code", "string", "authority code"),
            (code, "string", code_text),
            ("value_mwh", "double", "megawatt-hours"),
            ("bronze_processed_timestamp", "instant", "bronze load time"),
            ("silver_processed_timestamp", "instant", "silver load time"),
        ),
        required=(key, "period_timestamp"),
        references=(
            Reference("ba_code", DIM_BALANCING_AUTHORITY.name, "ba_code"),
            code_reference,
        ),
    )


FACT_OPERATIONS = _electricity_fact(
    "fact_nyiso_operation_metrics", "Hourly operating metrics", "rom_id",
    "type_code", "metric code", Reference("type_code", DIM_METRIC_TYPE.name, "type_code"),
)
FACT_GENERATION = _electricity_fact(
    "fact_nyiso_generation_energy_source", "Hourly generation by fuel", "ges_id",
    "fuel_code", "fuel code", Reference("fuel_code", DIM_ENERGY_SOURCE.name, "fuel_code"),
)
FACT_DEMAND = _electricity_fact(
    "fact_nyiso_subregional_demand", "Hourly demand by load zone", "srd_id",
    "sub_ba_code", "zone letter", Reference("sub_ba_code", DIM_COMBINED_ZONE.name, "nyiso_zone"),
)
FACT_WEATHER = Contract(
    "silver.fact_weather_data",
    "Readings per zone-county with their nearest hour",
    _columns(
        ("state_zone", "string", "forecast zone, unrelated to load zones"),
        ("fips", "string", "county code"),
        ("nyiso_zone", "string", "load zone letter"),
        ("station_id", "string", "station"),
        ("distance_km", "double", "distance to the station"),
        ("observed_at_utc", "utc", "time of the reading, UTC"),
        ("observation_hour", "string", "nearest hour key, UTC"),
        ("temperature", "double", "degrees Fahrenheit"),
        ("wind_speed", "double", "miles per hour"),
        ("bronze_processed_timestamp", "instant", "bronze load time"),
        ("silver_processed_timestamp", "instant", "silver load time"),
    ),
    required=("observed_at_utc", "station_id"),
    references=(
        Reference("station_id", DIM_WEATHER_STATION.name, "station_id"),
        Reference("nyiso_zone", DIM_COMBINED_ZONE.name, "nyiso_zone"),
        Reference("fips", DIM_COUNTY.name, "fips"),
    ),
)

# --- gold --------------------------------------------------------------------

GOLD_DAILY_BY_ZONE = Contract(
    "gold.gold_daily_weather_electricity_demand_by_nyiso_zone",
    "Daily demand and weather per load zone on the local calendar",
    required=("nyiso_zone", "demand_date"),
    key=("demand_date", "nyiso_zone"),
)
GOLD_NYC_DAILY = Contract(
    "gold.gold_nyc_daily_electricity_weather_past_year",
    "Daily demand and weather of one zone, trailing year",
    required=("report_date",),
    key=("report_date",),
)
GOLD_NYC_BANDS = Contract(
    "gold.gold_nyc_demand_by_temperature_band_past_year",
    "Demand of one zone by temperature band, trailing year",
    required=("temperature_band_low_f",),
    key=("temperature_band_low_f",),
)
GOLD_MONTHLY_TEMPERATURE = Contract(
    "gold.gold_monthly_temperature_by_nyiso_zone",
    "Monthly temperature per load zone beside the statewide mean",
    required=("nyiso_zone", "month_start_date"),
    key=("month_start_date", "nyiso_zone"),
)
GOLD_DAILY_WEATHER = Contract(
    "gold.gold_daily_weather_by_nyiso_zone",
    "Daily weather per load zone on the local calendar",
    required=("nyiso_zone", "observation_date"),
    key=("observation_date", "nyiso_zone"),
)

# Load zone names.
ZONE_NAMES = {
    "A": "WEST", "B": "GENESE", "C": "CENTRL", "D": "NORTH", "E": "MHK VL", "F": "CAPITL",
    "G": "HUD VL", "H": "MILLWD", "I": "DUNWOD", "J": "N.Y.C.", "K": "LONGIL",
}

# Load zone of each county code (no county maps to H).
COUNTY_ZONES = {
    "36003": "A",
    "36009": "A",
    "36013": "A",
    "36029": "A",
    "36037": "A",
    "36063": "A",
    "36073": "A",
    "36121": "A",
    "36051": "B",
    "36055": "B",
    "36069": "B",
    "36117": "B",
    "36123": "B",
    "36007": "C",
    "36011": "C",
    "36015": "C",
    "36017": "C",
    "36023": "C",
    "36053": "C",
    "36067": "C",
    "36075": "C",
    "36097": "C",
    "36099": "C",
    "36101": "C",
    "36107": "C",
    "36109": "C",
    "36019": "D",
    "36031": "D",
    "36033": "D",
    "36025": "E",
    "36041": "E",
    "36043": "E",
    "36045": "E",
    "36049": "E",
    "36057": "E",
    "36065": "E",
    "36077": "E",
    "36089": "E",
    "36001": "F",
    "36021": "F",
    "36035": "F",
    "36039": "F",
    "36083": "F",
    "36091": "F",
    "36093": "F",
    "36095": "F",
    "36113": "F",
    "36115": "F",
    "36027": "G",
    "36071": "G",
    "36079": "G",
    "36087": "G",
    "36105": "G",
    "36111": "G",
    "36119": "I",
    "36005": "J",
    "36047": "J",
    "36061": "J",
    "36081": "J",
    "36085": "J",
    "36059": "K",
    "36103": "K",
}

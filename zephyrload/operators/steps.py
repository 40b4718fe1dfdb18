"""Stepped means and daily statistics."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zephyrload.functions.timekeys import LOCAL_ZONE, first_key_of_local_day, local_date


def stepped_mean(
    df: DataFrame, grains: list[list[str]], measures: Mapping[str, str]
) -> DataFrame:
    """A1, A2: mean per first grain, then the mean of those per next grain, …

    ``measures`` maps output names to input columns. Means combine before each
    shuffle, so repeated rows of one station never travel.
    """
    names = dict(measures)
    for grain in grains:
        df = df.groupBy(*grain).agg(*[F.avg(c).alias(name) for name, c in names.items()])
        names = {name: name for name in names}
    return df


def partial_means(df: DataFrame, grain: list[str], measures: Mapping[str, str]) -> DataFrame:
    """What means over ``grain`` are made of: a sum and a count of known values per measure.

    Such rows of disjoint records add up to those of all (``merged_partials``), so new
    records never need the old ones again.
    """
    sums = [F.sum(c).alias(f"{name}_sum") for name, c in measures.items()]
    counts = [F.count(c).alias(f"{name}_count") for name, c in measures.items()]
    return df.groupBy(*grain).agg(*sums, *counts)


def merged_partials(parts: list[DataFrame], grain: list[str]) -> DataFrame:
    """Sums and counts over all parts."""
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy(*grain).agg(*[F.sum(c).alias(c) for c in every.columns if c not in grain])


def means_of(partials: DataFrame, grain: list[str], measures: list[str]) -> DataFrame:
    """The means that sums and counts stand for; without a known value, NULL."""
    return partials.select(*grain, *[F.try_divide(F.col(f"{m}_sum"), F.col(f"{m}_count")).alias(m) for m in measures])


def hourly_demand(fact: DataFrame, hour: list[str], value: str = "value_mwh") -> DataFrame:
    """One row per hour of what daily figures need, combined ahead of the shuffle.

    Sums, peak and counts over any set of hours follow from these columns, so
    calendar conversion and joins run per hour and not per record.
    """
    return fact.groupBy(*hour).agg(
        F.sum(value).alias("mwh"),
        F.max(value).alias("peak"),
        F.count(value).alias("known"),
        F.count(F.lit(1)).alias("records"),
    )


def demand_measures() -> list[Column]:
    """A4 over rows of ``hourly_demand``: total, mean, peak, number of known values."""
    return [
        F.sum("mwh").alias("total_demand_mwh"),
        F.try_divide(F.sum("mwh"), F.sum("known")).alias("avg_hourly_demand_mwh"),
        F.max("peak").alias("peak_hourly_demand_mwh"),
        F.sum("known").alias("demand_hours"),
    ]


def weather_statistics(df: DataFrame, grain: list[str]) -> DataFrame:
    """A5: mean, extremes and number of known hours."""
    return df.groupBy(*grain).agg(
        F.avg("temperature_f").alias("avg_temperature_f"),
        F.min("temperature_f").alias("min_temperature_f"),
        F.max("temperature_f").alias("max_temperature_f"),
        F.avg("wind_speed_mph").alias("avg_wind_speed_mph"),
        F.count("temperature_f").alias("weather_hours"),
    )


class TrailingWindow:
    """The last ``days`` local days up to the latest hour of ``hours``.

    The bounds are scalar subqueries: they need no cross join, and Spark hands
    their values to the scan being filtered. Without any hour they are NULL
    and every filter is empty.
    """

    def __init__(self, hours: DataFrame, key: str, days: int, zone: str = LOCAL_ZONE):
        self._hours, self._zone = hours, zone
        self._end = local_date(F.max(key), zone)
        self._start = F.date_sub(self._end, days - 1)

    def bounds(self) -> DataFrame:
        """One row: start_date, end_date."""
        return self._hours.agg(self._start.alias("start_date"), self._end.alias("end_date"))

    def _value(self, bound: Column, name: str) -> Column:
        return self._hours.agg(bound.alias(name)).scalar()

    def only(self, df: DataFrame, key: str) -> DataFrame:
        """Rows whose hour lies on a day of the window, both ends included."""
        first = self._value(first_key_of_local_day(self._start, self._zone), "first_key")
        after = self._value(first_key_of_local_day(F.date_add(self._end, 1), self._zone), "after_key")
        inside = df.filter((F.col(key) >= first) & (F.col(key) < after))
        if "utc_day" not in df.columns:
            return inside
        # tables stored by day: skip the days that cannot hold such an hour
        first_day = self._value(F.date_sub(self._start, 1), "first_day")
        last_day = self._value(F.date_add(self._end, 1), "last_day")
        return inside.filter(F.col("utc_day").between(first_day, last_day))


def monthly_statistics(daily: DataFrame, month: str, grain: list[str], mean: str) -> DataFrame:
    """Mean and extremes of the daily means, and the days behind them."""
    return daily.groupBy(month, *grain).agg(
        F.avg(mean).alias("avg_temperature_f"),
        F.min(mean).alias("min_daily_avg_temperature_f"),
        F.max(mean).alias("max_daily_avg_temperature_f"),
        F.count(mean).alias("days_observed"),
    )


def beside_period_mean(df: DataFrame, period: str, value: str, name: str) -> DataFrame:
    """The mean over all rows of a period beside each of its rows."""
    return df.withColumn(name, F.avg(value).over(Window.partitionBy(period)))

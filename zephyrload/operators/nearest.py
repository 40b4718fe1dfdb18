"""Nearest station of every point, exactly and without comparing all pairs.

Points and stations are placed on the unit sphere, where straight-line and
great-circle distance order stations alike. Space is cut into cubes, each level
four times finer per axis. A point starts from the coarse cubes holding
stations and keeps, level by level, only those that can still contain its
nearest station: a cube is dropped when even its closest corner lies beyond
the farthest corner of another occupied cube. Every step is an equi-join on
the cube, and the surviving cubes of the finest level name the stations that
are measured with the haversine formula.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zephyrload.functions.geo import haversine_km, unit_vector

FINEST = 20  # bits per axis: cubes of about 12 m
STEP = 2  # bits added per level
STATIONS_PER_CUBE = 16  # a level this sparse needs no finer one
SLACK = 1e-14  # squared chord; far above rounding, keeps equal distances in play

_AXES = ("x", "y", "z")


def _finest_cube() -> Column:
    """Id of the smallest cube around x, y, z: the bits of the three axes in turn."""
    top = F.lit(2**FINEST - 1)
    parts = [
        F.least(F.floor((F.col(axis) + 1.0) * float(2 ** (FINEST - 1))), top).cast("long")
        for axis in _AXES
    ]
    return (
        F.shiftleft(parts[0], 2 * FINEST)
        .bitwiseOR(F.shiftleft(parts[1], FINEST))
        .bitwiseOR(parts[2])
    )


def _cube(level: int) -> Column:
    """The enclosing cube at a level: the leading bits of every axis."""
    leading = (2**level - 1) << (FINEST - level)
    mask = leading << (2 * FINEST) | leading << FINEST | leading
    return F.col("finest").bitwiseAND(F.lit(mask))


def _chord_bounds(cube: Column, level: int) -> tuple[Column, Column]:
    """Least and greatest squared distance from x, y, z to a cube."""
    side = 2.0 / 2**level
    axis_bits = F.lit(2**FINEST - 1)
    near, far = [], []
    for position, axis in enumerate(_AXES):
        index = F.shiftright(cube, FINEST * (2 - position)).bitwiseAND(axis_bits)
        low = index * (2.0 / 2**FINEST) - 1.0
        at = F.col(axis)
        outside = F.greatest(low - at, at - (low + side), F.lit(0.0))
        reach = F.greatest(F.abs(at - low), F.abs(at - (low + side)))
        near.append(outside * outside)
        far.append(reach * reach)
    return reduce(Column.__add__, near), reduce(Column.__add__, far)


def _prune(candidates: DataFrame, level: int) -> DataFrame:
    """Drop cubes that cannot hold the nearest station of their point."""
    near, far = _chord_bounds(F.col("cube"), level)
    per_point = Window.partitionBy("lat", "lon")
    return (
        candidates.withColumn("_near", near)
        .withColumn("_reach", F.min(far).over(per_point))
        .filter(F.col("_near") <= F.col("_reach") + SLACK)
        .drop("_near", "_reach")
    )


def _placed(df: DataFrame) -> DataFrame:
    x, y, z = unit_vector(F.col("lat"), F.col("lon"))
    return df.withColumn("x", x).withColumn("y", y).withColumn("z", z)


def _levels(sites: DataFrame) -> list[int]:
    """Levels to walk: from the last with one occupied cube to a sparse one.

    Stations are counted per cube and level by Spark; one row per level, eleven
    whatever their number, comes back.
    """
    levels = list(range(0, FINEST + 1, STEP))
    cubes = F.array(*[F.struct(F.lit(k).alias("level"), _cube(k).alias("cube")) for k in levels])
    occupied = (
        sites.select(F.explode(cubes).alias("c")).groupBy("c.level", "c.cube").agg(F.count(F.lit(1)).alias("n"))
    )
    per_level = occupied.groupBy("level").agg(
        F.count(F.lit(1)).alias("cubes"), F.max("n").alias("fullest")
    )
    rows = {row.level: row for row in per_level.collect()}
    if not rows:
        return [0]
    start = max(k for k in levels if rows[k].cubes == 1)
    sparse = [k for k in levels if k >= start and rows[k].fullest <= STATIONS_PER_CUBE]
    return [k for k in levels if start <= k <= (sparse[0] if sparse else FINEST)]


def nearest_station(
    points: DataFrame,
    stations: DataFrame,
    point_lat: str = "latitude",
    point_lon: str = "longitude",
    station_id: str = "station_id",
    station_lat: str = "station_latitude",
    station_lon: str = "station_longitude",
    digits: int | None = 1,
) -> DataFrame:
    """Points with the columns of their closest station and ``distance_km``.

    Equal distances go to the lowest station id. The distance is rounded half
    to even. Points without coordinates keep NULL station columns.
    """
    spots = _placed(
        points.select(F.col(point_lat).cast("double").alias("lat"), F.col(point_lon).cast("double").alias("lon"))
        .dropna()
        .distinct()
    )
    located = stations.dropna(subset=[station_id, station_lat, station_lon])
    # stations sharing a place differ only by id, so the lowest one stands for all
    sites = _placed(
        located.groupBy(
            F.col(station_lat).cast("double").alias("lat"), F.col(station_lon).cast("double").alias("lon")
        ).agg(
            F.min_by(F.struct(*[F.col(c) for c in stations.columns]), F.col(station_id)).alias("site")
        )
    ).withColumn("finest", _finest_cube())
    levels = _levels(sites)
    # all stations lie in one cube of the first level
    whole = sites.select(_cube(levels[0]).alias("cube")).distinct()
    frontier = spots.withColumn("cube", whole.scalar())
    for coarse, fine in zip(levels, levels[1:]):
        parts = sites.select(_cube(coarse).alias("cube"), _cube(fine).alias("part")).distinct()
        opened = frontier.join(parts, "cube").drop("cube").withColumnRenamed("part", "cube")
        frontier = _prune(opened, fine)
    measured = frontier.select("lat", "lon", "cube").join(
        sites.select(
            _cube(levels[-1]).alias("cube"),
            F.col("lat").alias("s_lat"),
            F.col("lon").alias("s_lon"),
            "site",
        ),
        "cube",
    )
    distance = haversine_km(F.col("lat"), F.col("lon"), F.col("s_lat"), F.col("s_lon"))
    closest = (
        measured.withColumn("km", distance)
        .groupBy("lat", "lon")
        .agg(F.min(F.struct("km", F.col(f"site.{station_id}").alias("id"), "site")).alias("best"))
    )
    km = F.col("best.km")
    found = closest.select(
        F.col("lat").alias("_lat"),
        F.col("lon").alias("_lon"),
        *[F.col(f"best.site.{c}").alias(c) for c in stations.columns],
        (km if digits is None else F.bround(km, digits)).alias("distance_km"),
    )
    same_place = (F.col(point_lat).cast("double") == F.col("_lat")) & (
        F.col(point_lon).cast("double") == F.col("_lon")
    )
    return points.join(found, same_place, "left").drop("_lat", "_lon")

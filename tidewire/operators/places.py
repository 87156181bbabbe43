"""Country coordinates and the density of messages on a grid."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidewire import fixed_values as fixed
from tidewire.session import small_table

Points = Sequence[tuple[str, float, float]]

PLACE = StructType([
    StructField("place", StringType(), False),
    StructField("lat", DoubleType(), False),
    StructField("lon", DoubleType(), False),
])


def places_table(spark: SparkSession, points: Points = fixed.COUNTRY_POINTS) -> DataFrame:
    names = [name for name, _, _ in points]
    if len(set(names)) != len(names):
        raise ValueError("a place is listed twice")
    return small_table(spark, points, PLACE)


def keyed_normals(key: Column, seed: int = 0) -> tuple[Column, Column]:
    """Two independent normal numbers by Box and Muller from a hash of a key.

    They depend on key and seed alone, so partitions, retries and reruns do not change them. Rows
    without a key share theirs.
    """
    digits = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))

    def uniform(first: int) -> Column:
        return (F.conv(F.substring(digits, first, 12), 16, 10).cast("bigint") + 0.5) / 2.0 ** 48

    distance = F.sqrt(F.log(uniform(1)) * -2.0)
    angle = uniform(13) * (2 * math.pi)
    return distance * F.cos(angle), distance * F.sin(angle)


def geo_lookup(df: DataFrame, points: Points = fixed.COUNTRY_POINTS, *, country: str = "country",
               default: str = fixed.DEFAULT_COUNTRY, jitter: float = 0.0,
               seed: int | None = None, key: str | None = None) -> DataFrame:
    """Add latitude and longitude by country; unknown and NULL countries get the default's point.

    ``jitter`` adds normal noise of that many degrees to each coordinate. With ``key`` the noise is
    a message's own, by its id, and coordinates are rounded to a millionth of a degree; without, it
    is drawn anew.
    """
    table = places_table(df.sparkSession, points)
    at = {name: (lat, lon) for name, lat, lon in points}[default]
    joined = df.join(table, F.col(country) == F.col("place"), "left")
    lat = F.coalesce(F.col("lat"), F.lit(at[0]))
    lon = F.coalesce(F.col("lon"), F.lit(at[1]))
    if jitter and key is not None:
        north, east = keyed_normals(F.col(key), seed or 0)
        lat, lon = F.round(lat + north * jitter, 6), F.round(lon + east * jitter, 6)
    elif jitter:
        lat = lat + F.lit(jitter) * F.randn(seed)
        lon = lon + F.lit(jitter) * F.randn(None if seed is None else seed + 1)
    return joined.select(*[F.col(name) for name in df.columns], lat.alias("lat"), lon.alias("lon"))


def geo_density(df: DataFrame, points: Points = fixed.COUNTRY_POINTS, *, step: float = 1.0,
                country: str = "country", sentiment: str = "sentiment",
                polarity: str = fixed.NEGATIVE, default: str = fixed.DEFAULT_COUNTRY,
                jitter: float = 0.0, seed: int | None = None,
                key: str | None = None) -> DataFrame:
    """Messages of one polarity per grid cell of ``step`` degrees.

    Without jitter all messages of a country share a point, so they are counted per country before
    the lookup; with jitter each message has its own.
    """
    chosen = df.filter(F.col(sentiment) == polarity).select(
        country, *([key] if jitter and key is not None else []))
    if jitter:
        counted = chosen.withColumn("_n", F.lit(1).cast("bigint"))
    else:
        counted = chosen.groupBy(country).agg(F.count(F.lit(1)).alias("_n"))
    located = geo_lookup(counted, points, country=country, default=default, jitter=jitter,
                         seed=seed, key=key)
    return (
        located.groupBy(F.floor(F.col("lat") / step).cast("bigint").alias("lat_cell"),
                        F.floor(F.col("lon") / step).cast("bigint").alias("lon_cell"))
        .agg(F.sum("_n").alias("n"))
    )


# the largest radius whose weights, 2^(4 * radius) in all, leave room for some 10^10 messages a cell
MAX_RADIUS = 7


def smooth_density(cells: DataFrame, step: float = 1.0, radius: int = 2) -> DataFrame:
    """Counts per cell spread over their neighbours: lat_cell, lon_cell, weight.

    The kernel is the product of one for each axis, whose whole-number weights are those of
    ``2 * radius`` fair coins, close to a normal curve; a cell's count appears 2^(4 * radius)
    times in all. Spreading goes along one axis and then the other, with sums in between, so a cell
    makes ``2 * radius + 1`` rows twice and not its square; both sums combine in the map tasks.
    Where ``step`` divides 180 degrees, the map closes at the date line. What would fall beyond a
    pole is left out.
    """
    if not 0 <= radius <= MAX_RADIUS:
        raise ValueError(f"the radius is 0 to {MAX_RADIUS} cells")
    weights = F.explode(F.array(*[
        F.struct(F.lit(away).cast("bigint").alias("away"),
                 F.lit(math.comb(2 * radius, radius + away)).cast("bigint").alias("times"))
        for away in range(-radius, radius + 1)])).alias("kernel")

    def spread(df: DataFrame, axis: str, other: str) -> DataFrame:
        moved = df.select(axis, other, "weight", weights).select(
            (F.col(axis) + F.col("kernel.away")).alias(axis), other,
            (F.col("weight") * F.col("kernel.times")).alias("weight"))
        if axis == "lat_cell":
            moved = moved.filter(F.col(axis).between(math.floor(-90 / step), math.floor(90 / step)))
        elif 180 % step == 0:
            half = int(180 // step)
            around = F.pmod(F.col(axis) + half, F.lit(2 * half).cast("bigint")) - half
            moved = moved.withColumn(axis, around)
        return moved.groupBy(axis, other).agg(F.sum("weight").alias("weight"))

    counted = cells.select("lat_cell", "lon_cell", F.col("n").alias("weight"))
    return spread(spread(counted, "lat_cell", "lon_cell"), "lon_cell", "lat_cell").select(
        "lat_cell", "lon_cell", "weight")

"""Joins of trips with small dimensions, checked before they are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.geo import haversine_mi
from ..functions.trip_columns import prefix_columns
from ..session import pin

# 200,000 rows of a dimension row (ids, names, a few decimals) stay well below
# 100 MB; past it the join is left to shuffle, where AQE splits skewed keys.
BROADCAST_ROWS = 200_000


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, computed: bool = False) -> DataFrame:
    """Mark ``df`` for broadcast only when a count proves it is small.

    A larger side comes back without a hint, so the join shuffles and adaptive
    execution splits hot keys. Counting moves no rows and reads no columns that
    ``df`` does not need; a written table is counted from its file footers. A
    side that takes an aggregate or a join to get (``computed``) is kept first,
    so that it is computed once and not by the count and the join each.
    """
    df = pin(df) if computed else df
    return F.broadcast(df) if df.count() <= max_rows else df


def known_zones(zones: DataFrame) -> DataFrame:
    """Zones whose borough is known."""
    return zones.where(F.col("borough").isNotNull() & (F.col("borough") != "Unknown"))


def trips_with_zone(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """trips with the borough and zone of the pickup."""
    z = small_side(zones.select("locationid", "borough", "zone"))
    return trips.join(z, F.col("pickup_locationid") == F.col("locationid"), "inner").select(
        "tripid", F.col("pickup_datetime").alias("datetime"), "borough", "zone", "trip_distance", "fare_amount"
    )


def attach_role(trips: DataFrame, dim: DataFrame, role: str, how: str) -> DataFrame:
    """Join one role (``pickup`` or ``dropoff``) of a zone-keyed dimension."""
    return trips.join(prefix_columns(dim, role), f"{role}_locationid", how)


def attach_zones(trips: DataFrame, zones: DataFrame, how: str = "inner") -> DataFrame:
    """Pickup and dropoff borough and zone from one zone table."""
    z = small_side(zones.select("locationid", "borough", "zone"))
    return attach_role(attach_role(trips, z, "pickup", how), z, "dropoff", how)


def attach_centroids(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """pickup and dropoff coordinates; trips without a zone keep NULLs."""
    z = small_side(zones.select("locationid", "lat", "lon"))
    return attach_role(attach_role(trips, z, "pickup", "left"), z, "dropoff", "left")


def attach_climate(trips: DataFrame, climate: DataFrame) -> DataFrame:
    """daily climate by pickup date, never more than one row per trip.

    The climate side is cut to one row per date, the least in column order, so a
    repeated date cannot multiply trips and always gives the same row;
    ``operators.quality.climate_fanout`` reports such dates.
    """
    rest = [c for c in climate.columns if c != "climate_date"]
    least = climate.groupBy("climate_date").agg(F.min(F.struct(*rest)).alias("_row"))
    one_per_day = small_side(least.select("climate_date", *[F.col(f"_row.{c}").alias(c) for c in rest]), computed=True)
    return trips.join(one_per_day, F.col("pickup_date") == F.col("climate_date"), "left")


def zones_known_flag(raw: DataFrame, zones: DataFrame) -> DataFrame:
    """flag trips whose two zones are both known, keeping every trip."""
    known = known_zones(zones).select("locationid").distinct().withColumn("known", F.lit(True))
    known = small_side(known, computed=True)
    out = attach_role(attach_role(raw, known, "pickup", "left"), known, "dropoff", "left")
    both = F.coalesce(F.col("pickup_known") & F.col("dropoff_known"), F.lit(False))
    return out.withColumn("zones_known", both).drop("pickup_known", "dropoff_known")


def route_matrix(pairs: DataFrame, zones: DataFrame, mph: float = 12.0) -> DataFrame:
    """Straight-line miles, and minutes at a given speed, for pairs of zones.

    ``pairs`` holds the distinct (pickup, dropoff) ids that are needed, so the
    matrix has no more rows than routes that occur. Ids without a zone are left out.
    """
    located = attach_centroids(pairs, zones)
    miles = haversine_mi(F.col("pickup_lat"), F.col("pickup_lon"), F.col("dropoff_lat"), F.col("dropoff_lon"))
    routes = located.select("pickup_locationid", "dropoff_locationid", miles.alias("route_miles"))
    return routes.where(F.col("route_miles").isNotNull()).withColumn("route_minutes", F.col("route_miles") / mph * 60.0)


def attach_route(trips: DataFrame, matrix: DataFrame) -> DataFrame:
    """route miles and minutes by (pickup, dropoff)."""
    return trips.join(small_side(matrix, computed=True), ["pickup_locationid", "dropoff_locationid"], "left")


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """F8: rows of ``fact`` whose key has no row in ``dim``; NULL keys pass."""
    keys = small_side(dim.select(F.col(dim_key).alias("_key")).distinct(), computed=True)
    return fact.where(F.col(fact_key).isNotNull()).join(keys, F.col(fact_key) == F.col("_key"), "left_anti")

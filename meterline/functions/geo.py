"""Great-circle distances and polygon centroids as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import EARTH_RADIUS_M, EARTH_RADIUS_MI


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float) -> Column:
    """Great-circle distance in the unit of ``radius``."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    half_lat, half_lon = (p2 - p1) / 2, (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(half_lon), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres."""
    return haversine(lat1, lon1, lat2, lon2, EARTH_RADIUS_M)


def haversine_mi(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Miles."""
    return haversine(lat1, lon1, lat2, lon2, EARTH_RADIUS_MI)


def zone_centroids(zones_geo: DataFrame, ring: str = "ring") -> DataFrame:
    """Area centroid of each zone's outline.

    ``ring`` is an array of (lon, lat) structs, open or closed. The shoelace
    sums run over the row's own array, so nothing is shuffled. Coordinates are
    taken relative to the first vertex, which keeps the cross products small
    and exact enough; an outline without area falls back to the vertex mean.
    """
    r = F.col(ring)
    x0, y0 = r[0]["lon"], r[0]["lat"]
    rotated = F.concat(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(1))), F.slice(r, 1, 1))
    edges = F.zip_with(
        r, rotated,
        lambda a, b: F.struct(
            ((a["lon"] - x0) * (b["lat"] - y0) - (b["lon"] - x0) * (a["lat"] - y0)).alias("cross"),
            (a["lon"] + b["lon"] - 2 * x0).alias("sx"),
            (a["lat"] + b["lat"] - 2 * y0).alias("sy"),
        ),
    )

    def total(f):
        return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + f(e))

    def mean(field):
        return F.aggregate(r, F.lit(0.0), lambda acc, v: acc + v[field]) / F.size(r)

    sums = zones_geo.select(
        "locationid", x0.alias("x0"), y0.alias("y0"),
        total(lambda e: e["cross"]).alias("double_area"),
        total(lambda e: e["cross"] * e["sx"]).alias("mx"),
        total(lambda e: e["cross"] * e["sy"]).alias("my"),
        mean("lon").alias("mean_lon"), mean("lat").alias("mean_lat"),
    )
    flat = F.abs(F.col("double_area")) < 1e-18
    return sums.select(
        "locationid",
        F.when(flat, F.col("mean_lon")).otherwise(F.col("x0") + F.try_divide("mx", 3 * F.col("double_area"))).alias("lon"),
        F.when(flat, F.col("mean_lat")).otherwise(F.col("y0") + F.try_divide("my", 3 * F.col("double_area"))).alias("lat"),
    )


def _ring_sums(ring: Column) -> Column:
    """Twice the signed area of a ring, its centroid, and the sums of its vertices."""
    x0, y0 = ring[0]["lon"], ring[0]["lat"]
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(1))), F.slice(ring, 1, 1))
    crossed = F.zip_with(
        ring, following,
        lambda a, b: F.struct(
            ((a["lon"] - x0) * (b["lat"] - y0) - (b["lon"] - x0) * (a["lat"] - y0)).alias("cross"),
            (a["lon"] + b["lon"] - 2 * x0).alias("sx"), (a["lat"] + b["lat"] - 2 * y0).alias("sy"),
        ),
    )
    start = F.struct(*[F.lit(0.0).alias(n) for n in ("area", "mx", "my")])
    sums = F.aggregate(
        crossed, start,
        lambda acc, e: F.struct(
            (acc["area"] + e["cross"]).alias("area"), (acc["mx"] + e["cross"] * e["sx"]).alias("mx"), (acc["my"] + e["cross"] * e["sy"]).alias("my")),
    )
    total = lambda field: F.aggregate(ring, F.lit(0.0), lambda acc, v: acc + v[field])
    return F.struct(
        sums["area"].alias("area"),
        (x0 + F.coalesce(F.try_divide(sums["mx"], 3 * sums["area"]), F.lit(0.0))).alias("lon"),
        (y0 + F.coalesce(F.try_divide(sums["my"], 3 * sums["area"]), F.lit(0.0))).alias("lat"),
        total("lon").alias("sum_lon"), total("lat").alias("sum_lat"), F.size(ring).alias("vertices"),
    )


def ring_centroids(rings: DataFrame, key: str = "locationid", ring: str = "ring", hole: str = "hole") -> DataFrame:
    """Centroid of each key's area, from one row for each ring.

    ``ring`` is an array of (lon, lat) structs, open or closed and in either
    direction; ``hole`` says that its area is taken away. A key may have any
    number of rings, in several parts. Sums per ring come first, so only those
    are shuffled. Where no area is left, the mean of all vertices stands in.
    Rings that are null or empty count for nothing.
    """
    sums = rings.where(F.size(ring) > 0).select(key, F.col(hole).alias("_hole"), _ring_sums(F.col(ring)).alias("_s"))
    weight = F.abs(F.col("_s.area")) * F.when(F.col("_hole"), -1.0).otherwise(1.0)
    totals = sums.groupBy(key).agg(
        F.sum(weight).alias("w"), F.sum(F.abs("_s.area")).alias("size"), F.sum("_s.vertices").alias("n"),
        *[F.sum(weight * F.col(f"_s.{c}")).alias(f"w_{c}") for c in ("lon", "lat")],
        *[F.sum(f"_s.sum_{c}").alias(f"sum_{c}") for c in ("lon", "lat")],
    )
    empty = (F.abs("w") < 1e-18) | (F.abs("w") < 1e-12 * F.col("size"))
    return totals.select(key, *[F.when(empty, F.col(f"sum_{c}") / F.col("n")).otherwise(F.try_divide(f"w_{c}", "w")).alias(c) for c in ("lon", "lat")])


def geometry_centroids(zones: DataFrame, key: str = "locationid", geometry: str = "geometry") -> DataFrame:
    """Centroid of whole geometries: an array of parts, each an array of rings of which the first is the outline and the others are holes."""
    parts = zones.select(key, F.explode(geometry).alias("_part"))
    return ring_centroids(parts.select(key, F.posexplode("_part").alias("_place", "ring")).withColumn("hole", F.col("_place") > 0), key)


def point_centroids(points: DataFrame, key: str = "locationid") -> DataFrame:
    """The same from a table of vertices: (part, ring, place, lon, lat), where ring 0 is the outline of its part."""
    vertices = F.array_sort(F.collect_list(F.struct("place", "lon", "lat")))
    rings = points.groupBy(key, "part", F.col("ring").alias("_number")).agg(vertices.alias("ring"))
    return ring_centroids(rings.withColumn("hole", F.col("_number") > 0), key)

"""Row predicates: guards, report filters and outlier boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions import trip_columns as C
from .joins import known_zones

__all__ = [
    "guards", "guard", "derive", "derive_and_guard", "report_filter", "known_zones", "anomalous_passengers",
    "short_trips", "between_ts", "plausible_box", "valid_sample", "bad_records", "page_filter",
]


def guards() -> Column:
    """The base guards as one condition."""
    return (
        (F.col("fare_amount") >= 0)
        & (F.col("trip_distance") > 0)
        & (F.col("trip_duration_min") >= K.MIN_DURATION_MIN)
    )


def guard(df: DataFrame) -> DataFrame:
    """Fare >= 0, distance > 0, at least one minute; NULL fails."""
    return df.where(guards())


def derive(df: DataFrame) -> DataFrame:
    """The derived columns of the preparation step."""
    return (
        df.withColumns({
            "trip_distance": F.col("trip_distance").cast("double"),
            "fare_amount": F.col("fare_amount").cast("double"),
            "temperature": F.col("highTemp").cast("double"),
            "trip_duration_min": C.duration_min("pickup_datetime", "dropoff_datetime"),
            "pickup_hour": F.hour("pickup_datetime"),
            "pickup_dow": F.dayofweek("pickup_datetime"),
            "is_airport_trip": C.is_airport(),
            "passenger_count": C.fix_passengers(),
        })
        .withColumn("temp_band", C.temp_band("temperature"))
    )


def derive_and_guard(df: DataFrame) -> DataFrame:
    """Derived columns, then the base guards."""
    return derive(df).transform(guard)


def report_filter(df: DataFrame) -> DataFrame:
    """Dashboard-wide filter."""
    return df.where((F.col("trip_distance") > 0) & (F.col("fare_amount") >= 0))


def anomalous_passengers(df: DataFrame) -> DataFrame:
    """E5: no passenger, or seven to nine."""
    return df.where((F.col("passenger_count") == 0) | F.col("passenger_count").between(7, 9))


def short_trips(df: DataFrame, minutes: float = 1.0) -> DataFrame:
    """How many trips last at most ``minutes``, and their share."""
    short = F.count_if(F.col("trip_duration_min") <= minutes)
    total = F.count(F.lit(1))
    return df.agg(short.alias("short_trips"), total.alias("all_trips"), F.try_divide(short, total).alias("short_share"))


def between_ts(df: DataFrame, after: str, before: str, col: str = "pickup_datetime") -> DataFrame:
    """Rows strictly between two instants given as text.

    The bounds are typed literals, so the comparison reaches the scan.
    """
    lo, hi = F.lit(after).cast("timestamp_ntz"), F.lit(before).cast("timestamp_ntz")
    return df.where((F.col(col) > lo) & (F.col(col) < hi))


def plausible_box(df: DataFrame, minutes: tuple[float, float], metres: tuple[float, float] = (100.0, 100e3)) -> DataFrame:
    """Duration and direct distance strictly inside their ranges."""
    m, d = F.col("trip_duration_min"), F.col("direct_dist_m")
    return df.where((m > minutes[0]) & (m < minutes[1]) & (d > metres[0]) & (d < metres[1]))


def valid_sample(df: DataFrame) -> DataFrame:
    """0 < distance < 50, fare > 0, pickup zone present."""
    d = F.col("trip_distance")
    return df.where((d > 0) & (d < 50) & (F.col("fare_amount") > 0) & F.col("pickup_locationid").isNotNull())


def bad_records(df: DataFrame) -> DataFrame:
    """Trips that end before they start, or cost less than nothing."""
    return df.where((F.col("dropoff_datetime") < F.col("pickup_datetime")) | (F.col("fare_amount") < 0))


def page_filter(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    **equals: str | int | list,
) -> DataFrame:
    """Optional pickup-date range plus equality (or membership) filters."""
    if start is not None:
        df = df.where(F.col("pickup_date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("pickup_date") <= F.lit(end).cast("date"))
    for name, value in equals.items():
        df = df.where(F.col(name).isin(value) if isinstance(value, list) else F.col(name) == value)
    return df

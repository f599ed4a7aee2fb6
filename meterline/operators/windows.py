"""Window functions over trips and over small aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import pin
from .joins import small_side
from .ranking import global_row_number


def sequence_trips(df: DataFrame, ts: str = "pickup_datetime", key: str = "tripid") -> DataFrame:
    """H1: number of each trip in pickup order, overall and within its day.

    Trips of a day are consecutive in the overall order, so the number within
    the day is the overall number less the trips of earlier days; no day is
    sorted by itself.
    """
    numbered = global_row_number(df, [ts, key], "seq").withColumn("_day", F.to_date(ts))
    # One row per calendar day.
    first = small_side(pin(numbered.groupBy("_day").agg(F.min("seq").alias("_first"))))
    return (
        numbered.join(first.withColumnRenamed("_day", "_of_day"), F.col("_day").eqNullSafe(F.col("_of_day")))
        .withColumn("seq_in_day", F.col("seq") - F.col("_first") + 1)
        .drop("_day", "_of_day", "_first")
    )


def zone_rank(df: DataFrame, by: Sequence[str] = ("pickup_borough",), zone: str = "pickup_zone") -> DataFrame:
    """H2: rank of zones by trips, per group; ties share a rank."""
    counts = df.groupBy(*by, zone).agg(F.count(F.lit(1)).alias("trips"))
    return counts.withColumn("zone_rank", F.rank().over(Window.partitionBy(*by).orderBy(F.desc("trips"))))


def route_deltas(df: DataFrame, route: Sequence[str] = ("pickup_zone", "dropoff_zone"), date: str = "pickup_date") -> DataFrame:
    """H3: trips per route and day with the previous and next day that has trips.

    The window runs over daily counts, so a busy route is one row per day.
    """
    daily = df.groupBy(*route, date).agg(F.count(F.lit(1)).alias("trips"))
    w = Window.partitionBy(*route).orderBy(date)
    return daily.withColumns({
        "previous_trips": F.lag("trips").over(w),
        "next_trips": F.lead("trips").over(w),
        "delta": F.col("trips") - F.lag("trips").over(w),
    })


def vs_baseline(df: DataFrame, key: str, base: str, metric: str, out: str) -> DataFrame:
    """H7: ratio of each row's metric to that of the row whose key is ``base``.

    The baseline is one number, found by its own aggregate, so any frame will
    do; of several rows with that key the greatest metric counts.
    """
    baseline = df.where(F.col(key) == base).agg(F.max(metric)).scalar()
    return df.withColumn(out, F.try_divide(F.col(metric), baseline))

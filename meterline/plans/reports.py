"""Dashboard reports, one query each, over the trips with dashboard columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import constants as K
from ..functions import trip_columns as C
from ..operators.aggregates import feature_correlations, trend_line
from ..operators.filters import report_filter
from ..operators.sampling import top_corridors
from ..operators.windows import vs_baseline
from ..session import pin

HOURS = list(range(24))
# Rate codes with a fixed meaning here; other codes are shown by number.
RATE_LABELS = {2: "JFK", 3: "Newark"}


def dashboard(fact: DataFrame) -> DataFrame:
    """The fact with the calculated fields, under the report-wide filter.

    Fields nobody selects are pruned, so every report starts from here.
    """
    base = report_filter(fact).withColumns({
        "fare_capped": C.fare_null_capped(),
        "distance_capped": C.distance_null_capped(),
        "trip_duration_min": C.duration_min_int("pickup_datetime", "dropoff_datetime"),
        "pickup_hour": F.hour("pickup_datetime"),
        "weekday": C.weekday_ordered("pickup_datetime"),
        "pickup_date": F.to_date("pickup_datetime"),
        "temp_band": C.temp_band(F.col("highTemp").cast("double")),
        "weather": C.weather_refined(),
        "weather_condition": C.weather_basic(),
    })
    return base.withColumns({
        "revenue_per_mile": C.revenue_per_mile(),
        "avg_mph": C.avg_mph(),
    })


def _count(name: str = "trips") -> Column:
    return F.count(F.lit(1)).alias(name)


def kpis(d: DataFrame) -> DataFrame:
    """L1: headline numbers."""
    return d.agg(
        F.sum("fare_capped").alias("total_revenue"), F.avg("fare_capped").alias("avg_fare"),
        F.avg("revenue_per_mile").alias("revenue_per_mile"), F.sum("distance_capped").alias("total_distance"), _count(),
    )


def monthly_revenue(d: DataFrame) -> DataFrame:
    """L2: revenue and mean revenue per mile by month."""
    return d.groupBy(F.trunc("pickup_date", "month").alias("month")).agg(
        F.sum("fare_capped").alias("revenue"), F.avg("revenue_per_mile").alias("avg_revenue_per_mile")
    ).orderBy("month")


def fare_by_service(d: DataFrame) -> DataFrame:
    """L3: mean fare by service."""
    return d.groupBy("service_type").agg(F.avg("fare_capped").alias("avg_fare"))


def revenue_by_borough(d: DataFrame) -> DataFrame:
    """L3: revenue by pickup borough."""
    return d.groupBy("pickup_borough").agg(F.sum("fare_capped").alias("revenue"))


def fare_by_hour(d: DataFrame) -> DataFrame:
    """L3: mean fare for each of the 24 hours, in order."""
    return d.groupBy("pickup_hour").agg(F.avg("fare_capped").alias("avg_fare")).orderBy("pickup_hour")


def peak_cells(d: DataFrame) -> DataFrame:
    """L4: busiest and quietest (weekday, hour); ties go to the earlier cell."""
    cells = d.groupBy("weekday", "pickup_hour").agg(_count())
    label = F.concat(F.substring("weekday", 4, 3), F.lit(" "), F.lpad(F.col("pickup_hour").cast("string"), 2, "0"), F.lit(":00"))
    cell = F.struct("weekday", "pickup_hour", label.alias("label"), "trips")
    # Smallest key first: most trips for the peak, fewest for the low.
    peak = F.min_by(cell, F.struct(-F.col("trips"), "weekday", "pickup_hour")).alias("c")
    low = F.min_by(cell, F.struct("trips", "weekday", "pickup_hour")).alias("c")
    two = cells.agg(F.array(F.struct(F.lit("peak").alias("kind"), peak), F.struct(F.lit("lowest").alias("kind"), low)).alias("r"))
    return two.select(F.explode("r").alias("r")).select("r.kind", "r.c.*")


def heatmap(d: DataFrame) -> DataFrame:
    """Trips by weekday (rows) and hour (columns h0..h23)."""
    wide = d.groupBy("weekday").pivot("pickup_hour", HOURS).agg(F.count(F.lit(1)))
    return wide.select("weekday", *[F.coalesce(F.col(str(h)), F.lit(0)).alias(f"h{h}") for h in HOURS]).orderBy("weekday")


def top_zones_per_day(d: DataFrame, n: int = 10) -> DataFrame:
    """Busiest pickup zones by trips per day of the whole period.

    Zones and days are counted from one daily table, so trips are read once.
    """
    zone = ["pickup_zone", "pickup_borough"]
    daily = pin(d.groupBy(*zone, "pickup_date").agg(
        _count("_n"), F.sum("fare_capped").alias("_fare"), F.count("fare_capped").alias("_fares")
    ))
    days = daily.agg(F.count_distinct("pickup_date")).scalar()
    z = daily.groupBy(*zone).agg(
        F.sum("_n").alias("trips"), F.try_divide(F.sum("_fare"), F.sum("_fares")).alias("avg_fare")
    )
    return z.withColumn("trips_per_day", F.col("trips") / days).orderBy(F.desc("trips"), "pickup_zone").limit(n)


def demand_by_weekday(d: DataFrame) -> DataFrame:
    """Trips by weekday."""
    return d.groupBy("weekday").agg(_count()).orderBy("weekday")


def daily_volume(d: DataFrame) -> DataFrame:
    """Trips per day and service."""
    return d.groupBy("pickup_date", "service_type").agg(_count())


def _by_weather(d: DataFrame) -> DataFrame:
    """Per weather condition: days, trips per day, mean fare, mean speed."""
    daily = d.groupBy("weather", "pickup_date").agg(
        _count("_n"), F.sum("fare_capped").alias("_f"), F.count("fare_capped").alias("_fn"),
        F.sum("avg_mph").alias("_m"), F.count("avg_mph").alias("_mn"),
    )
    return daily.groupBy("weather").agg(
        F.count(F.lit(1)).alias("days"),
        (F.sum("_n") / F.count(F.lit(1))).alias("trips_per_day"),
        F.try_divide(F.sum("_f"), F.sum("_fn")).alias("avg_fare"),
        F.try_divide(F.sum("_m"), F.sum("_mn")).alias("avg_mph"),
    )


def demand_by_weather(d: DataFrame) -> DataFrame:
    """Trips per day by weather, relative to Clear."""
    w = _by_weather(d).select("weather", "days", "trips_per_day")
    return vs_baseline(w, "weather", "Clear", "trips_per_day", "demand_multiplier")


def fare_by_weather(d: DataFrame) -> DataFrame:
    """Mean fare by weather, relative to Clear."""
    return vs_baseline(_by_weather(d).select("weather", "avg_fare"), "weather", "Clear", "avg_fare", "fare_uplift")


def speed_by_weather(d: DataFrame) -> DataFrame:
    """Mean speed by weather."""
    return d.groupBy("weather").agg(F.avg("avg_mph").alias("avg_mph"))


def fare_by_temperature(d: DataFrame, width: float = 10.0) -> DataFrame:
    """Mean fare per temperature bucket and borough, with the borough's trend line."""
    degrees = F.floor(F.col("highTemp").cast("double") / width) * width
    points = d.where(F.col("highTemp").isNotNull()).groupBy("pickup_borough", degrees.cast("double").alias("temp_bucket")).agg(
        F.avg("fare_capped").alias("avg_fare")
    )
    # The points are an aggregate; a borough has a few dozen of them.
    w = Window.partitionBy("pickup_borough")
    slope, intercept = F.regr_slope("avg_fare", "temp_bucket"), F.regr_intercept("avg_fare", "temp_bucket")
    return points.withColumns({"slope": slope.over(w), "intercept": intercept.over(w)})


def corridor_kpis(d: DataFrame, home: str) -> DataFrame:
    """Airport share of revenue, flat airport fare, cross-borough share, share inside ``home``."""
    fare, n = F.col("fare_capped"), F.count(F.lit(1))
    cross = F.col("pickup_borough") != F.col("dropoff_borough")
    inside = (F.col("pickup_borough") == home) & (F.col("dropoff_borough") == home)
    return d.agg(
        F.try_divide(F.sum(F.when(F.col("ratecodeid").isin(*K.AIRPORT_RATECODES), fare)), F.sum(fare)).alias("airport_share"),
        F.avg(F.when(F.col("ratecodeid") == 2, fare)).alias("avg_airport_fare"),
        F.try_divide(F.count_if(cross), n).alias("cross_share"),
        F.try_divide(F.count_if(inside), n).alias("intra_share"),
    )


def corridors(d: DataFrame, n: int = 15) -> DataFrame:
    """Busiest zone pairs."""
    return top_corridors(d, n)


def revenue_by_ratecode(d: DataFrame) -> DataFrame:
    """Revenue by rate code, labelled."""
    labels = F.create_map(*[F.lit(v) for pair in RATE_LABELS.items() for v in pair])
    label = F.coalesce(F.try_element_at(labels, F.col("ratecodeid").cast("int")), F.concat(F.lit("Code "), F.col("ratecodeid").cast("string")))
    return d.groupBy("ratecodeid").agg(F.sum("fare_capped").alias("revenue")).withColumn("label", label)


def borough_matrix(d: DataFrame, boroughs: list[str]) -> DataFrame:
    """Trips from borough (rows) to borough (columns)."""
    wide = d.groupBy("pickup_borough").pivot("dropoff_borough", boroughs).agg(F.count(F.lit(1)))
    return wide.select("pickup_borough", *[F.coalesce(F.col(f"`{b}`"), F.lit(0)).alias(b) for b in boroughs])


def flow_edges(d: DataFrame, source: str = "pickup_borough", target: str = "dropoff_borough") -> DataFrame:
    """Flows between places, places numbered from zero in name order.

    A place is one node whether it starts or ends a flow. The numbering window
    runs over the list of places, not over trips.
    """
    edges = pin(d.groupBy(F.col(source).alias("source"), F.col(target).alias("target")).agg(_count("value")))
    names = edges.select(F.explode(F.array("source", "target")).alias("name")).distinct()
    nodes = names.withColumn("node", F.dense_rank().over(Window.partitionBy().orderBy("name")) - 1)
    src = nodes.select(F.col("name").alias("source"), F.col("node").alias("source_node"))
    dst = nodes.select(F.col("name").alias("target"), F.col("node").alias("target_node"))
    return edges.join(src, "source").join(dst, "target").select("source", "target", "source_node", "target_node", "value")


def tip_kpis(d: DataFrame) -> DataFrame:
    """Card trips only: conversion, mean tip where paid, tip percent, shared rides."""
    card = d.where(F.col("payment_type") == 1)
    tipped, n = F.col("tip_amount") > 0, F.count(F.lit(1))
    valid = F.col("passenger_count").between(K.PASSENGERS_MIN, K.PASSENGERS_MAX)
    return card.agg(
        F.try_divide(F.count_if(tipped), n).alias("tip_conversion"),
        F.avg(F.when(tipped, F.col("tip_amount"))).alias("avg_tip"),
        F.try_divide(F.sum("tip_amount") * 100.0, F.sum("fare_amount")).alias("tip_pct_of_fare"),
        F.try_divide(F.count_if(valid & (F.col("passenger_count") > 1)), F.count_if(valid)).alias("multi_passenger_rate"),
    )


def tip_rate(d: DataFrame, by: str) -> DataFrame:
    """Share of card trips with a tip, by hour or borough."""
    card = d.where(F.col("payment_type") == 1)
    return card.groupBy(by).agg(F.try_divide(F.count_if(F.col("tip_amount") > 0), F.count(F.lit(1))).alias("tip_rate"), _count())


def tip_distribution(d: DataFrame) -> DataFrame:
    """Trips by tip bucket and service."""
    return d.groupBy(C.tip_bucket().alias("tip_bucket"), "service_type").agg(_count())


CANDIDATES = ("trip_distance", "trip_duration_min", "ratecodeid", "temperature", "passenger_count", "pickup_hour", "pickup_dow")


def correlation_ranking(d: DataFrame) -> DataFrame:
    """Candidate features by strength of correlation with the capped fare."""
    full = d.withColumns({"temperature": F.col("highTemp").cast("double"), "pickup_dow": F.dayofweek("pickup_datetime")})
    return feature_correlations(full, CANDIDATES, "fare_capped")


def distributions(d: DataFrame) -> DataFrame:
    """Trips by distance bucket and by duration bucket, from one pass."""
    entries = F.array(
        F.struct(F.lit("distance").alias("measure"), C.distance_bucket().alias("bucket")),
        F.struct(F.lit("duration").alias("measure"), C.duration_bucket().alias("bucket")),
    )
    long = d.select(F.explode(entries).alias("e")).select("e.measure", "e.bucket")
    return long.where(F.col("bucket").isNotNull()).groupBy("measure", "bucket").agg(_count())


def fare_components(d: DataFrame) -> DataFrame:
    """Money by component and service, long form."""
    parts = ["fare_amount", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge"]
    wide = d.groupBy("service_type").agg(*[F.sum(p).alias(p) for p in parts])
    return wide.unpivot("service_type", parts, "component", "amount")


def distance_fare_trend(d: DataFrame) -> DataFrame:
    """Trend line of capped fare over capped distance."""
    return trend_line(d, "distance_capped", "fare_capped")


def category_counts(d: DataFrame) -> DataFrame:
    """Trips by store flag, vendor and passenger count, from one pass."""
    cols = ("store_and_fwd_flag", "vendorid", "passenger_count")
    entries = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in cols])
    long = d.select(F.explode(entries).alias("e")).select("e.field", "e.value")
    return long.groupBy("field", "value").agg(_count()).withColumn("sqrt_trips", C.sqrt_count("trips"))


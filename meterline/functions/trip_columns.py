"""Derived trip columns: each returns a Column, or maps a DataFrame row by row."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- types -----------------------------------------------------------------

def cast_decimals(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Listed columns as double, absent ones ignored, NULL stays NULL."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols if c in df.columns})


# --- time ------------------------------------------------------------------

def duration_sec(pickup: str | Column, dropoff: str | Column) -> Column:
    """D3: seconds from pickup to dropoff, each time without its fraction of a second."""
    def second(ts: Column) -> Column:
        return F.timestamp_diff("SECOND", F.expr(EPOCH), ts)
    return second(_c(dropoff)) - second(_c(pickup))


def duration_min(pickup: str | Column, dropoff: str | Column) -> Column:
    """Fractional minutes."""
    return duration_sec(pickup, dropoff) / F.lit(60.0)


def duration_min_int(pickup: str | Column, dropoff: str | Column) -> Column:
    """D3: minute boundaries crossed (00:00:59 -> 00:01:01 counts one)."""
    def minute_number(ts: Column) -> Column:
        return F.floor(F.timestamp_diff("SECOND", F.expr(EPOCH), ts) / F.lit(60))
    return minute_number(_c(dropoff)) - minute_number(_c(pickup))


def time_parts(df: DataFrame, ts: str = "pickup_datetime", prefix: str = "pickup_") -> DataFrame:
    """Hour, weekday (1 = Sunday), year, month and day of ``ts``."""
    parts = {"hour": F.hour, "dow": F.dayofweek, "year": F.year, "month": F.month, "day": F.dayofmonth}
    return df.withColumns({prefix + name: f(F.col(ts)) for name, f in parts.items()})


def year_month(col: str | Column) -> Column:
    """D5: 'yyyy-MM' of a date or timestamp."""
    return F.substring(F.to_date(_c(col)).cast("string"), 1, 7)


def month_label(col: str | Column) -> Column:
    """D6: 'Jan'..'Dec'; sort by the month number, not by the label."""
    return F.date_format(F.to_date(_c(col)), "MMM")


def weekday_label(col: str | Column) -> Column:
    """D6: 'Sun'..'Sat'."""
    return F.date_format(F.to_date(_c(col)), "E")


def weekday_code_label(code: str | Column) -> Column:
    """Sortable label from a weekday code; 0 and 7 both mean Saturday."""
    names = {2: "1. Mon", 3: "2. Tue", 4: "3. Wed", 5: "4. Thu", 6: "5. Fri", 7: "6. Sat", 0: "6. Sat", 1: "7. Sun"}
    lookup = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    return F.try_element_at(lookup, _c(code))


def weekday_ordered(ts: str | Column) -> Column:
    """Sortable weekday label of a timestamp."""
    return weekday_code_label(F.dayofweek(_c(ts)))


# --- flags and bands ---------------------------------------------------------

def is_airport(ratecode: str | Column = "ratecodeid") -> Column:
    """1 for flat-rate airport codes, 0 for others, NULL for NULL."""
    return _c(ratecode).isin(*K.AIRPORT_RATECODES).cast("int")


def fix_passengers(count: str | Column = "passenger_count") -> Column:
    """Counts outside 1..6, and NULL, become 1."""
    c = _c(count)
    valid = c.between(K.PASSENGERS_MIN, K.PASSENGERS_MAX)
    return F.when(valid, c).otherwise(F.lit(K.PASSENGERS_DEFAULT)).cast("int")


def temp_band(temperature: str | Column) -> Column:
    """Temperature band; NULL falls through to the last band, 'Hot'."""
    t = _c(temperature)
    band = F
    for cut, name in zip(K.TEMP_CUTS, K.TEMP_BANDS):
        band = band.when(t < cut, F.lit(name))
    return band.otherwise(F.lit(K.TEMP_BANDS[-1]))


def temp_band_ord(band: str | Column = "temp_band") -> Column:
    """0 (coldest) .. 4; an unknown label stops the query, NULL stays NULL."""
    b = _c(band)
    position = F.array_position(F.array(*[F.lit(x) for x in K.TEMP_BANDS]), b)
    unknown = F.raise_error(F.concat(F.lit("unknown temp_band: "), b)).cast("int")
    return F.when(position == 0, unknown).otherwise((position - 1).cast("int"))


def weather_basic(precip: str | Column = "precipIntensity") -> Column:
    """D23: 'Rainy' when it rained, else 'Dry' (also for NULL)."""
    return F.when(_c(precip) > 0, F.lit("Rainy")).otherwise(F.lit("Dry"))


WEATHER_THRESHOLDS = {"heavy": 0.1, "freezing": 32.0, "fog_visibility": 2.0, "fog_cloud": 0.5}


def weather_refined(thresholds: Mapping[str, float] = WEATHER_THRESHOLDS) -> Column:
    """Snow, Heavy rain, Light rain, Fog or Clear, first match wins.

    The cut points are a parameter; the defaults are this library's choice.
    """
    wet = F.col("precipIntensity") > 0
    return (
        F.when(wet & (F.col("lowTemp") <= thresholds["freezing"]), "Snow")
        .when(F.col("precipIntensity") > thresholds["heavy"], "Heavy rain")
        .when(wet, "Light rain")
        .when(
            (F.col("visibility") <= thresholds["fog_visibility"]) & (F.col("cloudCover") >= thresholds["fog_cloud"]),
            "Fog",
        )
        .otherwise("Clear")
    )


def _banded(value: Column, edges: Sequence[float], labels: Sequence[str], last: str | None) -> Column:
    """Label of the first upper edge above ``value``; NULL stays NULL."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(value < edge, F.lit(label))
    return out.otherwise(F.lit(last).cast("string"))


def tip_bucket(tip: str | Column = "tip_amount") -> Column:
    """No tip (zero or less), then 0-2, 2-5, 5-10 and 10+ dollars."""
    t = _c(tip)
    return F.when(t <= 0, F.lit("$0")).otherwise(_banded(t, (2, 5, 10), ("$0-2", "$2-5", "$5-10"), "$10+"))


def distance_bucket(miles: str | Column = "distance_capped") -> Column:
    """2-mile buckets up to 10, then 10-15; longer trips have none."""
    d = _c(miles)
    return _banded(d, (2, 4, 6, 8, 10, 15), ("0-2", "2-4", "4-6", "6-8", "8-10", "10-15"), None)


def duration_bucket(minutes: str | Column = "trip_duration_min") -> Column:
    """0-10, 10-20, 20-30, 30-45, 45-60 and 60+ minutes."""
    m = _c(minutes)
    return _banded(m, (10, 20, 30, 45, 60), ("0-10", "10-20", "20-30", "30-45", "45-60"), "60+")


def payment_description(code: str | Column, lookup: Mapping[int, str]) -> Column:
    """C11: description of a payment code; codes outside ``lookup`` give NULL."""
    table = F.create_map(*[F.lit(v) for pair in lookup.items() for v in pair])
    return F.try_element_at(table, _c(code).cast("int"))


# --- money, distance, speed ---------------------------------------------------

def _null_capped(value: Column, service: Column, caps: Mapping[str, float]) -> Column:
    cap = F.try_element_at(F.create_map(*[F.lit(v) for pair in caps.items() for v in pair]), service)
    # A service without a cap keeps its value; NULL > cap is unknown, not true.
    return F.when(F.coalesce(value > cap, F.lit(False)) | (value <= 0), F.lit(None)).otherwise(value)


def fare_null_capped(caps: Mapping[str, Mapping[str, float]] = K.DASHBOARD_CAPS) -> Column:
    """Fare, or NULL when above the service's cap or not positive."""
    return _null_capped(F.col("fare_amount"), F.col("service_type"), {s: c["fare"] for s, c in caps.items()})


def distance_null_capped(caps: Mapping[str, Mapping[str, float]] = K.DASHBOARD_CAPS) -> Column:
    """Distance, or NULL when above the service's cap or not positive."""
    return _null_capped(F.col("trip_distance"), F.col("service_type"), {s: c["distance"] for s, c in caps.items()})


def revenue_per_mile(fare: str | Column = "fare_capped", distance: str | Column = "distance_capped") -> Column:
    """Fare per mile, NULL without a distance."""
    return F.try_divide(_c(fare), _c(distance))


def avg_mph(distance: str | Column = "distance_capped", minutes: str | Column = "trip_duration_min") -> Column:
    """Miles per hour for durations in (0, 180], else NULL."""
    m = _c(minutes)
    return F.when((m > 0) & (m <= 180), _c(distance) / (m / 60.0))


def speed_mph(distance: str | Column, minutes: str | Column) -> Column:
    """Miles per hour, NULL when the duration is zero."""
    return F.try_divide(_c(distance), _c(minutes) / 60.0)


def speed_ms(metres: str | Column, minutes: str | Column) -> Column:
    """Metres per second, NULL when the duration is zero."""
    return F.try_divide(_c(metres), _c(minutes) * 60.0)


def tip_features(df: DataFrame) -> DataFrame:
    """Whether a tip was paid, and the tip in percent of the fare."""
    return df.withColumns({
        "has_tip": (F.col("tip_amount") > 0).cast("int"),
        "tip_pct_of_fare": F.try_divide(F.col("tip_amount") * 100.0, F.col("fare_amount")),
    })


# --- model features ------------------------------------------------------------

def cyclic_hour(df: DataFrame, col: str = "pickup_hour") -> DataFrame:
    """The hour on a circle, as sine and cosine; the hour goes."""
    angle = F.col(col).cast("double") * F.lit(2 * math.pi / 24)
    return df.withColumns({f"{col}_sin": F.sin(angle), f"{col}_cos": F.cos(angle)}).drop(col)


def hour_from_cyclic(sin: str | Column, cos: str | Column) -> Column:
    """The hour 0..23 back from sine and cosine."""
    hours = F.rint(F.atan2(_c(sin), _c(cos)) * F.lit(24 / (2 * math.pi)))
    return F.pmod(hours.cast("int"), F.lit(24))


def od_corridor(pickup: str | Column = "pickup_zone", dropoff: str | Column = "dropoff_zone") -> Column:
    """D14: 'pickup→dropoff'; NULL when either end is NULL."""
    return F.concat(_c(pickup), F.lit("→"), _c(dropoff))


def select_model_columns(df: DataFrame) -> DataFrame:
    """The 22 columns of a prepared sample, in order."""
    return df.select(*K.MODEL_COLUMNS)


def drop_excluded(df: DataFrame) -> DataFrame:
    """Drop leakage, superseded and identifier columns that are present."""
    return df.drop(*K.LEAKAGE_COLUMNS, *K.SUPERSEDED_COLUMNS, *K.IDENTIFIER_COLUMNS)


def build_features(df: DataFrame, include_duration: bool = True) -> DataFrame:
    """Prepared sample -> 15 features and the label ``fare_capped``."""
    out = cast_decimals(df, K.CLIMATE_DECIMALS).transform(cyclic_hour)
    out = out.withColumns({"temp_band_ord": temp_band_ord(), K.CORRIDOR: od_corridor()}).drop("temp_band")
    out = drop_excluded(out)
    return out if include_duration else out.drop("trip_duration_min")


# --- frame shape ----------------------------------------------------------------

def columns_first(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """The named columns first, the others in their order."""
    return df.select(*first, *[c for c in df.columns if c not in set(first)])


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Every column renamed to ``prefix_name`` for a role-playing join."""
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in df.columns})


def log10_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``log10_<col>`` for each column, NULL where it is not positive."""
    return df.withColumns({f"log10_{c}": F.when(F.col(c) > 0, F.log10(c)) for c in cols})


def sqrt_count(count: str | Column = "count") -> Column:
    """Square root of a count."""
    return F.sqrt(_c(count))

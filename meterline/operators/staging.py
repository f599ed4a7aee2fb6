"""Staging of raw trip, climate and zone files, de-duplication and marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions.trip_columns import payment_description, year_month
from ..session import pin
from .joins import attach_climate, attach_zones, known_zones

MONEY = "decimal(38,9)"
MARK_WORDS = 1 << 18  # 2 MB of marks; one row in 160 is shuffled for nothing where 100,000 rows repeat

# Raw column -> staged column and type; the two timestamp names depend on the service.
STAGED = (
    ("VendorID", "vendorid", "bigint"),
    ("RatecodeID", "ratecodeid", "bigint"),
    ("PULocationID", "pickup_locationid", "bigint"),
    ("DOLocationID", "dropoff_locationid", "bigint"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
    ("passenger_count", "passenger_count", "bigint"),
    ("trip_distance", "trip_distance", MONEY),
    ("fare_amount", "fare_amount", MONEY),
    ("extra", "extra", MONEY),
    ("mta_tax", "mta_tax", MONEY),
    ("tip_amount", "tip_amount", MONEY),
    ("tolls_amount", "tolls_amount", MONEY),
    ("improvement_surcharge", "improvement_surcharge", MONEY),
    ("total_amount", "total_amount", MONEY),
    ("payment_type", "payment_type", "bigint"),
)
TIME_PREFIX = {"Yellow": "tpep", "Green": "lpep"}


def stage_trips(df: DataFrame, service: str, start: str, end: str) -> DataFrame:
    """Typed and renamed trips of one service.

    Keeps rows with a vendor whose pickup date is in [start, end]. Only the
    staged columns are read, so raw columns whose type differs between files
    are gone before any de-duplication.
    """
    if service not in TIME_PREFIX:
        raise ValueError(f"unknown service: {service}")
    p = TIME_PREFIX[service]
    times = [
        F.col(f"{p}_pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col(f"{p}_dropoff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
    ]
    fields = [F.col(raw).cast(kind).alias(name) for raw, name, kind in STAGED]
    in_window = F.to_date("pickup_datetime").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return (
        df.select(*fields[:1], *times, *fields[1:])
        .where(F.col("vendorid").isNotNull() & in_window)
        .withColumn("service_type", F.lit(service))
    )


def _row_digests(df: DataFrame) -> list[Column]:
    """128 bits of a row in two numbers."""
    columns = [F.col(c) for c in df.columns]
    return [F.xxhash64(*columns), F.xxhash64(F.lit("b"), *reversed(columns))]


def dedup_rows(df: DataFrame, digests: Sequence[Column] | None = None) -> DataFrame:
    """One of each whole row; rows without a copy are not shuffled.

    Two digests of each row are counted first. Those that repeat set bits in a
    bitmap of fixed size (MARK_WORDS words of 64), which is all that is
    broadcast. Rows whose bit is clear have no copy and stay where they are;
    the others, a few without copies among them, are shuffled and compared
    whole, so equal digests of different rows do no harm. Rows are computed
    three times: keep an expensive input first (``session.pin``).
    """
    first, second = digests or _row_digests(df)
    word, bit = F.pmod(first, F.lit(MARK_WORDS)), F.pmod(second, F.lit(64)).cast("int")
    one = F.lit(1).cast("long")
    repeated = df.select(first.alias("_a"), second.alias("_b")).groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    places = repeated.select(F.pmod("_a", F.lit(MARK_WORDS)).alias("_word"), F.pmod("_b", F.lit(64)).cast("int").alias("_bit"))
    marks = pin(places.groupBy("_word").agg(F.bit_or(F.call_function("shiftleft", one, F.col("_bit"))).alias("_marks")))
    rows = df.withColumns({"_place": word, "_bit": bit}).join(F.broadcast(marks), F.col("_place") == F.col("_word"), "left")
    marked = F.coalesce(F.call_function("shiftright", F.col("_marks"), F.col("_bit")).bitwiseAND(one) == 1, F.lit(False))
    alone = rows.where(~marked).select(*df.columns)
    return alone.unionByName(rows.where(marked).select(*df.columns).distinct())


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """C4, H6: the first row per key in ascending ``order``.

    A grouped minimum rather than a row number: the minimum combines on the map
    side, so a key with very many rows is never sorted inside one task. Rows
    equal in ``order`` are decided by their remaining columns.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*[c if c in keys else F.col(f"_first.{c}") for c in df.columns])


def surrogate_key(df: DataFrame, cols: Sequence[str] | None = None, out: str = "tripid") -> DataFrame:
    """md5 over the given columns (all by default), NULL as empty text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (cols or df.columns)]
    return df.withColumn(out, F.md5(F.concat_ws("-", *parts)))


def stage_climate(df: DataFrame) -> DataFrame:
    """Typed daily climate, one row per date.

    Repeated dates keep the smallest row, so the result does not depend on the
    order in which files are read.
    """
    values = [F.col(c).cast(MONEY).alias(c) for c in df.columns if c != "climate_date"]
    typed = df.select(F.col("climate_date").cast("date").alias("climate_date"), *values)
    return dedup_keep_first(typed.where(F.col("climate_date").isNotNull()), ["climate_date"], [])


def union_services(*services: DataFrame) -> DataFrame:
    """All services in one frame, by column name, duplicates kept."""
    return reduce(DataFrame.unionByName, services)


def build_fact_trips(
    trips: DataFrame, zones: DataFrame, climate: DataFrame, payments: Mapping[int, str] | None = None
) -> DataFrame:
    """Trips with both zones known, and the climate of the pickup date."""
    out = trips
    if "pickup_date" not in out.columns:
        out = out.withColumn("pickup_date", F.to_date("pickup_datetime"))
    if "total_amount" not in out.columns:
        out = out.withColumn("total_amount", reduce(lambda a, b: a + b, [F.col(c) for c in K.MONEY_COLUMNS[:-1]]))
    if payments:
        out = out.withColumn("payment_type_description", payment_description("payment_type", payments))
    out = attach_zones(out, known_zones(zones))
    return attach_climate(out, climate)


def build_dim_zones(zones: DataFrame) -> DataFrame:
    """Distinct zones."""
    return zones.select("locationid", "borough", "zone").distinct()


def monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """Per pickup zone, month and service: money sums, trips, averages."""
    money = [F.sum(c).cast("double").alias(f"revenue_{c}") for c in K.MONEY_COLUMNS]
    month = F.trunc(F.to_date("pickup_datetime"), "month").alias("revenue_month")
    return fact.groupBy(F.col("pickup_zone").alias("revenue_zone"), month, "service_type").agg(
        *money,
        F.count(F.lit(1)).alias("total_trips"),
        F.avg("passenger_count").alias("avg_passenger_count"),
        F.avg("trip_distance").cast("double").alias("avg_trip_distance"),
    )


def batch_by_year(df: DataFrame, y0: int, y1: int, ts: str = "pickup_datetime") -> DataFrame:
    """Rows of the years y0..y1, each tagged with its 'yyyy-MM' batch.

    One filtered pass gives what a union of one frame per year gives, and reads
    the source once. The range of times reaches the file scan.
    """
    lo, hi = F.lit(f"{y0:04d}-01-01").cast("timestamp_ntz"), F.lit(f"{y1 + 1:04d}-01-01").cast("timestamp_ntz")
    return df.where((F.col(ts) >= lo) & (F.col(ts) < hi)).withColumn("year_month", year_month(ts))

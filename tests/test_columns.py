"""Derived columns on hand-computed rows."""

import math
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterline import constants as K
from meterline.functions import geo, trip_columns as C
from meterline.operators import filters as E


def one(spark, expr, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]) if cols else spark.range(1)
    return df.select(expr.alias("x")).first()[0]


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize("value,band", [(None, "Hot"), (31.99, "Freezing"), (32.0, "Cold"), (49.9, "Cold"), (50.0, "Mild"), (68.0, "Warm"), (85.0, "Hot")])
def test_temp_band_edges(spark, value, band):
    assert one(spark, C.temp_band(F.lit(value).cast("double"))) == band


def test_temp_band_ord_order_null_and_unknown(spark):
    assert [one(spark, C.temp_band_ord(F.lit(b))) for b in K.TEMP_BANDS] == [0, 1, 2, 3, 4]
    assert one(spark, C.temp_band_ord(F.lit(None).cast("string"))) is None
    with pytest.raises(Exception, match="unknown temp_band: Tepid"):
        one(spark, C.temp_band_ord(F.lit("Tepid")))


@pytest.mark.parametrize("value,want", [(None, 1), (0, 1), (1, 1), (6, 6), (7, 1), (9, 1)])
def test_fix_passengers(spark, value, want):
    assert one(spark, C.fix_passengers(F.lit(value).cast("int"))) == want


def test_durations(spark):
    a, b = ntz("2016-01-01 00:00:59"), ntz("2016-01-01 00:01:01")
    assert one(spark, C.duration_sec(a, b)) == 2
    assert one(spark, C.duration_min_int(a, b)) == 1
    assert one(spark, C.duration_min(a, b)) == pytest.approx(2 / 60)
    assert one(spark, C.duration_min_int(b, a)) == -1


def test_cyclic_hour_round_trip(spark):
    hours = spark.range(24).select(F.col("id").cast("int").alias("pickup_hour"), F.col("id").alias("h"))
    back = C.cyclic_hour(hours).select("h", C.hour_from_cyclic("pickup_hour_sin", "pickup_hour_cos").alias("x"))
    assert all(r["h"] == r["x"] for r in back.collect())


def test_corridor_keeps_direction_and_null(spark):
    assert one(spark, C.od_corridor(F.lit("A"), F.lit("B"))) == "A→B"
    assert one(spark, C.od_corridor(F.lit("B"), F.lit("A"))) == "B→A"
    assert one(spark, C.od_corridor(F.lit("A"), F.lit(None).cast("string"))) is None


def test_two_cap_rules_differ(spark):
    rows = spark.createDataFrame([("Yellow", 52.0), ("Yellow", 52.01), ("Green", 0.0), ("Grey", 900.0), (None, 5.0)], "service_type string, fare_amount double")
    got = [r[0] for r in rows.select(C.fare_null_capped()).collect()]
    assert got == [52.0, None, None, 900.0, 5.0]


def test_is_airport_keeps_null(spark):
    assert [one(spark, C.is_airport(F.lit(v).cast("int"))) for v in (1, 2, 3, None)] == [0, 1, 1, None]


def test_avg_mph_guard(spark):
    assert [one(spark, C.avg_mph(F.lit(30.0), F.lit(m))) for m in (0.0, 180.0, 180.5)] == [None, 10.0, None]


def test_weekday_codes(spark):
    assert [one(spark, C.weekday_code_label(F.lit(c))) for c in (0, 1, 2, 7, 8)] == ["6. Sat", "7. Sun", "1. Mon", "6. Sat", None]


def test_haversine_quarter_circle(spark):
    m = one(spark, geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(0.0)))
    assert m == pytest.approx(math.pi / 2 * K.EARTH_RADIUS_M)
    assert one(spark, geo.haversine_mi(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))) == pytest.approx(math.pi * K.EARTH_RADIUS_MI)


def test_centroid_open_closed_and_flat(spark):
    ring = "array<struct<lon:double,lat:double>>"
    rows = [(1, [(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (0.0, 2.0)]), (2, [(0.0, 0.0), (6.0, 0.0), (0.0, 3.0), (0.0, 0.0)]), (3, [(1.0, 1.0), (3.0, 3.0)])]
    got = {r["locationid"]: (r["lon"], r["lat"]) for r in geo.zone_centroids(spark.createDataFrame(rows, f"locationid int, ring {ring}")).collect()}
    assert got[1] == pytest.approx((2.0, 1.0))
    assert got[2] == pytest.approx((2.0, 1.0))
    assert got[3] == pytest.approx((2.0, 2.0))


PREP = (
    "tripid string, pickup_datetime timestamp_ntz, fare_capped double, fare_amount double, trip_distance double, distance_capped double, "
    "trip_duration_min double, passenger_count int, temperature double, pickup_hour int, pickup_dow int, service_type string, pickup_borough string, "
    "dropoff_borough string, pickup_zone string, dropoff_zone string, temp_band string, is_airport_trip int, ratecodeid bigint, "
    "humidity decimal(38,9), windSpeed decimal(38,9), visibility decimal(38,9)"
)


def prep_rows(spark):
    t = datetime(2016, 5, 1, 6)
    d = Decimal("0.5")
    return spark.createDataFrame([
        ("a", t, 9.5, 9.5, 2.0, 2.0, 11.0, 1, 40.0, 6, 1, "Yellow", "M", "Q", "Z1", "Z2", "Cold", 0, 1, d, d, None),
        ("b", t, 52.0, 70.0, 8003318.0, 14.15, 30.0, 2, 90.0, 0, 2, "Green", "Q", "M", "Z2", "Z1", "Hot", 1, 2, d, None, d),
    ], PREP)


def test_build_features(spark):
    out = C.build_features(prep_rows(spark))
    assert set(out.columns) == {*K.NUMERIC_FEATURES, *K.BINARY_FEATURES, *K.ONE_HOT_FEATURES, K.CORRIDOR, K.TARGET}
    first, second = out.orderBy("distance_capped").collect()
    assert first["pickup_hour_sin"] == pytest.approx(1.0) and first["pickup_hour_cos"] == pytest.approx(0.0)
    assert first["temp_band_ord"] == 1 and second["temp_band_ord"] == 4
    assert first["od_corridor"] == "Z1→Z2" and second["od_corridor"] == "Z2→Z1"
    assert second["distance_capped"] == 14.15 and second["windSpeed"] is None and first["humidity"] == 0.5
    assert dict(out.dtypes)["humidity"] == "double"
    assert "trip_duration_min" not in C.build_features(prep_rows(spark), include_duration=False).columns


def test_guard_fails_null(spark):
    rows = spark.createDataFrame([(0.0, 1.0, 1.0), (None, 1.0, 1.0), (1.0, 0.0, 1.0), (1.0, 1.0, 0.99), (-1.0, 1.0, 5.0)], "fare_amount double, trip_distance double, trip_duration_min double")
    assert E.guard(rows).count() == 1


def test_between_ts_is_open_and_pushed(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    cut = E.between_ts(orders, "1996-01-01", "1996-01-03", "o_orderdate").select("o_orderdate")
    assert {r[0] for r in cut.distinct().collect()} == {datetime(1996, 1, 2)}
    assert "GreaterThan(o_orderdate" in cut._jdf.queryExecution().executedPlan().toString()


def test_centroids_of_holes_and_islands(spark):
    box = lambda x, y, w, h, turn=1: [(float(a), float(b)) for a, b in [(x, y), (x + w, y), (x + w, y + h), (x, y + h)][::turn]]
    rows = [
        (1, [[box(0, 0, 4, 4), box(0, 0, 2, 2, -1)]]),
        (2, [[box(0, 0, 2, 2)], [box(10, 0, 2, 4, -1)]]),
        (3, [[[(0.0, 0.0), (2.0, 0.0), (4.0, 0.0)]]]),
        (4, [[box(0, 0, 2, 2)]]), (4, [[box(4, 0, 2, 2)]]),
        (5, [[box(0, 0, 2, 2), box(0, 0, 2, 2)]]), (6, []), (7, None), (8, [[[]]]),
    ]
    schema = "locationid int, geometry array<array<array<struct<lon:double,lat:double>>>>"
    got = {r["locationid"]: (r["lon"], r["lat"]) for r in geo.geometry_centroids(spark.createDataFrame(rows, schema)).collect()}
    # 16 around (2, 2) without 4 around (1, 1); 4 around (1, 1) with 8 around (11, 2).
    assert got == {k: pytest.approx(v) for k, v in {1: (28 / 12, 28 / 12), 2: (92 / 12, 20 / 12), 3: (2.0, 0.0), 4: (3.0, 1.0), 5: (1.0, 1.0)}.items()}

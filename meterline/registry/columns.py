"""Checked queries for derived columns, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, trip_columns as C
from ..operators import filters as E
from ..operators.joins import attach_centroids
from ..plans import fixtures as X
from ..plans.prep import prepared
from ..plans.reports import dashboard
from ..session import pin
from .core import query
from .helpers import rounded

# --- D: derived columns ------------------------------------------------------


@query("d01_cast_decimals", """
select climate_date, round(cast(humidity as double), 6) as humidity, round(cast(windSpeed as double), 6) as windSpeed,
  round(cast(visibility as double), 6) as visibility, round(cast(highTemp as double), 6) as highTemp from climate""", "climate")
def d01(spark, sf):
    cols = ["humidity", "windSpeed", "visibility", "highTemp"]
    return rounded(C.cast_decimals(X.climate(spark, sf), cols).select("climate_date", *cols), 6)


@query("d02_duration_min", """
select tripid, round(date_diff('second', pickup_datetime, dropoff_datetime) / 60.0, 6) as trip_duration_min from trips""", "trips")
def d02(spark, sf):
    t = X.trips(spark, sf)
    return rounded(t.select("tripid", C.duration_min("pickup_datetime", "dropoff_datetime").alias("trip_duration_min")), 6)


@query("d03_duration_sec_and_minutes", """
select event_id, date_diff('second', ts, ts + (user_id % 4000) * interval '1' second) as duration_sec,
  date_diff('minute', ts, ts + (user_id % 4000) * interval '1' second) as duration_min_int from events""")
def d03(spark, sf):
    e = X.table(spark, sf, "events").withColumn("ended", F.expr("timestampadd(SECOND, user_id % 4000, ts)"))
    return e.select(
        "event_id", C.duration_sec("ts", "ended").alias("duration_sec"), C.duration_min_int("ts", "ended").alias("duration_min_int")
    )


@query("d04_time_parts", """
select tripid, cast(hour(pickup_datetime) as int) as pickup_hour, cast(dayofweek(pickup_datetime) + 1 as int) as pickup_dow,
  cast(year(pickup_datetime) as int) as pickup_year, cast(month(pickup_datetime) as int) as pickup_month,
  cast(day(pickup_datetime) as int) as pickup_day from trips""", "trips")
def d04(spark, sf):
    return C.time_parts(X.trips(spark, sf).select("tripid", "pickup_datetime")).drop("pickup_datetime")


@query("d05_year_month", "select tripid, strftime(pickup_datetime, '%Y-%m') as year_month from trips", "trips")
def d05(spark, sf):
    return X.trips(spark, sf).select("tripid", C.year_month("pickup_datetime").alias("year_month"))


@query("d06_calendar_labels", """
select strftime(pickup_datetime, '%b') as month_label, strftime(pickup_datetime, '%a') as weekday_label,
  cast(month(pickup_datetime) as int) as month_number, count(*) as n from trips group by 1, 2, 3""", "trips")
def d06(spark, sf):
    ts = "pickup_datetime"
    return X.trips(spark, sf).groupBy(
        C.month_label(ts).alias("month_label"), C.weekday_label(ts).alias("weekday_label"), F.month(ts).alias("month_number")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("d07_weekday_ordered", """
select tripid, case dayofweek(pickup_datetime) when 1 then '1. Mon' when 2 then '2. Tue' when 3 then '3. Wed' when 4 then '4. Thu'
  when 5 then '5. Fri' when 6 then '6. Sat' else '7. Sun' end as weekday,
  case passenger_count when 0 then '6. Sat' when 1 then '7. Sun' when 2 then '1. Mon' when 3 then '2. Tue' when 4 then '3. Wed'
  when 5 then '4. Thu' when 6 then '5. Fri' when 7 then '6. Sat' end as from_code from trips""", "trips")
def d07(spark, sf):
    return X.trips(spark, sf).select(
        "tripid", C.weekday_ordered("pickup_datetime").alias("weekday"), C.weekday_code_label("passenger_count").alias("from_code")
    )


@query("d08_is_airport", """
select tripid, cast(ratecodeid in (2, 3) as int) as is_airport_trip,
  cast(passenger_count in (2, 3) as int) as null_kept from trips""", "trips")
def d08(spark, sf):
    return X.trips(spark, sf).select("tripid", C.is_airport().alias("is_airport_trip"), C.is_airport("passenger_count").alias("null_kept"))


@query("d09_fix_passengers", """
select tripid, cast(case when passenger_count between 1 and 6 then passenger_count else 1 end as int) as passenger_count from trips""", "trips")
def d09(spark, sf):
    return X.trips(spark, sf).select("tripid", C.fix_passengers().alias("passenger_count"))


@query("d10_temp_band", """
select climate_date, case when highTemp < 32 then 'Freezing' when highTemp < 50 then 'Cold' when highTemp < 68 then 'Mild'
  when highTemp < 85 then 'Warm' else 'Hot' end as temp_band, highTemp is null as no_reading from climate""", "climate")
def d10(spark, sf):
    c = X.climate(spark, sf)
    return c.select("climate_date", C.temp_band("highTemp").alias("temp_band"), F.col("highTemp").isNull().alias("no_reading"))


@query("d11_temp_band_ord", """
select climate_date, cast(case when highTemp < 32 then 0 when highTemp < 50 then 1 when highTemp < 68 then 2
  when highTemp < 85 then 3 else 4 end as int) as temp_band_ord from climate""", "climate")
def d11(spark, sf):
    c = X.climate(spark, sf).select("climate_date", C.temp_band("highTemp").alias("temp_band"))
    return c.select("climate_date", C.temp_band_ord().alias("temp_band_ord"))


@query("d12_cyclic_hour", """
select tripid, round(sin(2 * pi() * hour(pickup_datetime) / 24), 6) + 0.0 as pickup_hour_sin,
  round(cos(2 * pi() * hour(pickup_datetime) / 24), 6) + 0.0 as pickup_hour_cos from trips""", "trips")
def d12(spark, sf):
    return rounded(C.cyclic_hour(X.trips(spark, sf).select("tripid", F.hour("pickup_datetime").alias("pickup_hour"))), 6)


@query("d13_hour_from_cyclic", "select tripid, cast(hour(pickup_datetime) as int) as pickup_hour from trips", "trips")
def d13(spark, sf):
    t = C.cyclic_hour(X.trips(spark, sf).select("tripid", F.hour("pickup_datetime").alias("pickup_hour")))
    return t.select("tripid", C.hour_from_cyclic("pickup_hour_sin", "pickup_hour_cos").alias("pickup_hour"))


@query("d14_od_corridor", """
select tripid, p.zone || '→' || d.zone as od_corridor from trips
left join (select * from zones where borough <> 'Unknown') p on pickup_locationid = p.locationid
left join (select * from zones where borough <> 'Unknown') d on dropoff_locationid = d.locationid""", "trips zones")
def d14(spark, sf):
    from ..operators.joins import attach_zones
    t = attach_zones(X.trips(spark, sf), E.known_zones(X.zones(spark, sf)), "left")
    return t.select("tripid", C.od_corridor().alias("od_corridor"))


@query("d15_fare_null_capped", """
select tripid, round(case when fare_amount > (case service_type when 'Yellow' then 52 else 46 end) or fare_amount <= 0
  then null else fare_amount end, 4) as fare_capped from trips""", "trips")
def d15(spark, sf):
    return rounded(X.trips(spark, sf).select("tripid", C.fare_null_capped().alias("fare_capped")))


@query("d16_distance_null_capped", """
select tripid, round(case when trip_distance > (case service_type when 'Yellow' then 18.76 else 14.19 end) or trip_distance <= 0
  then null else trip_distance end, 4) as distance_capped from trips""", "trips")
def d16(spark, sf):
    return rounded(X.trips(spark, sf).select("tripid", C.distance_null_capped().alias("distance_capped")))


@query("d17_revenue_per_mile", "select tripid, round(fare_amount / nullif(trip_distance, 0), 6) as revenue_per_mile from trips", "trips")
def d17(spark, sf):
    t = X.trips(spark, sf)
    return rounded(t.select("tripid", C.revenue_per_mile("fare_amount", "trip_distance").alias("revenue_per_mile")), 6)


@query("d18_avg_mph", "select tripid, round(avg_mph, 4) as avg_mph from dash", "dash")
def d18(spark, sf):
    return rounded(dashboard(X.fact(spark, sf)).select("tripid", "avg_mph"))


@query("d19_avg_speed", """
select tripid, round(avg_speed, 4) as avg_speed from (
  select tripid, m, trip_distance / nullif(m / 60.0, 0) as avg_speed from (
    select tripid, trip_distance, date_diff('second', pickup_datetime, dropoff_datetime) / 60.0 as m from trips))
where m > 1 and avg_speed <= 80""", "trips")
def d19(spark, sf):
    t = X.trips(spark, sf).withColumn("m", C.duration_min("pickup_datetime", "dropoff_datetime"))
    t = t.withColumn("avg_speed", C.speed_mph("trip_distance", "m"))
    return rounded(t.where((F.col("m") > 1) & (F.col("avg_speed") <= 80)).select("tripid", "avg_speed"))


DISTANCE_SQL = """
with d as (select tripid, date_diff('second', pickup_datetime, dropoff_datetime) / 60.0 as trip_duration_min,
  2 * {radius} * asin(sqrt(least(1.0, pow(sin(radians(z.lat - p.lat) / 2), 2)
    + cos(radians(p.lat)) * cos(radians(z.lat)) * pow(sin(radians(z.lon - p.lon) / 2), 2)))) as dist
  from trips left join zones p on pickup_locationid = p.locationid left join zones z on dropoff_locationid = z.locationid)
"""


def located(spark, sf, radius=None):
    t = attach_centroids(X.trips(spark, sf), X.zones(spark, sf))
    f = geo.haversine_mi if radius == "mi" else geo.haversine_m
    return t.select(
        "tripid", C.duration_min("pickup_datetime", "dropoff_datetime").alias("trip_duration_min"),
        f(F.col("pickup_lat"), F.col("pickup_lon"), F.col("dropoff_lat"), F.col("dropoff_lon")).alias("direct_dist_m"),
    )


@query("d20_direct_speed", DISTANCE_SQL.format(radius="6371000") + """
select tripid, round(dist / (trip_duration_min * 60), 4) as speed_ms from d
where trip_duration_min > 0 and dist / (trip_duration_min * 60) > 2 and dist / (trip_duration_min * 60) < 100""", "trips zones")
def d20(spark, sf):
    t = located(spark, sf).where(F.col("trip_duration_min") > 0)
    t = t.withColumn("speed_ms", C.speed_ms("direct_dist_m", "trip_duration_min"))
    return rounded(t.where((F.col("speed_ms") > 2) & (F.col("speed_ms") < 100)).select("tripid", "speed_ms"))


@query("d21_haversine_metres", DISTANCE_SQL.format(radius="6371000") + "select tripid, round(dist, 4) as metres from d", "trips zones")
def d21(spark, sf):
    return rounded(located(spark, sf).select("tripid", F.col("direct_dist_m").alias("metres")))


@query("d22_haversine_miles", DISTANCE_SQL.format(radius="3959") + "select tripid, round(dist, 6) as miles from d", "trips zones")
def d22(spark, sf):
    return rounded(located(spark, sf, "mi").select("tripid", F.col("direct_dist_m").alias("miles")), 6)


@query("d23_weather_basic", """
select climate_date, case when precipIntensity > 0 then 'Rainy' else 'Dry' end as weather_condition from climate""", "climate")
def d23(spark, sf):
    return X.climate(spark, sf).select("climate_date", C.weather_basic().alias("weather_condition"))


@query("d24_weather_refined", """
select climate_date, case when precipIntensity > 0 and lowTemp <= 32 then 'Snow' when precipIntensity > 0.1 then 'Heavy rain'
  when precipIntensity > 0 then 'Light rain' when visibility <= 2 and cloudCover >= 0.5 then 'Fog' else 'Clear' end as weather from climate""", "climate")
def d24(spark, sf):
    return X.climate(spark, sf).select("climate_date", C.weather_refined().alias("weather"))


@query("d25_tip_bucket", """
select case when tip_amount <= 0 then '$0' when tip_amount < 2 then '$0-2' when tip_amount < 5 then '$2-5' when tip_amount < 10 then '$5-10'
  when tip_amount is not null then '$10+' end as tip_bucket, count(*) as n from trips group by 1""", "trips")
def d25(spark, sf):
    return X.trips(spark, sf).groupBy(C.tip_bucket().alias("tip_bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("d26_distance_and_duration_buckets", """
select case when trip_distance < 2 then '0-2' when trip_distance < 4 then '2-4' when trip_distance < 6 then '4-6' when trip_distance < 8 then '6-8'
    when trip_distance < 10 then '8-10' when trip_distance < 15 then '10-15' end as distance_bucket,
  case when m < 10 then '0-10' when m < 20 then '10-20' when m < 30 then '20-30' when m < 45 then '30-45' when m < 60 then '45-60' else '60+' end as duration_bucket,
  count(*) as n from (select trip_distance, date_diff('minute', pickup_datetime, dropoff_datetime) as m from trips) group by 1, 2""", "trips")
def d26(spark, sf):
    minutes = C.duration_min_int("pickup_datetime", "dropoff_datetime")
    return X.trips(spark, sf).groupBy(
        C.distance_bucket("trip_distance").alias("distance_bucket"), C.duration_bucket(minutes).alias("duration_bucket")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("d27_tip_features", """
select tripid, cast(tip_amount > 0 as int) as has_tip, round(tip_amount * 100.0 / nullif(fare_amount, 0), 4) as tip_pct_of_fare from trips""", "trips")
def d27(spark, sf):
    return rounded(C.tip_features(X.trips(spark, sf)).select("tripid", "has_tip", "tip_pct_of_fare"))


PREPARED_ROUND = """
round(fare_capped, 4) as fare_capped, round(distance_capped, 4) as distance_capped, round(trip_duration_min, 4) as trip_duration_min,
round(cast(humidity as double), 4) as humidity, round(cast(windSpeed as double), 4) as windSpeed, round(cast(visibility as double), 4) as visibility"""


def exact_prepared(spark, sf):
    """The prepared sample under exact caps, which any engine can reproduce."""
    from ..operators.aggregates import exact_caps
    guarded = E.derive_and_guard(X.fact(spark, sf))
    long = pin(exact_caps(guarded))
    wide = long.groupBy(F.col("grp").alias("service_type")).agg(*[
        F.max(F.when(F.col("metric") == m, F.col("p99"))).alias(f"{m}_p99") for m in ("fare", "distance", "duration")
    ])
    return prepared(X.fact(spark, sf), wide)


@query("d28_select_model_columns", f"""
select tripid, pickup_datetime, round(fare_amount, 4) as fare_amount, round(trip_distance, 4) as trip_distance,
  cast(passenger_count as int) as passenger_count, round(temperature, 4) as temperature, pickup_hour, pickup_dow, service_type,
  pickup_borough, dropoff_borough, pickup_zone, dropoff_zone, temp_band, is_airport_trip, ratecodeid, {PREPARED_ROUND} from prepared""", "prepared")
def d28(spark, sf):
    return rounded(exact_prepared(spark, sf))


@query("d29_drop_excluded", "select service_type, dropoff_datetime, passenger_count from trips", "trips")
def d29(spark, sf):
    return C.drop_excluded(X.trips(spark, sf))


@query("d30_build_features", f"""
select pickup_dow, service_type, pickup_borough, dropoff_borough, is_airport_trip, cast(passenger_count as int) as passenger_count,
  round(sin(2 * pi() * pickup_hour / 24), 4) + 0.0 as pickup_hour_sin, round(cos(2 * pi() * pickup_hour / 24), 4) + 0.0 as pickup_hour_cos,
  cast(case temp_band when 'Freezing' then 0 when 'Cold' then 1 when 'Mild' then 2 when 'Warm' then 3 else 4 end as int) as temp_band_ord,
  od_corridor, {PREPARED_ROUND} from prepared""", "prepared")
def d30(spark, sf):
    return rounded(C.build_features(exact_prepared(spark, sf)))


@query("d31_columns_first", "select zone, borough, locationid, round(lat, 4) as lat, round(lon, 4) as lon from zones", "zones")
def d31(spark, sf):
    return rounded(C.columns_first(X.zones(spark, sf), ["zone", "borough"]))


@query("d32_prefix_columns", """
select locationid as pickup_locationid, borough as pickup_borough, zone as pickup_zone from zones""", "zones")
def d32(spark, sf):
    return C.prefix_columns(X.zones(spark, sf).select("locationid", "borough", "zone"), "pickup")


@query("d33_log_and_root_scales", """
select pickup_locationid, count(*) as n, round(sqrt(count(*)), 6) as root_n,
  round(avg(case when trip_distance > 0 then log10(trip_distance) end), 6) as mean_log_distance,
  round(avg(case when fare_amount > 0 then log10(fare_amount) end), 6) as mean_log_fare from trips group by 1""", "trips")
def d33(spark, sf):
    t = C.log10_cols(X.trips(spark, sf), ["trip_distance", "fare_amount"])
    g = t.groupBy("pickup_locationid").agg(
        F.count(F.lit(1)).alias("n"), F.avg("log10_trip_distance").alias("mean_log_distance"), F.avg("log10_fare_amount").alias("mean_log_fare")
    )
    return rounded(g.withColumn("root_n", C.sqrt_count("n")), 6)


# --- E: predicates -------------------------------------------------------------

TIMED = "with t as (select *, date_diff('second', pickup_datetime, dropoff_datetime) / 60.0 as trip_duration_min from trips)\n"


def timed(spark, sf):
    return X.trips(spark, sf).withColumn("trip_duration_min", C.duration_min("pickup_datetime", "dropoff_datetime"))


@query("e01_guard", TIMED + "select tripid from t where fare_amount >= 0 and trip_distance > 0 and trip_duration_min >= 1", "trips")
def e01(spark, sf):
    return E.guard(timed(spark, sf)).select("tripid")


@query("e02_derive_and_guard", """
select tripid, round(temperature, 4) as temperature, round(trip_duration_min, 4) as trip_duration_min, pickup_hour, pickup_dow,
  is_airport_trip, cast(passenger_count as int) as passenger_count, temp_band from guarded""", "guarded")
def e02(spark, sf):
    cols = ["tripid", "temperature", "trip_duration_min", "pickup_hour", "pickup_dow", "is_airport_trip", "passenger_count", "temp_band"]
    return rounded(E.derive_and_guard(X.fact(spark, sf)).select(*cols))


@query("e03_report_filter", "select tripid from trips where trip_distance > 0 and fare_amount >= 0", "trips")
def e03(spark, sf):
    return E.report_filter(X.trips(spark, sf)).select("tripid")


@query("e04_known_zones", "select locationid, borough, zone from zones where borough <> 'Unknown'", "zones")
def e04(spark, sf):
    return E.known_zones(X.zones(spark, sf)).select("locationid", "borough", "zone")


@query("e05_anomalous_passengers", """
select passenger_count, vendorid, count(*) as n from trips where passenger_count = 0 or passenger_count between 7 and 9 group by 1, 2""", "trips")
def e05(spark, sf):
    return E.anomalous_passengers(X.trips(spark, sf)).groupBy("passenger_count", "vendorid").agg(F.count(F.lit(1)).alias("n"))


@query("e06_short_trips", TIMED + """
select count(*) filter (trip_duration_min <= 1) as short_trips, count(*) as all_trips,
  round(count(*) filter (trip_duration_min <= 1) / count(*), 6) as short_share from t""", "trips")
def e06(spark, sf):
    return rounded(E.short_trips(timed(spark, sf)), 6)


@query("e07_between_ts", """
select tripid, pickup_datetime from trips where pickup_datetime > timestamp '1996-01-20 00:00:00' and pickup_datetime < timestamp '1996-02-10 12:00:00'""", "trips")
def e07(spark, sf):
    return E.between_ts(X.trips(spark, sf), "1996-01-20", "1996-02-10 12:00:00").select("tripid", "pickup_datetime")


@query("e08_plausible_box", DISTANCE_SQL.format(radius="6371000") + """
select tripid from d where trip_duration_min > 2 and trip_duration_min < 60 and dist > 100 and dist < 100000""", "trips zones")
def e08(spark, sf):
    return E.plausible_box(located(spark, sf), (2, 60)).select("tripid")


@query("e09_valid_sample", """
select tripid from trips where trip_distance > 0 and trip_distance < 50 and fare_amount > 0 and pickup_locationid is not null""", "trips")
def e09(spark, sf):
    return E.valid_sample(X.trips(spark, sf)).select("tripid")


@query("e10_bad_records", """
select tripid, dropoff_datetime < pickup_datetime as negative_duration, fare_amount < 0 as negative_fare
from trips where dropoff_datetime < pickup_datetime or fare_amount < 0""", "trips")
def e10(spark, sf):
    return E.bad_records(X.trips(spark, sf)).select(
        "tripid", (F.col("dropoff_datetime") < F.col("pickup_datetime")).alias("negative_duration"), (F.col("fare_amount") < 0).alias("negative_fare")
    )


@query("e11_page_filter", """
select tripid from fact where pickup_date between '1996-01-01' and '1998-12-31' and service_type = 'Yellow'
  and pickup_borough in ('ASIA', 'EUROPE') and payment_type_description = 'Credit card'""", "fact")
def e11(spark, sf):
    f = E.page_filter(
        X.fact(spark, sf), "1996-01-01", "1998-12-31",
        service_type="Yellow", pickup_borough=["ASIA", "EUROPE"], payment_type_description="Credit card",
    )
    return f.select("tripid")


# --- K: scalar functions -----------------------------------------------------------


@query("k01_string_functions", """
select doc_id, concat(source, ':', lang) as joined, concat_ws('-', source, lang) as joined_ws, substring(source, 1, 3) as first3,
  split_part(source, '_', 1) as head, regexp_replace(source, '[aeiou]', '*', 'g') as masked, regexp_extract(source, '([a-z]+)', 1) as word,
  upper(lang) as up, lower(upper(source)) as low, trim('  ' || lang || ' ') as trimmed, ltrim('  ' || lang) as l, rtrim(lang || '  ') as r,
  cast(length(source) as int) as len from documents""")
def k01(spark, sf):
    source, lang = F.col("source"), F.col("lang")
    return X.table(spark, sf, "documents").select(
        "doc_id", F.concat(source, F.lit(":"), lang).alias("joined"), F.concat_ws("-", source, lang).alias("joined_ws"),
        F.substring(source, 1, 3).alias("first3"), F.split(source, "_")[0].alias("head"),
        F.regexp_replace(source, "[aeiou]", "*").alias("masked"), F.regexp_extract(source, "([a-z]+)", 1).alias("word"),
        F.upper(lang).alias("up"), F.lower(F.upper(source)).alias("low"), F.trim(F.concat(F.lit("  "), lang, F.lit(" "))).alias("trimmed"),
        F.ltrim(F.concat(F.lit("  "), lang)).alias("l"), F.rtrim(F.concat(lang, F.lit("  "))).alias("r"), F.length(source).alias("len"),
    )


@query("k02_date_functions", """
select event_id, cast(year(ts) as int) as y, cast(month(ts) as int) as m, cast(dayofyear(ts) as int) as doy, cast(day(ts) as int) as d,
  cast(dayofweek(ts) + 1 as int) as dow, cast(hour(ts) as int) as h, cast(minute(ts) as int) as mi, cast(second(ts) as int) as s,
  strftime(ts, '%Y/%m/%d') as text, cast(ts as date) as day, cast(strftime(ts, '%Y-%m-%d %H:%M:%S') as timestamp) as parsed,
  cast(cast(ts as date) - date '2024-01-01' as int) as days_in, cast(month(ts) - 1 as double) as months_in,
  cast(cast(date_trunc('month', ts) as date) + interval 1 month as date) as next_month, cast(cast(ts as date) + interval 7 day as date) as week_later,
  cast(cast(ts as date) - interval 7 day as date) as week_before, cast(epoch(date_trunc('second', ts)) as bigint) as unix_s, true as clock_runs from events""")
def k02(spark, sf):
    ts, day = F.col("ts"), F.to_date("ts")
    as_text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return X.table(spark, sf, "events").select(
        "event_id", F.year(ts).alias("y"), F.month(ts).alias("m"), F.dayofyear(ts).alias("doy"), F.dayofmonth(ts).alias("d"),
        F.dayofweek(ts).alias("dow"), F.hour(ts).alias("h"), F.minute(ts).alias("mi"), F.second(ts).alias("s"),
        F.date_format(ts, "yyyy/MM/dd").alias("text"), day.alias("day"), F.to_timestamp_ntz(as_text).alias("parsed"),
        F.datediff(day, F.lit("2024-01-01").cast("date")).alias("days_in"),
        F.months_between(F.trunc(day, "month"), F.lit("2024-01-01").cast("date")).alias("months_in"),
        F.add_months(F.trunc(day, "month"), 1).alias("next_month"), F.date_add(day, 7).alias("week_later"), F.date_sub(day, 7).alias("week_before"),
        (F.unix_timestamp(as_text) - F.unix_timestamp(F.lit("1970-01-01 00:00:00"))).alias("unix_s"),
        ((F.current_date() > day) & (F.current_timestamp() > F.to_timestamp(as_text))).alias("clock_runs"),
    )


@query("k03_math_functions", """
select locationid, round(radians(lat), 6) as rad, round(sin(lat), 6) as s, round(cos(lat), 6) as c, round(asin(lat / 100), 6) as a,
  round(atan2(lat, lon), 6) as at2, round(sqrt(lat), 6) as root, round(log10(lat), 6) as lg, round(least(lat, abs(lon)), 6) as small,
  cast(((locationid - 30) % 7 + 7) % 7 as int) as wrapped, cast(floor(lon) as bigint) as floored, round(abs(lon), 6) as positive from zones""", "zones")
def k03(spark, sf):
    lat, lon = F.col("lat"), F.col("lon")
    return rounded(X.zones(spark, sf).select(
        "locationid", F.radians(lat).alias("rad"), F.sin(lat).alias("s"), F.cos(lat).alias("c"), F.asin(lat / 100).alias("a"),
        F.atan2(lat, lon).alias("at2"), F.sqrt(lat).alias("root"), F.log10(lat).alias("lg"), F.least(lat, F.abs(lon)).alias("small"),
        F.pmod(F.col("locationid") - 30, F.lit(7)).alias("wrapped"), F.floor(lon).alias("floored"), F.abs(lon).alias("positive"),
    ), 6)


@query("k04_conditional_functions", """
select tripid, case when passenger_count > 3 then 'many' when passenger_count is not null then 'few' else 'none' end as party,
  coalesce(passenger_count, 0) as filled, passenger_count is null as missing, passenger_count is not null as present,
  service_type in ('Yellow', 'Grey') as listed, trip_distance between 5 and 10 as middling,
  try_cast(case when passenger_count is null then 'x' else cast(passenger_count as varchar) end as int) as safe from trips""", "trips")
def k04(spark, sf):
    p = F.col("passenger_count")
    return X.trips(spark, sf).select(
        "tripid", F.when(p > 3, "many").when(p.isNotNull(), "few").otherwise("none").alias("party"), F.coalesce(p, F.lit(0)).alias("filled"),
        p.isNull().alias("missing"), p.isNotNull().alias("present"), F.col("service_type").isin("Yellow", "Grey").alias("listed"),
        F.col("trip_distance").between(5, 10).alias("middling"),
        F.when(p.isNull(), "x").otherwise(p.cast("string")).try_cast("int").alias("safe"),
    )


@query("k05_nested_functions", """
select event_type, w as word, count(*) as n, count(distinct user_id) as users, cast(sum(cast(json_extract(props, '$.k') as int)) as bigint) as k_sum
from (select *, unnest(string_split(event_type || '_' || cast(user_id % 3 as varchar), '_')) as w from events) group by 1, 2""")
def k05(spark, sf):
    e = X.table(spark, sf, "events")
    tag = F.concat("event_type", F.lit("_"), (F.col("user_id") % 3).cast("string"))
    row = F.struct("user_id", F.array(F.get_json_object("props", "$.k").cast("int")).alias("k"))
    long = e.select("event_type", F.explode(F.split(tag, "_")).alias("word"), row.alias("row"), F.to_json(row).alias("text"))
    return long.groupBy("event_type", "word").agg(
        F.count("text").alias("n"), F.count_distinct("row.user_id").alias("users"), F.sum(F.col("row.k")[0]).alias("k_sum")
    )


@query("k05_collect_per_zone", """
select n_regionkey as region, string_agg(n_name, ',' order by n_name) as names, cast(count(distinct length(n_name)) as int) as lengths from nation group by 1""")
def k05b(spark, sf):
    # Lists are collected from the closed zone table, a few hundred rows at most.
    return X.table(spark, sf, "nation").groupBy(F.col("n_regionkey").alias("region")).agg(
        F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("names"), F.size(F.collect_set(F.length("n_name"))).alias("lengths")
    )


@query("k05_lines_per_order", """
select l_orderkey, string_agg(cast(l_linenumber as varchar), ',' order by l_linenumber) as lines, cast(count(distinct l_returnflag) as int) as flags, count(*) as n
from lineitem group by 1""")
def k05c(spark, sf):
    # An order has few lines, so its list is short however large the table.
    lines = X.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list("l_linenumber")).alias("all"), F.size(F.collect_set("l_returnflag")).alias("flags"), F.count(F.lit(1)).alias("n"))
    return lines.select("l_orderkey", F.array_join(F.col("all").cast("array<string>"), ",").alias("lines"), "flags", "n")


@query("k06_hash_functions", """
select tripid, md5(service_type || tripid) as key, ('0x' || substr(md5(tripid), 1, 8))::bigint % 16 as bucket, true as same from trips""", "trips")
def k06(spark, sf):
    from ..operators.sampling import md5_bucket
    ident = F.col("tripid")
    again = (F.crc32(ident) == F.crc32(F.concat(ident, F.lit("")))) & (F.xxhash64(ident) == F.xxhash64(F.concat(ident, F.lit(""))))
    return X.trips(spark, sf).select("tripid", F.md5(F.concat("service_type", ident)).alias("key"), md5_bucket(ident, 16).alias("bucket"), again.alias("same"))


@query("k07_aggregate_functions", """
select service_type, round(sum(fare_amount), 2) as total, round(avg(fare_amount), 4) as mean, count(passenger_count) as n, min(trip_distance) as lo,
  max(trip_distance) as hi, round(stddev_samp(fare_amount), 4) as sd, count(distinct pickup_locationid) as zones,
  round(corr(fare_amount, trip_distance), 6) as r, any_value(service_type) as any_service, bit_xor(dropoff_locationid) as folded,
  quantile_disc(trip_distance, 0.5) as middle from trips group by 1""", "trips")
def k07(spark, sf):
    fare = F.col("fare_amount")
    return X.trips(spark, sf).groupBy("service_type").agg(
        F.round(F.sum(fare), 2).alias("total"), F.round(F.avg(fare), 4).alias("mean"), F.count("passenger_count").alias("n"),
        F.min("trip_distance").alias("lo"), F.max("trip_distance").alias("hi"), F.round(F.stddev(fare), 4).alias("sd"),
        F.count_distinct("pickup_locationid").alias("zones"), F.round(F.corr(fare, "trip_distance"), 6).alias("r"),
        F.any_value("service_type").alias("any_service"), F.bit_xor("dropoff_locationid").alias("folded"),
        F.percentile_approx("trip_distance", 0.5, 1_000_000).alias("middle"),
    )



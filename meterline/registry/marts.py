"""Checked queries for staging, marts, joins and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import trip_columns as C
from ..operators import joins as J, quality as N, staging as S
from ..operators.aggregates import compare_groups
from ..plans import fixtures as X
from ..session import pin
from .core import NEEDS, VIEWS, query
from .helpers import rounded

START, END = "1996-01-01", "2000-12-31"

RAW_SQL = """
select cast(case when passenger_count = 9 then null else vendorid end as bigint) as vendorid, cast(ratecodeid as bigint) as ratecodeid,
  cast(pickup_locationid as bigint) as pickup_locationid, cast(dropoff_locationid as bigint) as dropoff_locationid, pickup_datetime, dropoff_datetime, store_and_fwd_flag, cast(passenger_count as bigint) as passenger_count,
  {money}, cast(payment_type as bigint) as payment_type, service_type from trips where service_type = '{service}'"""
MONEY_SQL = ", ".join(
    [f"cast({c} as decimal(38,9)) as {c}" for c in ("trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge")]
    + ["cast(fare_amount + extra + mta_tax + tip_amount + tolls_amount + improvement_surcharge as decimal(38,9)) as total_amount"]
)
for _service in ("Yellow", "Green"):
    _one = RAW_SQL.format(service=_service, money=MONEY_SQL)
    VIEWS[f"staged_{_service.lower()}"] = f"""
select * from (select * from ({_one}) union all select * from ({_one}) where ratecodeid = 7)
where vendorid is not null and cast(pickup_datetime as date) between date '{START}' and date '{END}'"""
    NEEDS[f"staged_{_service.lower()}"] = ["trips"]
KEY_COLUMNS = [
    "vendorid", "pickup_datetime", "dropoff_datetime", "ratecodeid", "pickup_locationid", "dropoff_locationid", "store_and_fwd_flag",
    "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "payment_type", "service_type",
]
STAGED_ROUND = ", ".join(
    f"round(cast({c} as double), 4) as {c}" if c in ("trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount") else c
    for c in KEY_COLUMNS
)


def staged(spark, sf, service):
    return S.stage_trips(X.raw_trips(spark, sf, service), service, START, END)


@query("c01_stage_trips", f"select {STAGED_ROUND} from staged_yellow", "staged_yellow")
def c01(spark, sf):
    return rounded(staged(spark, sf, "Yellow"))


@query("c02_stage_trips_second_service", f"select {STAGED_ROUND} from staged_green", "staged_green")
def c02(spark, sf):
    return rounded(staged(spark, sf, "Green"))


@query("c03_dedup_rows", f"select distinct {STAGED_ROUND} from staged_green", "staged_green")
def c03(spark, sf):
    return rounded(S.dedup_rows(staged(spark, sf, "Green")))


@query("c04_dedup_keep_first", """
select vendorid, pickup_datetime, dropoff_datetime, pickup_locationid, dropoff_locationid, round(cast(fare_amount as double), 4) as fare_amount from (
  select *, row_number() over (partition by vendorid, pickup_datetime order by dropoff_datetime, pickup_locationid, dropoff_locationid, fare_amount) as rn
  from staged_yellow) where rn = 1""", "staged_yellow")
def c04(spark, sf):
    order = ["dropoff_datetime", "pickup_locationid", "dropoff_locationid", "fare_amount"]
    t = staged(spark, sf, "Yellow").select("vendorid", "pickup_datetime", *order)
    return rounded(S.dedup_keep_first(t, ["vendorid", "pickup_datetime"], order))


@query("c05_surrogate_key", f"""
select md5(concat_ws('-', {", ".join(f"coalesce(cast({c} as varchar), '')" for c in KEY_COLUMNS)})) as tripid, vendorid, pickup_datetime
from (select distinct * from staged_yellow)""", "staged_yellow")
def c05(spark, sf):
    keyed = S.surrogate_key(S.dedup_rows(staged(spark, sf, "Yellow")), KEY_COLUMNS)
    return keyed.select("tripid", "vendorid", "pickup_datetime")


@query("c06_stage_climate", """
select climate_date, round(cast(highTemp as double), 4) as highTemp, round(cast(lowTemp as double), 4) as lowTemp, round(cast(precipIntensity as double), 4) as precipIntensity,
  round(cast(humidity as double), 4) as humidity, round(cast(windSpeed as double), 4) as windSpeed, round(cast(visibility as double), 4) as visibility,
  round(cast(cloudCover as double), 4) as cloudCover from climate""", "climate")
def c06(spark, sf):
    raw = X.climate(spark, sf)
    # Every rainy day arrives twice.
    doubled = raw.unionByName(raw.where(F.col("precipIntensity") > 0)).withColumn("climate_date", F.col("climate_date").cast("string"))
    return rounded(S.stage_climate(doubled))


@query("c07_union_services", """
select service_type, count(*) as n, round(cast(sum(total_amount) as double), 2) as total from (
  select * from staged_yellow union all by name select * from staged_green) group by 1""", "staged_yellow staged_green")
def c07(spark, sf):
    both = S.union_services(staged(spark, sf, "Yellow"), staged(spark, sf, "Green"))
    return rounded(both.groupBy("service_type").agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("total")), 2)


@query("c08_fact_trips", """
select tripid, service_type, pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, pickup_date, climate_date, payment_type_description,
  round(total_amount, 4) as total_amount, round(cast(highTemp as double), 4) as highTemp, round(cast(humidity as double), 4) as humidity from fact""", "fact")
def c08(spark, sf):
    return rounded(X.fact(spark, sf).select(
        "tripid", "service_type", "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone", "pickup_date", "climate_date",
        "payment_type_description", "total_amount", "highTemp", "humidity",
    ))


@query("c08_fact_from_raw", """
select service_type, pickup_borough, count(*) as n, round(cast(sum(total_amount) as double), 2) as total from (
  select distinct * from (select * from staged_yellow union all by name select * from staged_green)) t
join zones p on pickup_locationid = p.locationid and p.borough <> 'Unknown'
join zones d on dropoff_locationid = d.locationid and d.borough <> 'Unknown', lateral (select p.borough as pickup_borough) group by 1, 2""", "staged_yellow staged_green zones")
def c08b(spark, sf):
    # Kept first: the de-duplication reads its rows three times.
    parts = [S.dedup_rows(pin(staged(spark, sf, s))) for s in ("Yellow", "Green")]
    fact = S.build_fact_trips(S.union_services(*parts), X.zones(spark, sf), X.climate(spark, sf))
    return rounded(fact.groupBy("service_type", "pickup_borough").agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("total")), 2)


@query("c09_dim_zones", "select distinct locationid, borough, zone from zones", "zones")
def c09(spark, sf):
    return S.build_dim_zones(X.zones(spark, sf))


@query("c10_monthly_zone_revenue", """
select pickup_zone as revenue_zone, cast(date_trunc('month', pickup_datetime) as date) as revenue_month, service_type,
  round(sum(fare_amount), 6) as revenue_fare_amount, round(sum(extra), 6) as revenue_extra, round(sum(mta_tax), 6) as revenue_mta_tax,
  round(sum(tip_amount), 6) as revenue_tip_amount, round(sum(tolls_amount), 6) as revenue_tolls_amount,
  round(sum(improvement_surcharge), 6) as revenue_improvement_surcharge, round(sum(total_amount), 6) as revenue_total_amount,
  count(*) as total_trips, round(avg(passenger_count), 6) as avg_passenger_count, round(avg(trip_distance), 6) as avg_trip_distance
from fact where fare_amount >= 0 group by 1, 2, 3""", "fact")
def c10(spark, sf):
    return rounded(S.monthly_zone_revenue(X.fact(spark, sf).where(F.col("fare_amount") >= 0)), 6)


@query("c11_payment_description", """
select payment_type, case payment_type when 1 then 'Credit card' when 2 then 'Cash' end as description, count(*) as n from trips group by 1, 2""", "trips")
def c11(spark, sf):
    text = C.payment_description("payment_type", {1: "Credit card", 2: "Cash"}).alias("description")
    return X.trips(spark, sf).groupBy("payment_type", text).agg(F.count(F.lit(1)).alias("n"))


@query("c13_batch_by_year", """
select tripid, strftime(pickup_datetime, '%Y-%m') as year_month from trips where year(pickup_datetime) between 1996 and 1997""", "trips")
def c13(spark, sf):
    return S.batch_by_year(X.trips(spark, sf), 1996, 1997).select("tripid", "year_month")


# --- F: joins --------------------------------------------------------------------


@query("f01_trips_with_zone", """
select tripid, pickup_datetime as datetime, borough, zone, round(trip_distance, 4) as trip_distance, round(fare_amount, 4) as fare_amount
from trips join zones on pickup_locationid = locationid""", "trips zones")
def f01(spark, sf):
    return rounded(J.trips_with_zone(X.trips(spark, sf), X.zones(spark, sf)))


@query("f02_attach_centroids", """
select tripid, round(p.lat, 4) as pickup_lat, round(p.lon, 4) as pickup_lon, round(d.lat, 4) as dropoff_lat, round(d.lon, 4) as dropoff_lon
from trips left join (select * from zones where borough <> 'Unknown') p on pickup_locationid = p.locationid
left join (select * from zones where borough <> 'Unknown') d on dropoff_locationid = d.locationid""", "trips zones")
def f02(spark, sf):
    t = J.attach_centroids(X.trips(spark, sf), J.known_zones(X.zones(spark, sf)))
    return rounded(t.select("tripid", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon"))


@query("f03_attach_climate", """
select tripid, climate_date, round(cast(highTemp as double), 4) as highTemp from trips left join climate on pickup_date = climate_date
and precipIntensity > 0""", "trips climate")
def f03(spark, sf):
    wet = X.climate(spark, sf).where(F.col("precipIntensity") > 0)
    return rounded(J.attach_climate(X.trips(spark, sf), wet.unionByName(wet)).select("tripid", "climate_date", "highTemp"))


@query("f05_join_aggregates", """
select * from (select service_type, pickup_locationid, count(*) as n from trips group by 1, 2)
join (select service_type, pickup_locationid, round(max(fare_amount), 4) as top_fare from trips where trip_distance > 25 group by 1, 2) using (service_type, pickup_locationid)""", "trips")
def f05(spark, sf):
    t = X.trips(spark, sf)
    keys = ["service_type", "pickup_locationid"]
    counts = t.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(t.where(F.col("trip_distance") > 25).groupBy(*keys).agg(F.round(F.max("fare_amount"), 4).alias("top_fare")), keys)


@query("f06_zones_known_flag", """
select tripid, coalesce(p.borough <> 'Unknown' and d.borough <> 'Unknown', false) as zones_known from trips
left join zones p on pickup_locationid = p.locationid left join zones d on dropoff_locationid = d.locationid""", "trips zones")
def f06(spark, sf):
    return J.zones_known_flag(X.trips(spark, sf), X.zones(spark, sf)).select("tripid", "zones_known")


@query("f07_attach_route", """
select tripid, round(3959 * 2 * asin(sqrt(least(1.0, pow(sin(radians(d.lat - p.lat) / 2), 2)
    + cos(radians(p.lat)) * cos(radians(d.lat)) * pow(sin(radians(d.lon - p.lon) / 2), 2)))), 4) as route_miles,
  round(3959 * 2 * asin(sqrt(least(1.0, pow(sin(radians(d.lat - p.lat) / 2), 2)
    + cos(radians(p.lat)) * cos(radians(d.lat)) * pow(sin(radians(d.lon - p.lon) / 2), 2)))) / 12 * 60, 4) as route_minutes
from trips left join zones p on pickup_locationid = p.locationid left join zones d on dropoff_locationid = d.locationid""", "trips zones")
def f07(spark, sf):
    trips = X.trips(spark, sf)
    pairs = trips.select("pickup_locationid", "dropoff_locationid").distinct()
    t = J.attach_route(trips, pin(J.route_matrix(pairs, X.zones(spark, sf))))
    return rounded(t.select("tripid", "route_miles", "route_minutes"))


@query("f08_orphans", """
select tripid, pickup_locationid from trips where pickup_locationid not in (select locationid from zones where borough <> 'Unknown')""", "trips zones")
def f08(spark, sf):
    known = J.known_zones(X.zones(spark, sf))
    return J.orphans(X.trips(spark, sf), known, "pickup_locationid", "locationid").select("tripid", "pickup_locationid")


# --- N: quality -------------------------------------------------------------------


@query("n01_duplicate_keys", """
select service_type, k as day_key, count(*) as n from (select service_type, vendorid || '|' || cast(pickup_datetime as varchar) as k from trips)
group by 1, 2 having count(*) > 1""", "trips")
def n01(spark, sf):
    t = X.trips(spark, sf).withColumn("day_key", F.concat_ws("|", "vendorid", "pickup_datetime"))
    return N.duplicate_keys(t, "day_key", ["service_type"])


@query("n02_unaccepted_values", """
select passenger_count, count(*) as n from trips where passenger_count not in (1, 2, 3, 4, 5, 6) group by 1""", "trips")
def n02(spark, sf):
    return N.unaccepted_values(X.trips(spark, sf), "passenger_count", [1, 2, 3, 4, 5, 6])


@query("n03_missing_parents", """
select dropoff_locationid, count(*) as n from trips where dropoff_locationid not in (select locationid from zones where borough <> 'Unknown') group by 1""", "trips zones")
def n03(spark, sf):
    return N.missing_parents(X.trips(spark, sf), J.known_zones(X.zones(spark, sf)), "dropoff_locationid", "locationid")


@query("n04_reconcile", """
with g as (select t.*, date_diff('second', pickup_datetime, dropoff_datetime) / 60.0 as m, coalesce(p.borough <> 'Unknown' and d.borough <> 'Unknown', false) as known_pair
  from trips t left join zones p on pickup_locationid = p.locationid left join zones d on dropoff_locationid = d.locationid),
k as (select * from g where fare_amount >= 0 and trip_distance > 0 and m >= 1)
select service_type, count(*) as guarded, count(*) filter (known_pair) as known, count(*) filter (not known_pair) as unknown,
  round(quantile_disc(fare_amount, 0.99) filter (known_pair), 4) as fare_p99, round(quantile_disc(trip_distance, 0.99) filter (known_pair), 4) as dist_p99,
  round(quantile_disc(m, 0.99) filter (known_pair), 4) as dur_p99 from k group by 1""", "trips zones")
def n04(spark, sf):
    t = X.trips(spark, sf).withColumn("trip_duration_min", C.duration_min("pickup_datetime", "dropoff_datetime"))
    return rounded(N.reconcile(t, X.zones(spark, sf)))


@query("n05_climate_fanout", """
select count(*) as n_rows, count(distinct climate_date) as n_dates, count(*) = count(distinct climate_date) as one_row_per_date from climate""", "climate")
def n05(spark, sf):
    return N.climate_fanout(X.climate(spark, sf))


@query("n06_subsecond_audit", """
select count(*) filter (epoch_us(pickup_datetime) % 1000000 <> 0) as pickup_subsecond, count(*) filter (epoch_us(dropoff_datetime) % 1000000 <> 0) as dropoff_subsecond
from (select ts as pickup_datetime, ts + interval '250' millisecond as dropoff_datetime from events)""")
def n06(spark, sf):
    e = X.table(spark, sf, "events")
    return N.subsecond_audit(e.select(F.col("ts").alias("pickup_datetime"), F.expr("ts + interval '0.25' second").alias("dropoff_datetime")))


@query("n07_month_coverage", """
select service_type, count(*) as trips, round(sum(total_amount), 2) as revenue, round(avg(fare_amount), 4) as avg_fare,
  count(distinct strftime(pickup_datetime, '%Y-%m')) as months, count(distinct strftime(pickup_datetime, '%Y-%m')) = 24 as complete
from fact where cast(pickup_datetime as date) between date '1996-01-01' and date '1997-12-31' group by 1""", "fact")
def n07(spark, sf):
    got = N.month_coverage(X.fact(spark, sf), "1996-01-01", "1997-12-31")
    return got.withColumns({"revenue": F.round("revenue", 2), "avg_fare": F.round("avg_fare", 4)})


@query("n09_key_ambiguity", """
with k as (select vendorid, pickup_datetime, count(*) as n, count(distinct (pickup_locationid, dropoff_locationid)) as pairs from trips group by 1, 2)
select count(*) as keys, count(*) filter (n > 1) as repeated_keys, count(*) filter (n > 1 and pairs > 1) as ambiguous_keys,
  cast(coalesce(sum(n - 1) filter (n > 1), 0) as bigint) as rows_lost_by_keyed_dedup from k""", "trips")
def n09(spark, sf):
    return N.key_ambiguity(X.trips(spark, sf), ["vendorid", "pickup_datetime"])


@query("n10_schema_drift", """
select column_name, case when contract is null then 'new' when found is null then 'missing' else 'retyped' end as drift, total.n as table_rows
from (values ('o_orderkey', null, 'bigint'), ('o_custkey', 'int', 'bigint'), ('o_comment', 'string', null)) v(column_name, contract, found),
  (select count(*) as n from orders) total""")
def n10(spark, sf):
    orders = X.table(spark, sf, "orders")
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    kept = [StructField(f.name, IntegerType() if f.name == "o_custkey" else f.dataType) for f in orders.schema if f.name != "o_orderkey"]
    contract = StructType([*kept, StructField("o_comment", StringType())])
    drift = N.schema_drift(spark, {"orders": f"{sf}/orders.parquet"}, contract)
    return drift.select("column_name", "drift", orders.agg(F.count(F.lit(1))).scalar().alias("table_rows"))


# --- G24 uses two marts -------------------------------------------------------------


@query("g24_compare_groups", """
select coalesce(a.pickup_locationid, b.pickup_locationid) as pickup_locationid,
  case when a.n is null then 'right only' when b.n is null then 'left only' when a.n = b.n then 'equal' else 'differs' end as state
from (select pickup_locationid, count(*) as n from trips where pickup_locationid > 2 group by 1) a
full outer join (select pickup_locationid, count(*) as n from trips where pickup_locationid < 20 and (service_type = 'Yellow' or pickup_locationid < 10) group by 1) b
on a.pickup_locationid = b.pickup_locationid""", "trips")
def g24(spark, sf):
    t, zone = X.trips(spark, sf), F.col("pickup_locationid")
    a = t.where(zone > 2).groupBy("pickup_locationid").agg(F.count(F.lit(1)).alias("n"))
    some = (zone < 20) & ((F.col("service_type") == "Yellow") | (zone < 10))
    b = t.where(some).groupBy("pickup_locationid").agg(F.count(F.lit(1)).alias("n"))
    return compare_groups(a, b, ["pickup_locationid"])

"""Checked queries for readers, writers and the incremental ingest.

Writers put their output into the shared folder and read it back.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ..functions.geo import geometry_centroids, point_centroids, zone_centroids
from ..functions.trip_columns import build_features
from ..operators.aggregates import compute_caps
from ..operators.filters import derive, derive_and_guard, guards
from ..operators.metrics import regression_metrics
from ..operators.sampling import hash_stratified_sample
from ..plans import fixtures as X
from ..plans.prep import prepared, run_prep
from ..session import pin, scratch_path
from ..sources import live, readers as A, writers as B
from ..streaming.ingest import ingest_incremental, ingest_months
from .core import query
from .helpers import rounded


@query("a01_read_trips", "select count(*) as n_rows, round(sum(o_totalprice), 2) as total from orders")
def a01(spark, sf):
    orders = A.read_trips(spark, sf, pattern="orders*.parquet")
    return orders.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("a02_read_source", "select o_orderstatus, count(*) as n from orders group by 1")
def a02(spark, sf):
    name = "orders_" + hashlib.md5(sf.encode()).hexdigest()[:10]
    if not spark.catalog.tableExists(f"spark_catalog.default.{name}"):
        spark.catalog.createTable(f"spark_catalog.default.{name}", path=f"{sf}/orders.parquet", source="parquet")
    return A.read_source(spark, f"spark_catalog.default.{name}").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("a03_read_year", "select o_orderkey, cast(o_orderdate as date) as order_date from orders where year(o_orderdate) = 1997")
def a03(spark, sf):
    orders = X.table(spark, sf, "orders")
    return A.read_year(spark, orders, 1997, "o_orderdate").select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))


@query("a04_run_query", "select l_returnflag, l_linestatus, count(*) as n, round(avg(l_quantity), 4) as avg_quantity from lineitem group by 1, 2")
def a04(spark, sf):
    sql = "select l_returnflag, l_linestatus, count(*) as n, round(avg(l_quantity), 4) as avg_quantity from {line} group by 1, 2"
    return A.run_query(spark, sql, line=X.table(spark, sf, "lineitem"))


@query("a05_load_table", "select c_custkey, c_name from customer order by c_custkey limit 100")
def a05(spark, sf):
    return A.load_table(spark, "no_such_catalog_table", ["c_custkey", "c_name"], 100, ["c_custkey"], {"no_such_catalog_table": f"{sf}/customer.parquet"})


@query("a06_load_trips_for_years", """
select tripid, date_diff('second', pickup_datetime, dropoff_datetime) as trip_duration_seconds, cast(year(pickup_datetime) as int) as pickup_year,
  cast(month(pickup_datetime) as int) as pickup_month, cast(day(pickup_datetime) as int) as pickup_day, cast(hour(pickup_datetime) as int) as pickup_hour,
  cast(dayofweek(pickup_datetime) + 1 as int) as pickup_dow from trips
where year(pickup_datetime) in (1996, 1998) and trip_distance > 0 and fare_amount > 0 and pickup_datetime < dropoff_datetime""", "trips")
def a06(spark, sf):
    t = A.load_trips_for_years(X.trips(spark, sf), [1996, 1998])
    return t.select("tripid", "trip_duration_seconds", "pickup_year", "pickup_month", "pickup_day", "pickup_hour", "pickup_dow")


@query("a07_read_zones", """
select locationid, borough, zone, 'Zone ' || cast(locationid % 3 as varchar) as service_zone, n.k as trips from zones
left join (select pickup_locationid, count(*) as k from trips group by 1) n on locationid = n.pickup_locationid""", "zones trips")
def a07(spark, sf):
    path = scratch_path(spark, "zones")
    service = F.concat(F.lit("Zone "), (F.col("locationid") % 3).cast("string"))
    X.zones(spark, sf).select(
        F.col("locationid").alias("LocationID"), F.col("borough").alias("Borough"), F.col("zone").alias("Zone"), service.alias("service_zone")
    ).write.csv(path, header=True)
    trips = X.trips(spark, sf).groupBy(F.col("pickup_locationid").alias("locationid")).agg(F.count(F.lit(1)).alias("trips"))
    return A.read_zones(spark, path).join(trips, "locationid", "left")


@query("a08_register_external", "select event_type, count(*) as n from events group by 1")
def a08(spark, sf):
    A.register_external(spark, "external_events", "parquet", f"{sf}/events*.parquet")
    return spark.sql("select event_type, count(*) as n from external_events group by 1")


@query("a09_zone_centroids", """
select c_custkey as locationid, round(c_nationkey + 1.0::double, 6) as lon, round(-c_nationkey + 1.5::double, 6) as lat from customer""")
def a09(spark, sf):
    # A 2 x 3 box per customer, with a redundant point on one edge, at its nation's number.
    k = F.col("c_nationkey").cast("double")
    corners = [(0, 0), (2, 0), (2, 1), (2, 3), (0, 3), (0, 0)]
    ring = F.array(*[F.struct((k + x).alias("lon"), (-k + y).alias("lat")) for x, y in corners])
    boxes = X.table(spark, sf, "customer").select(F.col("c_custkey").alias("locationid"), ring.alias("ring"))
    return rounded(zone_centroids(boxes), 6)


GEOMETRY_SQL = """
select c_custkey as locationid, round(((k + 3) * 24 - (k + 2) * 2 + (k + 11) * 4) / 26.0, 6) as lon, round((2 * 24 - 1.5 * 2 + 1 * 4) / 26.0, 6) as lat
from (select c_custkey, c_nationkey as k from customer)"""


def islands(spark, sf):
    """Per customer, a 6 x 4 box with a hole and, apart from it, a 2 x 2 box, in both directions."""
    k = F.col("c_nationkey").cast("double")
    ring = lambda *corners: F.array(*[F.struct((k + x).alias("lon"), F.lit(float(y)).alias("lat")) for x, y in corners])
    large = F.array(ring((0, 0), (6, 0), (6, 4), (0, 4), (0, 0)), ring((1, 1), (3, 1), (3, 2), (1, 2)))
    small = F.array(ring((10, 0), (10, 2), (12, 2), (12, 0)))
    return X.table(spark, sf, "customer").select(F.col("c_custkey").alias("locationid"), F.array(large, small).alias("geometry"))


@query("a09_geometry_centroids", GEOMETRY_SQL)
def a09b(spark, sf):
    return rounded(geometry_centroids(islands(spark, sf)), 6)


@query("a09_point_centroids", GEOMETRY_SQL)
def a09c(spark, sf):
    parts = islands(spark, sf).select("locationid", F.posexplode("geometry").alias("part", "rings"))
    rings = parts.select("locationid", "part", F.posexplode("rings").alias("ring", "vertices"))
    points = rings.select("locationid", "part", "ring", F.posexplode("vertices").alias("place", "v")).select("*", "v.lon", "v.lat").drop("v")
    return rounded(point_centroids(points), 6)


@query("a10_month_files", """
select cast(m as date) as month, '/data/trips_' || strftime(m, '%Y-%m') || '.parquet' as path from (select unnest(generate_series(
  date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), interval 1 month)) as m from orders)""")
def a10(spark, sf):
    span = X.table(spark, sf, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    return A.month_files(spark, "/data/", "trips", f"{span['a']:%Y-%m-%d}", f"{span['b']:%Y-%m-%d}")


@query("a11_literal_table", """
select v.service_type, v.spark_cap, count(t.tripid) as trips, count(*) filter (t.fare_amount <= v.spark_cap) as within
from (values ('Yellow', 52.0::double), ('Green', 46.0::double)) v(service_type, spark_cap) left join trips t using (service_type) group by 1, 2""", "trips")
def a11(spark, sf):
    caps = A.literal_table(spark, [("Yellow", 52.0), ("Green", 46.0)], "service_type string, spark_cap double")
    joined = F.broadcast(caps).join(X.trips(spark, sf), "service_type")
    return joined.groupBy("service_type", "spark_cap").agg(
        F.count("tripid").alias("trips"), F.count_if(F.col("fare_amount") <= F.col("spark_cap")).alias("within")
    )


@query("a12_check_source_counts", """
select 'orders' as prefix, 1::bigint as expected_files, o.n as expected_rows, 1::bigint as files, o.n as n_rows, true as ok from (select count(*) as n from orders) o
union all select 'customer', 1, o.n, 1, c.n, false from (select count(*) as n from orders) o, (select count(*) as n from customer) c
union all select 'unlisted', 1, 1, 0, 0, false""")
def a12(spark, sf):
    n = X.table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("expected_rows"))
    expected = n.select(F.explode(F.array(F.lit("orders"), F.lit("customer"), F.lit("unlisted"))).alias("prefix"), F.lit(1).cast("bigint").alias("expected_files"), "expected_rows")
    expected = expected.withColumn("expected_rows", F.when(F.col("prefix") == "unlisted", 1).otherwise(F.col("expected_rows")))
    return A.check_source_counts(spark, {p: f"{sf}/{p}*.parquet" for p in ("orders", "customer")}, expected)


# --- B: writers ---------------------------------------------------------------------


@query("b01_write_sample", "select 8::bigint as files, count(*) as n_rows, round(sum(fare_amount), 2) as fares from trips", "trips")
def b01(spark, sf):
    path = scratch_path(spark, "sample")
    B.write_sample(X.trips(spark, sf).select("tripid", "fare_amount"), path, 8)
    back = spark.read.parquet(path).withColumn("file", F.input_file_name())
    return back.agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("fare_amount"), 2).alias("fares"))


@query("b02_csv_to_parquet", "select s_suppkey, s_name, s_nationkey, round(s_acctbal, 4) as s_acctbal from supplier")
def b02(spark, sf):
    csv, parquet = scratch_path(spark, "supplier") + ".csv", scratch_path(spark, "supplier")
    schema = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
    X.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal").write.csv(csv, header=True)
    B.csv_to_parquet(spark, csv, parquet, schema)
    return rounded(spark.read.parquet(parquet))


@query("b03_write_train_split", """
select count(*) as n_rows, round(sum(fare_amount), 2) as label_total, true as label_last, true as files_bounded, 16::bigint as n_columns from guarded""", "guarded")
def b03(spark, sf):
    guarded = derive_and_guard(X.fact(spark, sf)).withColumns({"fare_capped": F.col("fare_amount"), "distance_capped": F.col("trip_distance")})
    path = scratch_path(spark, "train")
    from .. import constants as K
    B.write_train_split(build_features(guarded.select(*K.MODEL_COLUMNS)), path, rows_per_file=1000)
    back = spark.read.parquet(path)
    per_file = back.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"), F.sum("fare_capped").alias("s"))
    return per_file.agg(
        F.sum("n").alias("n_rows"), F.round(F.sum("s"), 2).alias("label_total"), F.lit(back.columns[-1] == "fare_capped").alias("label_last"),
        (F.max("n") <= 1000).alias("files_bounded"), F.lit(len(back.columns)).cast("bigint").alias("n_columns"),
    )


@query("b05_write_score_once", """
select count(*) as rows, round(avg(abs(fare_amount - trip_distance)), 4) as mae, true as second_refused from trips""", "trips")
def b05(spark, sf):
    path = scratch_path(spark, "score")
    score = regression_metrics(X.trips(spark, sf), "fare_amount", "trip_distance").select("rows", "mae")
    B.write_score_once(score, path)
    try:
        B.write_score_once(score, path)
        refused = False
    except B.ScoreExists:
        refused = True
    return rounded(spark.read.json(path).select("rows", "mae")).withColumn("second_refused", F.lit(refused))


@query("b06_prep_stats", """
select (select count(*) from fact) as raw_rows, count(*) as guarded_rows, count(*) filter (('0x' || substr(md5('full' || tripid), 1, 8))::bigint % 1048576 < 524288) as full_rows,
  count(*) filter (('0x' || substr(md5('work' || tripid), 1, 8))::bigint % 1048576 < 104857) as work_rows, 42 as seed, count(distinct service_type)::int as capped_services,
  round(quantile_disc(trip_duration_min, 0.99) * 0 + 1, 4) as has_duration_cap from guarded""", "guarded")
def b06(spark, sf):
    fact = X.fact(spark, sf)
    guarded = derive_and_guard(fact)
    full, work = hash_stratified_sample(guarded, 0.5, "full"), hash_stratified_sample(guarded, 0.1, "work")
    path = scratch_path(spark, "stats")
    B.write_stats(B.prep_stats(pin(compute_caps(derive(fact), keep=guards())), full, work, seed=42), path)
    # The map of caps per service comes back from JSON as one field per service.
    stats = spark.read.schema(
        "raw_rows bigint, guarded_rows bigint, full_rows bigint, work_rows bigint, seed int, duration_p99 double, "
        "per_service map<string, struct<fare_p99: double, distance_p99: double>>"
    ).json(path)
    return stats.select(
        "raw_rows", "guarded_rows", "full_rows", "work_rows", "seed", F.size("per_service").alias("capped_services"),
        F.when(F.col("duration_p99") > 0, 1.0).alias("has_duration_cap"),
    )


@query("b06_run_prep")
def b06b(spark, sf):
    return run_prep(X.fact(spark, sf), scratch_path(spark, "prep"), source=sf, full_fraction=0.5, work_fraction=0.5)


@query("b07_write_leaderboard", """
select service_type as model, round(sqrt(avg(pow(fare_amount - trip_distance, 2))), 4) as rmse_mean, 1::bigint as files from trips group by 1""", "trips")
def b07(spark, sf):
    path = scratch_path(spark, "board")
    rows = regression_metrics(X.trips(spark, sf), "fare_amount", "trip_distance", by=["service_type"])
    B.write_leaderboard(rows.select(F.col("service_type").alias("model"), F.col("rmse").alias("rmse_mean")), path)
    back = spark.read.schema("model string, rmse_mean double").csv(path, header=True)
    files = back.select(F.input_file_name().alias("file")).agg(F.count_distinct("file")).scalar()
    return rounded(back.withColumn("files", files))


@query("b08_save_fact", """
select cast(date_trunc('month', pickup_datetime) as date) as pickup_month, count(*) as n, count(distinct (pickup_locationid, dropoff_locationid)) as pairs from fact group by 1""", "fact")
def b08(spark, sf):
    path = scratch_path(spark, "fact")
    B.save_fact(X.fact(spark, sf), path, files_per_month=2)
    return spark.read.parquet(path).groupBy("pickup_month").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("pickup_locationid", "dropoff_locationid").alias("pairs")
    )


@query("b08_zone_files", """
select p.id as zone, p.n as pickups, d.n as dropoffs, true as few_files
from (select pickup_locationid as id, count(*) as n from fact group by 1) p join (select dropoff_locationid as id, count(*) as n from fact group by 1) d using (id)""", "fact")
def b08_zones(spark, sf):
    # Files of the largest month whose range of ids holds the zone: at most five eighths of them, on average over both ids.
    path = scratch_path(spark, "clustered")
    B.save_fact(X.fact(spark, sf), path, files_per_month=16)
    mart = spark.read.parquet(path)
    month = mart.groupBy("pickup_month").count().orderBy(F.desc("count"), "pickup_month").first()["pickup_month"]
    files = mart.where(F.col("pickup_month") == F.lit(month)).groupBy(F.input_file_name().alias("file")).agg(
        *[f(c).alias(f"{f.__name__}_{c[:1]}") for c in ("pickup_locationid", "dropoff_locationid") for f in (F.min, F.max)])
    total = files.agg(F.count(F.lit(1))).scalar()

    def per_zone(side, name):
        return mart.groupBy(F.col(f"{side}_locationid").alias("zone")).agg(F.count(F.lit(1)).alias(name))

    zones = per_zone("pickup", "pickups").join(per_zone("dropoff", "dropoffs"), "zone")
    met = [F.col("zone").between(F.col(f"min_{c}"), F.col(f"max_{c}")) for c in "pd"]
    shares = zones.join(files, met[0] | met[1], "left").groupBy("zone", "pickups", "dropoffs").agg(*[F.count_if(m).alias(c) for m, c in zip(met, "pd")])
    return shares.select("zone", "pickups", "dropoffs", ((F.col("p") + F.col("d")) * 8 <= total * 2 * 5).alias("few_files"))


INGEST_SQL = """
select cast(date_trunc('month', o_orderdate) as date) as pickup_month, count(*) as n, round(sum(o_totalprice), 2) as total from orders
where o_orderdate >= date '1996-02-01' and o_orderdate < date '1997-07-01' group by 1"""
WINDOW = ("1996-02-01", "1997-06-30")


def monthly(rows):
    return rows.groupBy("pickup_month").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("c12_ingest_incremental", INGEST_SQL)
def c12(spark, sf):
    dst, checkpoint = scratch_path(spark, "ingest"), scratch_path(spark, "ingest-state")
    schema = X.table(spark, sf, "orders").schema
    for _ in range(2):  # the second run finds nothing new
        ingest_incremental(spark, sf, dst, checkpoint, *WINDOW, schema=schema, ts="o_orderdate", pattern="orders*.parquet")
    return monthly(spark.read.parquet(dst))


@query("c12_ingest_months", INGEST_SQL)
def c12b(spark, sf):
    dst = scratch_path(spark, "months")
    for _ in range(2):  # the second run replaces the same months
        ingest_months(X.table(spark, sf, "orders"), dst, *WINDOW, ts="o_orderdate", files_per_month=2)
    return monthly(live.read(spark, dst))


@query("c12_ingest_inside_months", """
select cast(date_trunc('month', o_orderdate) as date) as pickup_month, count(*) as n,
  round(sum(case when o_orderdate >= date '1996-05-10' and o_orderdate < date '1996-07-21' then o_totalprice + 1 else o_totalprice end), 2) as total from orders
where o_orderdate >= date '1996-02-01' and o_orderdate < date '1997-07-01' group by 1""")
def c12c(spark, sf):
    # A later load from the middle of one month to the middle of another replaces its own days only.
    dst, orders = scratch_path(spark, "inside"), X.table(spark, sf, "orders")
    ingest_months(orders, dst, *WINDOW, ts="o_orderdate")
    ingest_months(orders.withColumn("o_totalprice", F.col("o_totalprice") + 1), dst, "1996-05-10", "1996-07-20", ts="o_orderdate")
    return monthly(live.read(spark, dst))


@query("c12_replace_window", """
select cast(date_trunc('month', o_orderdate) as date) as pickup_month, count(*) as n, round(sum(o_totalprice), 2) as total from orders
where o_orderdate >= date '1996-02-01' and o_orderdate < date '1997-07-01' and (o_orderdate < date '1996-04-11' or o_orderdate >= date '1996-07-01' or
  (o_orderdate >= date '1996-06-01' and o_orderkey % 2 = 0)) group by 1""")
def c12d(spark, sf):
    # A second load whose window ends a month early, and has no row at all in another, takes those days out.
    dst, orders = scratch_path(spark, "window"), X.table(spark, sf, "orders")
    ingest_months(orders, dst, *WINDOW, ts="o_orderdate")
    again = orders.where((F.month("o_orderdate") == 6) & (F.col("o_orderkey") % 2 == 0))
    ingest_months(again, dst, "1996-04-11", "1996-06-30", ts="o_orderdate")
    return monthly(live.read(spark, dst))


@query("c12_versions", """
select v.version, v.n_rows + 0 as n_rows from (
  select 1::bigint as version, count(*) as n_rows from orders where o_orderdate >= date '1996-02-01' and o_orderdate < date '1997-07-01'
  union all select 2::bigint, count(*) from orders where o_orderdate >= date '1996-06-01' and o_orderdate < date '1997-07-01') v""")
def c12e(spark, sf):
    # Each commit stays readable; a load that never commits is not seen.
    dst, orders = scratch_path(spark, "versions"), X.table(spark, sf, "orders")
    ingest_months(orders, dst, *WINDOW, ts="o_orderdate")
    ingest_months(orders.limit(0), dst, "1996-02-01", "1996-05-31", ts="o_orderdate")
    live.write_load(orders.select("o_orderkey", F.trunc("o_orderdate", "month").alias("pickup_month")), dst)
    counts = [live.read(spark, dst, v).agg(F.lit(v).cast("long").alias("version"), F.count(F.lit(1)).alias("n_rows")) for v in (1, 2)]
    return counts[0].unionByName(counts[1])


@query("prep_sample", "select count(*) as n_rows, 22::int as n_columns from guarded", "guarded")
def prep_sample(spark, sf):
    sample = prepared(X.fact(spark, sf))
    return sample.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(sample.columns)).alias("n_columns"))

"""Checked queries for aggregates, quantiles, histograms and windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import trip_columns as C
from ..operators import aggregates as G, windows as H
from ..operators.filters import derive_and_guard
from ..operators.quantiles import running_total, value_histogram
from ..operators.staging import dedup_keep_first
from ..plans import fixtures as X
from ..plans.reports import dashboard
from ..session import pin, scratch_path
from ..sources import live
from .columns import located, timed
from .core import query
from .helpers import rounded

TIMED = """with t as (select *, date_diff('second', pickup_datetime, dropoff_datetime) / 60.0 as trip_duration_min,
  cast(hour(pickup_datetime) as int) as pickup_hour, cast(dayofweek(pickup_datetime) + 1 as int) as pickup_dow from trips)\n"""


def clocked(spark, sf):
    return timed(spark, sf).withColumns({"pickup_hour": F.hour("pickup_datetime"), "pickup_dow": F.dayofweek("pickup_datetime")})


def guarded(spark, sf):
    return derive_and_guard(X.fact(spark, sf))


@query("g01_count_by", "select service_type, store_and_fwd_flag, count(*) as n from trips group by 1, 2", "trips")
def g01(spark, sf):
    return G.count_by(X.trips(spark, sf), "service_type", "store_and_fwd_flag")


@query("g02_duration_summary", TIMED + """
select pickup_dow, round(avg(trip_duration_min), 4) as mean, round(quantile_disc(trip_duration_min, 0.5), 4) as median from t group by 1""", "trips")
def g02(spark, sf):
    return rounded(G.duration_summary(clocked(spark, sf), "pickup_dow"))


@query("g03_median_by_hour", TIMED + """
select pickup_hour, vendorid, round(quantile_disc(trip_duration_min, 0.5), 4) as median from t group by 1, 2""", "trips")
def g03(spark, sf):
    return rounded(G.median_by_hour(clocked(spark, sf)))


@query("g04_sketched_caps_in_band", """
select service_type, true as fare_in_band, true as distance_in_band from guarded group by 1""", "guarded")
def g04(spark, sf):
    # A sketch has no exact answer; it must fall between p98.9 and p99.1.
    rows = guarded(spark, sf)
    caps = pin(G.compute_caps(rows))
    observed = caps.where(F.col("service_type") != G.ALL).select(
        F.col("service_type").alias("grp"),
        F.explode(F.array(
            F.struct(F.lit("fare").alias("metric"), F.col("fare_p99").alias("cap")),
            F.struct(F.lit("distance").alias("metric"), F.col("distance_p99").alias("cap")),
        )).alias("o"),
    ).select("grp", "o.metric", "o.cap")
    band = G.cap_band(rows, observed).withColumn("inside", F.col("cap").between(F.col("p989"), F.col("p991")))
    return band.groupBy(F.col("grp").alias("service_type")).agg(
        F.bool_and(F.when(F.col("metric") == "fare", F.col("inside"))).alias("fare_in_band"),
        F.bool_and(F.when(F.col("metric") == "distance", F.col("inside"))).alias("distance_in_band"),
    )


@query("g04_compute_caps")
def g04b(spark, sf):
    return G.compute_caps(guarded(spark, sf))


@query("g04_month_sketches", """
select service_type, count(*) as kept_rows, true as fare_in_band, true as distance_in_band from guarded
where pickup_datetime >= timestamp '1994-03-01' and pickup_datetime < timestamp '1997-09-01' group by 1""", "guarded")
def g04c(spark, sf):
    # Sketches of two loads, the second of which replaces some months of the first, answer for a window without its trips.
    rows, path = guarded(spark, sf), scratch_path(spark, "sketches")
    months = [date(y, m, 1) for y in range(1992, 1999) for m in range(1, 13)]
    for part in (months[:40], months[36:]):
        own = rows.where(F.to_date("pickup_datetime").between(F.lit(part[0]), F.last_day(F.lit(part[-1]))))
        live.replace_months(spark, path, G.cap_sketches(own), part)
    wanted = live.read(spark, path).where(F.col("pickup_month").between(F.lit(date(1994, 3, 1)), F.lit(date(1997, 8, 1))))
    caps = pin(G.caps_from_sketches(wanted)).where(F.col("service_type") != G.ALL)
    trips = rows.where("pickup_datetime >= '1994-03-01' and pickup_datetime < '1997-09-01'").select("service_type", "fare_amount", "trip_distance")
    ranks = trips.join(caps, "service_type").groupBy("service_type", "kept_rows").agg(*[
        (((F.count_if(F.col(c) < F.col(f"{m}_p99")) / F.count(F.lit(1))) <= 0.991) & ((F.count_if(F.col(c) <= F.col(f"{m}_p99")) / F.count(F.lit(1))) >= 0.989)).alias(f"{m}_in_band")
        for m, c in (("fare", "fare_amount"), ("distance", "trip_distance"))])
    return ranks


LONG_SQL = """with l as (
  select 'fare' as metric, service_type as grp, fare_amount as v from guarded union all
  select 'distance', service_type, trip_distance from guarded union all
  select 'duration', service_type, trip_duration_min from guarded union all
  select 'duration', 'All', trip_duration_min from guarded)\n"""


@query("g05_exact_caps", LONG_SQL + """
select metric, grp, round(quantile_disc(v, 0.99), 4) as p99, count(*) as guarded_rows from l group by 1, 2""", "guarded")
def g05(spark, sf):
    return rounded(G.exact_caps(guarded(spark, sf)))


@query("g06_cap_band", LONG_SQL + """
select metric, grp, count(*) as guarded_rows, count(distinct v) as distinct_values, round(quantile_disc(v, 0.989), 4) as p989,
  round(quantile_disc(v, 0.99), 4) as p99, round(quantile_disc(v, 0.991), 4) as p991, 40.0::double as cap,
  round(count(*) filter (v <= 40) / count(*), 6) as cdf_at_cap from l group by 1, 2""", "guarded")
def g06(spark, sf):
    rows = guarded(spark, sf)
    observed = rows.select(F.explode(F.array(F.lit("fare"), F.lit("distance"), F.lit("duration"))).alias("metric"), F.col("service_type").alias("grp"))
    overall = observed.where(F.col("metric") == "duration").withColumn("grp", F.lit("All"))
    observed = observed.unionByName(overall).distinct().withColumn("cap", F.lit(40.0))
    return rounded(G.cap_band(rows, observed), 6).withColumns({c: F.round(c, 4) for c in ("p989", "p99", "p991")})


@query("g07_apply_caps", """
select tripid, round(least(fare_amount, case when service_type = 'Yellow' then 100.0 else fare_amount end), 4) as fare_capped,
  round(least(trip_distance, case when service_type = 'Yellow' then 30.0 else trip_distance end), 4) as distance_capped,
  round(least(trip_duration_min, 60.0), 4) as trip_duration_min from guarded""", "guarded")
def g07(spark, sf):
    rows = guarded(spark, sf)
    known = rows.agg(F.max("service_type").alias("service_type")).select(
        "service_type", F.lit(100.0).alias("fare_p99"), F.lit(30.0).alias("distance_p99"), F.lit(None).cast("double").alias("duration_p99")
    )
    overall = known.select(F.lit("All").alias("service_type"), F.lit(None).cast("double").alias("fare_p99"), F.lit(None).cast("double").alias("distance_p99"), F.lit(60.0).alias("duration_p99"))
    capped = G.apply_caps(rows, known.unionByName(overall))
    return rounded(capped.select("tripid", "fare_capped", "distance_capped", "trip_duration_min"))


@query("g08_null_profile", """
select 'passenger_count' as column_name, count(*) filter (passenger_count is null) as null_count, count(*) as total_rows,
  round(count(*) filter (passenger_count is null) * 100.0 / count(*), 4) as null_pct from fact
union all select 'highTemp', count(*) filter (highTemp is null), count(*), round(count(*) filter (highTemp is null) * 100.0 / count(*), 4) from fact
union all select 'tripid', count(*) filter (tripid is null), count(*), round(count(*) filter (tripid is null) * 100.0 / count(*), 4) from fact""", "fact")
def g08(spark, sf):
    return rounded(G.null_profile(X.fact(spark, sf), ["passenger_count", "highTemp", "tripid"]))


@query("g09_describe_cols", """
select 'fare_amount' as column_name, count(fare_amount) as count, round(avg(fare_amount), 4) as mean, round(stddev_samp(fare_amount), 4) as stddev,
  round(min(fare_amount), 4) as min, round(max(fare_amount), 4) as max from trips
union all select 'passenger_count', count(passenger_count), round(avg(passenger_count), 4), round(stddev_samp(passenger_count), 4), min(passenger_count)::double, max(passenger_count)::double from trips""", "trips")
def g09(spark, sf):
    return rounded(G.describe_cols(X.trips(spark, sf), ["fare_amount", "passenger_count"]))


@query("g10_distinct_months", "select distinct strftime(pickup_datetime, '%Y-%m') as year_month from trips", "trips")
def g10(spark, sf):
    return G.distinct_months(X.trips(spark, sf).select(C.year_month("pickup_datetime").alias("year_month")))


@query("g11_key_audit", """
with k as (select service_type, vendorid || '|' || cast(pickup_datetime as varchar) as id from trips)
select count(*) as n_rows, count(distinct id) as n_distinct_id, count(distinct service_type || '|' || id) as n_distinct_service_id from k""", "trips")
def g11(spark, sf):
    return G.key_audit(X.trips(spark, sf).withColumn("id", F.concat_ws("|", "vendorid", "pickup_datetime")), "id")


@query("g12_conditional_counts", """
select service_type, count(*) filter (fare_amount < 0) as negative_fares, count(*) filter (trip_distance = 0) as zero_distances,
  count(*) filter (passenger_count is null) as no_passengers from trips group by 1""", "trips")
def g12(spark, sf):
    conditions = {
        "negative_fares": F.col("fare_amount") < 0,
        "zero_distances": F.col("trip_distance") == 0,
        "no_passengers": F.col("passenger_count").isNull(),
    }
    return G.conditional_counts(X.trips(spark, sf), conditions, ["service_type"])


@query("g13_count_matrix", TIMED + """
select 'hour x month' as cube, pickup_hour as a, cast(month(pickup_datetime) as int) as b, count(*) as n from t group by 1, 2, 3
union all select 'hour x vendor', pickup_hour, vendorid, count(*) from t group by 1, 2, 3
union all select 'weekday x vendor', pickup_dow, vendorid, count(*) from t group by 1, 2, 3""", "trips")
def g13(spark, sf):
    t = clocked(spark, sf).withColumn("pickup_month", F.month("pickup_datetime"))
    pairs = {"hour x month": ("pickup_hour", "pickup_month"), "hour x vendor": ("pickup_hour", "vendorid"), "weekday x vendor": ("pickup_dow", "vendorid")}
    out = None
    for name, (a, b) in pairs.items():
        part = G.count_matrix(t, a, b).select(F.lit(name).alias("cube"), F.col(a).alias("a"), F.col(b).alias("b"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("g15_feature_correlations", TIMED + """
select 'trip_distance' as feature, round(corr(trip_distance, fare_amount), 6) as r, round(abs(corr(trip_distance, fare_amount)), 6) as abs_r from t
union all select 'trip_duration_min', round(corr(trip_duration_min, fare_amount), 6), round(abs(corr(trip_duration_min, fare_amount)), 6) from t
union all select 'ratecodeid', round(corr(ratecodeid, fare_amount), 6), round(abs(corr(ratecodeid, fare_amount)), 6) from t
union all select 'passenger_count', round(corr(passenger_count, fare_amount), 6), round(abs(corr(passenger_count, fare_amount)), 6) from t
union all select 'pickup_hour', round(corr(pickup_hour, fare_amount), 6), round(abs(corr(pickup_hour, fare_amount)), 6) from t""", "trips")
def g15(spark, sf):
    cols = ["trip_distance", "trip_duration_min", "ratecodeid", "passenger_count", "pickup_hour"]
    return rounded(G.feature_correlations(clocked(spark, sf), cols, "fare_amount"), 6)


CORR = ("trip_distance", "fare_amount", "tip_amount")


def corr_sql(table: str) -> str:
    return " union all ".join(
        f"select '{a}' as row, '{b}' as col, round(corr(\"{a}\", \"{b}\"), 6) as r from {table}" for a in CORR for b in CORR
    )


@query("g16_correlation_matrix", corr_sql("trips"), "trips")
def g16(spark, sf):
    return rounded(G.correlation_matrix(X.trips(spark, sf), CORR), 6)


RANKS = ", ".join(f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0 as {c}" for c in CORR)


@query("g16_rank_correlation_matrix", f"with ranked as (select {RANKS} from trips)\n" + corr_sql("ranked"), "trips")
def g16b(spark, sf):
    return rounded(G.correlation_matrix(X.trips(spark, sf), CORR, "spearman"), 6)


@query("g17_histogram", """
with m as (select min(trip_distance) as lo, max(trip_distance) as hi from trips)
select cast(least(floor((trip_distance - lo) * 30.0 / (hi - lo)), 29) as int) as bin, count(*) as n,
  round(min(lo + (hi - lo) * least(floor((trip_distance - lo) * 30.0 / (hi - lo)), 29) / 30.0), 4) as bin_left,
  round(min(lo + (hi - lo) * (least(floor((trip_distance - lo) * 30.0 / (hi - lo)), 29) + 1) / 30.0), 4) as bin_right from trips, m group by 1""", "trips")
def g17(spark, sf):
    return rounded(G.histogram(X.trips(spark, sf), "trip_distance", 30))


@query("g17_log_histogram", TIMED + """
, v as (select log10(trip_duration_min) as v from t where trip_duration_min > 0), m as (select min(v) as lo, max(v) as hi from v),
b as (select least(floor((v - lo) * 50.0 / (hi - lo)), 49) as k, lo, hi from v, m)
select cast(k as int) as bin, count(*) as n, round(min(pow(10, lo + (hi - lo) * k / 50.0)), 4) as bin_left,
  round(min(pow(10, lo + (hi - lo) * (k + 1) / 50.0)), 4) as bin_right from b group by 1""", "trips")
def g17b(spark, sf):
    return rounded(G.histogram(timed(spark, sf), "trip_duration_min", 50, log=True))


@query("g18_histogram2d", """
with d as (select tripid, date_diff('second', pickup_datetime, dropoff_datetime) / 60.0 as m, 
  2 * 6371000 * asin(sqrt(least(1.0, pow(sin(radians(z.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(z.lat)) * pow(sin(radians(z.lon - p.lon) / 2), 2)))) as dist
  from trips left join zones p on pickup_locationid = p.locationid left join zones z on dropoff_locationid = z.locationid),
v as (select log10(dist) as x, log10(m) as y from d where dist > 0 and m > 0),
e as (select min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from v)
select cast(least(floor((x - x0) * 40.0 / (x1 - x0)), 39) as int) as x_bin, cast(least(floor((y - y0) * 25.0 / (y1 - y0)), 24) as int) as y_bin, count(*) as n
from v, e group by 1, 2""", "trips zones")
def g18(spark, sf):
    # Rounding puts values that differ in their last bit into one bin everywhere.
    return G.histogram2d(located(spark, sf), "direct_dist_m", "trip_duration_min", 40, 25)


@query("g18_hexbins", """
with d as (select date_diff('second', pickup_datetime, dropoff_datetime) / 60.0 as m, trip_distance as dist from trips),
v as (select log10(cast(dist as double)) as x, log10(cast(m as double)) as y from d where dist > 0 and m > 0),
e as (select min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from v),
s as (select (x - x0) / ((x1 - x0) / 40) as u, (y - y0) / ((y1 - y0) / 23) as v from v, e),
c as (select *, floor(u + 0.5) as a, floor(v + 0.5) as b from s),
n as (select *, (u - a) * (u - a) + 3 * (v - b) * (v - b) <= (u - floor(u) - 0.5) * (u - floor(u) - 0.5) + 3 * (v - floor(v) - 0.5) * (v - floor(v) - 0.5) as near from c),
h as (select case when near then 0 else 1 end as grid, cast(case when near then a else floor(u) end as int) as "column", cast(case when near then b else floor(v) end as int) as "row", count(*) as n from n group by 1, 2, 3)
select grid, "column", "row", round(x0 + (x1 - x0) / 40 * ("column" + grid * 0.5), 6) as x_centre, round(y0 + (y1 - y0) / 23 * ("row" + grid * 0.5), 6) as y_centre, n from h, e""", "trips")
def g18b(spark, sf):
    return rounded(G.hexbins(timed(spark, sf), "trip_distance", "trip_duration_min", 40), 6)


@query("g19_percentile_markers", TIMED + """
select round(quantile_cont(trip_duration_min, 0.5), 4) as p50, round(quantile_cont(trip_duration_min, 0.75), 4) as p75,
  round(quantile_cont(trip_duration_min, 0.95), 4) as p95 from t""", "trips")
def g19(spark, sf):
    return rounded(G.percentile_markers(timed(spark, sf), "trip_duration_min"))


@query("g20_box_stats", TIMED + """
, q as (select pickup_hour, quantile_cont(trip_duration_min, 0.25) as q1, quantile_cont(trip_duration_min, 0.5) as median, quantile_cont(trip_duration_min, 0.75) as q3 from t group by 1)
select pickup_hour, round(q1, 4) as q1, round(median, 4) as median, round(q3, 4) as q3,
  round(min(trip_duration_min) filter (trip_duration_min >= q1 - 1.5 * (q3 - q1)), 4) as whisker_low,
  round(max(trip_duration_min) filter (trip_duration_min <= q3 + 1.5 * (q3 - q1)), 4) as whisker_high,
  count(*) filter (trip_duration_min < q1 - 1.5 * (q3 - q1) or trip_duration_min > q3 + 1.5 * (q3 - q1)) as outliers
from t join q using (pickup_hour) group by 1, 2, 3, 4, q1, q3""", "trips")
def g20(spark, sf):
    return rounded(G.box_stats(clocked(spark, sf), "pickup_hour", "trip_duration_min"))


@query("g21_trend_line", """
select service_type, round(regr_slope(fare_amount, trip_distance), 6) as slope, round(regr_intercept(fare_amount, trip_distance), 6) as intercept, count(*) as n
from trips group by 1""", "trips")
def g21(spark, sf):
    return rounded(G.trend_line(X.trips(spark, sf), "trip_distance", "fare_amount", ["service_type"]), 6)


@query("g22_share", """
select service_type, round(sum(fare_amount) filter (ratecodeid in (2, 3)) / sum(fare_amount), 6) as share from trips group by 1""", "trips")
def g22(spark, sf):
    return rounded(G.share(X.trips(spark, sf), F.col("ratecodeid").isin(2, 3), F.col("fare_amount"), ["service_type"]), 6)


@query("g23_table_checksum", """
select count(*) as n_rows, cast(sum(('0x' || substr(md5(concat_ws('|', cast(dropoff_locationid as varchar), coalesce(cast(passenger_count as varchar), ''),
  cast(pickup_datetime as varchar), tripid)), 1, 8))::bigint) as decimal(38,0)) as checksum from trips""", "trips")
def g23(spark, sf):
    return G.table_checksum(X.trips(spark, sf).select("tripid", "pickup_datetime", "dropoff_locationid", "passenger_count"), "md5")


@query("g23_table_checksum_hashed")
def g23b(spark, sf):
    return G.table_checksum(X.trips(spark, sf))


# --- H: windows ------------------------------------------------------------------


@query("h01_sequence_trips", """
select tripid, row_number() over (order by pickup_datetime, tripid) as seq,
  row_number() over (partition by cast(pickup_datetime as date) order by pickup_datetime, tripid) as seq_in_day from trips""", "trips")
def h01(spark, sf):
    return H.sequence_trips(X.trips(spark, sf).select("tripid", "pickup_datetime")).select("tripid", "seq", "seq_in_day")


@query("h02_zone_rank", """
select pickup_borough, pickup_zone, count(*) as trips, cast(rank() over (partition by pickup_borough order by count(*) desc) as int) as zone_rank from fact group by 1, 2""", "fact")
def h02(spark, sf):
    return H.zone_rank(X.fact(spark, sf))


@query("h03_route_deltas", """
select pickup_zone, dropoff_zone, pickup_date, count(*) as trips, lag(count(*)) over w as previous_trips, lead(count(*)) over w as next_trips,
  count(*) - lag(count(*)) over w as delta from fact group by 1, 2, 3 window w as (partition by pickup_zone, dropoff_zone order by pickup_date)""", "fact")
def h03(spark, sf):
    return H.route_deltas(X.fact(spark, sf))


RUNNING_SQL = """
select service_type, v, n, cast(sum(n) over (partition by service_type order by v) as bigint) as cum_n, cast(sum(n) over (partition by service_type) as bigint) as tot
from (select service_type, round(fare_amount, 4) as v, count(*) as n from trips group by 1, 2)"""


@query("h04_running_total", f"select service_type, v, n, cum_n from ({RUNNING_SQL})", "trips")
def h04(spark, sf):
    fares = X.trips(spark, sf).select("service_type", F.round("fare_amount", 4).alias("v"))
    return running_total(value_histogram(fares, ["service_type"], "v"), ["service_type"], "v").drop("tot")


@query("h05_partition_total", f"select service_type, v, n, tot from ({RUNNING_SQL})", "trips")
def h05(spark, sf):
    fares = X.trips(spark, sf).select("service_type", F.round("fare_amount", 4).alias("v"))
    return running_total(value_histogram(fares, ["service_type"], "v"), ["service_type"], "v").drop("cum_n")


@query("h06_keep_first", """
select tripid, pickup_locationid, pickup_date, pickup_datetime from (
  select *, row_number() over (partition by pickup_locationid, pickup_date order by pickup_datetime, tripid) as rn from trips) where rn = 1""", "trips")
def h06(spark, sf):
    t = X.trips(spark, sf).select("tripid", "pickup_locationid", "pickup_date", "pickup_datetime")
    return dedup_keep_first(t, ["pickup_locationid", "pickup_date"], ["pickup_datetime", "tripid"])


@query("h07_vs_baseline", """
with w as (select weather, count(*) as trips from dash group by 1)
select weather, trips, round(trips / (select trips from w where weather = 'Clear'), 6) as ratio from w""", "dash")
def h07(spark, sf):
    counts = dashboard(X.fact(spark, sf)).groupBy("weather").agg(F.count(F.lit(1)).alias("trips"))
    return rounded(H.vs_baseline(counts, "weather", "Clear", "trips", "ratio"), 6)

"""Checked queries for top rows, samples, unions, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import trip_columns as C
from ..operators import sampling as I, splits as J
from ..operators.filters import derive_and_guard
from ..operators.sampling import md5_bucket
from ..plans import fixtures as X
from ..plans.reports import dashboard
from ..session import pin
from .columns import timed
from .core import query
from .helpers import rounded

BUCKET_SQL = "('0x' || substr(md5({key}), 1, 8))::bigint % {k}"


@query("i01_top_by", """
select tripid, round(date_diff('second', pickup_datetime, dropoff_datetime) / 60.0, 4) as trip_duration_min from trips
order by date_diff('second', pickup_datetime, dropoff_datetime) desc, tripid limit 25""", "trips")
def i01(spark, sf):
    return rounded(I.top_by(timed(spark, sf).select("tripid", "trip_duration_min"), "trip_duration_min", 25, ["tripid"]))


@query("i02_top_zones", """
select pickup_zone, pickup_borough, count(*) as trips, round(avg(fare_capped), 4) as avg_fare from dash group by 1, 2 order by 3 desc, 1, 2 limit 10""", "dash")
def i02(spark, sf):
    return rounded(I.top_zones(dashboard(X.fact(spark, sf))))


@query("i03_sample_fraction_size", "select count(*) as n_rows, true as size_plausible, true as all_known from trips", "trips")
def i03(spark, sf):
    # The draw itself is random; its size must lie within six deviations.
    t = X.trips(spark, sf).select("tripid", "service_type")
    n = t.agg(F.count(F.lit(1)).alias("n_rows"))
    drawn = I.sample_fraction(t, 0.1, 7).agg(F.count(F.lit(1)).alias("k"), F.bool_and(F.col("service_type").isin("Yellow", "Green")).alias("all_known"))
    k = drawn.select("k").scalar()
    return n.select(
        "n_rows", (F.abs(k - F.col("n_rows") * 0.1) <= 6 * F.sqrt(F.col("n_rows") * 0.09)).alias("size_plausible"),
        drawn.select("all_known").scalar().alias("all_known"),
    )


@query("i03_sample_fraction")
def i03b(spark, sf):
    return I.sample_fraction(X.trips(spark, sf).select("tripid", "service_type"), 0.1, 7)


@query("i04_sample_n", "select tripid, service_type from trips order by md5(tripid), tripid limit 500", "trips")
def i04(spark, sf):
    return I.sample_n(X.trips(spark, sf).select("tripid", "service_type"), 500, key="tripid")


@query("i04_sample_n_random")
def i04b(spark, sf):
    return I.sample_n(X.trips(spark, sf).select("tripid", "service_type"), 500, seed=1234)


@query("i05_stratified_sample_shares", """
select service_type, temp_band, count(*) as n_rows, true as share_plausible from guarded group by 1, 2""", "guarded")
def i05(spark, sf):
    rows = derive_and_guard(X.fact(spark, sf)).select("tripid", "service_type", "temp_band")
    keys = ["service_type", "temp_band"]
    drawn = I.stratified_sample(rows, 0.2, 42).groupBy(*keys).agg(F.count(F.lit(1)).alias("k"))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).join(drawn, keys, "left")
    gap = F.abs(F.coalesce("k", F.lit(0)) - F.col("n_rows") * 0.2)
    return counts.select(*keys, "n_rows", (gap <= 6 * F.sqrt(F.col("n_rows") * 0.16) + 1).alias("share_plausible"))


@query("i05_stratified_sample")
def i05b(spark, sf):
    rows = derive_and_guard(X.fact(spark, sf)).select("tripid", "service_type", "temp_band")
    return I.stratified_sample(rows, {"Yellow|Hot": 0.5, "Yellow|Mild": 0.25, "Green|Hot": 0.5}, 42)


@query("i06_hash_stratified_sample", f"""
select tripid, service_type, temp_band from guarded where {BUCKET_SQL.format(key="'v1' || tripid", k=1048576)} < 104857""", "guarded")
def i06(spark, sf):
    rows = derive_and_guard(X.fact(spark, sf)).select("tripid", "service_type", "temp_band")
    return I.hash_stratified_sample(rows, 0.1, "v1")


@query("i07_nested_sample_is_subset", "select count(*) as n_rows, true as nested, true as smaller from guarded", "guarded")
def i07(spark, sf):
    rows = derive_and_guard(X.fact(spark, sf)).select("tripid", "service_type", "temp_band")
    full, work = I.nested_sample(rows, 0.5, 0.3, 42)
    outside = work.join(full.select("tripid"), "tripid", "left_anti").agg(F.count(F.lit(1)) == 0).scalar()
    n_full, n_work = (d.agg(F.count(F.lit(1))).scalar() for d in (full, work))
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", outside.alias("nested"), (n_work < n_full).alias("smaller"))


@query("i08_limit_rows", "select tripid, pickup_datetime from trips order by tripid limit 100", "trips")
def i08(spark, sf):
    return I.limit_rows(X.trips(spark, sf).select("tripid", "pickup_datetime"), 100, ["tripid"])


# --- J: unions, splits, folds -------------------------------------------------------


@query("j01_union_all", """
select c_nationkey as nationkey, 'customer' as side, c_acctbal as acctbal from customer union all select s_nationkey, 'supplier', s_acctbal from supplier""")
def j01(spark, sf):
    c = X.table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"), F.lit("customer").alias("side"), F.col("c_acctbal").alias("acctbal"))
    s = X.table(spark, sf, "supplier").select(F.lit("supplier").alias("side"), F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nationkey"))
    return J.union_all([c, s])


def dated(spark, sf):
    return C.time_parts(X.trips(spark, sf).select("tripid", "pickup_datetime"))


def labelled(splits):
    return J.union_all([d.select("tripid", F.lit(name).alias("split")) for name, d in splits.items()])


@query("j02_split_chronological", """
select tripid, case when year(pickup_datetime) = 1997 then 'test' when month(pickup_datetime) <= 10 then 'train' else 'validation' end as split
from trips where year(pickup_datetime) in (1996, 1997)""", "trips")
def j02(spark, sf):
    return labelled(J.split_chronological(dated(spark, sf), 1996, 1997))


@query("j03_split_random_parts", "select count(*) as n_rows, true as each_row_once, true as shares_plausible from trips", "trips")
def j03(spark, sf):
    t = dated(spark, sf)
    parts = labelled(J.split_random(t, 0.2, 42))
    test = F.count_if(F.col("split") == "test")
    after = parts.groupBy("tripid").agg(F.count(F.lit(1)).alias("k"), test.alias("test"))
    before = t.groupBy("tripid").agg(F.count(F.lit(1)).alias("n"))
    return before.join(after, "tripid", "full_outer").agg(
        F.sum("n").alias("n_rows"), F.bool_and(F.col("n").eqNullSafe(F.col("k"))).alias("each_row_once"),
        (F.abs(F.sum("test") / F.sum("n") - 0.2) < 0.05).alias("shares_plausible"),
    )


@query("j03_split_random")
def j03b(spark, sf):
    return labelled(J.split_random(dated(spark, sf), 0.2, 42))


@query("j04_split_stratified_month", """
select tripid, case when rn <= round(0.2 * n) then 'test' when rn <= round((0.2 + 0.1) * n) then 'validation' else 'train' end as split from (
  select tripid, row_number() over (partition by year(pickup_datetime), month(pickup_datetime) order by md5(tripid)) as rn,
    count(*) over (partition by year(pickup_datetime), month(pickup_datetime)) as n from trips)""", "trips")
def j04(spark, sf):
    return labelled(J.split_stratified_month(pin(dated(spark, sf)), 0.2))


@query("j05_split_holdout_months", """
select tripid, case month(pickup_datetime) when 12 then 'test' when 11 then 'validation' else 'train' end as split from trips""", "trips")
def j05(spark, sf):
    return labelled(J.split_holdout_months(dated(spark, sf)))


@query("j06_split_counts", """
select case month(pickup_datetime) when 12 then 'test' when 11 then 'validation' else 'train' end as split, cast(year(pickup_datetime) as int) as pickup_year,
  count(*) as n from trips group by 1, 2""", "trips")
def j06(spark, sf):
    return J.split_counts(J.temporal_split(dated(spark, sf), "holdout_months"))


@query("j06_production_splits", """
select case when year(pickup_datetime) = 1997 then 'test' when month(pickup_datetime) <= 10 then 'train' else 'validation' end as split,
  cast(year(pickup_datetime) as int) as pickup_year, count(*) as n from trips where year(pickup_datetime) in (1996, 1997) group by 1, 2""", "trips")
def j06b(spark, sf):
    return J.split_counts(J.production_splits(dated(spark, sf), train_year=1996, test_year=1997))


@query("j07_carve_temporal", "select tripid, pickup_datetime >= timestamp '2000-11-01' as sealed from trips", "trips")
def j07(spark, sf):
    before, sealed = J.carve_temporal(X.trips(spark, sf), "2000-11-01")
    return J.union_all([before.select("tripid", F.lit(False).alias("sealed")), sealed.select("tripid", F.lit(True).alias("sealed"))])


@query("j08_carve_holdout", """
select tripid, case when rn <= round(0.2 * n) then 'holdout' else 'train' end as part from (
  select tripid, row_number() over (partition by service_type, temp_band order by md5(tripid)) as rn,
    count(*) over (partition by service_type, temp_band) as n from guarded)""", "guarded")
def j08(spark, sf):
    # The carve reads its input three times; a written sample is what it is meant for.
    rows = pin(derive_and_guard(X.fact(spark, sf)).select("tripid", "service_type", "temp_band"))
    return J.carve_holdout(rows, key=["tripid"]).select("tripid", "part")


@query("j09_verify_carve", """
with c as (select count(*) as sample, count(*) filter (pickup_datetime >= timestamp '2000-11-01') as temporal,
  count(*) filter (pickup_datetime < timestamp '2000-11-01' and rn <= round(0.2 * n)) as holdout,
  count(*) filter (pickup_datetime < timestamp '2000-11-01' and rn > round(0.2 * n)) as train from (
    select pickup_datetime, row_number() over (partition by pickup_datetime >= timestamp '2000-11-01', service_type order by md5(tripid)) as rn,
      count(*) over (partition by pickup_datetime >= timestamp '2000-11-01', service_type) as n from trips))
select *, round(temporal / sample, 6) as temporal_share, round(holdout / (sample - temporal), 6) as holdout_share, round(train / sample, 6) as train_share,
  abs(holdout / (sample - temporal) - 0.2) <= 0.03 as shares_match from c""", "trips")
def j09(spark, sf):
    trips = pin(X.trips(spark, sf).select("tripid", "pickup_datetime", "service_type"))
    before, sealed = J.carve_temporal(trips, "2000-11-01")
    parts = J.carve_holdout(before, key=["tripid"]).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    marked = parts.unionByName(sealed.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("temporal")))
    counts = marked.agg(*[F.sum(F.when(F.col("part") == p, F.col("n")).otherwise(0)).alias(p) for p in ("temporal", "holdout", "train")])
    counts = counts.withColumn("sample", trips.agg(F.count(F.lit(1))).scalar())
    return rounded(J.verify_carve_table(counts, holdout_share=0.2), 6)


@query("j10_random_folds_complete", "select count(*) as n_rows, 5::bigint as folds, true as balanced from trips", "trips")
def j10(spark, sf):
    folds = J.random_folds(X.trips(spark, sf).select("tripid"), 5).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    n = F.sum("n")
    return folds.agg(
        n.alias("n_rows"), F.count(F.lit(1)).alias("folds"),
        ((F.max("n") < 0.2 * n + 6 * F.sqrt(0.16 * n)) & (F.min("n") > 0.2 * n - 6 * F.sqrt(0.16 * n))).alias("balanced"),
    )


@query("j10_random_folds")
def j10b(spark, sf):
    return J.random_folds(X.trips(spark, sf).select("tripid"), 5)


@query("j11_hash_folds", f"""
select tripid, cast({BUCKET_SQL.format(key="concat_ws(chr(31), tripid, service_type, cast(pickup_locationid as varchar))", k=5)} as int) as oof_fold from trips""", "trips")
def j11(spark, sf):
    t = X.trips(spark, sf).select("tripid", "service_type", "pickup_locationid", F.col("fare_amount").alias("fare_capped"))
    return J.hash_folds(t, method="md5").select("tripid", "oof_fold")


@query("j11_hash_folds_crc32")
def j11b(spark, sf):
    t = X.trips(spark, sf).select("tripid", "service_type", "pickup_locationid", F.col("fare_amount").alias("fare_capped"))
    return J.hash_folds(t).groupBy("oof_fold").agg(F.count(F.lit(1)).alias("n"))


@query("j12_fold_split", f"""
select tripid, case when {BUCKET_SQL.format(key="tripid", k=5)} = 2 then 'held out' else 'complement' end as side from trips""", "trips")
def j12(spark, sf):
    t = X.trips(spark, sf).select("tripid", md5_bucket(F.col("tripid"), 5).alias("fold"))
    rest, held = J.fold_split(t, 2)
    return J.union_all([rest.select("tripid", F.lit("complement").alias("side")), held.select("tripid", F.lit("held out").alias("side"))])

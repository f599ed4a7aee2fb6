"""Checked queries for the dashboard reports."""

from __future__ import annotations

from ..plans import fixtures as X, reports as L
from .core import query
from .helpers import rounded

BOROUGHS = ["AFRICA", "AMERICA", "ASIA", "EUROPE"]
CARD = "from dash where payment_type = 1"


def dash(spark, sf):
    return L.dashboard(X.fact(spark, sf))


def report(name, sql, build, digits=4):
    """Register a report: its SQL over the dashboard view, and its builder."""
    @query(name, sql, "dash")
    def run(spark, sf):
        return rounded(build(dash(spark, sf)), digits)
    return run


report("l01_kpis", """
select round(sum(fare_capped), 4) as total_revenue, round(avg(fare_capped), 4) as avg_fare, round(avg(revenue_per_mile), 4) as revenue_per_mile,
  round(sum(distance_capped), 4) as total_distance, count(*) as trips from dash""", L.kpis)

report("l02_monthly_revenue", """
select cast(date_trunc('month', pickup_date) as date) as month, round(sum(fare_capped), 4) as revenue, round(avg(revenue_per_mile), 4) as avg_revenue_per_mile
from dash group by 1""", L.monthly_revenue)

report("l03_fare_by_service", "select service_type, round(avg(fare_capped), 4) as avg_fare from dash group by 1", L.fare_by_service)
report("l03_revenue_by_borough", "select pickup_borough, round(sum(fare_capped), 4) as revenue from dash group by 1", L.revenue_by_borough)
report("l03_fare_by_hour", "select pickup_hour, round(avg(fare_capped), 4) as avg_fare from dash group by 1", L.fare_by_hour)

report("l04_peak_cells", """
with c as (select weekday, pickup_hour, substr(weekday, 4, 3) || ' ' || lpad(cast(pickup_hour as varchar), 2, '0') || ':00' as label, count(*) as trips from dash group by 1, 2, 3)
select * from (select 'peak' as kind, * from c order by trips desc, weekday, pickup_hour limit 1)
union all select * from (select 'lowest', * from c order by trips, weekday, pickup_hour limit 1)""", L.peak_cells)

report("l05_heatmap", "select weekday, " + ", ".join(f"count(*) filter (pickup_hour = {h}) as h{h}" for h in range(24)) + " from dash group by 1", L.heatmap)

report("l06_top_zones_per_day", """
select pickup_zone, pickup_borough, count(*) as trips, round(avg(fare_capped), 4) as avg_fare,
  round(count(*) / (select count(distinct pickup_date) from dash), 4) as trips_per_day from dash group by 1, 2 order by 3 desc, 1 limit 10""", L.top_zones_per_day)

report("l07_demand_by_weekday", "select weekday, count(*) as trips from dash group by 1", L.demand_by_weekday)
report("l08_daily_volume", "select pickup_date, service_type, count(*) as trips from dash group by 1, 2", L.daily_volume)

report("l09_demand_by_weather", """
with w as (select weather, count(distinct pickup_date) as days, count(*) / count(distinct pickup_date) as t from dash group by 1)
select weather, days, round(t, 4) as trips_per_day, round(t / (select t from w where weather = 'Clear'), 4) as demand_multiplier from w""", L.demand_by_weather)

report("l10_fare_by_weather", """
with w as (select weather, avg(fare_capped) as f from dash group by 1)
select weather, round(f, 4) as avg_fare, round(f / (select f from w where weather = 'Clear'), 4) as fare_uplift from w""", L.fare_by_weather)

report("l11_speed_by_weather", "select weather, round(avg(avg_mph), 4) as avg_mph from dash group by 1", L.speed_by_weather)

report("l12_fare_by_temperature", """
with p as (select pickup_borough, floor(cast(highTemp as double) / 10) * 10 as temp_bucket, avg(fare_capped) as f from dash where highTemp is not null group by 1, 2)
select pickup_borough, temp_bucket, round(f, 4) as avg_fare, round(regr_slope(f, temp_bucket) over (partition by pickup_borough), 4) as slope,
  round(regr_intercept(f, temp_bucket) over (partition by pickup_borough), 4) as intercept from p""", L.fare_by_temperature)

report("l13_corridor_kpis", """
select round(sum(fare_capped) filter (ratecodeid in (2, 3)) / sum(fare_capped), 4) as airport_share, round(avg(fare_capped) filter (ratecodeid = 2), 4) as avg_airport_fare,
  round(count(*) filter (pickup_borough <> dropoff_borough) / count(*), 4) as cross_share,
  round(count(*) filter (pickup_borough = 'ASIA' and dropoff_borough = 'ASIA') / count(*), 4) as intra_share from dash""", lambda d: L.corridor_kpis(d, "ASIA"))

report("l14_corridors", """
select pickup_zone, dropoff_zone, count(*) as trips, round(avg(fare_capped), 4) as avg_fare from dash group by 1, 2 order by 3 desc, 1, 2 limit 15""", L.corridors)

report("l15_revenue_by_ratecode", """
select ratecodeid, round(sum(fare_capped), 4) as revenue, case ratecodeid when 2 then 'JFK' when 3 then 'Newark' else 'Code ' || ratecodeid end as label
from dash group by 1""", L.revenue_by_ratecode)

report("l16_borough_matrix", "select pickup_borough, " + ", ".join(f"count(*) filter (dropoff_borough = '{b}') as {b}" for b in BOROUGHS) + " from dash group by 1",
       lambda d: L.borough_matrix(d, BOROUGHS))

report("l17_flow_edges", """
with n as (select name, cast(row_number() over (order by name) - 1 as int) as node from (select pickup_borough as name from dash union select dropoff_borough from dash))
select pickup_borough as source, dropoff_borough as target, s.node as source_node, t.node as target_node, count(*) as value
from dash join n s on pickup_borough = s.name join n t on dropoff_borough = t.name group by 1, 2, 3, 4""", L.flow_edges)

report("l18_tip_kpis", f"""
select round(count(*) filter (tip_amount > 0) / count(*), 4) as tip_conversion, round(avg(tip_amount) filter (tip_amount > 0), 4) as avg_tip,
  round(sum(tip_amount) * 100.0 / sum(fare_amount), 4) as tip_pct_of_fare,
  round(count(*) filter (passenger_count between 2 and 6) / count(*) filter (passenger_count between 1 and 6), 4) as multi_passenger_rate {CARD}""", L.tip_kpis)

report("l19_tip_rate_by_hour", f"select pickup_hour, round(count(*) filter (tip_amount > 0) / count(*), 4) as tip_rate, count(*) as trips {CARD} group by 1",
       lambda d: L.tip_rate(d, "pickup_hour"))
report("l19_tip_rate_by_borough", f"select pickup_borough, round(count(*) filter (tip_amount > 0) / count(*), 4) as tip_rate, count(*) as trips {CARD} group by 1",
       lambda d: L.tip_rate(d, "pickup_borough"))

report("l20_tip_distribution", """
select case when tip_amount <= 0 then '$0' when tip_amount < 2 then '$0-2' when tip_amount < 5 then '$2-5' when tip_amount < 10 then '$5-10' else '$10+' end as tip_bucket,
  service_type, count(*) as trips from dash group by 1, 2""", L.tip_distribution)

CANDIDATE_SQL = {
    "trip_distance": "trip_distance", "trip_duration_min": "trip_duration_min", "ratecodeid": "ratecodeid", "temperature": "cast(highTemp as double)",
    "passenger_count": "passenger_count", "pickup_hour": "pickup_hour", "pickup_dow": "dayofweek(pickup_datetime) + 1",
}
report("l21_correlation_ranking", " union all ".join(
    f"select '{n}' as feature, round(corr({e}, fare_capped), 4) as r, round(abs(corr({e}, fare_capped)), 4) as abs_r from dash" for n, e in CANDIDATE_SQL.items()
), L.correlation_ranking)

report("l22_distributions", """
select 'distance' as measure, case when distance_capped < 2 then '0-2' when distance_capped < 4 then '2-4' when distance_capped < 6 then '4-6'
  when distance_capped < 8 then '6-8' when distance_capped < 10 then '8-10' else '10-15' end as bucket, count(*) as trips from dash where distance_capped < 15 group by 1, 2
union all select 'duration', case when trip_duration_min < 10 then '0-10' when trip_duration_min < 20 then '10-20' when trip_duration_min < 30 then '20-30'
  when trip_duration_min < 45 then '30-45' when trip_duration_min < 60 then '45-60' else '60+' end, count(*) from dash group by 1, 2""", L.distributions)

report("l23_fare_components", " union all ".join(
    f"select service_type, '{c}' as component, round(sum({c}), 2) as amount from dash group by 1"
    for c in ("fare_amount", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge")
), L.fare_components, 2)

report("l24_distance_fare_trend", """
select round(regr_slope(fare_capped, distance_capped), 4) as slope, round(regr_intercept(fare_capped, distance_capped), 4) as intercept,
  regr_count(fare_capped, distance_capped)::bigint as n from dash""", L.distance_fare_trend)

report("l25_category_counts", " union all ".join(
    f"select '{c}' as field, cast({c} as varchar) as value, count(*) as trips, round(sqrt(count(*)), 4) as sqrt_trips from dash group by 1, 2"
    for c in ("store_and_fwd_flag", "vendorid", "passenger_count")
), L.category_counts)

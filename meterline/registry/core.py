"""Registration of checked queries and the SQL views their checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}

# Views in dependency order; a check lists the ones it reads.
VIEWS = {
    "trips": """
select md5(concat_ws('-', cast(l_orderkey as varchar), cast(l_partkey as varchar), cast(l_suppkey as varchar), cast(l_linenumber as varchar))) as tripid,
  cast(l_suppkey % 2 + 1 as int) as vendorid,
  case when l_linestatus = 'F' then 'Yellow' else 'Green' end as service_type,
  l_linenumber as ratecodeid, c_nationkey as pickup_locationid, s_nationkey as dropoff_locationid,
  o_orderdate + ((l_orderkey*37 + l_linenumber*11) % 1440) * INTERVAL '1' MINUTE as pickup_datetime,
  o_orderdate + ((l_orderkey*37 + l_linenumber*11) % 1440 + (l_partkey*13 + l_linenumber*7) % 120 - 5) * INTERVAL '1' MINUTE as dropoff_datetime,
  cast(o_orderdate as date) as pickup_date,
  case when l_discount > 0.05 then 'Y' else 'N' end as store_and_fwd_flag,
  case when l_partkey % 11 = 10 then null else cast(l_partkey % 11 as int) end as passenger_count,
  case when l_partkey % 97 = 0 then cast(0 as double) else l_quantity end as trip_distance,
  case when l_orderkey % 211 = 0 then cast(-5 as double) else 2.5 + 2.5*l_quantity - 10*l_discount + (case when l_linenumber in (2,3) then 20 else 0 end) end as fare_amount,
  cast(0.5*(l_linenumber % 2) as double) as extra, cast(0.5 as double) as mta_tax,
  case when l_tax > 0.02 then l_tax*l_quantity else cast(0 as double) end as tip_amount,
  case when l_linenumber in (2,3) then cast(5.5 as double) else cast(0 as double) end as tolls_amount,
  cast(0.3 as double) as improvement_surcharge,
  cast(substr(o_orderpriority,1,1) as int) as payment_type
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey""",
    "zones": """
select n_nationkey as locationid, case when n_regionkey = 4 then 'Unknown' else r_name end as borough, n_name as zone,
  cast(40.5 + n_nationkey*0.02 as double) as lat, cast(-74.2 + ((n_nationkey*7) % 25)*0.03 as double) as lon
from nation join region on n_regionkey = r_regionkey""",
    "climate": """
select d as climate_date,
  case when dayofyear(d) % 50 = 0 then null else cast(10 + (dayofyear(d)*7) % 85 as decimal(38,9)) end as highTemp,
  cast((dayofyear(d)*7) % 85 - 5 as decimal(38,9)) as lowTemp,
  cast(case when dayofyear(d) % 5 = 0 then (dayofyear(d) % 30)/100.0 else 0 end as decimal(38,9)) as precipIntensity,
  cast((dayofyear(d) % 100)/100.0 as decimal(38,9)) as humidity,
  cast((dayofyear(d)*3 % 20) as decimal(38,9)) as windSpeed,
  cast(10 - (dayofyear(d) % 9) as decimal(38,9)) as visibility,
  cast((dayofyear(d)*11 % 100)/100.0 as decimal(38,9)) as cloudCover
from (select distinct cast(o_orderdate as date) as d from orders) x""",
    "fact": """
select t.*, fare_amount + extra + mta_tax + tip_amount + tolls_amount + improvement_surcharge as total_amount,
  case payment_type when 1 then 'Credit card' when 2 then 'Cash' when 3 then 'No charge' when 4 then 'Dispute' when 5 then 'Unknown' end as payment_type_description,
  p.borough as pickup_borough, p.zone as pickup_zone, d.borough as dropoff_borough, d.zone as dropoff_zone, c.*
from trips t
join zones p on t.pickup_locationid = p.locationid and p.borough <> 'Unknown'
join zones d on t.dropoff_locationid = d.locationid and d.borough <> 'Unknown'
left join climate c on t.pickup_date = c.climate_date""",
    "guarded": """
select * from (
  select * replace (case when passenger_count between 1 and 6 then passenger_count else 1 end as passenger_count),
    cast(highTemp as double) as temperature,
    date_diff('second', pickup_datetime, dropoff_datetime) / 60.0 as trip_duration_min,
    cast(hour(pickup_datetime) as int) as pickup_hour, cast(dayofweek(pickup_datetime) + 1 as int) as pickup_dow,
    cast(ratecodeid in (2, 3) as int) as is_airport_trip,
    case when highTemp < 32 then 'Freezing' when highTemp < 50 then 'Cold' when highTemp < 68 then 'Mild' when highTemp < 85 then 'Warm' else 'Hot' end as temp_band
  from fact) where fare_amount >= 0 and trip_distance > 0 and trip_duration_min >= 1""",
    "caps": """
select service_type, quantile_disc(fare_amount, 0.99) as fare_p99, quantile_disc(trip_distance, 0.99) as distance_p99,
  (select quantile_disc(trip_duration_min, 0.99) from guarded) as duration_p99
from guarded group by service_type""",
    "prepared": """
select tripid, pickup_datetime, least(fare_amount, fare_p99) as fare_capped, fare_amount, trip_distance,
  least(trip_distance, distance_p99) as distance_capped, least(trip_duration_min, duration_p99) as trip_duration_min,
  passenger_count, temperature, pickup_hour, pickup_dow, service_type, pickup_borough, dropoff_borough, pickup_zone, dropoff_zone,
  temp_band, is_airport_trip, ratecodeid, humidity, windSpeed, visibility, pickup_zone || '→' || dropoff_zone as od_corridor
from guarded join caps using (service_type)""",
    "dash": """
select *, fare_capped / nullif(distance_capped, 0) as revenue_per_mile,
  case when trip_duration_min > 0 and trip_duration_min <= 180 then distance_capped / (trip_duration_min / 60.0) end as avg_mph
from (
  select *,
    case when fare_amount > (case service_type when 'Yellow' then 52 else 46 end) or fare_amount <= 0 then null else fare_amount end as fare_capped,
    case when trip_distance > (case service_type when 'Yellow' then 18.76 else 14.19 end) or trip_distance <= 0 then null else trip_distance end as distance_capped,
    date_diff('minute', pickup_datetime, dropoff_datetime) as trip_duration_min,
    cast(hour(pickup_datetime) as int) as pickup_hour,
    case dayofweek(pickup_datetime) when 1 then '1. Mon' when 2 then '2. Tue' when 3 then '3. Wed' when 4 then '4. Thu' when 5 then '5. Fri' when 6 then '6. Sat' else '7. Sun' end as weekday,
    case when precipIntensity > 0 and lowTemp <= 32 then 'Snow' when precipIntensity > 0.1 then 'Heavy rain' when precipIntensity > 0 then 'Light rain'
      when visibility <= 2 and cloudCover >= 0.5 then 'Fog' else 'Clear' end as weather
  from fact where trip_distance > 0 and fare_amount >= 0)""",
}
NEEDS = {
    "fact": ["trips", "zones", "climate"],
    "guarded": ["fact"],
    "caps": ["guarded"],
    "prepared": ["guarded", "caps"],
    "dash": ["fact"],
}


def _closure(names: list[str]) -> list[str]:
    seen: set[str] = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        if name not in seen:
            seen.add(name)
            todo += NEEDS.get(name, [])
    return [v for v in VIEWS if v in seen]


def query(name: str, sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    """Register a query and, if it has one, the SQL that must give the same rows.

    ``views`` names the shared views the SQL reads; those they need come along.
    """
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ctes = [f"{v} as ({VIEWS[v]})" for v in _closure(views.split())]
            text = sql.strip()
            if ctes:
                text = "with " + ",\n".join(ctes) + (",\n" + text[5:] if text.lower().startswith("with ") else "\n" + text)
            CHECK_SQL[name] = text
        return fn
    return register

"""Trip, zone and climate tables derived from the order tables used for checks.

One order line becomes one trip; nations stand for zones and regions for
boroughs; every order date has a climate row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.staging import build_fact_trips
from ..session import deal


# Payment code descriptions for the derived trips; only code 1 has a fixed meaning.
PAYMENTS = {1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute", 5: "Unknown"}


# Columns and types of the tables read here, so that no file is opened to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per order line, with NULLs, negatives and zeros among the values."""
    # Dealt by the key of the first join: one small file would otherwise be read, and all that follows run, in one task.
    line, orders = deal(table(spark, sf_dir, "lineitem"), "l_orderkey"), table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    start = "(l_orderkey * 37 + l_linenumber * 11) % 1440"
    end = f"{start} + (l_partkey * 13 + l_linenumber * 7) % 120 - 5"
    return joined.select(
        F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])).alias("tripid"),
        F.expr("cast(l_suppkey % 2 + 1 as int)").alias("vendorid"),
        F.when(F.col("l_linestatus") == "F", "Yellow").otherwise("Green").alias("service_type"),
        F.col("l_linenumber").alias("ratecodeid"),
        F.col("c_nationkey").alias("pickup_locationid"),
        F.col("s_nationkey").alias("dropoff_locationid"),
        F.expr(f"timestampadd(MINUTE, {start}, o_orderdate)").alias("pickup_datetime"),
        F.expr(f"timestampadd(MINUTE, {end}, o_orderdate)").alias("dropoff_datetime"),
        F.to_date("o_orderdate").alias("pickup_date"),
        F.when(F.col("l_discount") > 0.05, "Y").otherwise("N").alias("store_and_fwd_flag"),
        F.expr("case when l_partkey % 11 = 10 then null else cast(l_partkey % 11 as int) end").alias("passenger_count"),
        F.expr("case when l_partkey % 97 = 0 then 0.0D else l_quantity end").alias("trip_distance"),
        F.expr(
            "case when l_orderkey % 211 = 0 then -5.0D else 2.5D + 2.5D * l_quantity - 10D * l_discount"
            " + (case when l_linenumber in (2, 3) then 20 else 0 end) end"
        ).alias("fare_amount"),
        F.expr("cast(0.5 * (l_linenumber % 2) as double)").alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.expr("case when l_tax > 0.02D then l_tax * l_quantity else 0.0D end").alias("tip_amount"),
        F.expr("case when l_linenumber in (2, 3) then 5.5D else 0.0D end").alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        F.expr("cast(substr(o_orderpriority, 1, 1) as int)").alias("payment_type"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 zones with coordinates; five have the borough 'Unknown'."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("locationid"),
        F.when(F.col("n_regionkey") == 4, "Unknown").otherwise(F.col("r_name")).alias("borough"),
        F.col("n_name").alias("zone"),
        F.expr("cast(40.5 + n_nationkey * 0.02 as double)").alias("lat"),
        F.expr("cast(-74.2 + ((n_nationkey * 7) % 25) * 0.03 as double)").alias("lon"),
    )


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order date; some temperatures are NULL."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("climate_date")).distinct()
    doy = days.withColumn("y", F.dayofyear("climate_date"))
    exprs = {
        "highTemp": "case when y % 50 = 0 then null else 10 + (y * 7) % 85 end",
        "lowTemp": "(y * 7) % 85 - 5",
        "precipIntensity": "case when y % 5 = 0 then (y % 30) / 100.0 else 0 end",
        "humidity": "(y % 100) / 100.0",
        "windSpeed": "y * 3 % 20",
        "visibility": "10 - (y % 9)",
        "cloudCover": "(y * 11 % 100) / 100.0",
    }
    return doy.select("climate_date", *[F.expr(f"cast({e} as decimal(38,9))").alias(n) for n, e in exprs.items()])


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips of known zones with zone, climate and payment columns."""
    return build_fact_trips(trips(spark, sf_dir), zones(spark, sf_dir), climate(spark, sf_dir), PAYMENTS)


def raw_trips(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """The trips of one service under raw column names, with copies and gaps.

    Times are text, one vendor in ten passenger classes is missing, and trips of
    rate code 7 occur twice. Green files also carry columns nobody stages.
    """
    t = trips(spark, sf_dir).where(F.col("service_type") == service)
    p = {"Yellow": "tpep", "Green": "lpep"}[service]
    out = t.select(
        F.when(F.col("passenger_count") == 9, None).otherwise(F.col("vendorid")).alias("VendorID"),
        F.col("pickup_datetime").cast("string").alias(f"{p}_pickup_datetime"),
        F.col("dropoff_datetime").cast("string").alias(f"{p}_dropoff_datetime"),
        F.col("ratecodeid").cast("double").alias("RatecodeID"),
        F.col("pickup_locationid").alias("PULocationID"),
        F.col("dropoff_locationid").alias("DOLocationID"),
        "store_and_fwd_flag",
        F.col("passenger_count").cast("double").alias("passenger_count"),
        "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
        F.expr("fare_amount + extra + mta_tax + tip_amount + tolls_amount + improvement_surcharge").alias("total_amount"),
        "payment_type",
    )
    if service == "Green":
        out = out.withColumns({"trip_type": F.lit(1.0), "congestion_surcharge": F.lit(None).cast("double")})
    # One pass over the trips gives the copies too.
    copies = F.when(F.col("RatecodeID") == 7, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return out.withColumn("_copy", F.explode(copies)).drop("_copy")

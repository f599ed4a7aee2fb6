"""Data-quality checks: each returns the violations, or counts of them."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import pin
from .filters import guard
from .joins import orphans, zones_known_flag
from .quantiles import quantiles_from_histogram


def duplicate_keys(df: DataFrame, key: str = "tripid", by: Sequence[str] = ()) -> DataFrame:
    """Key values that occur more than once (per ``by``)."""
    return df.groupBy(*by, key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def unaccepted_values(df: DataFrame, col: str, accepted: Sequence) -> DataFrame:
    """Values outside the accepted list, with their rows; NULL is not judged."""
    return df.where(~F.col(col).isin(*accepted)).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def missing_parents(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Key values of ``fact`` that ``dim`` lacks, with their rows."""
    return orphans(fact, dim, fact_key, dim_key).groupBy(fact_key).agg(F.count(F.lit(1)).alias("n"))


def reconcile(raw: DataFrame, zones: DataFrame) -> DataFrame:
    """Guarded rows per service, by whether both zones are known, and exact p99s.

    ``raw`` has service_type, fare_amount, trip_distance, trip_duration_min and
    the two zone ids. The p99s are over rows whose zones are known.
    """
    flagged = zones_known_flag(guard(raw), zones)
    metrics = {"fare": "fare_amount", "dist": "trip_distance", "dur": "trip_duration_min"}
    # Every row counts once as a row and once in the histogram of each metric, so the trips are read once.
    entries = F.array(F.struct(F.lit("rows").alias("metric"), F.lit(0.0).alias("v")), *[
        F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("v")) for m, c in metrics.items()
    ])
    long = flagged.select("service_type", "zones_known", F.explode(entries).alias("e")).select("service_type", "zones_known", "e.metric", "e.v")
    hist = pin(long.groupBy("service_type", "zones_known", "metric", "v").agg(F.count(F.lit(1)).alias("n")))
    known = F.col("zones_known")
    counts = hist.where("metric = 'rows'").groupBy(F.col("service_type").alias("_service")).agg(
        F.sum("n").alias("guarded"), F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("known"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("unknown"),
    )
    judged = hist.where(known & (F.col("metric") != "rows") & F.col("v").isNotNull()).drop("zones_known")
    p99 = quantiles_from_histogram(judged, ["service_type", "metric"], "v", {"p99": 0.99})
    wide = p99.groupBy("service_type").agg(*[
        F.max(F.when(F.col("metric") == m, F.col("p99"))).alias(f"{m}_p99") for m in metrics
    ])
    return counts.join(wide, F.col("service_type").eqNullSafe(F.col("_service"))).drop("_service")


def climate_fanout(climate: DataFrame) -> DataFrame:
    """Rows and distinct dates of the climate table; equal when no join can fan out."""
    per_day = climate.groupBy("climate_date").agg(F.count(F.lit(1)).alias("n"))
    return per_day.agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("climate_date").isNotNull()).alias("n_dates")
    ).withColumn("one_row_per_date", F.col("n_rows") == F.col("n_dates"))


def subsecond_audit(df: DataFrame) -> DataFrame:
    """Rows whose pickup or dropoff time has a fraction of a second."""
    def fraction(c: str):
        return F.date_part(F.lit("SECOND"), F.col(c)) % 1 != 0
    return df.agg(
        F.count_if(fraction("pickup_datetime")).alias("pickup_subsecond"),
        F.count_if(fraction("dropoff_datetime")).alias("dropoff_subsecond"),
    )


def month_coverage(df: DataFrame, start: str, end: str) -> DataFrame:
    """Per service: trips, revenue, mean fare, months present of those expected."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    monthly = (
        df.where(F.to_date("pickup_datetime").between(lo, hi))
        .groupBy("service_type", F.trunc(F.to_date("pickup_datetime"), "month").alias("_month"))
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("total_amount").alias("_revenue"), F.sum("fare_amount").alias("_fare"),
             F.count("fare_amount").alias("_fares"))
    )
    expected = F.months_between(F.trunc(hi, "month"), F.trunc(lo, "month")).cast("bigint") + 1
    return monthly.groupBy("service_type").agg(
        F.sum("_n").alias("trips"),
        F.sum("_revenue").alias("revenue"),
        F.try_divide(F.sum("_fare"), F.sum("_fares")).alias("avg_fare"),
        F.count(F.lit(1)).alias("months"),
    ).withColumn("complete", F.col("months") == expected)


def leakage_audit(encoded: DataFrame, recomputed: DataFrame, key: str, encoded_col: str, tolerance: float = 1e-9, by: Sequence[str] = ()) -> DataFrame:
    """Rows whose encoding moves when their own target changes.

    ``recomputed`` is the same encoding fitted after every target of the audited
    rows was replaced; without self-leakage no value may differ. The tables are
    matched on a unique row key. With ``by``, one result for each value of those
    columns of ``encoded``.
    """
    a = encoded.select(key, *by, F.col(encoded_col).alias("_a"))
    b = recomputed.select(key, F.col(encoded_col).alias("_b"))
    moved = ~F.coalesce(F.abs(F.col("_a") - F.col("_b")) <= tolerance, F.col("_a").isNull() & F.col("_b").isNull())
    return a.join(b, key).groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(moved).alias("moved"))


def key_ambiguity(df: DataFrame, keys: Sequence[str], pair: Sequence[str] = ("pickup_locationid", "dropoff_locationid")) -> DataFrame:
    """Keys with more than one row, and how many of them disagree on ``pair``."""
    both = F.struct(*pair)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(both).alias("_lo"), F.max(both).alias("_hi"))
    repeated = F.col("_n") > 1
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(repeated).alias("repeated_keys"),
        F.count_if(repeated & ~F.col("_lo").eqNullSafe(F.col("_hi"))).alias("ambiguous_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("_n") - 1)), F.lit(0)).alias("rows_lost_by_keyed_dedup"),
    )


def file_columns(spark: SparkSession, path: str) -> DataFrame:
    """(file, column_name, found_type) of every column in the footers of a set of parquet files.

    Files are rows, and tasks read their footers side by side. Types are those
    that Spark noted in a file it wrote, or else follow from the file's own.
    """
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"))
    out = pa.schema([("file", pa.string()), ("column_name", pa.string()), ("found_type", pa.string())])

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, parquet
        from pyspark.sql.pandas.types import from_arrow_type

        def spark_type(kind: pa.DataType) -> str:
            kind = kind.value_type if pa.types.is_dictionary(kind) else kind
            try:
                return from_arrow_type(kind, prefer_timestamp_ntz=True).simpleString()
            except Exception:  # a type Spark has no name for is told by the file's own
                return str(kind)

        for batch in batches:
            rows = []
            for file in batch.column("file").to_pylist():
                store, name = fs.FileSystem.from_uri(file)
                found = parquet.read_schema(name, filesystem=store)
                noted = (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                columns = [(f.name, f.dataType.simpleString()) for f in StructType.fromJson(json.loads(noted))] if noted else [(f.name, spark_type(f.type)) for f in found]
                # A file without columns still counts as one.
                rows += [(file, *c) for c in columns] or [(file, None, None)]
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, r)) for r in rows], schema=out)

    # One file is a small row that stands for a slow read, so rows alone do not spread the work.
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(tasks, "file").mapInArrow(footers, "file string, column_name string, found_type string")


def schema_drift(spark: SparkSession, paths: Mapping[str, str], contract: StructType) -> DataFrame:
    """Columns of each file set that are missing, new or retyped.

    Only file footers are read, by the tasks; what they find is counted by
    column and type before anything else happens to it.
    """
    have = None
    for name, path in paths.items():
        columns = pin(file_columns(spark, path))
        files = columns.agg(F.count_distinct("file")).scalar()
        found = columns.where("column_name is not null").groupBy("column_name", "found_type").agg(F.count(F.lit(1)).alias("_n"))
        found = found.select(F.lit(name).alias("source"), "column_name", "found_type", (F.col("_n") == files).alias("everywhere"))
        have = found if have is None else have.unionByName(found)
    expected = [(name, f.name, f.dataType.simpleString()) for name in paths for f in contract]
    want = spark.createDataFrame(expected, "source string, column_name string, expected_type string")
    state = (
        F.when(F.col("found_type").isNull(), "missing")
        .when(F.col("expected_type").isNull(), "new")
        .when(F.col("found_type") != F.col("expected_type"), "retyped")
        .when(~F.col("everywhere"), "missing in some files")
    )
    both = want.join(have, ["source", "column_name"], "full_outer")
    return both.withColumn("drift", state).where(F.col("drift").isNotNull()).drop("everywhere")

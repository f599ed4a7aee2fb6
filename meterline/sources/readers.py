"""Readers: parquet folders, catalog tables, CSV seeds, SQL text, literals."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.trip_columns import duration_sec, time_parts

ZONE_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> list[str]:
    """Paths in a folder, sorted. Works on any file system Spark can read.

    Only names are listed; the contents column is never asked for.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return [r["path"] for r in listing.select("path").distinct().orderBy("path").collect()]


def read_trips(spark: SparkSession, folder: str, limit_files: int | None = None, pattern: str = "*.parquet") -> DataFrame:
    """A1: all parquet files of a folder, or the first few by name."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path").distinct()
    files = [r["path"] for r in listing.orderBy("path").limit(1 if limit_files is None else limit_files).collect()]
    if not files:
        raise FileNotFoundError(f"no {pattern} files in {folder}")
    if limit_files is None:
        return spark.read.option("pathGlobFilter", pattern).parquet(folder)
    return spark.read.parquet(*files)


def is_table_name(source: str) -> bool:
    """A2: ``catalog.schema.table``: exactly three non-empty parts, no path, no colon."""
    parts = str(source).strip().split(".")
    return len(parts) == 3 and all(p.strip() for p in parts) and not any(ch in source for ch in "/:")


def read_source(spark: SparkSession, source: str) -> DataFrame:
    """A2: a table by its full name; half-named sources are refused."""
    if not is_table_name(source):
        raise ValueError(f"expected catalog.schema.table, got {source!r}")
    return spark.table(source.strip())


def read_year(spark: SparkSession, table: str | DataFrame, year: int, date: str = "pickup_date") -> DataFrame:
    """A3: one year of a table.

    Written as a date range, which reaches the file scan and prunes partitions.
    """
    df = spark.table(table) if isinstance(table, str) else table
    lo, hi = F.lit(f"{year:04d}-01-01").cast("date"), F.lit(f"{year + 1:04d}-01-01").cast("date")
    return df.where((F.col(date) >= lo) & (F.col(date) < hi))


def run_query(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """A4: SQL text; frames passed by name can be used as ``{name}``."""
    return spark.sql(sql, **views)


def load_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[str] | None = None,
    limit: int | None = None,
    order: Sequence[str] = (),
    fallback: Mapping[str, str] | None = None,
) -> DataFrame:
    """A5: a catalog table, or, when the catalog lacks it, its parquet path.

    With ``order`` a limit returns the same rows every time.
    """
    try:
        df = spark.table(name)
    except AnalysisException:
        if not fallback or name not in fallback:
            raise
        df = spark.read.parquet(fallback[name])
    if order:
        df = df.orderBy(*order)
    if limit is not None:
        df = df.limit(limit)
    return df.select(*columns) if columns else df


def load_trips_for_years(
    df: DataFrame, years: Iterable[int], sample_fraction: float | None = None, seed: int = 42
) -> DataFrame:
    """Valid trips of some years with duration in seconds and time parts.

    Valid: both times present and in order, distance and fare above zero. The
    years also become date ranges, so files outside them are not read.
    """
    years = sorted(set(years))
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    first = F.lit(f"{years[0]:04d}-01-01 00:00:00").cast("timestamp_ntz")
    after = F.lit(f"{years[-1] + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    valid = (
        (pickup >= first) & (pickup < after) & F.year(pickup).isin(years)
        & pickup.isNotNull() & dropoff.isNotNull() & (pickup < dropoff)
        & (F.col("trip_distance") > 0) & (F.col("fare_amount") > 0)
    )
    out = df.where(valid)
    if sample_fraction is not None:
        out = out.sample(withReplacement=False, fraction=sample_fraction, seed=seed)
    return time_parts(out.withColumn("trip_duration_seconds", duration_sec(pickup, dropoff)))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup CSV, typed by an explicit schema."""
    raw = spark.read.schema(ZONE_SCHEMA).csv(path, header=True)
    return raw.select(F.col("LocationID").alias("locationid"), F.col("Borough").alias("borough"), F.col("Zone").alias("zone"), "service_zone")


def register_external(spark: SparkSession, name: str, fmt: str, glob: str, schema: str | StructType | None = None) -> DataFrame:
    """A view over a file glob, created or replaced."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", True)
    reader.load(glob).createOrReplaceTempView(name)
    return spark.table(name)


def month_files(spark: SparkSession, root: str, prefix: str, start: str, end: str) -> DataFrame:
    """A10: one path per month from ``start`` to ``end``."""
    months = month_range(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(months).alias("month")).withColumn("path", month_path(root, prefix))


def month_range(start, end):
    """First days of the months from ``start`` to ``end``, as an array."""
    return F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))


def month_path(root: str, prefix: str, month: str = "month"):
    """``root/prefix_yyyy-MM.parquet`` of a month."""
    return F.concat(F.lit(f"{root.rstrip('/')}/{prefix}_"), F.substring(F.col(month).cast("string"), 1, 7), F.lit(".parquet"))


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A small table given in the program."""
    return spark.createDataFrame(list(rows), schema)


def check_source_counts(spark: SparkSession, sources: Mapping[str, str], expected: DataFrame) -> DataFrame:
    """Files and rows per source against what is expected.

    ``sources`` maps a prefix to its path or glob; ``expected`` has columns
    prefix, expected_files, expected_rows. A source without files counts zero.
    """
    parts = []
    for prefix, path in sources.items():
        try:
            rows = spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            parts.append(spark.createDataFrame([(0, 0, prefix)], "files bigint, n_rows bigint, prefix string"))
            continue
        per_file = rows.groupBy(F.input_file_name().alias("_file")).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(per_file.agg(F.count(F.lit(1)).alias("files"), F.sum("_n").alias("n_rows")).withColumn("prefix", F.lit(prefix)))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    out = expected.join(found, "prefix", "full_outer").withColumns({
        "files": F.coalesce("files", F.lit(0)), "n_rows": F.coalesce("n_rows", F.lit(0)),
    })
    same = F.col("files").eqNullSafe(F.col("expected_files")) & F.col("n_rows").eqNullSafe(F.col("expected_rows"))
    return out.withColumn("ok", same)

"""Writers: samples, train splits, statistics, scores, leaderboards, the mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..constants import TARGET
from ..session import pin


def write_sample(df: DataFrame, path: str, parts: int | None = None, rows_per_file: int = 5_000_000) -> None:
    """B1: replace ``path`` with ``parts`` parquet files of even size, or with files of bounded size."""
    rows = df if parts is None else df.repartition(parts)
    writer = rows.write.mode("overwrite")
    (writer if parts is not None else writer.option("maxRecordsPerFile", rows_per_file)).parquet(path)


def by_month(df: DataFrame, spread: Sequence[str], files_per_month: int | None, rows_per_file: int) -> DataFrame:
    """Rows dealt to (pickup_month, bucket), so that no writer gets a whole large month.

    A month has as many buckets as files of ``rows_per_file`` rows need, from a
    count of each month, or ``files_per_month`` if given. Where it counts, the
    rows are computed once and kept.
    """
    if files_per_month is not None:
        buckets, counted = F.lit(files_per_month), df
    else:
        df = pin(df)
        sizes = df.groupBy(F.col("pickup_month").alias("_month")).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
        counted = df.join(sizes, F.col("pickup_month").eqNullSafe(F.col("_month")))
        buckets = F.col("_files")
    dealt = counted.withColumn("_bucket", F.pmod(F.xxhash64(*spread), buckets))
    return dealt.repartition("pickup_month", "_bucket").select(*df.columns)


def z_value(x: str, y: str, bits: int = 16) -> Column:
    """Place of two small numbers on a Z-shaped curve: their bits in turn.

    Pairs near each other on the curve are near in both numbers. A null counts
    as 0, and numbers beyond the bits as the greatest; such pairs are only
    placed less well.
    """
    top = (1 << bits) - 1
    a, b = (F.least(F.greatest(F.coalesce(F.col(c).cast("long"), F.lit(0)), F.lit(0)), F.lit(top)) for c in (x, y))
    out = F.lit(0).cast("long")
    for i in range(bits):
        bit = lambda v: F.shiftright(v, i).bitwiseAND(F.lit(1))
        out = out.bitwiseOR(F.shiftleft(bit(a), 2 * i)).bitwiseOR(F.shiftleft(bit(b), 2 * i + 1))
    return out


def clustered(df: DataFrame, cluster: Sequence[str], ts: str, files_per_month: int | None, rows_per_file: int) -> DataFrame:
    """Rows in ranges of (pickup_month, Z value of two columns), a file's worth each.

    The time is the last key, so a pair that holds very many rows is cut as
    well. A range that ends one month and begins the next becomes two files.
    """
    kept = pin(df.withColumn("_z", z_value(*cluster)))
    if files_per_month is None:
        ranges = F.ceil(F.count(F.lit(1)) / rows_per_file)
    else:
        ranges = F.count_distinct("pickup_month") * files_per_month
    wanted = int(kept.agg(ranges).first()[0]) or 1
    keys = ["pickup_month", "_z", F.xxhash64(ts)]
    return kept.repartitionByRange(wanted, *keys).sortWithinPartitions(*keys).select(*df.columns)


def csv_to_parquet(spark: SparkSession, src: str, dst: str, schema: str | StructType) -> None:
    """B2: a CSV file as parquet; anything but a .csv is an error.

    Malformed rows stop the job. A file with a header only gives a parquet
    dataset without rows.
    """
    if not src.lower().endswith((".csv", ".csv.gz")):
        raise ValueError(f"not a CSV file: {src}")
    rows = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(src)
    rows.write.mode("overwrite").parquet(dst)


def write_train_split(df: DataFrame, path: str, label: str = TARGET, rows_per_file: int = 1_000_000) -> None:
    """Features and label as one dataset of bounded files, label last."""
    if not label:
        raise ValueError("the label needs a name")
    if df.columns.count(label) != 1:
        raise ValueError(f"the label {label!r} must be exactly one column, found {df.columns.count(label)}")
    features = [c for c in df.columns if c != label]
    out = df.select(*features, label)
    out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


class ScoreExists(RuntimeError):
    """The sealed sets were scored before."""


def write_score_once(df: DataFrame, path: str) -> None:
    """Write the one score; a second score is refused."""
    try:
        df.write.mode("errorifexists").json(path)
    except AnalysisException as error:
        raise ScoreExists(f"{path} exists; read it instead of scoring again") from error


def prep_stats(caps: DataFrame, full: DataFrame, work: DataFrame, **run) -> DataFrame:
    """One row of row counts, caps per service and run settings.

    ``caps`` has the shape of ``aggregates.compute_caps``: one row per service,
    and 'All' with the duration cap and the counts of raw and guarded rows.
    Settings (seed, fractions, source) become columns as given.
    """
    overall = F.col("service_type") == "All"
    entry = F.struct("service_type", F.struct("fare_p99", "distance_p99").alias("caps"))
    one = caps.agg(
        F.max(F.when(overall, F.col("all_rows"))).alias("raw_rows"),
        F.max(F.when(overall, F.col("kept_rows"))).alias("guarded_rows"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(~overall, entry)))).alias("per_service"),
        F.max(F.when(overall, F.col("duration_p99"))).alias("duration_p99"),
    )
    return one.select(
        "raw_rows", "guarded_rows",
        *[df.agg(F.count(F.lit(1))).scalar().alias(name) for name, df in (("full_rows", full), ("work_rows", work))],
        "per_service", "duration_p99",
        *[F.lit(v).alias(k) for k, v in run.items()],
    )


def write_stats(stats: DataFrame, path: str) -> None:
    """The statistics row as JSON."""
    stats.write.mode("overwrite").json(path)


def write_leaderboard(rows: DataFrame, path: str, fmt: str = "csv") -> None:
    """The leaderboard (a row per model) as one CSV or JSON file, best first."""
    if fmt not in ("csv", "json"):
        raise ValueError(f"unknown format: {fmt}")
    writer = rows.orderBy("rmse_mean", "model").coalesce(1).write.mode("overwrite")
    writer.csv(path, header=True) if fmt == "csv" else writer.json(path)


def save_fact(
    df: DataFrame,
    path: str | None = None,
    ts: str = "pickup_datetime",
    cluster: Sequence[str] = ("pickup_locationid", "dropoff_locationid"),
    files_per_month: int | None = None,
    rows_per_file: int = 5_000_000,
    table: str | None = None,
) -> None:
    """The mart by month, files clustered by the two zone ids, in a folder, as a table, or as a table over a folder.

    Inside a month, files are ranges of a Z-shaped curve through the two ids
    (``clustered``). A filter on either id, or on a pair, so meets a share of
    the files that falls as a month gets more of them: a quarter of sixteen
    for one id, about one for a pair.
    """
    if path is None and table is None:
        raise ValueError("the mart needs a path or a table name")
    if len(cluster) != 2:
        raise ValueError("the mart is clustered by two columns")
    rows = clustered(df.withColumn("pickup_month", F.trunc(F.to_date(ts), "month")), cluster, ts, files_per_month, rows_per_file)
    writer = rows.write.mode("overwrite").partitionBy("pickup_month")
    if table is None:
        writer.parquet(path)
    else:
        (writer if path is None else writer.option("path", path)).format("parquet").saveAsTable(table)

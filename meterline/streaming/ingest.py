"""Incremental ingest of monthly trip files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..sources import live
from ..sources.writers import by_month


def _window(df: DataFrame, start: str, end: str, ts: str) -> DataFrame:
    """Rows of the backfill window with their month."""
    day = F.to_date(ts)
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    return df.where(day.between(lo, hi)).withColumn("pickup_month", F.trunc(day, "month"))


def ingest_incremental(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    start: str,
    end: str,
    schema: StructType,
    ts: str = "pickup_datetime",
    pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> None:
    """Bring every new file of ``src`` into ``dst`` exactly once, then stop.

    The checkpoint records which files were read and the file sink which batches
    were written, so a run after a failure, or a second run, adds nothing twice.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        _window(reader.parquet(src), start, end, ts)
        .writeStream.format("parquet")
        .option("path", dst)
        .option("checkpointLocation", checkpoint)
        .partitionBy("pickup_month")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_months(
    df: DataFrame, dst: str, start: str, end: str, ts: str = "pickup_datetime", files_per_month: int | None = None, rows_per_file: int = 5_000_000
) -> int:
    """C12 as a batch: replace the days of the window as a whole, leave all others alone, and return the new version.

    Days of the window without new rows end up empty, and a month without any
    row left is no longer live. A window that begins or ends inside a month
    writes that month's other days again, together with the new ones. All
    months are written by one job, with files of bounded size, and take effect
    together with the commit at the end (``sources.live``): a run that stops
    before changes nothing. Read the table with ``live.read``. Rows without a
    time lie in no window. Columns that one side lacks are null there.
    """
    spark = df.sparkSession
    before = live.state(spark, dst)
    rows = _window(df, start, end, ts)
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    first, last = (date.fromisoformat(d).replace(day=1) for d in (start, end))
    inside = [m for m in before.loads if first <= m <= last]
    edges = [m for m in inside if m in (first, last)]
    if edges:
        there = live.rows_of(spark, live.LiveTable(dst, before.version, before.columns, {m: before.loads[m] for m in edges}))
        rows = rows.unionByName(there.where(~F.to_date(ts).between(lo, hi)), allowMissingColumns=True)
    load = live.write_load(by_month(rows, df.columns, files_per_month, rows_per_file), dst)
    loads = {m: old for m, old in before.loads.items() if m not in inside}
    loads |= dict.fromkeys(live.load_months(spark, dst, load), load)
    columns = {f.name: f for schema in (df.schema, before.columns or StructType()) for f in schema}
    columns |= {f.name: f for f in df.schema}
    columns.pop(live.MONTH, None)
    return live.commit(spark, before, StructType(list(columns.values())), loads)

"""Monthly tables whose live files are named by commit records.

    <table>/data/load=<id>/pickup_month=<month>/...   written once, never changed
    <table>/commits/version=<n>/...                   one row for each live month, written last

A load writes its files into a folder of its own. The commit that follows says
which load holds each month from now on; it replaces months as a whole, also
by nothing. A load that stops before its commit leaves the table as it was,
and readers keep what they began to read. A commit lists months, not files, so
it stays small.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

MONTH = "pickup_month"
_COMMIT = f"{MONTH} date, load string, columns string, version long"


class CommitConflict(RuntimeError):
    """Another load has committed since this one looked at the table."""


class LiveTable:
    """The state of a table at one commit: its version, columns, and the load of each live month."""

    def __init__(self, path: str, version: int, columns: StructType | None, loads: dict[date, str]) -> None:
        self.path, self.version, self.columns, self.loads = path, version, columns, loads


def state(spark: SparkSession, path: str, version: int | None = None) -> LiveTable:
    """The table's last commit, or the one asked for; a table without commits has version 0 and no months."""
    try:
        commits = spark.read.schema(_COMMIT).parquet(f"{path}/commits")
        last = version if version is not None else commits.agg(F.max("version")).first()[0]
    except AnalysisException:  # no commit yet
        last = None
    if last is None:
        return LiveTable(path, 0, None, {})
    rows = commits.where(F.col("version") == last).collect()  # one for each month
    if not rows:
        raise ValueError(f"{path} has no commit {last}")
    columns = next(StructType.fromDDL(r["columns"]) for r in rows if r["columns"])
    return LiveTable(path, last, columns, {r[MONTH]: r["load"] for r in rows if r[MONTH] is not None})


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The live rows with their month; filters on the month reach the folders.

    An earlier version can be read as long as nobody deleted its files.
    """
    return rows_of(spark, state(spark, path, version))


def rows_of(spark: SparkSession, table: LiveTable) -> DataFrame:
    """The rows of a table at a commit."""
    if table.columns is None:
        raise ValueError(f"{table.path} holds no commit")
    schema = StructType([*table.columns, StructField(MONTH, DateType())])
    if not table.loads:
        return spark.createDataFrame([], schema)
    data = f"{table.path}/data"
    folders = [f"{data}/load={load}/{MONTH}={month}" for month, load in sorted(table.loads.items())]
    return spark.read.schema(schema).option("basePath", data).parquet(*folders).select(*schema.names)


def write_load(rows: DataFrame, path: str) -> str:
    """Write rows by month into a new load and return its id; nothing reads them before a commit."""
    load = uuid.uuid4().hex
    rows.write.partitionBy(MONTH).parquet(f"{path}/data/load={load}")
    return load


def load_months(spark: SparkSession, path: str, load: str) -> list[date]:
    """The months a load holds."""
    try:
        written = spark.read.schema(f"{MONTH} date").parquet(f"{path}/data/load={load}")
    except AnalysisException:  # no rows at all
        return []
    return [r[MONTH] for r in written.select(MONTH).distinct().collect()]


def commit(spark: SparkSession, before: LiveTable, columns: StructType, loads: dict[date, str]) -> int:
    """Make ``loads`` the live months; refused if the table has moved on since ``before``.

    The record is one file, which appears under its name when it is complete.
    """
    version = before.version + 1
    if state(spark, before.path).version != before.version:
        raise CommitConflict(f"{before.path} is past version {before.version}")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    rows = [(None, None, ddl), *((month, load, None) for month, load in loads.items())]
    record = spark.createDataFrame(rows, f"{MONTH} date, load string, columns string").coalesce(1)
    try:
        record.write.mode("errorifexists").parquet(f"{before.path}/commits/version={version}")
    except AnalysisException as error:
        raise CommitConflict(f"version {version} of {before.path} was committed meanwhile") from error
    return version


def replace_months(spark: SparkSession, path: str, rows: DataFrame, months: Sequence[date]) -> int:
    """Make ``rows``, which carry their month, all there is of ``months``; other months stay as they are."""
    before = state(spark, path)
    load = write_load(rows, path)
    written = load_months(spark, path, load)
    if not set(written) <= set(months):
        raise ValueError(f"rows of months that are not replaced: {sorted(set(written) - set(months))}")
    loads = {m: old for m, old in before.loads.items() if m not in months} | dict.fromkeys(written, load)
    return commit(spark, before, StructType([f for f in rows.schema if f.name != MONTH]), loads)

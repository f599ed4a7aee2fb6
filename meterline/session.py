"""Session for tests and the benchmark; jobs on a cluster bring their own."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROWS_PER_TASK = 500_000  # of a dealt table; sorts and hash tables of a task over so many rows stay in the tens of MB
_scopes: list[list[str]] = []  # paths written by pin, for each open scope


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local Spark session with the settings the checks rely on."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("meterline")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session that
    leaves it unset gets a temporary folder; anywhere else that is an error,
    because executors on other machines could not read it.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="meterline-", dir=os.environ.get("TMPDIR", "/tmp"))
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Compute ``df`` once, as a table in the shared folder, and read that.

    Used where a result feeds several later steps, or must not change on
    recomputation (random draws, positions). It survives lost executors, and
    the planner knows its size from the files. The shuffles behind the table
    are dropped once it is written. With ``by``, rows lie in one folder for
    each value of those columns, and filters on them read only theirs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "pinned")
    for scope in _scopes:
        scope.append(path)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def deal(df: DataFrame, *by: str, rows: int = ROWS_PER_TASK) -> DataFrame:
    """Rows dealt over the shuffle partitions, or over more where those would get more than ``rows`` rows each.

    By a hash of the columns ``by``, or evenly. The count reads file footers
    only, if ``df`` is a written table.
    """
    tasks = -(-df.count() // rows)
    if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(tasks, *by)
    return df.repartition(*by) if by else df


@contextmanager
def collecting() -> Iterator[list[str]]:
    """The paths of the tables that ``pin`` writes inside the block."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes[:] = [s for s in _scopes if s is not made]


def release(spark: SparkSession, paths: Sequence[str], reader: DataFrame | None = None) -> None:
    """Delete pinned tables that nothing needs any more, but for those that ``reader`` still reads."""
    used = [f.split(":", 1)[-1] for f in reader.inputFiles()] if reader is not None and paths else []
    for path in paths:
        folder = path.split(":", 1)[-1].lstrip("/")
        if any(f.lstrip("/").startswith(folder + "/") for f in used):
            continue
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

"""Readers, writers and ingest on temporary folders."""

import pyarrow as pa
import pytest
from pyarrow import parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.operators import quality as N
from meterline.session import pin, scratch_path, shared_dir
from meterline.sources import live, readers as A, writers as B
from meterline.streaming.ingest import ingest_incremental, ingest_months


@pytest.mark.parametrize("name,ok", [
    ("a.b.c", True), (" a.b.c ", True), ("b.c", False), ("a.b.c.d", False), ("a..c", False), ("", False), ("local", False),
    ("a:b.c", False), ("s3://x/a.b.c", False), ("dir/a.b.c", False), ("sample_full.parquet", False),
])
def test_table_names(name, ok):
    assert A.is_table_name(name) is ok


def test_read_source_refuses_half_names(spark):
    with pytest.raises(ValueError, match="catalog.schema.table"):
        A.read_source(spark, "schema.table")


def test_read_trips_sorted_first_files_and_empty(spark):
    folder = scratch_path(spark, "months")
    for month in ("2016-02", "2016-01", "2016-03"):
        spark.range(1).select(F.lit(month).alias("m")).coalesce(1).write.parquet(f"{folder}/part_{month}")
    paths = [f"{folder}/part_{m}" for m in ("2016-01", "2016-02", "2016-03")]
    got = [A.list_files(spark, p)[0] for p in paths]
    assert got == sorted(got)
    flat = scratch_path(spark, "flat")
    spark.range(90).repartition(3).write.parquet(flat)
    assert A.read_trips(spark, flat).count() == 90
    assert 29 <= A.read_trips(spark, flat, limit_files=1).count() <= 31
    with pytest.raises(FileNotFoundError):
        A.read_trips(spark, flat, pattern="*.nothing")


def test_load_table_falls_back_and_otherwise_raises(spark, sf):
    with pytest.raises(AnalysisException):
        A.load_table(spark, "missing_table")
    df = A.load_table(spark, "missing_table", ["r_name"], 2, ["r_regionkey"], {"missing_table": f"{sf}/region.parquet"})
    assert df.columns == ["r_name"] and df.count() == 2


def test_month_files_span_a_year(spark):
    rows = A.month_files(spark, "/d/", "yellow", "2015-11-15", "2016-02-01").collect()
    assert [r["path"] for r in rows] == [f"/d/yellow_{m}.parquet" for m in ("2015-11", "2015-12", "2016-01", "2016-02")]


def test_year_filter_reaches_the_scan(spark, sf):
    plan = A.read_year(spark, spark.read.parquet(f"{sf}/orders.parquet"), 1997, "o_orderdate")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_csv_conversion_is_strict(spark):
    dst = scratch_path(spark, "csv")
    with pytest.raises(ValueError, match="not a CSV"):
        B.csv_to_parquet(spark, "/tmp/file.json", dst, "a int")
    bad = scratch_path(spark, "bad") + ".csv"
    spark.createDataFrame([("1",), ("x",)], "a string").coalesce(1).write.csv(bad, header=True)
    with pytest.raises(Exception):
        B.csv_to_parquet(spark, bad, dst, "a int")
    empty = scratch_path(spark, "empty") + ".csv"
    spark.createDataFrame([], "a string").coalesce(1).write.csv(empty, header=True)
    B.csv_to_parquet(spark, empty, dst, "a int")
    assert spark.read.parquet(dst).count() == 0


def test_train_split_rules(spark):
    df = spark.range(25).select(F.col("id").alias("x"), F.col("id").cast("double").alias("fare_capped"), "id")
    path = scratch_path(spark, "split")
    B.write_train_split(df.coalesce(1), path, rows_per_file=10)
    back = spark.read.parquet(path)
    assert back.columns[-1] == "fare_capped" and back.select(F.input_file_name().alias("f")).distinct().count() == 3
    twice = df.select("x", "fare_capped", F.col("x").alias("fare_capped"))
    for bad, label in ((df, "absent"), (df, ""), (twice, "fare_capped")):
        with pytest.raises(ValueError):
            B.write_train_split(bad, path, label)


def test_second_score_is_refused_and_first_kept(spark):
    path = scratch_path(spark, "score")
    B.write_score_once(spark.createDataFrame([(1.5,)], "mae double"), path)
    with pytest.raises(B.ScoreExists):
        B.write_score_once(spark.createDataFrame([(0.1,)], "mae double"), path)
    assert spark.read.json(path).first()["mae"] == 1.5


def test_leaderboard_is_one_ordered_file(spark):
    path = scratch_path(spark, "board")
    B.write_leaderboard(spark.createDataFrame([("b", 2.0), ("a", 1.0)], "model string, rmse_mean double"), path, "json")
    lines = spark.read.text(path)
    assert lines.select(F.input_file_name().alias("f")).distinct().count() == 1
    assert [r["model"] for r in spark.read.json(path).collect()] == ["a", "b"]


def dated(spark, day_from, days):
    return spark.range(days * 10).select("id", F.expr(f"timestampadd(DAY, cast(id % {days} as int), timestamp_ntz'{day_from} 08:00:00')").alias("pickup_datetime"))


def test_stream_ingest_takes_each_file_once(spark):
    src, dst, state = (scratch_path(spark, n) for n in ("src", "dst", "state"))
    first = dated(spark, "2016-01-01", 60)
    first.write.parquet(src)
    args = dict(start="2016-01-10", end="2016-03-31", schema=first.schema)
    ingest_incremental(spark, src, dst, state, **args)
    ingest_incremental(spark, src, dst, state, **args)
    assert spark.read.parquet(dst).count() == 51 * 10
    dated(spark, "2016-03-01", 40).write.mode("append").parquet(src)
    ingest_incremental(spark, src, dst, state, **args)
    assert spark.read.parquet(dst).count() == 51 * 10 + 31 * 10
    months = {str(r[0]) for r in spark.read.parquet(dst).select("pickup_month").distinct().collect()}
    assert months == {"2016-01-01", "2016-02-01", "2016-03-01"}


def months_of(rows):
    return {str(r["pickup_month"]): r["n"] for r in rows.groupBy("pickup_month").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_batch_ingest_replaces_only_its_months(spark):
    dst = scratch_path(spark, "batch")
    ingest_months(dated(spark, "2016-01-01", 60), dst, "2016-01-01", "2016-02-29")
    ingest_months(dated(spark, "2016-02-01", 5), dst, "2016-02-01", "2016-02-29")
    assert months_of(live.read(spark, dst)) == {"2016-01-01": 310, "2016-02-01": 50}


def test_batch_ingest_replaces_days_without_new_rows(spark):
    dst = scratch_path(spark, "batch")
    assert ingest_months(dated(spark, "2016-01-01", 91), dst, "2016-01-01", "2016-03-31") == 1
    # The same window with one February day: January and March go.
    one = dated(spark, "2016-02-10", 1)
    assert ingest_months(one, dst, "2016-01-01", "2016-03-31") == 2
    assert months_of(live.read(spark, dst)) == {"2016-02-01": 10}
    assert months_of(live.read(spark, dst, 1)) == {"2016-01-01": 310, "2016-02-01": 290, "2016-03-01": 310}
    # A window inside months takes out its own days, here all of them, and then everything.
    ingest_months(one.limit(0), dst, "2016-02-09", "2016-02-11")
    assert live.read(spark, dst).count() == 0 and live.read(spark, dst).columns == ["id", "pickup_datetime", "pickup_month"]
    ingest_months(dated(spark, "2016-04-01", 2).withColumn("new", F.lit(1)), dst, "2016-04-01", "2016-04-30")
    ingest_months(dated(spark, "2016-04-03", 2), dst, "2016-04-03", "2016-04-04")
    assert sorted(r["new"] or 0 for r in live.read(spark, dst).collect()) == [0] * 20 + [1] * 20


def test_batch_ingest_that_stops_changes_nothing(spark, monkeypatch):
    dst = scratch_path(spark, "batch")
    ingest_months(dated(spark, "2016-01-01", 60), dst, "2016-01-01", "2016-02-29")

    def killed(*args):
        raise KeyboardInterrupt
    with monkeypatch.context() as stop, pytest.raises(KeyboardInterrupt):
        stop.setattr(live, "commit", killed)
        ingest_months(dated(spark, "2016-01-01", 3), dst, "2016-01-01", "2016-02-29")
    assert months_of(live.read(spark, dst)) == {"2016-01-01": 310, "2016-02-01": 290}
    before = live.state(spark, dst)
    ingest_months(dated(spark, "2016-01-01", 3), dst, "2016-01-01", "2016-02-29")
    with pytest.raises(live.CommitConflict):
        live.commit(spark, before, before.columns, {})
    assert months_of(live.read(spark, dst)) == {"2016-01-01": 30}


def test_live_readers_open_only_the_months_they_ask_for(spark):
    dst = scratch_path(spark, "batch")
    ingest_months(dated(spark, "2016-01-01", 60), dst, "2016-01-01", "2016-02-29")
    january = live.read(spark, dst).where(F.col("pickup_month") == F.lit("2016-01-01").cast("date"))
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_month" in plan
    assert january.count() == 310
    with pytest.raises(ValueError, match="no commit"):
        live.read(spark, scratch_path(spark, "nothing"))


def test_fact_files_prune_by_month(spark):
    path = scratch_path(spark, "fact")
    rows = dated(spark, "2016-01-01", 60).withColumns({"pickup_locationid": F.col("id") % 3, "dropoff_locationid": F.col("id") % 2})
    B.save_fact(rows, path, files_per_month=2)
    one = spark.read.parquet(path).where(F.col("pickup_month") == F.lit("2016-01-01").cast("date"))
    assert one.count() == 310
    files = one.select(F.input_file_name().alias("f")).distinct().collect()
    assert 1 <= len(files) <= 3 and all("pickup_month=2016-01-01" in r["f"] for r in files)


def rows_scanned(df):
    """Rows that the scan of a plan gave to the filter behind it."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collect()
    nodes, out = [plan], []
    while nodes:
        node = nodes.pop()
        if "FileSourceScan" in node.getClass().getSimpleName():
            out.append(node.metrics().apply("numOutputRows").value())
        if "AdaptiveSparkPlan" in node.getClass().getSimpleName():
            nodes.append(node.executedPlan())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return sum(out)


def test_fact_files_are_clustered_by_both_zones(spark):
    path = scratch_path(spark, "fact")
    times = F.expr("timestampadd(SECOND, cast(id % 86400 as int), timestamp_ntz'2016-01-05 00:00:00')")
    zone = lambda seed: F.when(F.rand(seed) < 0.33, 17).otherwise((F.rand(seed + 1) * 256).cast("int"))
    rows = pin(spark.range(64_000).select("id", times.alias("pickup_datetime"), zone(1).alias("pickup_locationid"), zone(5).alias("dropoff_locationid")))
    B.save_fact(rows, path, files_per_month=32)
    mart = spark.read.parquet(path)
    assert mart.drop("pickup_month").exceptAll(rows).isEmpty() and mart.count() == 64_000
    files = mart.groupBy(F.input_file_name()).agg(*[f(c) for c in ("pickup_locationid", "dropoff_locationid") for f in (F.min, F.max)], F.count("*")).collect()
    assert max(f[5] for f in files) < 2 * 64_000 / 32  # the pair (17, 17) and the zone 17 are cut as well
    share = lambda i, z: sum(f[i] <= z <= f[i + 1] for f in files) / len(files)
    for side in (1, 3):
        assert sum(share(side, z) for z in range(256)) / 256 < 0.35  # ranges are cut by a sample, so this moves by a few hundredths
    for column in ("pickup_locationid", "dropoff_locationid"):
        assert rows_scanned(mart.where(F.col(column) == 200)) < 0.5 * 64_000
    assert rows_scanned(mart.where("pickup_locationid = 200 and dropoff_locationid = 30")) < 0.15 * 64_000


def test_schema_drift(spark):
    path = scratch_path(spark, "drift")
    spark.range(1).select(F.lit(1).alias("a"), F.lit("x").alias("b"), F.lit(1.0).alias("extra")).write.parquet(path)
    contract = StructType.fromDDL("a bigint, b string, c date")
    got = {(r["column_name"], r["drift"]) for r in N.schema_drift(spark, {"jan": path}, contract).collect()}
    assert got == {("a", "retyped"), ("extra", "new"), ("c", "missing")}


def test_one_odd_file_of_many(spark, tmp_path):
    plain = pa.table({"a": pa.array([1, 2]), "when": pa.array([0, 1], pa.timestamp("us")), "kind": pa.array(["x", "y"]).dictionary_encode(), "u": pa.array([1, 2], pa.uint32())})
    for i in range(1000):
        table = plain.append_column("late", pa.array([1.5, 2.5])) if i == 613 else plain.set_column(0, "a", pa.array(["1", "2"])) if i == 77 else plain
        pq.write_table(table, tmp_path / f"part-{i}.parquet")
    contract = StructType.fromDDL("a bigint, when timestamp_ntz, kind string, u bigint, late double")
    got = {(r["column_name"], r["found_type"], r["drift"]) for r in N.schema_drift(spark, {"s": str(tmp_path)}, contract).collect()}
    assert {("a", "string", "retyped"), ("a", "bigint", "missing in some files"), ("late", "double", "missing in some files")} <= got
    assert {c for c, _, _ in got} == {"a", "late", "u"}
    columns = N.file_columns(spark, str(tmp_path))
    assert columns.where("column_name = 'late'").select("file").collect()[0]["file"].endswith("part-613.parquet")
    assert columns.select(F.spark_partition_id()).distinct().count() > 4


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_climate_join_cannot_fan_out(spark):
    from meterline.operators.joins import attach_climate
    trips = spark.createDataFrame([(1, "2016-01-01"), (2, "2016-01-02"), (3, None)], "id int, d string").select("id", F.col("d").cast("date").alias("pickup_date"))
    climate = spark.createDataFrame([("2016-01-01", 1.0), ("2016-01-01", 2.0)], "d string, highTemp double").select(F.col("d").cast("date").alias("climate_date"), "highTemp")
    assert attach_climate(trips, climate).count() == 3
    assert N.climate_fanout(climate).first()["one_row_per_date"] is False


def test_small_side_only_broadcasts_what_it_counted(spark):
    from meterline.operators.joins import small_side
    big = spark.range(1000)
    assert "broadcast" in small_side(big, 1000)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in small_side(big, 999)._jdf.queryExecution().logical().toString().lower()

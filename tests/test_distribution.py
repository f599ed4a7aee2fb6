"""Quantiles, ranks and exact splits against brute force, on skewed data."""

import math
import random

import pytest
from pyspark.sql import functions as F

from meterline.operators import aggregates as G, staging as S
from meterline.operators.quantiles import exact_quantiles, running_total, value_histogram
from meterline.operators.ranking import global_row_number, quota_split
from meterline.operators.staging import dedup_keep_first
from meterline.operators.windows import sequence_trips
from meterline.session import pin


@pytest.fixture(scope="module")
def skewed(spark):
    """Two groups; a third of all rows share one value."""
    rng = random.Random(5)
    rows = [("a", 3.0)] * 700 + [("a", round(rng.lognormvariate(1, 2), 3)) for _ in range(900)] + [("b", float(rng.randint(-5, 5))) for _ in range(501)] + [("b", None)] * 9
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, v double").cache()


def values(rows, g):
    return sorted(v for k, v in rows if k == g and v is not None)


def test_discrete_quantiles(skewed):
    rows, df = skewed
    probs = {"p0": 0.0, "p1": 0.01, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    for r in exact_quantiles(df, ["g"], "v", probs).collect():
        vs = values(rows, r["g"])
        assert r["tot"] == len(vs)
        for name, p in probs.items():
            assert r[name] == vs[max(math.ceil(p * len(vs)), 1) - 1]


def test_interpolated_quantiles(skewed):
    rows, df = skewed
    probs = {"q1": 0.25, "q2": 0.5, "q9": 0.95}
    for r in exact_quantiles(df, ["g"], "v", probs, interpolate=True).collect():
        vs = values(rows, r["g"])
        for name, p in probs.items():
            at = p * (len(vs) - 1)
            lo, hi = vs[math.floor(at)], vs[math.ceil(at)]
            assert r[name] == pytest.approx(lo + (hi - lo) * (at - math.floor(at)))


def test_running_total_matches_window(skewed):
    rows, df = skewed
    for r in running_total(value_histogram(df, ["g"], "v"), ["g"], "v").collect():
        vs = values(rows, r["g"])
        assert r["cum_n"] == sum(v <= r["v"] for v in vs) and r["tot"] == len(vs)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(empty, ["g"], "v", {"p": 0.5}).count() == 0


def test_global_row_number_with_copies(spark):
    rows = [(1, "x")] * 50 + [(i % 9, f"k{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "t int, k string").repartition(6)
    got = [(r["t"], r["k"]) for r in global_row_number(df, ["t", "k"]).orderBy("seq").collect()]
    assert got == sorted(rows)
    assert sorted(r["seq"] for r in global_row_number(df, ["t", "k"]).collect()) == list(range(1, 251))


def test_sequence_in_day_restarts(spark):
    df = spark.range(48).select(F.col("id").cast("string").alias("tripid"), F.expr("timestampadd(HOUR, cast(id as int), timestamp_ntz'2016-01-01 00:00:00')").alias("pickup_datetime"))
    got = {int(r["tripid"]): (r["seq"], r["seq_in_day"]) for r in sequence_trips(df).collect()}
    assert got == {i: (i + 1, i % 24 + 1) for i in range(48)}


def shares(df, strata):
    return {tuple(r[s] for s in strata) + (r["part"],): r["n"] for r in df.groupBy(*strata, "part").agg(F.count(F.lit(1)).alias("n")).collect()}


@pytest.mark.parametrize("copies", [1, 400])
def test_quota_split_is_exact_with_copies_and_null_strata(spark, copies):
    base = spark.range(600).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 3).alias("s"), (F.col("id") % 97).alias("x"))
    df = base.unionByName(spark.range(copies).select(F.lit(1).cast("bigint").alias("s"), F.lit(7).cast("bigint").alias("x")))
    out = quota_split(df, ["s"], {"test": 0.2, "validation": 0.1})
    totals = {r["s"]: r["n"] for r in df.groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}
    got = shares(out, ["s"])
    for s, n in totals.items():
        test, both = math.floor(0.2 * n + 0.5), math.floor((0.2 + 0.1) * n + 0.5)
        assert got[(s, "test")] == test and got[(s, "validation")] == both - test and got[(s, "train")] == n - both
    # The same rows as before, each with its copies.
    assert sorted(map(repr, out.drop("part").collect())) == sorted(map(repr, df.collect()))


def test_quota_split_does_not_depend_on_partitioning(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("s"), "id")
    a, b = (quota_split(d, ["s"], {"holdout": 0.2}, key=["id"]).where("part = 'holdout'").select("id").collect() for d in (df, df.repartition(5)))
    assert {r[0] for r in a} == {r[0] for r in b} and len(a) == 100


def test_keep_first_needs_no_window(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "z"), (1, 3, "a"), (2, None, "n"), (2, 1, "m")], "k int, o int, v string")
    out = dedup_keep_first(df, ["k"], ["o"])
    assert {(r["k"], r["o"], r["v"]) for r in out.collect()} == {(1, 3, "a"), (2, None, "n")}
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_rank_correlation_of_monotone_columns(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), F.exp(F.col("id") / 40).alias("b"), (-F.col("id")).cast("double").alias("c"))
    r = {(x["row"], x["col"]): x["r"] for x in G.correlation_matrix(df, ["a", "b", "c"], "spearman").collect()}
    assert r[("a", "b")] == pytest.approx(1.0) and r[("a", "c")] == pytest.approx(-1.0)


def test_sketched_caps_lie_in_the_exact_band(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "Green").otherwise("Yellow").alias("service_type"), (F.col("id") * 7919 % 5003).cast("double").alias("fare_amount"),
        (F.col("id") * 104729 % 5003).cast("double").alias("trip_distance"), (F.col("id") % 60).cast("double").alias("trip_duration_min"),
    )
    caps = {r["service_type"]: r for r in G.compute_caps(df).collect()}
    assert caps["Yellow"]["duration_p99"] is None and caps["All"]["fare_p99"] is None
    band = exact_quantiles(df, ["service_type"], "fare_amount", {"lo": 0.989, "hi": 0.991})
    for r in band.collect():
        assert r["lo"] <= caps[r["service_type"]]["fare_p99"] <= r["hi"]


def test_apply_caps_passes_unknown_services(spark):
    df = spark.createDataFrame([("Yellow", 90.0, 5.0, 99.0), ("Grey", 90.0, 5.0, 10.0), ("Yellow", None, 50.0, 1.0)], "service_type string, fare_amount double, trip_distance double, trip_duration_min double")
    caps = spark.createDataFrame([("Yellow", 52.0, 18.0, None), ("All", None, None, 60.0)], "service_type string, fare_p99 double, distance_p99 double, duration_p99 double")
    got = [(r["fare_capped"], r["distance_capped"], r["trip_duration_min"]) for r in G.apply_caps(df, caps).orderBy("service_type", "fare_amount").collect()]
    assert got == [(90.0, 5.0, 10.0), (None, 18.0, 1.0), (52.0, 5.0, 60.0)]


def test_checksum_ignores_order_and_sees_changes(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).cast("string").alias("s"))
    a, b = (G.table_checksum(d).first() for d in (df, df.orderBy(F.desc("id")).select("s", "id")))
    assert a == b
    assert G.table_checksum(df.withColumn("s", F.when(F.col("id") == 5, "x").otherwise(F.col("s")))).first() != a


def test_compare_groups_states(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0), (None, 3.0)], "k string, v double")
    b = spark.createDataFrame([("x", 1.0 + 1e-13), ("z", 2.0), (None, 4.0)], "k string, v double")
    got = {r["k"]: r["state"] for r in G.compare_groups(a, b, ["k"], tolerance=1e-9).collect()}
    assert got == {"x": "equal", "y": "left only", "z": "right only", None: "differs"}


def test_exact_split_keeps_every_row(spark):
    """NULL and repeated keys, NULL strata and tiny strata: nothing is lost, sizes are exact."""
    for share in (0.0, 0.1, 0.5, 1.0):
        rows = spark.range(1000).select(
            F.when(F.col("id") % 100 >= int(100 * share), F.col("id") % 37).alias("key"), "id",
            F.when(F.col("id") >= 2, F.when(F.col("id") % 3 > 0, F.col("id") % 3)).otherwise(F.lit(9)).alias("stratum"),
        )
        out = pin(quota_split(rows, ["stratum"], {"holdout": 0.2, "validation": 0.1}, key=["key"]))
        assert out.count() == 1000 and out.select("id").distinct().count() == 1000
        sizes = {r["stratum"]: r["count"] for r in rows.groupBy("stratum").count().collect()}
        found = {(r["stratum"], r["part"]): r["count"] for r in out.groupBy("stratum", "part").count().collect()}
        for stratum, n in sizes.items():
            held = found.get((stratum, "holdout"), 0)
            assert held == round(0.2 * n) and held + found.get((stratum, "validation"), 0) == round(0.3 * n + 1e-9)


def test_null_groups_have_quantiles(spark):
    rows = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), (F.col("id") * 7 % 100).cast("double").alias("v"))
    got = {r["g"]: (r["p"], r["tot"]) for r in exact_quantiles(rows, ["g"], "v", {"p": 0.5}).collect()}
    want = {r["g"]: (r["p"], r["n"]) for r in rows.groupBy("g").agg(F.percentile_approx("v", 0.5, 100000).alias("p"), F.count("*").alias("n")).collect()}
    assert got == want and None in got
    running = running_total(value_histogram(rows, ["g"], "v"), ["g"], "v").collect()
    assert max(r["cum_n"] for r in running if r["g"] is None) == 100


def shuffled_bytes(df):
    """Bytes written by the shuffles of a plan, once it has run."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collect()
    nodes, out = [plan], 0
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            out += node.metrics().apply("shuffleBytesWritten").value()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return out


def wide(spark, n):
    return spark.range(n).select("id", *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(i)), 256).alias(f"c{i}") for i in range(3)], F.when(F.col("id") % 3 > 0, F.col("id")).alias("sometimes"))


def test_distinct_rows_with_and_without_copies(spark):
    rows = pin(wide(spark, 5000))
    copies = rows.where("id % 10 = 0").unionByName(rows.where("id < 100")).unionByName(rows.where("id = 7").crossJoin(spark.range(3000).toDF("k")).select(*rows.columns))
    for df in (rows, rows.unionByName(copies), rows.limit(0), copies.select("sometimes", "id")):
        got = S.dedup_rows(df)
        assert got.columns == df.columns
        assert got.exceptAll(df.distinct()).isEmpty() and got.count() == df.distinct().count()


def test_distinct_rows_survive_equal_digests(spark):
    rows = pin(wide(spark, 3000).unionByName(wide(spark, 200)))
    for digests in ([F.lit(1).cast("long")] * 2, [F.pmod("id", F.lit(5)), F.pmod("id", F.lit(3))], [F.col("id"), F.lit(0).cast("long")]):
        got = S.dedup_rows(rows, digests)
        assert got.exceptAll(rows.distinct()).isEmpty() and got.count() == 3000


def test_distinct_shuffles_no_rows_that_stand_alone(spark):
    rows = pin(wide(spark, 100_000))
    a, b = S._row_digests(rows)
    counting = rows.select(a.alias("a"), b.alias("b")).groupBy("a", "b").count()
    assert shuffled_bytes(S.dedup_rows(rows)) + shuffled_bytes(counting) < shuffled_bytes(rows.distinct()) / 3


def test_hexagons_hold_each_point_at_its_nearest_centre(spark):
    rng = random.Random(3)
    points = [(rng.gauss(3, 1), rng.gauss(5, 2)) for _ in range(400)]
    bins = G.hexbins(spark.createDataFrame([*points, (None, 1.0)], "x double, y double"), "x", "y", 9, log=False).collect()
    assert sum(r["n"] for r in bins) == 400
    x0, y0 = min(x for x, _ in points), min(y for _, y in points)
    sx, sy = (max(x for x, _ in points) - x0) / 9, (max(y for _, y in points) - y0) / 5
    centres = [(x0 + sx * (i + g / 2), y0 + sy * (j + g / 2)) for g in (0, 1) for i in range(-1, 11) for j in range(-1, 7)]
    nearest = {}
    for x, y in points:
        c = min(centres, key=lambda c: ((x - c[0]) / sx) ** 2 + 3 * ((y - c[1]) / sy) ** 2)
        nearest[round(c[0], 6), round(c[1], 6)] = nearest.get((round(c[0], 6), round(c[1], 6)), 0) + 1
    assert {(round(r["x_centre"], 6), round(r["y_centre"], 6)): r["n"] for r in bins} == nearest
    one = G.hexbins(spark.createDataFrame([(1.0, 1.0)] * 3, "x double, y double"), "x", "y", 9).collect()
    assert len(one) == 1 and one[0]["n"] == 3


def test_caps_of_any_months_from_their_sketches(spark):
    rng = random.Random(12)
    rows = [(m, s, rng.expovariate(1 / (10 + m)), rng.expovariate(1.0), rng.expovariate(0.1)) for m in range(1, 5) for s in ("Yellow", "Green") for _ in range(4000)]
    df = spark.createDataFrame(rows, "m int, service_type string, fare_amount double, trip_distance double, trip_duration_min double")
    df = pin(df.withColumn("pickup_datetime", F.make_timestamp_ntz(F.lit(2016), "m", F.lit(3), F.lit(1), F.lit(0), F.lit(0.0))))
    sketches = pin(G.cap_sketches(df, F.col("trip_distance") > 0.01, k=512))
    for months in ((1,), (2, 4), (1, 2, 3, 4)):
        caps = {r["service_type"]: r for r in G.caps_from_sketches(sketches.where(F.month("pickup_month").isin(*months)), k=512).collect()}
        own = [r for r in rows if r[0] in months and r[3] > 0.01]
        for service in ("Yellow", "Green"):
            fares = [r[2] for r in own if r[1] == service]
            assert 0.986 < sum(f <= caps[service]["fare_p99"] for f in fares) / len(fares) < 0.994
            assert caps[service]["kept_rows"] == len(fares) and caps[service]["duration_p99"] is None
        assert 0.986 < sum(r[4] <= caps["All"]["duration_p99"] for r in own) / len(own) < 0.994
        assert caps["All"]["all_rows"] == 8000 * len(months) and caps["All"]["fare_p99"] is None
    assert G.caps_from_sketches(sketches.limit(0)).count() == 0


def test_medians_are_exact_where_sketches_are_not(spark):
    """One row more or less decides each median; groups of NULLs and a NULL key stay."""
    half = F.when(F.col("id") < 200_000, F.pmod(F.xxhash64("id"), F.lit(50_000))).otherwise(F.pmod(F.xxhash64("id"), F.lit(50_000)) + 50_001)
    rows = spark.range(0, 400_000, 1, 8).select(F.lit("a").alias("vendorid"), half.cast("double").alias("trip_duration_min"))
    rows = rows.unionByName(spark.createDataFrame([("a", 50_000.0), ("b", None), (None, 7.0), (None, None)], "vendorid string, trip_duration_min double")).withColumn("pickup_hour", F.lit(3))
    want = {"a": 50_000.0, "b": None, None: 7.0}
    summary = G.duration_summary(rows, "vendorid")
    assert summary.columns == ["vendorid", "mean", "median"] and {r["vendorid"]: r["median"] for r in summary.collect()} == want
    assert {r["vendorid"]: r["mean"] for r in summary.collect() if r["vendorid"] != "a"} == {"b": None, None: 7.0}
    by_hour = G.median_by_hour(rows)
    assert by_hour.columns == ["pickup_hour", "vendorid", "median"] and {r["vendorid"]: r["median"] for r in by_hour.collect()} == want

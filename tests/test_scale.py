"""What must not grow with the input: rows of one task, passes over the trips, repeated fits."""

import inspect

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from meterline import constants as K
from meterline.ml import ensembles as E, evaluation as V, stages as P
from meterline.operators import quality as N
from meterline.plans import fixtures as X, prep
from meterline.registry import QUERIES
from meterline.session import deal


def test_tables_are_dealt_over_more_tasks_as_they_grow(spark):
    rows = spark.range(0, 1000).withColumn("k", F.col("id") % 100)
    dealt = deal(rows, "k", rows=20).select("id", "k", F.spark_partition_id().alias("task")).collect()
    assert len({r["task"] for r in dealt}) > 8 and len({(r["k"], r["task"]) for r in dealt}) == 100
    assert sorted(r["id"] for r in dealt) == list(range(1000))


def test_raw_trips_read_the_lines_once(spark, sf):
    raw = X.raw_trips(spark, sf, "Green")
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") and plan.count("Relation [l_orderkey") == 1
    trips = X.trips(spark, sf).where("service_type = 'Green'")
    assert raw.count() == trips.count() + trips.where("ratecodeid = 7").count()
    assert raw.where("RatecodeID = 7").count() == 2 * trips.where("ratecodeid = 7").count()


def labelled(spark):
    return spark.range(0, 300).select(
        (F.col("id") % 50).cast("double").alias("distance_capped"), (F.col("id") % 50 * 2 + F.col("id") % 7).cast("double").alias("fare_capped"),
        (F.col("id") % 3).cast("int").alias("fold"))


class Counted(P.MeanRegressor):
    """Counts its fits."""

    fits = []

    def _fit(self, dataset):
        Counted.fits.append(1)
        return super()._fit(dataset)


def test_a_sweep_makes_each_fit_once(spark):
    """Three folds out, and three pairs of folds; the vote and the stack need no others, and score as on their own."""
    df, Counted.fits[:] = labelled(spark), []
    mean, ols = V.ModelSpec("mean", False, Counted("fare_capped")), V.ModelSpec("ols", True, LinearRegression(labelCol="fare_capped", featuresCol="features"))
    vote, stack = V.ModelSpec("vote", False, members=(mean, ols)), V.ModelSpec("stack", False, members=(mean, ols), options={"foldCol": "fold"})
    board = {r["model"]: r for r in V.run_sweep(df, [mean, ols, vote, stack], 3, variant="dropped").collect()}
    assert len(Counted.fits) == 3 + 3
    for spec in (vote, stack):
        alone = V.cross_validate(df, V.spec_pipeline(spec, df.columns, "dropped"), 3).agg(F.avg("mae"), F.avg("rmse")).first()
        assert abs(board[spec.name]["mae_mean"] - alone[0]) < 1e-9 and abs(board[spec.name]["rmse_mean"] - alone[1]) < 1e-9


def test_folds_of_a_column_are_checked_without_python(spark):
    df = labelled(spark)
    for halves in V._ByColumn(numFolds=3, foldCol="fold")._kFold(df):
        assert all("Python" not in h._jdf.queryExecution().executedPlan().toString() for h in halves)
    for bad in (df.where("fold < 2"), df.withColumn("fold", F.col("fold") + 1), df.withColumn("fold", F.nullif("fold", F.lit(1)))):
        try:
            V.tune(P.MeanRegressor("fare_capped"), bad, [], RegressionEvaluator(labelCol="fare_capped"), 3, fold="fold")
        except ValueError as error:
            assert "folds must be" in str(error)
        else:
            raise AssertionError("wrong folds were taken")


def test_trees_are_fitted_on_dealt_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(P, "deal", lambda df: seen.append(df.count()) or df)
    df = labelled(spark)
    specs = {s.name: s for s in V.model_specs(depth=2)}
    P.fit(V.spec_pipeline(specs["decision_tree"], df.columns, "dropped"), df)
    P.fit(V.spec_pipeline(specs["ols"], df.columns, "dropped"), df)
    E.StackingRegressor(members={"tree": V.spec_pipeline(specs["decision_tree"], df.columns, "dropped")}, foldCol="fold").fit(df)
    assert seen == [300, 200, 200, 200, 300]


def test_tree_fits_read_rows_prepared_once(spark, monkeypatch):
    """Only the columns of the tree reach it, computed once and kept on disk while it is fitted."""
    seen, real = [], P.DecisionTreeRegressor._fit
    monkeypatch.setattr(P.DecisionTreeRegressor, "_fit", lambda self, df: seen.append((sorted(df.columns), df.storageLevel.useDisk)) or real(self, df))
    df = labelled(spark)
    pipeline = V.spec_pipeline({s.name: s for s in V.model_specs(depth=2)}["decision_tree"], df.columns, "dropped")
    model = P.fit(pipeline, df)
    assert seen == [(["fare_capped", "features"], True)]
    whole = pipeline.fit(df)
    predicted = [sorted(r["prediction"] for r in m.transform(df).collect()) for m in (model, whole)]
    assert predicted[0] == predicted[1]


def test_capped_trips_are_computed_once(spark):
    """Caps and trips are read from one kept table."""
    sample = prep.prepared(X.fact(spark, "/root/testdata/sf0.001"))
    assert all("/pinned-" in f for f in sample.inputFiles()) and sample.columns == list(K.MODEL_COLUMNS)


def test_the_sweep_runs_the_registry_at_its_own_sizes(spark, sf, monkeypatch):
    """100 trees of depth 10, 100 rounds, five folds that all hold rows, and the corridor encoded."""
    seen, real = [], V.run_sweep
    monkeypatch.setattr(V, "run_sweep", lambda df, specs, *a, **k: seen.append((df, specs, inspect.signature(real).bind(df, specs, *a, **k))) or df)
    QUERIES["m15_run_sweep"](spark, sf)
    (df, specs, given), = seen
    given.apply_defaults()
    assert given.arguments["k"] == K.FOLDS and given.arguments["variant"] == "target_encoded" and "od_corridor" in df.columns
    assert sorted(r[0] for r in df.select("fold").distinct().collect()) == list(range(K.FOLDS))
    assert [s.name for s in specs] == [s.name for s in V.model_specs()]
    by = {s.name: s.estimator for s in specs}
    assert by["random_forest"].getNumTrees() == 100 and by["random_forest"].getMaxDepth() == by["decision_tree"].getMaxDepth() == 10
    assert by["gradient_boosting"].getMaxIter() == 100


def test_leakage_is_audited_once_for_all_folds(spark, monkeypatch):
    calls, real = [], N.leakage_audit
    monkeypatch.setattr(N, "leakage_audit", lambda *a, **k: calls.append(k) or real(*a, **k))
    row = QUERIES["n08_leakage_audit"](spark, "/root/testdata/sf0.001").first()
    assert len(calls) == 2 and row["moved"] == 0 and row["leak_is_found"] and row["rows"] > 0


def test_leakage_audit_by_group(spark):
    before = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 2.0), ("c", 1, 3.0)], "k string, f int, te double")
    after = spark.createDataFrame([("a", 1.0), ("b", 2.5), ("c", 3.0)], "k string, te double")
    got = {r["f"]: (r["rows"], r["moved"]) for r in N.leakage_audit(before, after, "k", "te", by=["f"]).collect()}
    assert got == {0: (2, 1), 1: (1, 0)}

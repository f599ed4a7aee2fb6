"""Splits, metrics, leaderboards and Spark ML on small frames."""

import itertools
import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from meterline import constants as K
from meterline.ml import attribution as T, ensembles as E, evaluation as V, stages as P
from meterline.operators import metrics as R, sampling as I, splits as J
from meterline.session import scratch_path


def test_unknown_strategy_and_preset(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="unknown strategy"):
        J.temporal_split(df, "sideways")
    with pytest.raises(ValueError, match="unknown approach"):
        J.production_splits(df, "sideways")


def test_random_split_is_a_partition(spark):
    df = spark.range(2000).withColumn("pickup_year", F.lit(2015))
    parts = J.split_random(df, 0.2, 1)
    ids = [r["id"] for p in parts.values() for r in p.collect()]
    assert sorted(ids) == list(range(2000))
    assert 300 < parts["test"].count() < 500 and 130 < parts["validation"].count() < 270
    assert set(J.split_random(df, 0.2, 1, validation=False)) == {"train", "test"}


def test_cutoff_instant_is_sealed(spark):
    rows = spark.createDataFrame([(1, "2016-10-31 23:59:59"), (2, "2016-11-01 00:00:00"), (3, "2016-12-01 00:00:00"), (4, None)], "id int, t string")
    df = rows.select("id", F.col("t").cast("timestamp_ntz").alias("pickup_datetime"))
    before, sealed = J.carve_temporal(df, "2016-11-01")
    assert {r["id"] for r in sealed.collect()} == {2, 3} and {r["id"] for r in before.collect()} == {1, 4}
    with pytest.raises(ValueError, match="no column"):
        J.carve_temporal(rows, "2016-11-01")


def test_holdout_without_strata_columns(spark):
    out = J.carve_holdout(spark.range(101))
    assert out.where("part = 'holdout'").count() == 20 and out.count() == 101


def test_verify_carve_table_stops_on_lost_rows(spark):
    counts = spark.createDataFrame([(100, 10, 18, 71)], "sample bigint, temporal bigint, holdout bigint, train bigint")
    with pytest.raises(Exception, match="parts hold 99"):
        J.verify_carve_table(counts).collect()


def test_nested_sample_and_missing_strata(spark):
    df = spark.range(4000).select("id", (F.col("id") % 2).cast("string").alias("service_type"), F.lit("Hot").alias("temp_band"))
    full, work = I.nested_sample(df, 0.5, 0.5, 42)
    a, b = ({r["id"] for r in d.collect()} for d in (full, work))
    assert b < a and 1800 < len(a) < 2200
    only = I.stratified_sample(df, {"1|Hot": 1.0}, 1)
    assert only.count() == 2000 and only.where("service_type = '0'").count() == 0


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 1.0), (None, 1.0)], "label double, prediction double")
    m = R.regression_metrics(df).first()
    assert m["rows"] == 3 and m["mae"] == pytest.approx(5 / 3) and m["rmse"] == pytest.approx((17 / 3) ** 0.5) and m["r2"] == pytest.approx(1 - 17 / 8)


def folds(spark, model, maes, times):
    return R.fold_rows(spark, model, [{"mae": m, "rmse": m, "r2": 0.5} for m in maes], times)


def test_fold_rows_reject_gaps(spark):
    with pytest.raises(Exception, match="no folds"):
        R.fold_metrics_to_row(folds(spark, "a", [], [])).collect()
    incomplete = spark.createDataFrame([("a", 0, 1.0, 1.0, 0.5, None)], folds(spark, "a", [], []).schema)
    with pytest.raises(Exception, match="incomplete folds of a"):
        R.fold_metrics_to_row(incomplete).collect()
    with pytest.raises(ValueError, match="shorter"):
        folds(spark, "a", [1.0, 2.0], [1.0])


def test_leaderboard_row_uses_population_deviation(spark):
    row = R.fold_metrics_to_row(folds(spark, "a", [1.0, 3.0], [2.0, 4.0])).first()
    assert row["mae_mean"] == 2.0 and row["mae_std"] == 1.0 and row["fit_time_s"] == 3.0


BOARD = "model string, mae_mean double, mae_std double, fit_time_s double"


@pytest.mark.parametrize("rows,champion,inside", [
    ([("slow", 1.0, 0.01, 9.0), ("fast", 2.0, 0.01, 1.0)], "slow", False),
    ([("slow", 1.0, 0.5, 9.0), ("fast", 1.4, 0.1, 1.0)], "fast", True),
    ([("fast", 1.0, 0.5, 1.0), ("slow", 1.4, 0.1, 9.0)], "fast", True),
])
def test_champion(spark, rows, champion, inside):
    r = R.pick_champion(spark.createDataFrame(rows, BOARD)).first()
    assert r["champion"] == champion and r["inside_std"] is inside


def test_champion_needs_two(spark):
    with pytest.raises(Exception, match="two models expected, got 1"):
        R.pick_champion(spark.createDataFrame([("a", 1.0, 0.1, 1.0)], BOARD)).collect()


FEATURES = [*K.NUMERIC_FEATURES, *K.BINARY_FEATURES, *K.ONE_HOT_FEATURES, K.CORRIDOR]


def test_routing():
    g = P.route_columns([*reversed(FEATURES), "stray", "fare_capped"])
    assert g.unknown == ["stray"] and g.target_encoded == [K.CORRIDOR] and g.numeric == sorted(g.numeric) and len(g.numeric) == 11
    dropped = P.route_columns(FEATURES, "dropped")
    assert dropped.target_encoded == [] and dropped.unknown == []
    oof = P.route_columns([*FEATURES, "od_corridor_te", "oof_fold"], "out_of_fold")
    assert "od_corridor_te" in oof.numeric and oof.unknown == [] and oof.target_encoded == []
    assert P.route_columns([*FEATURES, "od_corridor_te"]).unknown == ["od_corridor_te"]
    with pytest.raises(ValueError):
        P.route_columns(FEATURES, "both")


def test_out_of_fold_stages_hold_no_target_encoder():
    names = [type(s).__name__ for s in P.gbt_pipeline([*FEATURES, "od_corridor_te"], "out_of_fold")[0].getStages()]
    assert "TargetEncoder" not in names and "SQLTransformer" not in names and names[-1] == "GBTRegressor"
    assert "TargetEncoder" in [type(s).__name__ for s in P.gbt_pipeline(FEATURES)[0].getStages()]


def trips(spark, n=600):
    i = F.col("id")
    return spark.range(n).select(
        (i % 37 / 2.0).alias("distance_capped"), (i % 50 + 1.0).alias("trip_duration_min"), (i % 4).cast("int").alias("pickup_dow"),
        F.when(i % 3 == 0, "Green").otherwise("Yellow").alias("service_type"), (i % 5).cast("string").alias("pickup_borough"),
        F.concat(F.lit("c"), (i % 60).cast("string")).alias("od_corridor"),
        (i % 37 * 1.5 + i % 50 * 0.3 + F.when(i % 3 == 0, 4).otherwise(0)).alias("fare_capped"), (F.floor(i / 3) % 3).cast("int").alias("fold"),
    )


def test_target_encoded_boosting_runs_with_many_corridors(spark):
    df = trips(spark)
    pipeline, groups = P.gbt_pipeline([c for c in df.columns if c != "fold"], max_iter=3, max_depth=3)
    model = pipeline.fit(df)
    scored = R.regression_metrics(model.transform(df), "fare_capped").first()
    assert scored["r2"] > 0.5
    importance = V.feature_importance(model, model.transform(df)).collect()
    assert importance[0]["importance"] >= importance[-1]["importance"]
    assert sum(r["importance"] for r in importance) == pytest.approx(1.0)
    assert {"distance_capped", "od_corridor_te"} <= {r["feature"] for r in importance}


def test_scaled_design_has_full_rank_and_keeps_unseen(spark):
    df = trips(spark)
    model = Pipeline(stages=P.ohe_stages(["pickup_borough"], drop_first=True)).fit(df)
    seen = {r["pickup_borough"]: r["v"] for r in model.transform(df.select("pickup_borough").distinct()).select("pickup_borough", vector_to_array("pickup_borough_ohe").alias("v")).collect()}
    assert sum(seen["0"]) == 0 and all(len(v) == 4 for v in seen.values()) and all(sum(v) == 1 for k, v in seen.items() if k != "0")
    unseen = model.transform(spark.createDataFrame([("new",)], "pickup_borough string")).select(vector_to_array("pickup_borough_ohe")).first()[0]
    assert sum(unseen) == 0


def test_cross_validation_variants_and_sweep(spark):
    df = trips(spark)
    columns = [*[c for c in df.columns if c != "fold"], "od_corridor_te"]
    oof = V.cross_validate(df, P.gbt_pipeline(columns, "out_of_fold", max_iter=2, max_depth=2)[0], 3, name="oof", halves=V.encoded_halves(3))
    assert oof.count() == 3 and oof.where("fit_time_s <= 0").count() == 0
    board = V.run_sweep(df, [s for s in V.specs_for(df, 3) if s.name in ("mean", "ols", "ridge", "decision_tree")], 3, variant="dropped").collect()
    assert [r["rmse_mean"] for r in board] == sorted(r["rmse_mean"] for r in board)
    assert board[-1]["model"] == "mean" and board[-1]["r2_mean"] < 0.05
    with pytest.raises(ValueError, match="folds without rows"):
        V.cross_validate(df.where("fold < 2"), P.MeanRegressor(), 3)


def test_ridge_matches_its_closed_form(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + F.col("id") % 3).alias("fare_capped"))
    rows = [(r["x"], r["fare_capped"]) for r in df.collect()]
    mx, my = (sum(v) / 50 for v in zip(*rows))
    sxx, sxy = sum((x - mx) ** 2 for x, _ in rows), sum((x - mx) * (y - my) for x, y in rows)
    std = (sum((y - my) ** 2 for _, y in rows) / 50) ** 0.5
    for alpha in (1.0, 1000.0):
        estimator = V.linear_with_penalty(0.0, alpha / 50, std, labelCol="fare_capped", featuresCol="features")
        model = estimator.fit(VectorAssembler(inputCols=["x"], outputCol="features").transform(df))
        assert model.coefficients[0] == pytest.approx(sxy / (sxx + alpha), rel=1e-4 * alpha / 50)


def test_lasso_matches_its_closed_form(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0).alias("fare_capped"))
    estimator = V.linear_with_penalty(20.0, 0.0, 1.0, labelCol="fare_capped", featuresCol="features")
    model = estimator.fit(VectorAssembler(inputCols=["x"], outputCol="features").transform(df))
    variance = sum((i - 24.5) ** 2 for i in range(50)) / 50
    # Soft threshold of the least-squares slope.
    assert model.coefficients[0] == pytest.approx(2.0 - 20.0 / variance, rel=1e-3)


def test_stack_keeps_rows_and_beats_the_mean(spark):
    df = trips(spark)
    specs = {s.name: s for s in V.model_specs(max_iter=2, trees=3)}
    fitted = V.stack(df, {n: V.spec_pipeline(specs[n], df.columns, "dropped") for n in ("ols", "mean")}, 3, penalty=0.1)
    out = fitted.transform(df)
    assert out.columns == [*df.columns, "prediction"] and out.count() == 600
    assert R.regression_metrics(out, "fare_capped").first()["r2"] > 0.8


def ensembles(df, kind, **options):
    specs = {s.name: s for s in V.model_specs(max_iter=3, trees=3, depth=4)}
    members = {n: V.spec_pipeline(specs[n], df.columns, "dropped") for n in ("random_forest", "gradient_boosting", "ridge")}
    return E.ensemble(kind, members, **options)


@pytest.mark.parametrize("kind", ["vote", "stack"])
def test_ensembles_of_forest_booster_and_ridge_are_saved_and_loaded(spark, kind):
    df = trips(spark)
    train, test = df.where("fold > 0"), df.where("fold = 0")
    model = ensembles(df, kind).fit(train)
    out = model.transform(test)
    assert out.columns == [*df.columns, "prediction"] and out.count() == test.count()
    assert R.regression_metrics(out, "fare_capped").first()["r2"] > 0.7
    path = scratch_path(spark, kind)
    model.write().overwrite().save(path)
    again = type(model).load(path)
    assert again.uid == model.uid and list(again.members) == list(model.members)
    assert again.transform(test).exceptAll(out).isEmpty()
    piped = Pipeline(stages=[ensembles(df, kind)]).fit(train)
    assert piped.transform(test).select("prediction").count() == test.count()


def test_a_vote_is_the_mean_and_a_stack_sees_no_row_it_predicts(spark):
    df = trips(spark).withColumn("noise", F.xxhash64("trip_duration_min", "distance_capped").cast("double"))
    members = {"mean": P.MeanRegressor(), "ols": Pipeline(stages=[VectorAssembler(inputCols=["distance_capped"], outputCol="v"), LinearRegression(labelCol="fare_capped", featuresCol="v")])}
    fitted = E.VotingRegressor(members=members).fit(df)
    single = E.predict_all({n: e.fit(df) for n, e in members.items()}, df).select(((F.col("pred_mean") + F.col("pred_ols")) / 2).alias("prediction"))
    assert fitted.transform(df).select(F.round("prediction", 9)).exceptAll(single.select(F.round("prediction", 9))).isEmpty()

    class Remembers(P.MeanRegressor):
        """Fits its rows perfectly and knows nothing of others."""
        def _fit(self, dataset):
            return Table(dataset.select("noise", F.col("fare_capped").alias("known")).distinct())

    class Table(P.MeanModel):
        def __init__(self, rows):
            super().__init__()
            self.rows = rows

        def _transform(self, dataset):
            return dataset.join(self.rows, "noise", "left").withColumn("prediction", F.coalesce("known", F.lit(0.0))).drop("known")

    stacked = E.StackingRegressor(members={"learned": Remembers(), "ols": members["ols"]}, foldCol="fold").fit(df)
    # Out of fold the first member is worthless, so the stack leans on the second.
    assert abs(stacked.final.coefficients[0]) < 0.1 < 0.9 < stacked.final.coefficients[1]


def test_ensembles_in_cross_validation_sweep_and_grid_search(spark):
    df = trips(spark)
    specs = [s for s in V.specs_for(df, 3, max_iter=2, trees=2, depth=3, inner_folds="fold") if s.name in ("mean", "vote", "stack")]
    board = [r["model"] for r in V.run_sweep(df, specs, 3, variant="dropped").collect()]
    assert sorted(board[:2]) == ["stack", "vote"] and board[2] == "mean"
    linear = LinearRegression(labelCol="fare_capped", featuresCol="features")
    member = Pipeline(stages=[VectorAssembler(inputCols=["distance_capped"], outputCol="features"), linear])
    grid = ParamGridBuilder().addGrid(linear.regParam, [1000.0]).build()
    cv = V.tune(E.VotingRegressor(members={"one": member}), df, grid, V.regression_evaluator(), 3, fold="fold")
    results = [r["metric_mean"] for r in V.tuning_results(cv, spark).orderBy("entry").collect()]
    assert results[1] > 1.5 * results[0]


def test_ensembles_refuse_what_they_cannot_fit(spark):
    df = trips(spark)
    for bad in (E.VotingRegressor(), E.StackingRegressor()):
        with pytest.raises(ValueError, match="needs members"):
            bad.fit(df)
    with pytest.raises(ValueError, match="inner folds"):
        E.StackingRegressor(members={"mean": P.MeanRegressor()}, foldCol="fold").fit(df.where("fold = 1"))
    with pytest.raises(ValueError, match="unknown ensemble"):
        E.ensemble("blend", {})


def brute_shapley(x, own):
    """Sums over all subsets of features, of what a tree predicts when only those are known."""
    def value(known):
        total = 0.0
        for leaf in own:
            part = leaf.value
            for f, share, conditions in zip(leaf.features, leaf.shares, leaf.conditions):
                goes = all(((x[f] <= t) if c is None else (x[f] in c)) == left for t, c, left in conditions)
                part *= goes if f in known else share
            total += part
        return total

    n = len(x)
    out = []
    for i in range(n):
        others = [j for j in range(n) if j != i]
        out.append(sum(
            math.factorial(size) * math.factorial(n - 1 - size) / math.factorial(n) * (value({*some, i}) - value(set(some)))
            for size in range(n) for some in itertools.combinations(others, size)))
    return out


@pytest.mark.parametrize("kind", ["tree", "forest", "booster"])
def test_shapley_values_equal_sums_over_subsets(spark, kind):
    df = spark.range(400).select(
        (F.col("id") % 7).cast("double").alias("a"), (F.col("id") * 37 % 11).cast("double").alias("b"), (F.col("id") * 13 % 5).cast("double").alias("kind"),
        (F.col("id") % 3).cast("double").alias("d")).withColumn("fare_capped", F.col("a") * F.col("b") + F.when(F.col("kind").isin(1.0, 4.0), 30.0).otherwise(F.col("d")))
    cols = {"labelCol": "fare_capped", "featuresCol": "features", "seed": 1}
    last = {
        "tree": DecisionTreeRegressor(**cols, maxDepth=4), "forest": RandomForestRegressor(**cols, maxDepth=3, numTrees=4),
        "booster": GBTRegressor(**cols, maxDepth=3, maxIter=4)}[kind]
    index = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=5)  # two features are categories
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "kind", "d"], outputCol="raw"), index, last]).fit(df)
    out = model.transform(df).withColumn("values", T.attributions(model)).select(vector_to_array("features").alias("x"), "values", "prediction").collect()
    trees = T.leaves(model)
    for r in out:
        assert sum(r["values"]) == pytest.approx(r["prediction"] - T.expected(trees), abs=1e-6)
    for r in out[:12]:
        want = [sum(w * v for w, v in zip([w for w, _ in trees], column)) for column in zip(*[brute_shapley(r["x"], own) for _, own in trees])]
        assert r["values"] == pytest.approx(want, abs=1e-9)
    ranking = T.attribution_ranking(model, model.transform(df)).collect()
    assert [r["mean_abs"] for r in ranking] == sorted((r["mean_abs"] for r in ranking), reverse=True)
    assert {r["feature"] for r in ranking} == {"a", "b", "kind", "d"}
    with pytest.raises(ValueError, match="no tree model"):
        T.leaves(LinearRegression(labelCol="fare_capped").fit(model.transform(df).drop("prediction")))


def test_halving_finds_the_winner_of_the_full_grid_with_fewer_fits(spark):
    df = trips(spark)
    linear = LinearRegression(labelCol="fare_capped", featuresCol="features")
    estimator = Pipeline(stages=[VectorAssembler(inputCols=["distance_capped"], outputCol="features"), linear])
    grid = ParamGridBuilder().addGrid(linear.regParam, [30.0, 10.0, 3.0, 1.0, 300.0, 100.0]).build()
    best, log = V.halving(estimator, df, grid, (0.3, 1.0), 3)
    full, whole = V.halving(estimator, df, grid, (1.0,), 3)
    assert best == full == {}
    rows = log.collect()
    assert {r["entry"] for r in rows if r["round"] == 0} == set(range(7)) and {r["entry"] for r in rows if r["round"] == 1} < set(range(7))
    cost = lambda t: sum(r["fits"] * r["budget"] for r in t.collect())
    assert cost(log) < 0.75 * cost(whole)
    tuned, _ = V.halving(estimator.copy({linear.regParam: 300.0}), df, [{linear.regParam: 0.0}, {linear.regParam: 900.0}], (0.5, 1.0), 3)
    assert tuned == {linear.regParam: 0.0}
    with pytest.raises(ValueError, match="rising"):
        V.halving(estimator, df, grid, (1.0, 0.5), 3)


def test_tune_entry_zero_is_untuned(spark):
    df = trips(spark)
    linear = LinearRegression(labelCol="fare_capped", featuresCol="features")
    estimator = Pipeline(stages=[VectorAssembler(inputCols=["distance_capped"], outputCol="features"), linear])
    grid = ParamGridBuilder().addGrid(linear.regParam, [10.0]).build()
    cv = V.tune(estimator, df, grid, V.regression_evaluator(), 3, fold="fold")
    results = V.tuning_results(cv, spark).orderBy("entry").collect()
    plain = V.cross_validate(df, estimator, 3).agg(F.avg("mae")).first()[0]
    assert len(results) == 2 and results[0]["metric_mean"] == pytest.approx(plain) and results[1]["metric_mean"] > plain


def test_sealed_scores_fit_once_and_return_numbers_only(spark):
    calls = []

    class Counting(P.MeanRegressor):
        def _fit(self, dataset):
            calls.append(1)
            return super()._fit(dataset)

    df = trips(spark)
    out = V.score_sealed(Counting(), df.where("fold = 0"), {"a": df.where("fold = 1"), "b": df.where("fold = 2")}, groups={"b": "service_type"})
    rows = out.collect()
    assert len(calls) == 1 and {(r["set"], r["grp"]) for r in rows} == {("a", None), ("b", None), ("b", "Green"), ("b", "Yellow")}
    assert set(out.columns) == {"set", "grp", "rows", "mae", "rmse", "r2", "fit_time_s"}


def test_ablation_reports_the_gap(spark):
    df = trips(spark)
    out = V.ablation(df, lambda cols: P.gbt_pipeline(cols, "dropped", max_iter=2, max_depth=3)[0], "distance_capped", 3).collect()
    means = {r["model"]: r["mae_mean"] for r in out}
    assert out[0]["mae_gap"] == pytest.approx(means["without"] - means["with"]) and out[0]["mae_gap"] > 0


def test_factory_names(spark):
    for model, task in (("rf", "regression"), ("gbt", "regression"), ("linear", "regression"), ("rf", "classification"), ("gbt", "classification"), ("logistic", "classification")):
        assert len(P.create_ml_pipeline(["a"], "y", model, task).getStages()) == 3
    for model, task in (("logistic", "regression"), ("linear", "classification"), ("rf", "clustering")):
        with pytest.raises(ValueError):
            P.create_ml_pipeline(["a"], "y", model, task)


def test_evaluate_classifier(spark):
    df = trips(spark).withColumn("label", (F.col("service_type") == "Green").cast("double"))
    model = P.create_ml_pipeline(["distance_capped", "fare_capped"], "label", "logistic", "classification").fit(df)
    row = V.evaluate_model(model, df, "label", "classification").first()
    assert 0.4 <= row["auc"] <= 1 and 0 <= row["accuracy"] <= 1

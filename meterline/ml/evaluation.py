"""Cross-validation, sweeps, ensembles, tuning and sealed scoring on Spark ML.

Loops run over folds and models (a handful each); rows stay in Spark. Where folds
share rows, the frame is kept in the shared folder first, so each fit reads files
instead of recomputing joins.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import constants as K
from ..operators.encoding import encode_outer_folds
from ..operators.metrics import METRICS, fold_metrics_to_row, fold_rows, leaderboard, regression_metrics
from ..operators.splits import fold_split, union_all
from ..session import pin
from .ensembles import StackingRegressor, ensemble, inner_folds, linear_with_penalty, predict_all
from .stages import MeanRegressor, fit, preprocessor, route_columns

Fitted = Callable[[int], tuple[Model, float]]
Halves = Callable[[DataFrame, int], tuple[DataFrame, DataFrame]]


def plain_halves(fold: str = "fold") -> Halves:
    """Train and test rows of a fold as they are."""
    return lambda df, i: fold_split(df, i, fold)


def encoded_halves(k: int = K.FOLDS, smoothing: float = K.SMOOTHING, label: str = K.TARGET, fold: str = "fold") -> Halves:
    """Train and test rows with the corridor encoded from train rows only; the folds of a frame share their sums."""
    made: list[tuple[DataFrame, Callable[[int], tuple[DataFrame, DataFrame]]]] = []

    def halves(df: DataFrame, i: int) -> tuple[DataFrame, DataFrame]:
        if not made or made[-1][0] is not df:
            made[:] = [(df, encode_outer_folds(df, k, smoothing, target=label, fold_col=fold))]
        return made[-1][1](i)
    return halves


def timed_fit(estimator: Estimator, df: DataFrame) -> tuple[Model, float]:
    """A fitted model, and the seconds its fit took."""
    started = time.perf_counter()
    model = fit(estimator, df)
    return model, time.perf_counter() - started


def oof_predictions(
    df: DataFrame, estimator: Estimator, k: int, fold: str = "fold", halves: Halves | None = None, prediction: str = "prediction",
    fitted: Fitted | None = None,
) -> tuple[DataFrame, list[float]]:
    """Each row predicted by the model of the other folds, with its fold.

    Also returns the seconds each fit took. ``fitted`` brings models and
    seconds of a fold where fits are shared.
    """
    halves = halves or plain_halves(fold)
    parts, times = [], []
    for i in range(k):
        train, test = halves(df, i)
        model, seconds = fitted(i) if fitted else timed_fit(estimator, train)
        times.append(seconds)
        keep = [c for c in test.columns if c != fold]
        parts.append(model.transform(test).select(*keep, prediction, F.lit(i).alias(fold)))
    return union_all(parts), times


def cross_validate(
    df: DataFrame, estimator: Estimator, k: int = K.FOLDS, label: str = K.TARGET, name: str = "model", fold: str = "fold",
    halves: Halves | None = None, fitted: Fitted | None = None,
) -> DataFrame:
    """Metrics and fit time of each fold. ``df`` carries its fold column.

    All folds are scored by one grouped aggregate.
    """
    predictions, times = oof_predictions(df, estimator, k, fold, halves, fitted=fitted)
    scored = {r[fold]: r.asDict() for r in regression_metrics(predictions, label, by=[fold]).collect()}
    missing = sorted(set(range(k)) - set(scored))
    if missing:
        raise ValueError(f"folds without rows: {missing}")
    return fold_rows(df.sparkSession, name, [scored[i] for i in range(k)], times)


@dataclass(frozen=True)
class ModelSpec:
    """A model of the sweep: its name, whether it wants scaled numbers, and its estimator, or members and how they combine."""

    name: str
    scaled: bool
    estimator: Estimator | None = None
    members: tuple[ModelSpec, ...] = ()
    options: Mapping[str, object] = field(default_factory=dict)


def model_specs(
    label: str = K.TARGET, rows: int = 1, label_std: float = 1.0, max_iter: int = 100, trees: int = 100, seed: int = K.SEED, depth: int = 10,
    inner_folds: str = "",
) -> list[ModelSpec]:
    """The registry of the sweep, with a vote and a stack of forest, booster and ridge at its end.

    ``rows`` and ``label_std`` describe the training rows: the penalty of ridge
    is one against a sum of squares, so it is 1 / rows against their mean.
    ``depth`` bounds single trees and forests, whose statistics of a level Spark
    keeps in memory. ``inner_folds`` is the stack's fold column, if any.
    """
    cols = {"labelCol": label, "featuresCol": "features"}
    forest = {**cols, "featureSubsetStrategy": "all", "seed": seed, "maxDepth": depth}
    singles = [
        ModelSpec("mean", False, MeanRegressor(label)),
        ModelSpec("ols", True, LinearRegression(**cols)),
        ModelSpec("ridge", True, linear_with_penalty(0.0, 1.0 / rows, label_std, **cols)),
        ModelSpec("lasso", True, linear_with_penalty(1.0, 0.0, label_std, **cols)),
        ModelSpec("elastic_net", True, linear_with_penalty(0.5, 0.5, label_std, **cols)),
        ModelSpec("decision_tree", False, DecisionTreeRegressor(**cols, maxDepth=depth, seed=seed)),
        ModelSpec("random_forest", False, RandomForestRegressor(**forest, numTrees=trees)),
        ModelSpec("bagging", False, RandomForestRegressor(**forest, numTrees=10)),
        ModelSpec("gradient_boosting", False, GBTRegressor(**cols, maxIter=max_iter, maxDepth=3, seed=seed)),
    ]
    chosen = tuple(s for s in singles if s.name in ("ridge", "random_forest", "gradient_boosting"))
    return [*singles, ModelSpec("vote", False, members=chosen), ModelSpec("stack", False, members=chosen, options={"foldCol": inner_folds})]


def specs_for(df: DataFrame, k: int = K.FOLDS, label: str = K.TARGET, **options) -> list[ModelSpec]:
    """The registry, with penalties for the training half of ``df``."""
    n, std = df.agg(F.count(label), F.stddev_pop(label)).first()
    return model_specs(label, rows=max(n * (k - 1) // k, 1), label_std=std or 1.0, **options)


def spec_pipeline(spec: ModelSpec, columns: Sequence[str], variant: str = "target_encoded", label: str = K.TARGET) -> Estimator:
    """The preprocessing a model wants, then the model; members of an ensemble each bring their own."""
    if spec.members:
        members = {m.name: spec_pipeline(m, columns, variant, label) for m in spec.members}
        return ensemble(spec.name, members, label, **spec.options)
    groups = route_columns([c for c in columns if c != "fold"], variant, label)
    return Pipeline(stages=[*preprocessor(groups, spec.scaled, label), spec.estimator])


class SharedFits:
    """The fits of a sweep over folds, each made once.

    A model fitted with some folds left out is the same wherever it is needed:
    on the board, in a vote, as a member of a stack, and inside a stack, where
    leaving out fold a and then b is leaving out b and then a. So is the
    preprocessing of models that want the same one. A fit's seconds are those of
    all its parts, shared or not.
    """

    def __init__(self, df: DataFrame, label: str, variant: str, fold: str):
        self.df, self.label, self.variant, self.fold = df, label, variant, fold
        self.made: dict[tuple, tuple[Model, float]] = {}

    def _rows(self, out: frozenset) -> DataFrame:
        rows = self.df
        for one in sorted(out):
            rows = fold_split(rows, one, self.fold)[0]
        return rows

    def _once(self, key: tuple, make: Callable[[], tuple[Model, float]]) -> tuple[Model, float]:
        if key not in self.made:
            self.made[key] = make()
        return self.made[key]

    def single(self, spec: ModelSpec, out: frozenset) -> tuple[Model, float]:
        """A model without members, fitted on the rows of the other folds."""
        *stages, last = spec_pipeline(spec, self.df.columns, self.variant, self.label).getStages()

        def make() -> tuple[Model, float]:
            before, spent = self._once((spec.scaled, out), lambda: timed_fit(Pipeline(stages=stages), self._rows(out)))
            model, seconds = timed_fit(last, before.transform(self._rows(out)))
            return PipelineModel([*before.stages, model]), spent + seconds
        return self._once((id(spec.estimator), spec.scaled, out), make)

    def fit(self, spec: ModelSpec, i: int) -> tuple[Model, float]:
        """Any model of the sweep, fitted without fold ``i``."""
        out = frozenset([i])
        if not spec.members:
            return self.single(spec, out)
        whole = spec_pipeline(spec, self.df.columns, self.variant, self.label)
        stacks = isinstance(whole, StackingRegressor)
        if any(m.members for m in spec.members) or (stacks and whole.getOrDefault("foldCol") != self.fold):
            return timed_fit(whole, self._rows(out))
        fitted = {m.name: self.single(m, out) for m in spec.members}
        members, spent = {n: f[0] for n, f in fitted.items()}, sum(f[1] for f in fitted.values())
        if not stacks:
            return whole.combined(members), spent
        unseen = []
        for value in inner_folds(self._rows(out), self.fold):
            inner = {m.name: self.single(m, out | {value}) for m in spec.members}
            spent += sum(f[1] for f in inner.values())
            unseen.append(predict_all({n: f[0] for n, f in inner.items()}, fold_split(self._rows(out), value, self.fold)[1]))
        started = time.perf_counter()
        return whole.combined(unseen, members), spent + time.perf_counter() - started


def run_sweep(
    df: DataFrame, specs: Sequence[ModelSpec], k: int = K.FOLDS, label: str = K.TARGET, variant: str = "target_encoded", fold: str = "fold"
) -> DataFrame:
    """Every model on the same folds, best first. Models that share fits take them from each other."""
    shared = SharedFits(df, label, variant, fold)
    folds = [cross_validate(df, spec_pipeline(s, df.columns, variant, label), k, label, s.name, fold, fitted=lambda i, s=s: shared.fit(s, i)) for s in specs]
    return leaderboard(fold_metrics_to_row(union_all(folds)))


def stack(df: DataFrame, members: Mapping[str, Estimator], k: int = K.FOLDS, label: str = K.TARGET, fold: str = "fold", penalty: float = 1.0) -> Model:
    """A stack over the folds that ``df`` brings, or over ``k`` folds by hash."""
    column = fold if fold in df.columns else ""
    return StackingRegressor(members=members, labelCol=label, folds=k, foldCol=column, penalty=penalty).fit(df)


class _ByColumn(CrossValidator):
    """Cross-validation over the folds of a column, checked by one aggregate instead of Python for each row."""

    def _kFold(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        fold, k = F.col(self.getFoldCol()), self.getNumFolds()
        found = {r[0]: r[1] for r in dataset.groupBy(F.when(fold.between(0, k - 1), fold.cast("int")).alias("f")).agg(F.count(F.lit(1))).collect()}
        if set(found) != set(range(k)):
            raise ValueError(f"folds must be 0 to {k - 1}, each with rows; found {found}")
        return [(dataset.where(fold != F.lit(i)), dataset.where(fold == F.lit(i))) for i in range(k)]


def tune(
    estimator: Estimator, df: DataFrame, grid: Sequence[dict], evaluator: Evaluator, folds: int = 3, seed: int = K.SEED,
    fold: str | None = None, parallelism: int = 2,
) -> CrossValidatorModel:
    """Grid search. Entry 0 is always the untuned estimator.

    With ``fold`` the rows bring their folds, so every run sees the same ones.
    """
    maps = [{}, *[m for m in grid if m]]
    kind = CrossValidator if fold is None else _ByColumn
    cv = kind(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds, seed=seed, parallelism=parallelism)
    if fold is not None:
        cv = cv.setFoldCol(fold)
    return cv.fit(df)


def tuning_results(model: CrossValidatorModel, spark: SparkSession) -> DataFrame:
    """Mean and deviation of the metric per grid entry; entry 0 is untuned."""
    rows = [(i, float(m), float(d)) for i, (m, d) in enumerate(zip(model.avgMetrics, model.stdMetrics))]
    return spark.createDataFrame(rows, "entry int, metric_mean double, metric_std double")


def halving(
    estimator: Estimator, df: DataFrame, grid: Sequence[dict], budgets: Sequence[float] = (0.1, 0.3, 1.0), k: int = K.FOLDS, label: str = K.TARGET,
    fold: str = "fold", metric: str = "mae", keep: float = 1 / 3,
) -> tuple[dict, DataFrame]:
    """Successive halving. Returns the best grid entry and the log of all rounds.

    Round r fits what is left of the grid on a share ``budgets[r]`` of each
    fold's training rows, chosen by a hash of the row, and scores on all rows of
    the fold; the best share ``keep`` of the entries goes on. Entry 0 is the
    untuned estimator and goes through every round, so the winner of the last
    one, which should use all rows, has been compared with it. The folds are
    those of ``df`` and the same in every round.
    """
    if not budgets or sorted(budgets) != list(budgets) or not 0 < budgets[0] <= budgets[-1] <= 1:
        raise ValueError("budgets must be rising shares of the rows")
    entries = [{}, *[m for m in grid if m]]
    columns = [c for c in df.columns if c != fold]
    kept = pin(df.withColumn("_place", F.pmod(F.xxhash64(*columns), F.lit(1_000_000)) / 1_000_000.0))
    alive, log = list(range(len(entries))), []
    for turn, share in enumerate(budgets):
        def halves(rows: DataFrame, i: int, share: float = share) -> tuple[DataFrame, DataFrame]:
            train, test = fold_split(rows, i, fold)
            return train.where(F.col("_place") < share).drop("_place"), test.drop("_place")
        scores = {}
        for e in alive:
            folds = cross_validate(kept, estimator.copy(entries[e]), k, label, str(e), fold, halves)
            mean, std, seconds = folds.agg(F.avg(metric), F.stddev_pop(metric), F.sum("fit_time_s")).first()
            scores[e] = mean
            log.append((turn, float(share), e, float(mean), float(std), k, float(seconds)))
        ranked = sorted(alive, key=lambda e: (scores[e], e))
        best = ranked[0]
        alive = sorted({0, *ranked[:max(1, round(len(ranked) * keep))]})
    table = df.sparkSession.createDataFrame(log, "round int, budget double, entry int, metric_mean double, metric_std double, fits int, fit_time_s double")
    return entries[best], table


def evaluate_model(model: Model, df: DataFrame, label: str, task: str = "regression") -> DataFrame:
    """One row of metrics: rmse, r2, mae, or auc, accuracy, precision, recall."""
    predictions = model.transform(df)
    if task == "regression":
        return regression_metrics(predictions, label).select("rmse", "r2", "mae")
    if task != "classification":
        raise ValueError(f"unknown task: {task}")
    scored = pin(predictions.select(label, "prediction", "rawPrediction"))
    multi = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction")
    row = (
        BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction").evaluate(scored),
        *[multi.evaluate(scored, {multi.metricName: m}) for m in ("accuracy", "weightedPrecision", "weightedRecall")],
    )
    return df.sparkSession.createDataFrame([row], "auc double, accuracy double, precision double, recall double")


def feature_importance(model: PipelineModel, transformed: DataFrame, features: str = "features") -> DataFrame:
    """Importance per feature, highest first, named from the vector's metadata."""
    final = model.stages[-1] if hasattr(model, "stages") else model
    if not hasattr(final, "featureImportances"):
        raise ValueError(f"{type(final).__name__} has no feature importances")
    attrs = transformed.schema[features].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    weights = final.featureImportances
    rows = [(names.get(i, f"feature {i}"), float(weights[i])) for i in range(weights.size)]
    table = transformed.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def score_sealed(
    estimator: Estimator, train: DataFrame, sets: Mapping[str, DataFrame], label: str = K.TARGET, groups: Mapping[str, str] | None = None
) -> DataFrame:
    """Fit once, then metrics of each sealed set, and per label of a set's group column.

    Only numbers come back: a row per set (``grp`` NULL) and per label.
    """
    groups = dict(groups or {})
    started = time.perf_counter()
    model = estimator.fit(train)
    seconds = time.perf_counter() - started
    parts = []
    for name, df in sets.items():
        grp = F.col(groups[name]).cast("string") if name in groups else F.lit(None).cast("string")
        parts.append(model.transform(df).select(F.lit(name).alias("set"), grp.alias("grp"), label, "prediction"))
    predictions = union_all(parts)
    whole = regression_metrics(predictions, label, by=["set"]).withColumn("grp", F.lit(None).cast("string"))
    labelled = regression_metrics(predictions.where(F.col("grp").isNotNull()), label, by=["set", "grp"])
    return whole.unionByName(labelled).withColumn("fit_time_s", F.lit(seconds))


def ablation(
    df: DataFrame, make: Callable[[Sequence[str]], Estimator], column: str, k: int = K.FOLDS, label: str = K.TARGET, fold: str = "fold"
) -> DataFrame:
    """Mean metrics with and without one column on the same rows and folds, and the gap."""
    without = df.drop(column)
    rows = union_all([
        cross_validate(d, make([c for c in d.columns if c not in (label, fold)]), k, label, name, fold)
        for name, d in (("with", df), ("without", without))
    ])
    board = fold_metrics_to_row(rows)
    gap = {
        f"{m}_gap": F.max(F.when(F.col("model") == "without", F.col(f"{m}_mean"))) - F.max(F.when(F.col("model") == "with", F.col(f"{m}_mean")))
        for m in METRICS
    }
    gaps = board.agg(*[e.alias(n) for n, e in gap.items()])
    return board.withColumns({n: gaps.select(n).scalar() for n in gap})


def regression_evaluator(label: str = K.TARGET, metric: str = "mae") -> RegressionEvaluator:
    """The evaluator of the tuning runs."""
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)

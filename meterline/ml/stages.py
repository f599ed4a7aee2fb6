"""Spark ML stages: column routing, encoders, scaling, and whole pipelines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, TargetEncoder, VectorAssembler, VectorSlicer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..session import deal

VARIANTS = ("target_encoded", "dropped", "out_of_fold")


@dataclass(frozen=True)
class ColumnGroups:
    """Where each column of a frame goes; ``unknown`` ones go nowhere."""

    one_hot: list[str]
    target_encoded: list[str]
    numeric: list[str]
    unknown: list[str]


def route_columns(columns: Sequence[str], variant: str = "target_encoded", label: str = K.TARGET) -> ColumnGroups:
    """Sort columns into groups by allowlist, each group in name order.

    The corridor is target-encoded by the pipeline, left out, or read as the
    number an out-of-fold encoding produced, depending on the variant.
    """
    if variant not in VARIANTS:
        raise ValueError(f"unknown variant: {variant}; expected one of {VARIANTS}")
    present = set(columns) - {label}
    encoded = {f"{c}_te" for c in K.TARGET_ENCODED_FEATURES} if variant == "out_of_fold" else set()
    numeric = present & ({*K.NUMERIC_FEATURES, *K.BINARY_FEATURES} | encoded)
    one_hot = present & set(K.ONE_HOT_FEATURES)
    corridor = present & set(K.TARGET_ENCODED_FEATURES)
    ignored = corridor | ({"oof_fold"} if variant == "out_of_fold" else set())
    unknown = present - numeric - one_hot - ignored
    used = corridor if variant == "target_encoded" else set()
    return ColumnGroups(sorted(one_hot), sorted(used), sorted(numeric), sorted(unknown))


def _named(cols: Sequence[str], suffix: str) -> list[str]:
    return [f"{c}_{suffix}" for c in cols]


def index_stages(cols: Sequence[str], order: str = "frequencyDesc") -> list[StringIndexer]:
    """Number the levels of all columns in one pass; unseen levels share one further number."""
    if not cols:
        return []
    return [StringIndexer(inputCols=list(cols), outputCols=_named(cols, "idx"), handleInvalid="keep", stringOrderType=order)]


class DropLastSlot(Estimator):
    """Cut the last slot off a one-hot vector once its width is known."""

    def __init__(self, input_col: str, output_col: str):
        super().__init__()
        self.input_col, self.output_col = input_col, output_col

    def _fit(self, dataset: DataFrame) -> VectorSlicer:
        width = dataset.schema[self.input_col].metadata["ml_attr"]["num_attrs"]
        return VectorSlicer(inputCol=self.input_col, outputCol=self.output_col, indices=list(range(max(width - 1, 1))))


def ohe_stages(cols: Sequence[str], drop_first: bool = False) -> list:
    """M6: index and one-hot encode; unseen levels are kept, not refused.

    Trees get a slot per level and one for unseen levels. Linear models drop the
    first level by name, so the slots are not collinear: levels are numbered in
    descending order, the encoder drops the slot of unseen levels, and the slot
    before it, the first level's, is cut off. Unseen levels are then all zero.
    """
    if not cols:
        return []
    index, hot = _named(cols, "idx"), _named(cols, "ohe")
    if not drop_first:
        return [*index_stages(cols), OneHotEncoder(inputCols=index, outputCols=hot, dropLast=False)]
    slots = _named(cols, "slots")
    encoder = OneHotEncoder(inputCols=index, outputCols=slots, dropLast=True)
    return [*index_stages(cols, "alphabetDesc"), encoder, *[DropLastSlot(a, b) for a, b in zip(slots, hot)]]


def target_encoder_stage(col: str, label: str = K.TARGET, smoothing: float = K.SMOOTHING) -> TargetEncoder:
    """M4: smoothed target mean of an indexed column; unseen levels get the overall mean."""
    return TargetEncoder(
        inputCol=f"{col}_idx", outputCol=f"{col}_te_raw", labelCol=label,
        targetType="continuous", handleInvalid="keep", smoothing=smoothing,
    )


def demote_nominal(cols: Sequence[str]) -> SQLTransformer:
    """M5: copy encoded columns as plain numbers, without category metadata.

    A tree would otherwise take the encoded mean for a category code.
    """
    copies = ", ".join(f"`{c}_te_raw` * 1.0 AS `{c}_te`" for c in cols)
    return SQLTransformer(statement=f"SELECT *, {copies} FROM __THIS__")


def preprocessor(groups: ColumnGroups, scaled: bool = False, label: str = K.TARGET, smoothing: float = K.SMOOTHING) -> list:
    """M7: stages up to the ``features`` vector; ``scaled`` standardises the numbers."""
    stages = [*ohe_stages(groups.one_hot, drop_first=scaled)]
    numeric = list(groups.numeric)
    if groups.target_encoded:
        stages += [*index_stages(groups.target_encoded), *[target_encoder_stage(c, label, smoothing) for c in groups.target_encoded]]
        stages.append(demote_nominal(groups.target_encoded))
        numeric += [f"{c}_te" for c in groups.target_encoded]
    hot = [f"{c}_ohe" for c in groups.one_hot]
    if not scaled:
        return [*stages, VectorAssembler(inputCols=[*numeric, *hot], outputCol="features")]
    return [
        *stages,
        VectorAssembler(inputCols=numeric, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="standardised", withMean=True, withStd=True),
        VectorAssembler(inputCols=["standardised", *hot], outputCol="features"),
    ]


def gbt_pipeline(
    columns: Sequence[str],
    variant: str = "target_encoded",
    label: str = K.TARGET,
    max_iter: int = 100,
    max_depth: int = 5,
    smoothing: float = K.SMOOTHING,
    seed: int = K.SEED,
) -> tuple[Pipeline, ColumnGroups]:
    """M9: the gradient-boosting pipeline for a frame, and how its columns were routed."""
    groups = route_columns(columns, variant, label)
    model = GBTRegressor(labelCol=label, featuresCol="features", maxIter=max_iter, maxDepth=max_depth, seed=seed)
    return Pipeline(stages=[*preprocessor(groups, False, label, smoothing), model]), groups


class MeanModel(Model, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Predicts one number for every row."""

    mean = Param(Params._dummy(), "mean", "the number", TypeConverters.toFloat)

    def __init__(self, mean: float = 0.0):
        super().__init__()
        self._set(mean=mean)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getPredictionCol(), F.lit(self.getOrDefault("mean")))


class MeanRegressor(Estimator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """The mean of the label: the floor every model is compared with."""

    def __init__(self, label: str = K.TARGET, prediction: str = "prediction"):
        super().__init__()
        self._set(labelCol=label, predictionCol=prediction)

    def _fit(self, dataset: DataFrame) -> MeanModel:
        mean = dataset.agg(F.avg(self.getLabelCol())).first()[0]
        model = MeanModel(mean)
        return model._set(predictionCol=self.getPredictionCol())


REGRESSORS = {"rf": RandomForestRegressor, "gbt": GBTRegressor, "linear": LinearRegression}
CLASSIFIERS = {"rf": RandomForestClassifier, "gbt": GBTClassifier, "logistic": LogisticRegression}


def create_ml_pipeline(features: Sequence[str], target: str, model: str = "rf", task: str = "regression") -> Pipeline:
    """Assemble, scale, and fit one model of the named kind."""
    tasks = {"regression": REGRESSORS, "classification": CLASSIFIERS}
    if task not in tasks:
        raise ValueError(f"unknown task: {task}")
    if model not in tasks[task]:
        raise ValueError(f"unknown {task} model: {model}; expected one of {sorted(tasks[task])}")
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled_features"),
        tasks[task][model](featuresCol="scaled_features", labelCol=target),
    ])


TREES = (DecisionTreeRegressor, RandomForestRegressor, GBTRegressor, RandomForestClassifier, GBTClassifier)


def fit(estimator: Estimator, df: DataFrame) -> Model:
    """Fit; trees get their rows prepared once, cut to the columns they read, and dealt.

    Trees read the rows three times before they keep them in memory, many times
    as large as in the files, one block for each task; tasks over files would
    grow with the table. The stages before the tree run once for all of that.
    """
    stages = estimator.getStages() if isinstance(estimator, Pipeline) else [estimator]
    if not stages or not isinstance(stages[-1], TREES):
        return estimator.fit(df)
    *before, tree = stages
    prepared = Pipeline(stages=before).fit(df)
    rows = deal(prepared.transform(df).select(*tree_columns(tree))).persist(StorageLevel.DISK_ONLY)
    try:
        model = tree.fit(rows)
    finally:
        rows.unpersist()
    return PipelineModel([*prepared.stages, model]) if isinstance(estimator, Pipeline) else model


def tree_columns(tree: Estimator) -> list[str]:
    """The columns that fitting a tree reads."""
    named = (tree.getParam(n) for n in ("featuresCol", "labelCol", "weightCol", "validationIndicatorCol") if tree.hasParam(n))
    return sorted({tree.getOrDefault(p) for p in named if tree.isDefined(p) and tree.getOrDefault(p)})

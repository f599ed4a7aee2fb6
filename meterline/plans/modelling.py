"""The modelling jobs: parts and sweep, diagnosis of cross-validated predictions, and the one sealed score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..ml.evaluation import ModelSpec, oof_predictions, run_sweep, score_sealed
from ..operators.metrics import regression_metrics
from ..operators.splits import carve_holdout, carve_temporal
from ..session import pin
from ..sources.writers import ScoreExists, write_leaderboard, write_score_once, write_train_split


def model_parts(
    sample: DataFrame, cutoff: str, time: str = "pickup_datetime", fraction: float = K.HOLDOUT_FRACTION,
    strata: Sequence[str] = K.STRATA, key: Sequence[str] | None = None,
) -> DataFrame:
    """Every row of the sample with its ``part``: temporal from the cutoff on, else holdout or train."""
    before, sealed = carve_temporal(sample, cutoff, time)
    return pin(carve_holdout(before, fraction, strata, key).unionByName(sealed.withColumn("part", F.lit("temporal"))))


def part_sizes(parts: DataFrame) -> DataFrame:
    """One row with the rows of the sample and of each part, as ``verify_carve_table`` reads them."""
    sizes = [F.count_if(F.col("part") == name).alias(name) for name in ("temporal", "holdout", "train")]
    return parts.agg(F.count(F.lit(1)).alias("sample"), *sizes)


def sweep_job(parts: DataFrame, specs: Sequence[ModelSpec], out: str, k: int = K.FOLDS, label: str = K.TARGET, variant: str = "target_encoded") -> DataFrame:
    """Write the train split, run every model over its folds, write and return the leaderboard.

    ``parts`` carries features, label, fold and part.
    """
    train = parts.where(F.col("part") == "train").drop("part")
    write_train_split(train, f"{out}/train", label)
    kept = parts.sparkSession.read.schema(train.select(*[c for c in train.columns if c != label], label).schema).parquet(f"{out}/train")
    board = pin(run_sweep(kept, specs, k, label, variant))
    write_leaderboard(board, f"{out}/leaderboard")
    return board


def diagnose(df: DataFrame, estimator: Estimator, slices: Sequence[str], k: int = K.FOLDS, label: str = K.TARGET, fold: str = "fold") -> DataFrame:
    """Metrics of out-of-fold predictions for every value of each slice column.

    One pass: each prediction is grouped under all slices at once.
    """
    predictions, _ = oof_predictions(df, estimator, k, fold)
    entries = F.array(*[F.struct(F.lit(s).alias("slice"), F.col(s).cast("string").alias("value")) for s in slices])
    long = predictions.select(F.explode(entries).alias("s"), label, "prediction").select("s.slice", "s.value", label, "prediction")
    return regression_metrics(long, label, by=["slice", "value"])


def score_job(parts: DataFrame, estimator: Estimator, path: str, label: str = K.TARGET, groups: Mapping[str, str] | None = None) -> DataFrame:
    """Fit on the train part, score holdout and temporal once, and write the scores.

    A second run is refused before anything is read or fitted.
    """
    spark = parts.sparkSession
    there = spark.read.format("binaryFile").option("ignoreMissingFiles", True)
    try:
        there.load(path).limit(1)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    else:
        raise ScoreExists(f"{path} exists; read it instead of scoring again")
    sets = {name: parts.where(F.col("part") == name) for name in ("holdout", "temporal")}
    scores = pin(score_sealed(estimator, parts.where(F.col("part") == "train"), sets, label, groups))
    write_score_once(scores, path)
    return scores

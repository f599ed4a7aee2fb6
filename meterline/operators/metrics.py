"""Regression metrics, leaderboards and model choice as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

METRICS = ("mae", "rmse", "r2")


def regression_metrics(df: DataFrame, y: str = "label", yhat: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Rows, MAE, RMSE and R2 of a prediction table, per group if asked."""
    error = F.col(y) - F.col(yhat)
    scored = df.where(error.isNotNull())
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(F.lit(1)))).alias("r2"),
    )


def fold_metrics_to_row(folds: DataFrame, by: str = "model") -> DataFrame:
    """Mean and population deviation over folds, one row per model.

    No folds at all, or a fold without a metric or fit time, is an error.
    """
    needed = [*METRICS, "fit_time_s"]
    missing = F.count_if(F.greatest(*[F.col(c).isNull() for c in needed]))
    stats = []
    for m in METRICS:
        stats += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    rows = folds.groupBy(by).agg(*stats, F.avg("fit_time_s").alias("fit_time_s"), missing.alias("_missing"))
    stop = F.raise_error(F.concat(F.lit("incomplete folds of "), F.col(by))).cast("double")
    checked = rows.withColumn("fit_time_s", F.when(F.col("_missing") > 0, stop).otherwise(F.col("fit_time_s")))
    # A row that exists only to fail where there are no folds.
    none = folds.agg(F.count(F.lit(1)).alias("_folds")).where("_folds = 0")
    failed = none.select(*[F.raise_error(F.lit("no folds")).cast(kind).alias(c) for c, kind in checked.drop("_missing").dtypes])
    return checked.drop("_missing").unionByName(failed)


def fold_rows(spark, model: str, metrics: Sequence[dict], fit_times: Sequence[float]) -> DataFrame:
    """Fold results measured on the driver (a few numbers per fold) as a table, one row per metric and fit time."""
    rows = [(model, i, *[float(m[k]) for k in METRICS], float(t)) for i, (m, t) in enumerate(zip(metrics, fit_times, strict=True))]
    return spark.createDataFrame(rows, "model string, fold int, mae double, rmse double, r2 double, fit_time_s double")


def leaderboard(rows: DataFrame) -> DataFrame:
    """Models by mean RMSE, best first."""
    return rows.orderBy("rmse_mean", "model")


def vote(df: DataFrame, members: Sequence[str], out: str = "prediction") -> DataFrame:
    """Mean of the members' predictions."""
    total = F.col(members[0])
    for m in members[1:]:
        total = total + F.col(m)
    return df.withColumn(out, total / F.lit(float(len(members))))


def slice_mae(df: DataFrame, group: str, y: str = "label", yhat: str = "prediction") -> DataFrame:
    """Rows and MAE per group, in group order."""
    return (
        df.groupBy(group)
        .agg(F.count(F.lit(1)).alias("rows"), F.avg(F.abs(F.col(y) - F.col(yhat))).alias("mae"))
        .orderBy(group)
    )


def pick_champion(rows: DataFrame) -> DataFrame:
    """The lower MAE wins; inside the larger deviation, the faster fit.

    Compares exactly two leaderboard rows; any other number is an error. Both
    rows fold into one aggregate, sorted by MAE (ties by name).
    """
    entry = F.struct("mae_mean", "model", "mae_std", "fit_time_s")
    two = rows.agg(F.min(entry).alias("lo"), F.max(entry).alias("hi"), F.count(F.lit(1)).alias("n"))
    two = two.withColumn("n", F.when(F.col("n") == 2, F.col("n")).otherwise(
        F.raise_error(F.concat(F.lit("two models expected, got "), F.col("n").cast("string"))).cast("bigint")
    ))
    gap = F.col("hi.mae_mean") - F.col("lo.mae_mean")
    larger = F.greatest("lo.mae_std", "hi.mae_std")
    faster = F.when(F.col("lo.fit_time_s") <= F.col("hi.fit_time_s"), F.col("lo.model")).otherwise(F.col("hi.model"))
    return two.where(F.col("n") == 2).select(
        F.when(gap <= larger, faster).otherwise(F.col("lo.model")).alias("champion"),
        F.col("lo.model").alias("lower_mae"),
        gap.alias("gap"),
        larger.alias("larger_std"),
        (gap <= larger).alias("inside_std"),
    )

"""Exact quantiles and running totals without collecting a group in one task.

The rows of a group are first counted per distinct value; copies combine on the
map side. The histogram is then range-sorted by value over as many partitions
as the shuffle setting asks for, whatever the distribution, and written once.
Running counts need one short window over a group's totals per partition, and
one inside each partition. NULL is a group like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import pin

def value_histogram(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per distinct (keys, value), NULL values left out."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def with_bucket(hist: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Keep the histogram, range-sorted, and add ``_bucket``: the number of its partition, in the order of values.

    Ranges end between values, or between the keys of one value, so few values
    with many keys still make many ranges; for each key the order is right.
    """
    return pin(hist.repartitionByRange(value, *keys).withColumn("_bucket", F.spark_partition_id()))


def _same(keys: Sequence[str]) -> Column:
    """Whether a row belongs to the keys renamed by ``_renamed``."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_of_{k}" for k in keys})


def bucket_offsets(bucketed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per (keys, bucket): rows, rows before it, and rows of the group."""
    per_bucket = bucketed.groupBy(*keys, "_bucket").agg(F.sum("n").alias("_in_bucket"))
    group = Window.partitionBy(*keys)
    before = F.sum("_in_bucket").over(group.orderBy("_bucket")) - F.col("_in_bucket")
    return per_bucket.withColumns({"_before": before, "_total": F.sum("_in_bucket").over(group)})


def running_total(hist: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """H4, H5: histogram with ``cum_n`` (running) and ``tot`` (group) counts."""
    bucketed = with_bucket(hist, value, keys)
    keys = [*keys, "_bucket"]
    joined = bucketed.join(_renamed(bucket_offsets(bucketed, keys[:-1]), keys), _same(keys))
    inside = Window.partitionBy(*keys).orderBy(value)
    return joined.select(
        *keys[:-1], value, "n",
        (F.col("_before") + F.sum("n").over(inside)).alias("cum_n"),
        F.col("_total").alias("tot"),
    )


def quantiles_from_histogram(
    hist: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    interpolate: bool = False,
) -> DataFrame:
    """One row per group with a column per named probability, and ``tot``.

    Discrete: the smallest value whose running count reaches ``p * total``.
    Interpolated: linear between the two values around ``p * (total - 1)``.
    """
    keys = list(keys)
    bucketed = with_bucket(hist, value, keys)
    offsets = bucket_offsets(bucketed, keys)

    def wanted(p: float) -> list[Column]:
        if not interpolate:
            return [F.greatest(F.ceil(F.lit(float(p)) * F.col("_total")), F.lit(1)).cast("bigint")]
        position = F.lit(float(p)) * (F.col("_total") - 1)
        return [(F.floor(position) + 1).cast("bigint"), (F.ceil(position) + 1).cast("bigint")]

    ranks = F.array(*[
        F.struct(F.lit(i).alias("prob"), F.lit(side).alias("side"), rank.alias("rank"))
        for i, p in enumerate(probs.values())
        for side, rank in enumerate(wanted(p))
    ])
    # Only buckets that hold a wanted rank survive; at most 2 * len(probs) per group.
    targets = (
        offsets.withColumn("_ranks", F.filter(
            ranks,
            lambda r: (r["rank"] > F.col("_before")) & (r["rank"] <= F.col("_before") + F.col("_in_bucket")),
        ))
        .where(F.size("_ranks") > 0)
        .select(*keys, "_bucket", "_before", "_total", "_ranks")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(value)
    upper = F.col("_before") + F.sum("n").over(inside)
    hits = (
        bucketed.join(_renamed(targets, [*keys, "_bucket"]), _same([*keys, "_bucket"]))
        .withColumn("_upper", upper)
        .withColumn("_hit", F.explode(F.filter(
            F.col("_ranks"),
            lambda r: (r["rank"] > F.col("_upper") - F.col("n")) & (r["rank"] <= F.col("_upper")),
        )))
    )
    picked = hits.groupBy(*keys).agg(
        F.first("_total").alias("tot"),
        *[
            F.max(F.when((F.col("_hit.prob") == i) & (F.col("_hit.side") == s), F.col(value))).alias(f"_v{i}_{s}")
            for i in range(len(probs))
            for s in range(2 if interpolate else 1)
        ],
    )
    out = []
    for i, (name, p) in enumerate(probs.items()):
        if not interpolate:
            out.append(F.col(f"_v{i}_0").alias(name))
            continue
        position = F.lit(float(p)) * (F.col("tot") - 1)
        fraction = position - F.floor(position)
        low, high = F.col(f"_v{i}_0").cast("double"), F.col(f"_v{i}_1").cast("double")
        out.append((low + (high - low) * fraction).alias(name))
    return picked.select(*keys, *out, "tot")


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], interpolate: bool = False
) -> DataFrame:
    """Exact quantiles of ``value`` per group; see ``quantiles_from_histogram``."""
    return quantiles_from_histogram(value_histogram(df, keys, value), keys, value, probs, interpolate)

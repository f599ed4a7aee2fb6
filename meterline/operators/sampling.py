"""Top rows and samples, random and reproducible."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import STRATA
from ..session import pin

BUCKETS = 1 << 20


def md5_bucket(text: Column, buckets: int) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of an md5."""
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def top_by(df: DataFrame, col: str, n: int, tie: Sequence[str]) -> DataFrame:
    """The n largest rows by ``col``, ties in order of ``tie``."""
    return df.orderBy(F.desc_nulls_last(col), *tie).limit(n)


def top_groups(df: DataFrame, keys: Sequence[str], n: int, fare: str = "fare_capped") -> DataFrame:
    """The n groups with most rows, with their mean fare; ties by key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("trips"), F.avg(fare).alias("avg_fare"))
    return counts.orderBy(F.desc("trips"), *keys).limit(n)


def top_zones(df: DataFrame, n: int = 10) -> DataFrame:
    """Busiest pickup zones."""
    return top_groups(df, ["pickup_zone", "pickup_borough"], n)


def top_corridors(df: DataFrame, n: int = 15) -> DataFrame:
    """Busiest zone pairs."""
    return top_groups(df, ["pickup_zone", "dropoff_zone"], n)


def sample_fraction(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Each row with probability ``fraction``."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_n(df: DataFrame, n: int, seed: int | None = None, key: str | None = None) -> DataFrame:
    """I4: n rows in random order, or, with ``key``, in md5 order of the key."""
    if key is not None:
        return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
    return df.withColumn("_rand", F.rand(seed)).orderBy("_rand").limit(n).drop("_rand")


def stratum(strata: Sequence[str]) -> Column:
    """Name of a row's stratum."""
    return F.concat_ws("|", *strata)


def stratified_sample(
    df: DataFrame,
    fraction: float | Mapping[str, float],
    seed: int,
    strata: Sequence[str] = STRATA,
) -> DataFrame:
    """Random sample with a fraction per stratum.

    A mapping names strata as ``service|band``; strata it leaves out give no
    rows. One number is the fraction of every stratum: then each row is an
    independent draw, and no list of strata has to be collected first.
    """
    if isinstance(fraction, Mapping):
        return df.withColumn("_stratum", stratum(strata)).sampleBy("_stratum", dict(fraction), seed).drop("_stratum")
    return df.withColumn("_rand", F.rand(seed)).where(F.col("_rand") < fraction).drop("_rand")


def hash_stratified_sample(df: DataFrame, fraction: float, salt: str = "", key: str = "tripid") -> DataFrame:
    """Rows whose salted key hashes below ``fraction``; the same on any engine.

    The hash does not depend on the stratum, so every stratum is sampled alike.
    """
    if 0 < fraction < 1 / BUCKETS:
        raise ValueError(f"a fraction below {1 / BUCKETS:g} is finer than the hash")
    text = F.concat(F.lit(salt), F.col(key).cast("string"))
    return df.where(md5_bucket(text, BUCKETS) < F.lit(int(fraction * BUCKETS)))


def nested_sample(df: DataFrame, outer: float, inner: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """A sample, and a sample of that sample drawn with ``seed + 1``.

    The outer sample is kept in the shared folder, so the inner one is a subset
    of the rows that were actually drawn.
    """
    full = pin(stratified_sample(df, outer, seed))
    return full, stratified_sample(full, inner, seed + 1)


def limit_rows(df: DataFrame, n: int, order: Sequence[str] = ()) -> DataFrame:
    """I8: n rows; the first in ``order`` when given."""
    return (df.orderBy(*order) if order else df).limit(n)

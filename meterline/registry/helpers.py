"""Small helpers of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles and decimals as doubles rounded for comparison across engines."""
    numeric = [n for n, t in df.dtypes if t == "double" or t.startswith("decimal")]
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) + F.lit(0.0) for n in numeric})

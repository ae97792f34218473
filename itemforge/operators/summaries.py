"""Counts and rates over enriched items (map-side combined, one small shuffle each)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def match_rate(df: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """Rows, rows whose text is neither null nor empty, and the rate in per cent; an empty input gives no group."""
    hit = F.count(F.when(text != "", F.lit(1)))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        hit.alias("n_matched"),
        F.round(F.lit(100.0) * hit / F.count(F.lit(1)), 4).alias("pct"),
    )

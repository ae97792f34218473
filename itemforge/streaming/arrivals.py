"""Item rows that arrive over time: repeated loads collapse while they stream in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _timed(arrivals: DataFrame, loaded: str, late: str) -> DataFrame:
    """Watermarks need a time with a zone; times without one are taken in the session's zone."""
    return arrivals.withColumn(loaded, F.col(loaded).cast("timestamp")).withWatermark(loaded, late)


def distinct_loads(arrivals: DataFrame, key: list[str], loaded: str, late: str = "30 days") -> DataFrame:
    """Rows of a stream without those whose key already came within the watermark; state is dropped behind it.

    Rows without a load time never leave the state and are kept as they come.
    """
    return _timed(arrivals, loaded, late).dropDuplicatesWithinWatermark(key)


def load_counts(arrivals: DataFrame, loaded: str, window: str = "7 days", late: str = "30 days") -> DataFrame:
    """Rows by load window and area, final once the watermark has passed the window."""
    timed = _timed(arrivals, loaded, late)
    return timed.groupBy(F.window(loaded, window).alias("w"), "SG_AREA").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("inicio"), "SG_AREA", "n")

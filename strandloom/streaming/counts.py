"""Counts over unbounded inputs. The batch operators without windows also run on streams as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(stream: DataFrame, time: str, keys: list[str], window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows per key and tumbling window; state older than the watermark is dropped."""
    out = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, window).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("from"), F.col("w.end").alias("to"), *keys, "n")

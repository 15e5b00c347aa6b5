"""Partitioned sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorqc.plans.chunks import time_chunk


def write_series(df: DataFrame, path: str, keys=("site", "parameter"), time: str = "dt_round", chunk_seconds: int = 31_536_000, mode: str = "overwrite") -> None:
    """Parquet per series; a year (by default) of one series is one task, so a hot series is split."""
    df.repartition(*keys, time_chunk(time, chunk_seconds)).write.mode(mode).partitionBy(*keys).parquet(path)


def write_site_csv(df: DataFrame, path: str, time: str = "dt_round", pattern: str = "yyyy/MM/dd HHmm", chunk_seconds: int = 31_536_000) -> None:
    spread = df.repartition("site", time_chunk(time, chunk_seconds))
    spread.withColumn(time, F.date_format(time, pattern)).write.mode("overwrite").option("header", "true").partitionBy("site").csv(path)


def append_history(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """History plus new rows, exact copies once."""
    return history.unionByName(incoming).distinct()

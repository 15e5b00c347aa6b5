"""Incremental batch updates: high-water marks, the 24-hour overlap and restated tails."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorqc.functions import time as tm
from sensorqc.plans.chunks import carry_series
from sensorqc.series import Series
from sensorqc.session import materialise

OVERLAP = 24 * 3600


def high_water_marks(df: DataFrame, time: str = "dt_round", keys=("site", "parameter")) -> DataFrame:
    """Earliest of the series' last slots per site: where the next pull starts."""
    last = df.groupBy(*keys).agg(F.max(time).alias("_last"))
    return last.groupBy("site").agg(F.min("_last").alias("pull_from"))


def _last_slots(df: DataFrame, spec: Series) -> DataFrame:
    return df.groupBy(*spec.keys).agg(F.max(spec.time).alias("_last"))


def overlap_combine(history: DataFrame, incoming: DataFrame, spec: Series, fill: list[str], overlap: int = OVERLAP) -> DataFrame:
    """Tail of the history plus the new rows; state columns are carried into the new rows."""
    tail = history.join(_last_slots(history, spec), list(spec.keys))
    tail = tail.filter(F.col(spec.time) >= tm.shift("_last", -overlap)).drop("_last").withColumn("historical", F.lit(True))
    marked = incoming.withColumn("historical", F.lit(False))
    new = marked.join(tail.select(*spec.keys, spec.time), [*spec.keys, spec.time], "left_anti")
    both = materialise(tail.unionByName(new, allowMissingColumns=True), "overlap")  # read twice
    return carry_series(both, spec, fills={c: F.col(c) for c in fill})


def restate_tail(history: DataFrame, reflagged: DataFrame, spec: Series, overlap: int = OVERLAP) -> DataFrame:
    """History before the overlap plus the re-flagged rows; series without new rows stay whole."""
    touched = reflagged.select(*spec.keys).distinct().withColumn("_hit", F.lit(True))
    h = history.join(_last_slots(history, spec), list(spec.keys)).join(touched, list(spec.keys), "left")
    old = h.filter(F.col("_hit").isNull() | (F.col(spec.time) < tm.shift("_last", -overlap))).drop("_last", "_hit")
    return old.unionByName(reflagged, allowMissingColumns=True)


def split_late(incoming: DataFrame, history: DataFrame, time: str, keys=("site",), overlap: int = OVERLAP) -> DataFrame:
    """Marks rows older than the overlap, which are not flagged again."""
    last = history.groupBy(*keys).agg(F.max(time).alias("_last"))
    d = incoming.join(last, list(keys), "left")
    return d.withColumn("is_late", F.coalesce(F.col(time) < tm.shift("_last", -overlap), F.lit(False))).drop("_last")

"""Replies of a station service: JSON with lists of lists, one reply per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: What is read of a reply; other fields are skipped.
SCHEMA = """
stationSummaries array<struct<
  id:string, numId:string, name:string, elevation:double, latitude:double, longitude:double,
  dataTypes:array<struct<name:string>>,
  ts:array<struct<data:array<struct<dt:string,v:string,f:string>>>>>>,
_broken string
"""

# Sensor name in the reply -> (parameter, factor to its unit).
SENSORS = {"Precip": ("p_cm", 2.54), "DischargeRiver": ("q_cfs", 1.0)}

STATION = ("id", "numId", "name", "elevation", "latitude", "longitude")


def parse_replies(df: DataFrame, body: str = "body") -> DataFrame:
    """``df`` with ``station`` (the first summary, null if the reply has none) and ``is_broken`` for bodies that aren't JSON of this shape."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    d = df.withColumn("_reply", F.from_json(body, SCHEMA, options))
    broken = F.col(body).isNotNull() & (F.col("_reply").isNull() | F.col("_reply._broken").isNotNull())
    station = F.when(~broken, F.get("_reply.stationSummaries", F.lit(0)))
    return d.withColumns({"station": station, "is_broken": broken}).drop("_reply")


def sensor_data(name: str) -> Column:
    """The readings of a sensor: its place among the station's distinct sensor names is its place in the list of series."""
    place = F.array_position(F.array_distinct(F.transform("station.dataTypes", lambda x: x["name"])), name) - 1
    return F.when(place >= 0, F.get("station.ts", place.cast("int"))["data"])


def station_series(df: DataFrame, body: str = "body", sensors: dict[str, tuple[str, float]] = SENSORS) -> DataFrame:
    """One row per reading of the wanted sensors: the columns of ``df`` but the body, station fields, ts, parameter, value, flag.

    Stations without a sensor, empty lists and broken replies give no rows (``parse_replies`` tells them apart);
    times and numbers that can't be read are null.
    """
    d = parse_replies(df, body)

    def series(sensor: str, parameter: str, factor: float) -> Column:
        return F.transform(sensor_data(sensor), lambda x: F.struct(F.lit(parameter).alias("parameter"), F.lit(factor).alias("factor"), x.alias("x")))

    rows = F.flatten(F.array_compact(F.array(*[series(n, p, k) for n, (p, k) in sensors.items()])))
    keep = [c for c in df.columns if c != body]
    d = d.select(*keep, *[F.col("station")[c].alias(f"station_{c}") for c in STATION], F.explode(rows).alias("_r"))
    return d.select(
        *keep,
        *[f"station_{c}" for c in STATION],
        F.try_to_timestamp("_r.x.dt", F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
        F.col("_r.parameter").alias("parameter"),
        (F.col("_r.x.v").try_cast("double") * F.col("_r.factor")).alias("value"),
        F.col("_r.x.f").alias("flag"),
    )

"""Headline timings on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorqc import Series, catalog
from sensorqc.operators import flags as fl, thresholds as th
from sensorqc.session import build_session, materialise

HEADLINE = [
    "g01_slot_agg",
    "g02_pad_grid",
    "g05_rolling7",
    "g10_interpolate_gap",
    "j04_ffill_state",
    "j16_asof_join",
    "f17_anomaly_window",
    "f18_rolling_r2",
    "f28_network_check",
    "f33_flag_pass",
    "t06_thresholds",
    "c09_final_value",
    "d06_range_selection",
    "d16_stitch",
    "v01_weekly_decision",
    "v02_box_decision",
    "p01_lineage",
    "p10_wide_publish",
    "r01_flag_report",
    "r04_down_days",
    "r08_summary_statistics",
    "r18_storms",
    "r26_alarm_suppression",
    "x04_slot_stream",
]

SEASON_PARAMETERS = ["Turbidity", "DO", "Temperature", "Specific Conductivity", "FDOM Fluorescence", "Chl-a Fluorescence", "pH", "ORP", "Depth"]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def season(spark: SparkSession, sites: int = 9, days: int = 275) -> tuple[DataFrame, ...]:
    """One season of 15-minute slots (about 2.1 million rows) with gaps, noise and visits."""
    slots = days * 96
    names = F.array(*[F.lit(p) for p in SEASON_PARAMETERS])
    n = len(SEASON_PARAMETERS)
    d = spark.range(sites * n * slots, numPartitions=64)
    d = d.select(
        F.format_string("s%02d", (F.col("id") / (n * slots)).cast("int")).alias("site"),
        F.element_at(names, ((F.col("id") / slots).cast("int") % n + 1).cast("int")).alias("parameter"),
        (F.col("id") % slots).alias("i"),
    )
    u = F.pmod(F.xxhash64("site", "parameter", "i"), F.lit(10000)) / 10000.0
    value = 20 + 8 * F.sin(F.col("i") / 96 * 6.283) + 4 * F.sin(F.col("i") / 3000) + 2 * u
    series = d.select(
        "site",
        "parameter",
        F.timestamp_seconds(F.lit(1772323200) + F.col("i") * 900).alias("dt_round"),
        F.when(u > 0.03, value).alias("mean"),
        u.alias("spread"),
        F.lit(3).cast("long").alias("n_obs"),
    )
    visits = series.filter("parameter = 'DO'").filter(F.pmod(F.unix_seconds("dt_round") / 900, F.lit(96 * 14)) == 40)
    visits = visits.select("site", "dt_round", F.col("dt_round").alias("start_dt"), F.lit(None).cast("string").alias("sensor_pulled"), F.lit("DO").alias("sensor_deployed"))
    return series, visits


def season_flag_pass(spark: SparkSession) -> float:
    spec = Series()
    series, visits = season(spark)
    series = materialise(series, "season")
    limits = spark.createDataFrame([(p, 5.0, 33.0) for p in SEASON_PARAMETERS], "parameter string, lo double, hi double")
    bad = series.filter("site = 's03' and parameter = 'pH'").groupBy("site", "parameter").agg(F.min("dt_round").alias("start_dt"), (F.min("dt_round") + F.expr("interval 5 days")).alias("end_dt"))
    pairs = spark.createDataFrame([(f"s{a:02d}", f"s{b:02d}") for a in range(9) for b in (a - 1, a + 1) if 0 <= b < 9], "site string, neighbour string")
    thresholds = materialise(th.build_thresholds(series, spec), "thresholds")
    t0 = time.time()
    run(fl.flag_pass(series, visits, limits, thresholds, bad, pairs, spec, fl.FlagSettings(drift=fl.DriftWindows())))
    return time.time() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    catalog.load()
    spark = build_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    run(catalog.QUERIES["g01_slot_agg"](spark, sf_dir))
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        run(catalog.QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - t0, 3)
    if os.environ.get("BENCH_SEASON", "1") == "1":
        times["season_flag_pass_2m_rows"] = round(season_flag_pass(spark), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()

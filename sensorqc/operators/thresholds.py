"""Building of seasonal and alarm thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorqc.functions import time as tm, tokens
from sensorqc.operators import grid
from sensorqc.plans.quantiles import exact_quantiles
from sensorqc.series import Series
from sensorqc.session import materialise

KEYS = ["site", "parameter", "season"]


def build_thresholds(df: DataFrame, spec: Series, value: str = "mean", low: float = 0.01, high: float = 0.99, absolute_slope: bool = False, approximate: bool = False) -> DataFrame:
    """Low and high quantile of the value and of the slope behind, by season."""
    d = grid.with_slopes(df.select(*spec.keys, spec.time, F.col(value).alias("mean")), spec, absolute_slope).withColumn("season", tm.season(spec.time))
    if approximate:
        pair = F.array(F.lit(low), F.lit(high))
        a = d.groupBy(*KEYS).agg(F.percentile_approx("mean", pair, 10000).alias("m"), F.percentile_approx("slope_behind", pair, 10000).alias("s"))
        return a.select(*KEYS, *[F.col(c)[i].alias(n) for c, i, n in (("m", 0, "t_mean01"), ("m", 1, "t_mean99"), ("s", 0, "t_slope_behind_01"), ("s", 1, "t_slope_behind_99"))])
    ends = {"mean": {"t_mean01": low, "t_mean99": high}, "slope_behind": {"t_slope_behind_01": low, "t_slope_behind_99": high}}
    return exact_quantiles(d, KEYS, ends)


def clean_for_thresholds(df: DataFrame, value: str = "mean") -> DataFrame:
    """NULL where auto-flagged, out of the water, moved or malfunctioning."""
    bad = F.col("auto_flag").isNotNull() | (F.col("sonde_employed") == 1) | F.col("sonde_moved") | F.col("mal_flag").isNotNull()
    return df.withColumn("clean_mean", F.when(~F.coalesce(bad, F.lit(False)), F.col(value)))


def old_scheme(flag: Column, verified: Column, value: Column) -> dict[str, Column]:
    """Older truth table of flag and PASS/FAIL to a clean value and a clean flag."""
    flagged, passed = flag.isNotNull(), verified == "PASS"
    good = (~flagged & passed) | (flagged & ~passed)
    text = F.when(flagged & passed, flag).when(~flagged & ~passed, F.lit("MANUAL FLAG"))
    return {"clean_mean": F.when(good, value), "clean_flag": text}


# Flag texts whose values never enter the thresholds.
NULLING_TEXTS = (
    "site visit",
    "sv window",
    "sonde unsubmerged",
    "sensor malfunction",
    "sonde burial",
    "frozen",
    "suspect data",
    "repeated value",
    "missing data",
    "DO interference",
    "baro issue",
    "baro noise",
    "do noise",
    "wiper issue",
    "wiper interference",
    "Possible burial",
    "drift",
    "sensor biofouling",
)
NULLING_CLASSES = "|".join(NULLING_TEXTS)


def null_by_flag(df: DataFrame, keep_calibration_year: int, time: str = "dt_round", flag: str = "flag", value: str = "mean", pattern: str = NULLING_CLASSES) -> DataFrame:
    f = F.coalesce(F.col(flag), F.lit(""))
    calibration = f.rlike("calibration error") & (F.year(time) != keep_calibration_year)
    over = (F.col("parameter") == "Turbidity") & (F.col(value) > 1000)
    bad = f.rlike(pattern) | calibration | F.coalesce(over, F.lit(False))
    return df.withColumn("clean_mean", F.when(~bad, F.col(value)))


def sufficiency(df: DataFrame, value: str = "mean", time: str = "dt_round", min_rows: int = 7000, min_values: int = 5000, min_share: float = 0.70, min_years: int = 1) -> DataFrame:
    d = df if "season" in df.columns else df.withColumn("season", tm.season(time))
    n, v = F.count(F.lit(1)), F.count(value)
    out = d.groupBy(*KEYS).agg(n.alias("n_rows"), v.alias("n_values"), F.count_distinct(F.year(time)).alias("n_years"))
    share = F.col("n_values") / F.col("n_rows")
    ok = (F.col("n_rows") >= min_rows) & (F.col("n_values") >= min_values) & (share >= min_share) & (F.col("n_years") >= min_years)
    return out.withColumns({"share": share, "sufficient": ok})


def combination_grid(sites: DataFrame, parameters: list[str], seasons: list[str] = tuple(tm.SEASON_MONTHS)) -> DataFrame:
    """Every site x parameter x season; the two short lists are literals, sites stay distributed."""
    p, s = (F.array(*[F.lit(x) for x in xs]) for xs in (parameters, seasons))
    return sites.select("site", F.explode(p).alias("parameter")).select("site", "parameter", F.explode(s).alias("season"))


def finalise(grid_df: DataFrame, computed: DataFrame, sufficient: DataFrame, realistic: DataFrame, cap: float = 4000.0, cap_to: float = 2000.0, realistic_on=("parameter",)) -> DataFrame:
    """Failing combinations take the realistic range; values are capped and clipped; missing slopes
    take the widest of the same parameter and season."""
    ok = sufficient.select(*KEYS, "sufficient")
    d = grid_df.join(computed, KEYS, "left").join(ok, KEYS, "left")
    d = materialise(d.join(realistic.select(*realistic_on, "lo", "hi"), list(realistic_on), "left"), "threshold-rows")
    wide = d.groupBy("parameter", "season").agg(F.min("t_slope_behind_01").alias("_a"), F.max("t_slope_behind_99").alias("_b"))
    d = d.join(wide, ["parameter", "season"], "left")
    use = F.coalesce("sufficient", F.lit(False))
    low, high = F.when(use, F.col("t_mean01")).otherwise(F.col("lo")), F.when(use, F.col("t_mean99")).otherwise(F.col("hi"))
    high = F.when(high >= cap, F.lit(cap_to)).otherwise(high)
    return d.select(
        *KEYS,
        F.when(low < F.col("lo"), F.col("lo")).otherwise(low).alias("t_mean01"),
        F.when(high > F.col("hi"), F.col("hi")).otherwise(high).alias("t_mean99"),
        F.coalesce("t_slope_behind_01", "_a").alias("t_slope_behind_01"),
        F.coalesce("t_slope_behind_99", "_b").alias("t_slope_behind_99"),
    )


def backfill(new: DataFrame, old: DataFrame, grid_df: DataFrame) -> DataFrame:
    """Old thresholds for wanted combinations that the new table lacks."""
    new = materialise(new, "new-thresholds")
    kept = old.join(grid_df.select(*KEYS), KEYS, "left_semi").join(new.select(*KEYS), KEYS, "left_anti")
    return new.unionByName(kept)


def alarm_thresholds(df: DataFrame, keys: list[str], value: str = "mean") -> DataFrame:
    """Mean plus sd times the 95 % and 99 % two-sided t quantile, as warning and alarm."""
    from sensorqc.functions.numeric import t_quantile

    a = df.groupBy(*keys).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"), F.count(value).alias("n"))
    dof = (F.col("n") - 1).cast("double")
    levels = {"warning": 0.975, "alarm": 0.995}
    cols = {k: F.when(F.col("n") > 1, F.col("_m") + F.col("_s") * t_quantile(F.lit(p), dof)) for k, p in levels.items()}
    return a.select(*keys, "n", *[c.alias(k) for k, c in cols.items()])


def sd_comparison(df: DataFrame, spec: Series, value: str = "mean") -> DataFrame:
    """Distinct month and season sd of each series and their absolute difference."""
    d = df.withColumns({"month": F.month(spec.time).cast("long"), "season": tm.season(spec.time)})
    month = d.groupBy(*spec.keys, "season", "month").agg(F.stddev_samp(value).alias("month_sd"))
    season = d.groupBy(*spec.keys, "season").agg(F.stddev_samp(value).alias("season_sd"))
    return month.join(season, [*spec.keys, "season"]).withColumn("sd_difference", F.abs(F.col("month_sd") - F.col("season_sd")))

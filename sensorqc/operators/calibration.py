"""Back-calibration of readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorqc.functions import time as tm
from sensorqc.plans.chunks import carry, carry_series, over_slots, time_chunk
from sensorqc.plans.joins import asof_join, newest_per_key
from sensorqc.series import Series
from sensorqc.session import materialise

CAL_CHUNK = 31_536_000


def join_calibration(df: DataFrame, calibrations: DataFrame, spec: Series, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Newest calibration at or before each reading."""
    c = calibrations.withColumn("_cal_dt", F.col("sensor_date"))
    return asof_join(df, c, keys or list(spec.keys), spec.time, "_cal_dt", columns, spec.chunk_seconds)


def lag_lead(calibrations: DataFrame, keys: list[str], time: str = "sensor_date", tie: str = "id", chunk_seconds: int = CAL_CHUNK) -> DataFrame:
    """Previous and next slope, offset and date of the same sensor."""
    here = F.struct(F.col("slope").alias("slope"), F.col("offset").alias("offset"), F.col(time).alias("date"))
    order, chunk = [time, tie], time_chunk(time, chunk_seconds)
    d = carry(calibrations, keys, chunk, order, fills={"_lag": here}, next_fills={"_lead": here}, exclusive=True)
    cols = {}
    for side in ("lag", "lead"):
        cols |= {f"slope_{side}": F.col(f"_{side}.slope"), f"offset_{side}": F.col(f"_{side}.offset"), f"{time}_{side}": F.col(f"_{side}.date")}
    return d.withColumns(cols).drop("_lag", "_lead")


def calibration_windows(df: DataFrame, spec: Series, date: str = "sensor_date", name: str = "cal_window_id") -> DataFrame:
    """Number of the segment between consecutive calibrations."""
    d = carry_series(df, spec, fills={"_prev": F.struct(F.col(date).alias("d"))}, exclusive=True)
    d = materialise(d, "calibration-rows")  # the next carry reads it twice
    changed = F.col("_prev").isNotNull() & ~F.col("_prev.d").eqNullSafe(F.col(date))
    return carry_series(d.withColumn("_c", changed.cast("long")), spec, sums={name: F.col("_c")}).drop("_prev", "_c")


def temporal_weight(df: DataFrame, keys: list[str], time: str, name: str = "wt") -> DataFrame:
    """0 at the first and 1 at the last time of each window; 0 for a window of one instant."""
    ends = df.groupBy(*keys).agg(F.min(time).alias("_a"), F.max(time).alias("_b"))
    d = df.join(ends, keys)
    return d.withColumn(name, weight(time, "_a", "_b")).drop("_a", "_b")


def weight(time: str, first: str, last: str) -> Column:
    span = tm.seconds_between(last, first)
    return F.when(span > 0, tm.seconds_between(time, first) / span).otherwise(0.0)


def inverse_linear(value: Column, slope: Column, offset: Column) -> Column:
    return F.when(slope != 0, (value - offset) / slope)


def between(a: Column, b: Column, wt: Column) -> Column:
    return a + wt * (b - a)


def linear_transform(raw: Column, slope_from: Column, offset_from: Column, slope_to: Column, offset_to: Column, wt: Column) -> Column:
    return raw * between(slope_from, slope_to, wt) + between(offset_from, offset_to, wt)


def ph_transform(mv: Column, slope_from: Column, offset_from: Column, slope_to: Column, offset_to: Column, wt: Column) -> Column:
    slope = between(slope_from, slope_to, wt)
    return F.when(slope != 0, (mv - between(offset_from, offset_to, wt)) / slope)


def usable(transformed: Column) -> Column:
    x = F.nanvl(transformed, F.lit(None).cast("double"))
    return F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))


# Parameters corrected with the linear form.
LINEAR_PARAMETERS = ("Chl-a Fluorescence", "FDOM Fluorescence", "ORP", "Pressure", "Specific Conductivity", "DO", "Turbidity")


def recalibrate(df: DataFrame) -> DataFrame:
    """Transform, check and final value from the chosen coefficients."""
    args = [F.col(c) for c in ("mean_raw", "updated_slope_from", "updated_offset_from", "updated_slope_to", "updated_offset_to", "wt")]
    trans = F.when(F.col("parameter") == "pH", ph_transform(*args)).when(F.col("parameter").isin(*LINEAR_PARAMETERS), linear_transform(*args))
    d = df.withColumn("mean_lm_trans", trans)
    unchanged = F.coalesce((F.col("from") == "Original") & (F.col("to") == "Original"), F.lit(False))
    d = d.withColumn("cal_check", usable(F.col("mean_lm_trans")) & ~unchanged)
    return d.withColumn("mean_cal", F.when(F.col("cal_check"), F.col("mean_lm_trans")).otherwise(F.col("mean")))


def choose_coefficients(df: DataFrame, decisions: DataFrame, spec: Series) -> DataFrame:
    """Reviewer's Original/Lag/Lead choice per calibration, filled down then up along the series."""
    d = materialise(df.join(decisions, [*spec.keys, "sensor_date", spec.time], "left"), "calibration-choices")
    down, up = ({f"_{way}_{c}": F.col(c) for c in ("from", "to")} for way in ("down", "up"))
    d = carry_series(d, spec, fills=down, next_fills=up)
    d = d.withColumns({c: F.coalesce(f"_down_{c}", f"_up_{c}") for c in ("from", "to")}).drop(*down, *up)
    cols = {}
    for side, default in (("from", "final"), ("to", "lead")):
        for v in ("slope", "offset"):
            pick = F.when(F.col(side) == "Original", F.col(v)).when(F.col(side) == "Lag", F.col(f"{v}_lag"))
            cols[f"updated_{v}_{side}"] = pick.when(F.col(side) == "Lead", F.col(f"{v}_lead")).otherwise(F.col(f"{v}_{default}"))
    return d.withColumns(cols)


def merge_calibrated(calibrated: DataFrame, series: DataFrame, spec: Series, uncalibrated=("Depth", "Temperature")) -> DataFrame:
    """Calibrated values with the side columns of the series, plus the uncalibrated parameters."""
    moved = ~((F.col("slope") == F.col("updated_slope_to")) & (F.col("slope") == F.col("updated_slope_from")))
    keys = [*spec.keys, spec.time]
    left = calibrated.select(*keys, F.col("mean").alias("mean_pre_cal"), F.col("mean_cal").alias("mean"), moved.alias("back_cal_performed"))
    sides = series.drop("mean")
    plain = series.filter(F.col("parameter").isin(*uncalibrated)).withColumns({"mean_pre_cal": F.col("mean"), "back_cal_performed": F.lit(False)})
    return left.join(sides, keys, "left").unionByName(plain)


def first_of_calibration(df: DataFrame, spec: Series, date: str = "sensor_date") -> DataFrame:
    return newest_per_key(df, [*spec.keys, date], [spec.time], newest=False)


def visit_steps(df: DataFrame, spec: Series, before: int = 2, after: int = 5, value: str = "mean") -> DataFrame:
    """Value ``before`` slots earlier against ``after`` slots later."""

    def reach(w):
        return {"before": F.lag(value, before).over(w), "after": F.lead(value, after).over(w)}

    def compare(w):
        a, b = F.col("after"), F.col("before")
        safe = (a != 0) & (b != 0)
        return {
            "difference": a - b,
            "percent_change": F.when(safe, (a - b) / F.abs(b) * 100),
            "percent_difference": F.when(safe, F.abs(a - b) / F.abs((a + b) / 2) * 100),
        }

    return over_slots(df, spec, before, after, reach, compare)


def rate_visit_steps(steps: DataFrame, visit: Column, near_visit: Column) -> DataFrame:
    """BAD where the step at a visit exceeds the mean step away from visits."""
    keys = ["site", "parameter"]
    usual = steps.filter(~near_visit).groupBy(*keys).agg(F.avg("percent_difference").alias("mean_dif"), F.avg("percent_change").alias("mean_change"))
    d = steps.filter(visit & F.col("percent_difference").isNotNull()).join(usual, keys, "left")

    def grade(x, y):
        return F.when(F.col(x) > F.col(y), "BAD").when(F.col(x) <= F.col(y), "GOOD")

    return d.withColumns({"acceptable_dif": grade("percent_difference", "mean_dif"), "acceptable_change": grade("percent_change", "mean_change")})


def count_bad(rated: DataFrame) -> DataFrame:
    return rated.filter("acceptable_change = 'BAD'").groupBy("site", "parameter").agg(F.count(F.lit(1)).alias("instances"))


def fill_calibration(df: DataFrame, calibrations: DataFrame, spec: Series, columns: list[str], forward_first: bool = False) -> DataFrame:
    """Full join on the slot, then next observation backward and last observation forward
    (``forward_first`` swaps the order)."""
    keys = [*spec.keys, spec.time]
    d = df.join(calibrations.select(*keys, *columns), keys, "full")
    d = carry_series(d, spec, fills={f"_d_{c}": F.col(c) for c in columns}, next_fills={f"_u_{c}": F.col(c) for c in columns})
    pair = (lambda c: (f"_d_{c}", f"_u_{c}")) if forward_first else (lambda c: (f"_u_{c}", f"_d_{c}"))
    d = d.withColumns({c: F.coalesce(*pair(c)) for c in columns})
    return d.drop(*[f"_d_{c}" for c in columns], *[f"_u_{c}" for c in columns])

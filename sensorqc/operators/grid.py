"""Gridding and per-series statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from sensorqc.functions import time as tm
from sensorqc.plans.chunks import carry_series, over_index, over_slots
from sensorqc.plans.quantiles import exact_quantiles
from sensorqc.series import Series

DEFAULT = Series()


def slot_aggregate(readings: DataFrame, spec: Series = DEFAULT, ts: str = "timestamp", value: str = "value", nearest: bool = True) -> DataFrame:
    """Mean, spread and count per slot; the partial aggregate absorbs hot series before the shuffle."""
    slot = tm.round_slot(ts, spec.step) if nearest else tm.floor_slot(ts, spec.step)
    v = F.col(value)
    return readings.groupBy(*spec.keys, slot.alias(spec.time)).agg(
        F.avg(v).alias("mean"), F.abs(F.min(v) - F.max(v)).alias("spread"), F.count(v).alias("n_obs")
    )


def pad_grid(df: DataFrame, spec: Series = DEFAULT, how: str = "left") -> DataFrame:
    """All slots between the first and last of each series; missing ones get NULL values.

    Slots are emitted chunk by chunk after a shuffle on (keys, chunk), so the rows of one very
    long series are produced by many tasks.
    """
    keys = list(spec.keys)
    lo, hi = tm.slot_number("_lo", spec.step), tm.slot_number("_hi", spec.step)
    bounds = df.groupBy(*keys).agg(F.min(spec.time).alias("_lo"), F.max(spec.time).alias("_hi"))
    per = F.lit(spec.chunk)
    chunks = bounds.select(*keys, lo.alias("_a"), hi.alias("_b")).withColumn(
        "_c", F.explode(F.sequence(F.floor(F.col("_a") / per), F.floor(F.col("_b") / per)))
    )
    first, last = F.greatest("_a", F.col("_c") * per), F.least("_b", F.col("_c") * per + per - 1)
    slots = chunks.repartition(*keys, "_c").select(*keys, F.explode(F.sequence(first, last)).alias("_s"))
    grid = slots.select(*keys, F.timestamp_seconds(F.col("_s") * spec.step).alias(spec.time))
    return grid.join(df, [*keys, spec.time], how).select(*df.columns)


def spacing_audit(df: DataFrame, spec: Series = DEFAULT) -> DataFrame:
    """Number of distinct gaps per series; anything but one is uneven spacing."""
    prev = carry_series(df, spec, fills={"_prev": F.col(spec.time)}, exclusive=True)
    gap = tm.seconds_between(spec.time, "_prev")
    out = prev.withColumn("_gap", gap.cast("long")).groupBy(*spec.keys).agg(
        F.count_distinct("_gap").alias("n_gaps"), F.min("_gap").alias("min_gap"), F.max("_gap").alias("max_gap")
    )
    return out.withColumn("evenly_spaced", F.col("n_gaps") <= 1)


# --- steps for over_slots -------------------------------------------------------------------


def neighbours(value: str = "mean", n: int = 1):
    def step(w: WindowSpec) -> dict[str, Column]:
        cols = {}
        for i in range(1, n + 1):
            cols[f"front{i}"] = F.lead(value, i).over(w)
            cols[f"back{i}"] = F.lag(value, i).over(w)
        return cols

    return step


def rolling(value: str = "mean", width: int = 7):
    """Centred median, mean and sd; NULL unless the frame is full and has no missing value."""
    half = width // 2

    def step(w: WindowSpec) -> dict[str, Column]:
        frame = w.rowsBetween(-half, half)
        full = F.count(value).over(frame) == width
        ordered = F.array_sort(F.collect_list(value).over(frame))
        return {
            "rollmed": F.when(full, F.element_at(ordered, half + 1)),
            "rollavg": F.when(full, F.avg(value).over(frame)),
            "rollsd": F.when(full, F.stddev_samp(value).over(frame)),
        }

    return step


def slopes(step_minutes: float, value: str = "mean", absolute: bool = False):
    def step(w: WindowSpec) -> dict[str, Column]:
        ahead = (F.lead(value).over(w) - F.col(value)) / step_minutes
        behind = (F.col(value) - F.lag(value).over(w)) / step_minutes
        if absolute:
            ahead, behind = F.abs(ahead), F.abs(behind)
        return {"slope_ahead": ahead, "slope_behind": behind}

    return step


def with_neighbours(df: DataFrame, spec: Series = DEFAULT, n: int = 3) -> DataFrame:
    return over_slots(df, spec, n, n, neighbours(n=n))


def with_rolling(df: DataFrame, spec: Series = DEFAULT, width: int = 7) -> DataFrame:
    return over_slots(df, spec, width // 2, width // 2, rolling(width=width))


def with_slopes(df: DataFrame, spec: Series = DEFAULT, absolute: bool = False) -> DataFrame:
    return over_slots(df, spec, 1, 1, slopes(spec.step / 60, absolute=absolute))


def with_month_sd(df: DataFrame, spec: Series = DEFAULT, value: str = "mean") -> DataFrame:
    """Standard deviation of the year-month, as an aggregate joined back (a month may be hot)."""
    d = df.withColumn("y_m", F.date_format(spec.time, "yyyy-MM"))
    sd = d.groupBy(*spec.keys, "y_m").agg(F.stddev_samp(value).alias("month_sd"))
    return d.join(sd, [*spec.keys, "y_m"], "left")


def summary_steps(spec: Series, value: str = "mean"):
    """Everything the flag rules need, in one pass with a halo of three slots."""
    return [neighbours(value), rolling(value), slopes(spec.step / 60, value)]


def first_pass(df: DataFrame, limits: DataFrame, spec: Series = DEFAULT) -> DataFrame:
    """NULL outside [lo, hi] of the parameter, then mean and sd of the six neighbours."""
    cut = df.join(limits.select("parameter", "lo", "hi"), "parameter", "left")
    outside = (F.col("mean") < F.col("lo")) | (F.col("mean") > F.col("hi"))
    cut = cut.withColumn("removed", F.coalesce(outside, F.lit(False)))
    cut = cut.withColumn("mean", F.when(~F.col("removed"), F.col("mean")))

    def step(w):
        around = F.filter(F.array(*[f("mean", i).over(w) for i in (1, 2, 3) for f in (F.lag, F.lead)]), lambda x: x.isNotNull())
        n = F.size("_around")
        total = F.aggregate("_around", F.lit(0.0), lambda a, x: a + x)
        avg = F.when(n > 0, total / n)
        return [{"_around": around}, {"mean_around": avg}]

    def around(w):
        return step(w)[0]

    def mean_around(w):
        return step(w)[1]

    def sd_around(w):
        ss = F.aggregate("_around", F.lit(0.0), lambda a, x: a + (x - F.col("mean_around")) * (x - F.col("mean_around")))
        sd = F.when(F.size("_around") > 1, F.sqrt(ss / (F.size("_around") - 1)))
        return {"sd_around": sd}

    def verdict(w):
        far = F.abs(F.col("mean") - F.col("mean_around")) > 3 * F.col("sd_around")
        return {"anomalous": F.coalesce(far, F.lit(False))}

    out = over_slots(cut, spec, 3, 3, around, mean_around, sd_around, verdict)
    return out.drop("_around", "lo", "hi")


def interpolate_gaps(df: DataFrame, spec: Series = DEFAULT, value: str = "mean", maxgap: int = 4, name: str | None = None) -> DataFrame:
    """Linear in time inside runs of at most ``maxgap`` missing slots; edges and longer runs stay."""
    name = name or value

    def around(w):
        known = F.when(F.col(value).isNotNull(), F.struct(F.unix_seconds(spec.time).alias("t"), F.col(value).alias("v")))
        return {
            "_before": F.last(known, True).over(w.rowsBetween(-maxgap, -1)),
            "_after": F.first(known, True).over(w.rowsBetween(1, maxgap)),
        }

    def fill(w):
        t, a, b = F.unix_seconds(spec.time), F.col("_before"), F.col("_after")
        fits = (b["t"] - a["t"]) <= spec.step * (maxgap + 1)
        line = a["v"] + (b["v"] - a["v"]) * (t - a["t"]) / (b["t"] - a["t"])
        return {name: F.when(F.col(value).isNotNull(), F.col(value)).when(fits, line)}

    return over_slots(df, spec, maxgap, maxgap, around, fill).drop("_before", "_after")


def low_pass(df: DataFrame, spec: Series = DEFAULT, value: str = "mean", passes: int = 3, parameters=("Turbidity",), name: str = "smoothed") -> DataFrame:
    """Binomial 1-4-6-4-1 filter repeated ``passes`` times; other parameters are copied."""
    weights = {-2: 1, -1: 4, 0: 6, 1: 4, 2: 1}

    def one(source: str, target: str):
        def step(w):
            terms = [F.lit(float(k)) * (F.lead(source, i).over(w) if i > 0 else F.lag(source, -i).over(w) if i < 0 else F.col(source)) for i, k in weights.items()]
            total = terms[0]
            for t in terms[1:]:
                total = total + t
            return {target: total / 16.0}

        return step

    names = [value] + [f"_lp{i}" for i in range(1, passes + 1)]
    steps = [one(a, b) for a, b in zip(names, names[1:])]
    out = over_slots(df, spec, 2 * passes, 2 * passes, *steps)
    chosen = F.when(F.col("parameter").isin(*parameters), F.col(names[-1])).otherwise(F.col(value))
    return out.withColumn(name, chosen).drop(*names[1:])


def triangular(df: DataFrame, spec: Series = DEFAULT, value: str = "mean", name: str = "smoothed") -> DataFrame:
    """Weights 1-2-3-2-1 over the values present; NULL when all five are missing."""
    weights = {-2: 1.0, -1: 2.0, 0: 3.0, 1: 2.0, 2: 1.0}

    def step(w):
        num, den = F.lit(0.0), F.lit(0.0)
        for i, k in weights.items():
            v = F.lead(value, i).over(w) if i > 0 else F.lag(value, -i).over(w) if i < 0 else F.col(value)
            num = num + F.coalesce(v * k, F.lit(0.0))
            den = den + F.when(v.isNotNull(), k).otherwise(0.0)
        return {name: F.when(den > 0, num / den)}

    return over_slots(df, spec, 2, 2, step)


# Fixed value: standard deviation of the normal kernel per unit of bandwidth.
KERNEL_SD_PER_BANDWIDTH = 0.3706506


def gaussian_smooth(df: DataFrame, keys, x: str, y: str, bandwidth: float = 3.0, name: str = "smoothed", chunk: int = 1024) -> DataFrame:
    """Normal kernel smoothing on an integer axis with one row per (keys, x); cutoff four sd."""
    sd = KERNEL_SD_PER_BANDWIDTH * bandwidth
    reach = int(4 * sd)

    def step(w):
        num, den = F.lit(0.0), F.lit(0.0)
        for d in range(-reach, reach + 1):
            k = float(2.718281828459045 ** (-0.5 * (d / sd) ** 2))
            v = F.first(y).over(w.rangeBetween(d, d))
            num = num + F.coalesce(v * k, F.lit(0.0))
            den = den + F.when(v.isNotNull(), k).otherwise(0.0)
        return {name: F.when(den > 0, num / den)}

    return over_index(df, keys, x, reach, reach, chunk, step)


def resample(df: DataFrame, spec: Series, unit: str, value: str = "mean", how: str = "mean") -> DataFrame:
    """Coarser slots ('hour', 'day', 'week'); medians are exact for any number of readings per slot."""
    d = df.select(*spec.keys, F.date_trunc(unit, spec.time).alias(spec.time), value)
    keys = [*spec.keys, spec.time]
    if how != "median":
        return d.groupBy(*keys).agg(F.avg(value).alias(value), F.count(value).alias("n"))
    n = d.groupBy(*keys).agg(F.count(value).alias("n"))
    return n.join(exact_quantiles(d, keys, value, {value: 0.5}), keys, "left")


def moving_average(df: DataFrame, keys, time: str, value: str, width: int, step: int = 86400, chunk: int = 4096, name: str = "rolled") -> DataFrame:
    """Centred mean over ``width`` rows, NULL unless all are present; ``keys`` holds the year."""
    half = width // 2

    def roll(w):
        frame = w.rowsBetween(-half, half)
        return {name: F.when(F.count(value).over(frame) == width, F.avg(value).over(frame))}

    return over_slots(df, Series(tuple(keys), time, step, chunk), half, half, roll)


def rescale_to(df: DataFrame, target: DataFrame, on: list[str], value: str, target_value: str, name: str = "scaled") -> DataFrame:
    """Min-max map of a series onto the range of another one of the same key."""
    own = df.groupBy(*on).agg(F.min(value).alias("_a"), F.max(value).alias("_b"))
    other = target.groupBy(*on).agg(F.min(target_value).alias("_c"), F.max(target_value).alias("_d"))
    out = df.join(own.join(other, on), on)
    width = F.col("_b") - F.col("_a")
    scaled = F.when(width != 0, (F.col(value) - F.col("_a")) / width * (F.col("_d") - F.col("_c")) + F.col("_c"))
    return out.withColumn(name, scaled).drop("_a", "_b", "_c", "_d")

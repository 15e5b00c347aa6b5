"""Flag rules.

A rule is either a *step* (``w -> {column: expression}``) for ``over_slots`` or a DataFrame
function. ``flags`` is an ``array<string>``; see ``functions.tokens``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from sensorqc.functions import time as tm, tokens
from sensorqc.functions.fits import window_fit
from sensorqc.operators import grid, visits as vz
from sensorqc.plans.chunks import frame_total, full_frame, over_slots, over_slots_in_arrow, running_total
from sensorqc.plans.joins import asof_join, mark_covered
from sensorqc.series import Series
from sensorqc.session import materialise

# Flag texts.
NOT_EMPLOYED = "sonde not employed"
SITE_VISIT = "site visit"
SV_WINDOW = "sv window"
MISSING = "missing data"
REPEATED = "repeated value"
SPEC_RANGE = "outside of sensor specification range"
REALISTIC_RANGE = "outside of sensor realistic range"
SEASONAL_RANGE = "outside of seasonal range"
SLOPE = "slope violation"
SD_RANGE = "outside sd range"
SLOPE_SUSPECT = "slope flag suspect"
SLOPE_ACTUAL = "slope flag actual"
ANOMALY_24H = "24hr anomaly"
ANOMALY_WINDOW = "anomaly window"
DRIFT = "drift"
DO_INTERFERENCE = "DO interference"
FROZEN = "frozen"
UNSUBMERGED = "sonde unsubmerged"
BURIAL = "sonde burial"
SUSPECT = "suspect data"

# Token sets that do not count as an anomaly.
QUIET_SETS = [
    {ANOMALY_24H},
    {ANOMALY_WINDOW},
    {ANOMALY_24H, ANOMALY_WINDOW},
    {MISSING},
    {NOT_EMPLOYED, MISSING},
    {MISSING, ANOMALY_WINDOW},
    {MISSING, ANOMALY_24H},
    {NOT_EMPLOYED, MISSING, ANOMALY_WINDOW},
    {MISSING, ANOMALY_24H, ANOMALY_WINDOW},
    {SITE_VISIT, MISSING, ANOMALY_24H, ANOMALY_WINDOW},
    {SV_WINDOW, MISSING, ANOMALY_24H, ANOMALY_WINDOW},
]

def rule(condition: Column, text: str):
    """A step that appends ``text`` where a plain column condition is TRUE."""
    return lambda w: {"flags": tokens.add("flags", condition, text)}


# --- single series ---------------------------------------------------------------------------


def field_steps(time: str = "dt_round", slots: int = 3, both_sides: bool = False):
    def visit_window(w: WindowSpec):
        is_visit = tokens.has("flags", SITE_VISIT).cast("int")
        near = F.max(is_visit).over(w.rowsBetween(-slots, -1))
        if both_sides:
            near = F.greatest(near, F.max(is_visit).over(w.rowsBetween(1, slots)))
        return {"flags": tokens.add("flags", near == 1, SV_WINDOW)}

    return [
        rule(F.col("sonde_employed") == 1, NOT_EMPLOYED),
        rule(F.col("last_site_visit") == F.col(time), SITE_VISIT),
        visit_window,
    ]


def missing_step(value: str = "mean"):
    return rule(F.col(value).isNull(), MISSING)


def repeated_step(value: str = "mean"):
    def step(w):
        same = (F.col(value) == F.lag(value).over(w)) | (F.col(value) == F.lead(value).over(w))
        return {"flags": tokens.add("flags", same, REPEATED)}

    return step


def do_noise_step(threshold: float = 2.0, value: str = "mean", parameter: str = "DO"):
    def step(w):
        swing = F.abs(F.col(value) - F.lag(value).over(w)) + F.abs(F.lead(value).over(w) - F.col(value))
        return {"flags": tokens.add("flags", (F.col("parameter") == parameter) & (swing >= threshold), DO_INTERFERENCE)}

    return step


def outside(lo: str, hi: str, value: str = "mean") -> Column:
    return (F.col(value) < F.col(lo)) | (F.col(value) > F.col(hi))


def range_flag(df: DataFrame, limits: DataFrame, on: list[str], text: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Limits are one row per parameter (or per parameter and watershed); size decides the join."""
    out = df.join(limits.select(*on, F.col(lo).alias("_lo"), F.col(hi).alias("_hi")), on, "left")
    return out.withColumn("flags", tokens.add("flags", outside("_lo", "_hi"), text)).drop("_lo", "_hi")


THRESHOLDS = ["t_mean01", "t_mean99", "t_slope_behind_01", "t_slope_behind_99"]


def seasonal_steps(sd: bool = False, sd_column: str = "season_sd"):
    slope_low, slope_high = F.col("t_slope_behind_01"), F.col("t_slope_behind_99")
    ahead, behind = F.col("slope_ahead"), F.col("slope_behind")
    steep = (ahead >= slope_high) | (behind >= slope_high) | (ahead <= slope_low) | (behind <= slope_low)
    steps = [rule(outside("t_mean01", "t_mean99"), SEASONAL_RANGE), rule(steep, SLOPE)]
    if sd:
        steps.append(rule(F.abs(F.col("mean") - F.col("rollavg")) > 3 * F.col(sd_column), SD_RANGE))
    return steps


def with_thresholds(df: DataFrame, thresholds: DataFrame, time: str = "dt_round") -> DataFrame:
    return df.withColumn("season", tm.season(time)).join(thresholds, ["site", "parameter", "season"], "left")


def with_season_sd(df: DataFrame, spec: Series, value: str = "mean") -> DataFrame:
    d = df if "season" in df.columns else df.withColumn("season", tm.season(spec.time))
    sd = d.groupBy(*spec.keys, "season").agg(F.stddev_samp(value).alias("season_sd"))
    return d.join(sd, [*spec.keys, "season"], "left")


def slope_suspect(df: DataFrame, limits: DataFrame) -> DataFrame:
    """One steep side is a suspect, two make it actual."""
    d = df.join(limits.select("parameter", F.col("slope_threshold").alias("_t")), "parameter", "left")
    a, b = F.col("slope_ahead") >= F.col("_t"), F.col("slope_behind") >= F.col("_t")
    d = d.withColumn("flags", tokens.add("flags", a | b, SLOPE_SUSPECT))
    return d.withColumn("flags", tokens.replace("flags", a & b, SLOPE_SUSPECT, SLOPE_ACTUAL)).drop("_t")


def anomaly_steps(half: int = 48, skip_unflagged: bool = True):
    """24-hour anomaly by the share of flagged slots, then its surroundings."""
    width = 2 * half + 1

    def binary(w):
        loud = (F.size("flags") > 0) & ~tokens.equals_any_set("flags", QUIET_SETS)
        return {"_loud": loud.cast("int")}

    def loud_total(w):
        return {"_total": running_total("_loud", w)}

    def day(w):
        hits = frame_total("_total", w, half, half)
        return {"flags": tokens.add("flags", full_frame(w, half, half) & (hits >= width * 0.5), ANOMALY_24H)}

    def marked(w):
        return {"_day": tokens.has("flags", ANOMALY_24H).cast("int")}

    def day_total(w):
        return {"_total": running_total("_day", w)}

    def around(w):
        near = (frame_total("_total", w, half, half) - F.col("_day")) > 0
        if skip_unflagged:
            near = near & (F.size("flags") > 0)
        return {"flags": tokens.add("flags", near & ~tokens.has("flags", ANOMALY_WINDOW), ANOMALY_WINDOW)}

    return [binary, loud_total, day, marked, day_total, around]


def large_anomalies(df: DataFrame, spec: Series, half: int = 48, skip_unflagged: bool = True) -> DataFrame:
    return over_slots(df, spec, 2 * half, 2 * half, *anomaly_steps(half, skip_unflagged)).drop("_loud", "_day", "_total")


# --- drift tests -----------------------------------------------------------------------------


def rolling_r2(df: DataFrame, spec: Series, short: int = 96, long: int = 288, share: float = 0.6, value: str = "mean") -> DataFrame:
    """R2 of the value against time over full windows to the left and right; then its trailing mean.

    Windows with a tenth or more missing count as 0, incomplete windows as NULL.
    """
    frames = {"r2_s_right": (short - 1, 0), "r2_s_left": (0, short - 1), "r2_l_right": (long - 1, 0), "r2_l_left": (0, long - 1)}

    def fit(table):
        y = table[value].to_numpy()
        out = {}
        for name, (before, after) in frames.items():
            width = before + after + 1
            _, r2, present, rows = window_fit(y, before, after)
            r2 = np.where(present > width - 0.1 * width, r2, 0.0)
            out[name] = np.where(rows == width, r2, np.nan)
        return out

    d = over_slots_in_arrow(df, spec, long - 1, long - 1, fit, {n: "double" for n in frames})

    def tightest(w):
        return {"tightest_r": F.greatest(*frames)}

    def failed(w):
        frame = w.rowsBetween(-(short - 1), 0)
        full = F.count("tightest_r").over(frame) == short
        return {"steady": F.when(full, (F.avg("tightest_r").over(frame) >= share).cast("long"))}

    return over_slots(d, spec, short, 0, tightest, failed)


def biofouling_contrast(df: DataFrame, time: str = "dt_round") -> DataFrame:
    """Steady rise in Turbidity but not in Specific Conductivity at the same site and slot."""
    w = Window.partitionBy("site", time)
    turb = F.max(F.when(F.col("parameter") == "Turbidity", F.col("steady"))).over(w)
    cond = F.max(F.when(F.col("parameter") == "Specific Conductivity", F.col("steady"))).over(w)
    hit = (F.col("parameter") == "Turbidity") & (turb == 1) & (cond != 1) & ~tokens.has("flags", DRIFT)
    return df.withColumn("_hit", hit).withColumn("flags", tokens.add("flags", F.col("_hit"), DRIFT)).drop("_hit")


@dataclass(frozen=True)
class DriftWindows:
    """Reach of the drift windows in slots (defaults are 12 h, 24 h, 36 h and 72 h of 15 minutes)."""

    short_half: int = 48
    short_back: int = 96
    long_half: int = 144
    long_back: int = 144
    exp_half: int = 144
    exp_back: int = 288
    trail: int = 96
    min_points: int = 10
    share: float = 0.5


FITS = ["r2_s_center", "r2_s_right", "r2_l_center", "r2_l_right", "r2_l_right_exp", "r2_l_center_exp"]


def time_drift(df: DataFrame, spec: Series, visit: Column | None = None, win: DriftWindows = DriftWindows(), value: str = "mean", parameters: tuple[str, ...] | None = None) -> DataFrame:
    """Linear and exponential fits inside visit groups; falling FDOM and rising others count.

    Adds the fits and ``failed``; ``visit`` marks rows that start a new visit group (without it the
    rows already carry ``visit_group``). With ``parameters``, others aren't fitted (their fits are 0).
    """
    grouped = df if visit is None else vz.visit_groups(df, spec, visit)
    linear = {
        "r2_s_center": (win.short_half, win.short_half),
        "r2_s_right": (win.short_back, 0),
        "r2_l_center": (win.long_half, win.long_half),
        "r2_l_right": (win.long_back, 0),
    }
    exponential = {"r2_l_right_exp": (win.exp_back, 0), "r2_l_center_exp": (win.exp_half, win.exp_half)}
    back = max(b for b, _ in [*linear.values(), *exponential.values()])
    ahead = max(a for _, a in [*linear.values(), *exponential.values()])

    def fit(table):
        parameter, out = table["parameter"][0].as_py(), {}
        if parameters is not None and parameter not in parameters:
            return {name: np.zeros(len(table)) for name in FITS}
        y, group = table[value].to_numpy(), table["visit_group"].to_numpy()
        fdom = parameter == "FDOM Fluorescence"
        for name, (before, after) in linear.items():
            slope, r2, present, rows = window_fit(y, before, after, group)
            good = (rows >= win.min_points) & (present >= np.ceil(0.9 * rows)) & ((slope <= 0) if fdom else (slope > 0))
            out[name] = np.where(good, r2, 0.0)
        for name, (before, after) in exponential.items():
            if fdom:
                out[name] = np.zeros(len(y))
                continue
            slope, r2, present, _ = window_fit(y, before, after, group, log_from_min=True)
            out[name] = np.where((present >= win.min_points) & (slope > 0), r2, 0.0)
        return out

    d = over_slots_in_arrow(grouped, spec, back, ahead, fit, {n: "double" for n in FITS})
    d = d.withColumn("tightest_r", F.greatest(*FITS))

    def failed(w):
        return {"failed": (F.avg("tightest_r").over(w.rowsBetween(-win.trail, 0)) >= win.share).cast("long")}

    return over_slots(d, spec.by(*spec.keys, "visit_group"), win.trail, 0, failed)


# --- several parameters of one sonde -----------------------------------------------------------


def depth_shift(df: DataFrame, visits: DataFrame, spec: Series) -> DataFrame:
    """Depth change of the latest visit carried forward; ``sonde_moved`` where it is not zero."""
    moves = visits.filter(F.col("depth_change").isNotNull()).select("site", F.col("start_dt").alias("_move_dt"), "depth_change")
    out = asof_join(df, moves, ["site"], spec.time, "_move_dt", ["depth_change"], spec.chunk_seconds)
    return out.withColumn("sonde_moved", F.coalesce(F.col("depth_change") != 0, F.lit(False)))


def _at_slot(time: str) -> WindowSpec:
    return Window.partitionBy("site", time)


def _any(condition: Column, w: WindowSpec) -> Column:
    return F.coalesce(F.max(F.coalesce(condition, F.lit(False)).cast("int")).over(w) == 1, F.lit(False))


def intrasensor_rules(time: str = "dt_round", freezing: float = 0.0, min_depth: float = 0.0, min_conductivity: float = 10.0):
    """(name, function of flags) pairs applied in order over one (site, slot) partitioning."""
    w = _at_slot(time)
    p, v = F.col("parameter"), F.col("mean")
    frozen = _any((p == "Temperature") & (v < freezing), w)
    dry = _any(((p == "Depth") & (v < min_depth)) | ((p == "Specific Conductivity") & (v < min_conductivity)), w)
    return frozen, dry


def frozen_flag(df: DataFrame, time: str = "dt_round", freezing: float = 0.0) -> DataFrame:
    frozen, _ = intrasensor_rules(time, freezing)
    return df.withColumn("_x", frozen).withColumn("flags", tokens.add("flags", F.col("_x"), FROZEN)).drop("_x")


def unsubmerged_flag(df: DataFrame, time: str = "dt_round", min_depth: float = 0.0, min_conductivity: float = 10.0) -> DataFrame:
    _, dry = intrasensor_rules(time, 0.0, min_depth, min_conductivity)
    return df.withColumn("_x", dry).withColumn("flags", tokens.add("flags", F.col("_x"), UNSUBMERGED)).drop("_x")


def intersensor_check(df: DataFrame, time: str = "dt_round", references=("Temperature", "Depth")) -> DataFrame:
    """Drop slope violations that temperature or depth of the same slot share."""
    shared = _any(F.col("parameter").isin(*references) & tokens.has("flags", SLOPE), _at_slot(time))
    return df.withColumn("_x", shared).withColumn("flags", tokens.remove("flags", SLOPE, when=F.col("_x") & ~F.col("parameter").isin(*references))).drop("_x")


def burial_steps(half: int = 48, share: float = 0.5):
    """Share of noisy DO slots around each slot of the DO series."""

    def totals(w):
        noisy = ((F.col("parameter") == "DO") & tokens.has("flags", DO_INTERFERENCE)).cast("int")
        return {"_noisy": running_total(noisy, w), "_rows": running_total(F.lit(1), w)}

    def buried(w):
        part = frame_total("_noisy", w, half, half) / frame_total("_rows", w, half, half)
        return {"_buried": (F.col("parameter") == "DO") & (part >= share)}

    return [totals, buried]


def burial_flag(df: DataFrame, spec: Series, half: int = 48, share: float = 0.5) -> DataFrame:
    d = over_slots(df, spec, half, half, *burial_steps(half, share))
    hit = _any(F.col("_buried"), _at_slot(spec.time))
    return d.withColumn("_x", hit).withColumn("flags", tokens.add("flags", F.col("_x"), BURIAL)).drop("_x", "_buried", "_noisy", "_rows")


def malfunction_flag(df: DataFrame, records: DataFrame, spec: Series, on=("site", "parameter"), text: str = "sensor malfunction") -> DataFrame:
    m = mark_covered(df, records, list(on), spec.time, "start_dt", "end_dt", spec.chunk_seconds, "_bad")
    return m.withColumn("mal_flag", F.when(F.col("_bad"), text)).drop("_bad")


# --- several sites -----------------------------------------------------------------------------


def network_check(df: DataFrame, pairs: DataFrame, spec: Series, reach: int = 8, clearable=(SLOPE, SEASONAL_RANGE)) -> DataFrame:
    """Clear an event token when a neighbour site shows an event within ``reach`` slots.

    ``pairs`` is (site, neighbour). Only flagged slots are spread in time, once per slot.
    """
    event = tokens.has_any("flags", clearable)
    slot = tm.slot_number(spec.time, spec.step)
    events = df.filter(event).select("site", "parameter", slot.alias("_s")).distinct()
    spread = events.join(pairs.select("site", F.col("neighbour").alias("_target")), "site")
    spread = spread.select(F.col("_target").alias("site"), "parameter", F.explode(F.sequence(F.col("_s") - reach, F.col("_s") + reach)).alias("_slot"))
    seen = spread.distinct().withColumn("_echo", F.lit(True))
    out = df.withColumn("_slot", slot).join(seen, ["site", "parameter", "_slot"], "left")
    cleared = tokens.remove("flags", *clearable, when=F.coalesce("_echo", F.lit(False)))
    return out.withColumn("flags", cleared).drop("_slot", "_echo")


def suspect_steps(half: int = 4, share: float = 0.5):
    """Unflagged values among mostly flagged neighbours, then lone suspects removed."""

    def density(w):
        flagged = (F.size("flags") > 0).cast("int")
        others = F.count(F.lit(1)).over(w.rowsBetween(-half, half)) - 1
        hits = F.sum(flagged).over(w.rowsBetween(-half, half)) - flagged
        return {"_crowd": F.when(others > 0, hits / others)}

    def add(w):
        return {"flags": tokens.add("flags", (F.size("flags") == 0) & (F.col("_crowd") >= share), SUSPECT)}

    return [density, add]


def lone_suspect_step(w: WindowSpec):
    alone = (F.coalesce(F.size(F.lag("flags").over(w)), F.lit(0)) <= 0) & (F.coalesce(F.size(F.lead("flags").over(w)), F.lit(0)) <= 0)
    only = (F.size("flags") == 1) & tokens.has("flags", SUSPECT)
    return {"flags": tokens.remove("flags", SUSPECT, when=only & alone)}


def suspect_flags(df: DataFrame, spec: Series, half: int = 4, share: float = 0.5) -> DataFrame:
    return over_slots(df, spec, half + 1, half + 1, *suspect_steps(half, share), lone_suspect_step).drop("_crowd")


# --- using flags ---------------------------------------------------------------------------------


def seed_verification(flag: str = "flag") -> Column:
    f = F.col(flag)
    return F.when(f.contains(MISSING), "fail").when(f.isNull(), "pass")


def public_value(flag: str = "flag", value: str = "mean") -> Column:
    return F.when(F.col(flag).isNull(), F.col(value))


def site_overrides(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Drop listed tokens at listed sites; ``rules`` has (site, token), a few per site."""
    listed = rules.groupBy("site").agg(F.collect_set("token").alias("_drop"))
    out = df.join(listed, "site", "left")
    kept = F.filter("flags", lambda t: ~F.coalesce(F.array_contains("_drop", t), F.lit(False)))
    return out.withColumn("flags", kept).drop("_drop")


@dataclass(frozen=True)
class FlagSettings:
    do_noise: float = 2.0
    anomaly_half: int = 48
    drift: DriftWindows | None = DriftWindows()  # None leaves the drift test out
    freezing: float = 0.0
    min_depth: float = 0.0
    min_conductivity: float = 10.0
    burial_half: int = 48
    burial_share: float = 0.5
    network_reach: int = 8
    suspect_half: int = 4
    drift_parameters: tuple[str, ...] = ("FDOM Fluorescence", "Chl-a Fluorescence", "Turbidity")


def flag_pass(
    series: DataFrame,
    visits: DataFrame,
    limits: DataFrame,
    thresholds: DataFrame,
    malfunction_records: DataFrame,
    pairs: DataFrame,
    spec: Series = Series(),
    settings: FlagSettings = FlagSettings(),
) -> DataFrame:
    """All flags in order: one series, one sonde, the network, suspects.

    The series rules share one (series, chunk) partitioning, the sonde rules one (site, slot)
    partitioning. Visits and malfunctions are carried along the bare series first, so nothing
    expensive is computed twice; the flagged rows are written once before the network check, which
    reads them from two sides.
    """
    s = settings
    d = malfunction_flag(series, malfunction_records, spec)
    d = vz.visit_state(d, visits, spec)
    d = d.join(limits.select("parameter", F.col("lo").alias("_lo"), F.col("hi").alias("_hi")), "parameter", "left")
    d = with_thresholds(d, thresholds, spec.time)
    field = [(F.col("sonde_employed") == 1, NOT_EMPLOYED), (F.col("has_visit"), SITE_VISIT), (F.col("in_sv_window"), SV_WINDOW)]
    d = d.withColumn("flags", tokens.add_all(tokens.empty(), field))
    first = [*grid.summary_steps(spec), missing_step(), do_noise_step(s.do_noise), repeated_step()]
    second = [rule(outside("_lo", "_hi"), SPEC_RANGE), *seasonal_steps(), *burial_steps(s.burial_half, s.burial_share)]
    if s.drift is None:
        d = over_slots(d, spec, 3 + s.burial_half, 3 + s.burial_half, *first, *second)
    else:
        d = time_drift(over_slots(d, spec, 3, 3, *first), spec, None, s.drift, parameters=s.drift_parameters)
        drifting = (F.col("failed") == 1) & F.col("parameter").isin(*s.drift_parameters)
        d = d.withColumn("flags", tokens.add("flags", drifting, DRIFT))
        d = over_slots(d, spec, s.burial_half, s.burial_half, *second)
    keep = [c for c in ("sonde_employed", "last_site_visit", "season", "depth_change", "sonde_moved", "mal_flag") if c in d.columns]
    d = d.select(*series.columns, *keep, "flags", "_buried")
    w = _at_slot(spec.time)
    frozen, dry = intrasensor_rules(spec.time, s.freezing, s.min_depth, s.min_conductivity)
    reference = F.col("parameter").isin("Temperature", "Depth")
    d = d.withColumns({"_frozen": frozen, "_dry": dry, "_shared": _any(reference & tokens.has("flags", SLOPE), w), "_burial": _any(F.col("_buried"), w)})
    d = d.withColumn("flags", tokens.add("flags", F.col("_frozen"), FROZEN))
    d = d.withColumn("flags", tokens.remove("flags", SLOPE, when=F.col("_shared") & ~reference))
    d = d.withColumn("flags", tokens.add_all("flags", [(F.col("_burial"), BURIAL), (F.col("_dry"), UNSUBMERGED)]))
    d = materialise(d.select(*series.columns, *keep, "flags"), "intrasensor-flags")
    d = network_check(d, pairs, spec, s.network_reach)
    reach = 2 * s.anomaly_half + s.suspect_half + 1
    last = [*anomaly_steps(s.anomaly_half), *suspect_steps(s.suspect_half), lone_suspect_step]
    d = over_slots(d, spec, reach, reach, *last)
    return d.select(*series.columns, tokens.render("flags").alias("auto_flag"), *keep)

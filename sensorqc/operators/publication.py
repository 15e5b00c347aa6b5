"""Published datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorqc.functions import time as tm
from sensorqc.plans.joins import mark_covered
from sensorqc.plans.segments import pick_winners
from sensorqc.series import Series

VALUES = ["value_raw", "value_post_cal_corr", "value_post_ver", "value_post_drift_corr"]


def modifications(non_resolved: bool = False) -> Column:
    """What was done to a value, from its four stages."""
    raw, cal, ver, drift = (F.col(c) for c in VALUES)
    out = F.when(ver.isNull() & raw.isNotNull(), "manual data exclusion")
    if non_resolved:
        drifting = F.coalesce(F.col("user_qc_flag").contains("drift"), F.lit(False))
        out = out.when((raw == cal) & (ver == drift) & drifting, "non-resolved drift")
    return (
        out.when((raw == cal) & (ver != drift), "drift correction")
        .when((raw != cal) & (ver == drift), "calibration correction")
        .when((raw != cal) & (ver != drift), "calibration correction;drift correction")
    )


def lineage(drift_corrected: DataFrame, other: DataFrame, keys=("site", "parameter"), digits: int = 3) -> DataFrame:
    """Drift-corrected series first, the other series where none exists; rounded half to even.

    Both inputs carry the four value stages (``value_post_drift_corr`` may be missing in ``other``).
    """
    done = drift_corrected.select(*keys).distinct()
    rest = other.join(done, list(keys), "left_anti")
    both = drift_corrected.unionByName(rest, allowMissingColumns=True)
    both = both.withColumn("value_post_drift_corr", F.coalesce("value_post_drift_corr", "value_post_ver"))
    both = both.withColumns({c: F.bround(c, digits) for c in VALUES})
    return both.withColumn("modifications", modifications())


def units_lookup(df: DataFrame) -> DataFrame:
    return df.select("parameter", "units").filter("parameter is not null and units is not null").distinct()


def rebuild_units(df: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Units by parameter; a parameter with two units is an error of the data and duplicates rows."""
    return df.drop("units").join(lookup if lookup is not None else units_lookup(df), "parameter", "left")


def ambiguous_units(lookup: DataFrame) -> DataFrame:
    return lookup.groupBy("parameter").agg(F.count(F.lit(1)).alias("n_units")).filter("n_units > 1")


def manual_overrides(df: DataFrame, overrides: DataFrame, spec: Series) -> DataFrame:
    """Windows that null, reset to raw, or subtract from the corrected values.

    ``overrides`` has (keys, start_dt, end_dt, seq, action, amount) with action 'null', 'raw' or
    'subtract'; rows without a verified value are left alone; the first window counts.
    """
    keys = list(spec.keys)
    first = {"_o": (F.struct("action", "amount"), -F.col("seq"))}
    d = pick_winners(df, overrides, keys, spec.time, "start_dt", "end_dt", first, spec.chunk_seconds)
    raw, cal, ver, drift = (F.col(c) for c in VALUES)
    act = F.when(ver.isNotNull(), F.col("_o.action"))
    by = F.col("_o.amount")
    return d.withColumns(
        {
            "value_post_cal_corr": F.when(act == "subtract", cal - by).otherwise(cal),
            "value_post_ver": F.when(act == "raw", raw).when(act == "subtract", ver - by).otherwise(ver),
            "value_post_drift_corr": F.when(act == "null", F.lit(None).cast("double"))
            .when(act == "raw", raw)
            .when(act == "subtract", drift - by)
            .otherwise(F.coalesce(drift, ver)),
        }
    ).drop("_o")


def positive_floor(df: DataFrame, columns=tuple(VALUES[1:]), parameter: str = "Turbidity", floor: float = 0.1) -> DataFrame:
    p = F.col("parameter") == parameter
    return df.withColumns({c: F.when(p & (F.col(c) <= 0), floor).otherwise(F.col(c)) for c in columns})


def recover_stages(df: DataFrame, raw: DataFrame, calibrated: DataFrame, spec: Series) -> DataFrame:
    keys = [*spec.keys, spec.time]
    r = raw.select(*keys, F.col("mean").alias("value_raw"))
    c = calibrated.select(*keys, F.col("mean").alias("value_post_cal_corr"))
    return df.join(r, keys, "left").join(c, keys, "left")


def status_code(status: str = "status", value: str = "final_value", flag: str = "final_flag") -> Column:
    """A approved, P provisional, R removed."""
    s, v, f = F.col(status), F.col(value), F.col(flag)
    return F.when(v.isNull(), "R").when(s == "auto_flagged", "P").when((s == "in_progress_verified") & f.isNull(), "A").when(s == "in_progress_verified", "P")


def drop_colocated(df: DataFrame, rules: DataFrame, suffix: str = "_virridy") -> DataFrame:
    """Remove listed (site, parameter) pairs, then merge the suffixed site names."""
    kept = df.join(rules.select("site", "parameter").distinct(), ["site", "parameter"], "left_anti")
    return kept.withColumn("site", F.regexp_replace("site", suffix + "$", "")).select(*df.columns)


CFS_TO_M3S = 0.0283168  # fixed value


def clean_flow(flow: DataFrame, sites: DataFrame, time: str, value: str, flag: str, step: int = 900) -> DataFrame:
    """Slot means of a gauge as the parameter 'Discharge' in m3/s; a flagged slot is R."""
    slots = flow.groupBy("gauge", tm.floor_slot(time, step).alias("dt_round")).agg(
        F.avg(value).alias("final_value"), F.when(F.count(flag) == 0, "A").otherwise("R").alias("final_status")
    )
    d = slots.join(sites, "gauge").withColumn("final_value", F.col("final_value") * CFS_TO_M3S)
    return d.select("site", "dt_round", F.lit("Discharge").alias("parameter"), "final_value", "final_status")


def wide_publish(df: DataFrame, ids: list[str], parameters: list[str], values: dict[str, str]) -> DataFrame:
    """One row per ids with <parameter>_<label> columns; ``values`` maps source columns to labels."""
    aggs = []
    for p in parameters:
        stem = p.lower().replace(" ", "_").replace("-", "_")
        aggs += [F.max(F.when(F.col("parameter") == p, F.col(c))).alias(f"{stem}_{label}") for c, label in values.items()]
    return df.groupBy(*ids).agg(*aggs)


def clip_to_sites(other: DataFrame, df: DataFrame, time: str = "dt_round", margin: int = 10 * 86400) -> DataFrame:
    bounds = df.groupBy("site").agg(F.min(time).alias("_a"), F.max(time).alias("_b"))
    d = other.join(bounds, "site").filter(F.col(time).between(tm.shift("_a", -margin), tm.shift("_b", margin)))
    return d.drop("_a", "_b")


def share_export(df: DataFrame, start: str, end: str, bad_ranges: DataFrame, spec: Series, factors: dict[str, float], flag: str = "flag", value: str = "mean") -> DataFrame:
    """Unflagged rows of a date range in the receiver's units, without known bad periods."""
    d = df.filter(F.col(spec.time).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")) & F.col(flag).isNull())
    factor = F.lit(1.0)
    for p, f in factors.items():
        factor = F.when(F.col("parameter") == p, F.lit(f)).otherwise(factor)
    d = d.withColumn(value, F.col(value) * factor)
    m = mark_covered(d, bad_ranges, list(spec.keys), spec.time, "start_dt", "end_dt", spec.chunk_seconds, "_bad")
    return m.filter(~F.col("_bad")).drop("_bad")


def location_metadata(df: DataFrame, first: str, last: str, open_end: str, formats=("yyyy-MM-dd", "MM/dd/yyyy")) -> DataFrame:
    a = tm.parse_any(first, formats)
    b = F.coalesce(tm.parse_any(last, formats), F.lit(open_end).cast("timestamp"))
    years = F.when(F.year(a) == F.year(b), F.year(a).cast("string")).otherwise(F.concat_ws("-", F.year(a), F.year(b)))
    return df.withColumns({"data_start": a, "data_end": b, "years": years})


def site_compare(df: DataFrame, sites: list[str], ids: list[str], value: str = "mean") -> DataFrame:
    return df.groupBy(*ids).pivot("site", sites).agg(F.max(value))

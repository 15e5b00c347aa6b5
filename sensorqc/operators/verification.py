"""Reviewers' decisions as tables joined to the series."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from sensorqc.functions import time as tm, tokens
from sensorqc.plans.joins import interval_join, mark_covered
from sensorqc.series import Series

BLOCK = ["site", "parameter", "year", "week"]


def weekly_decision(df: DataFrame, decisions: DataFrame, value: str = "mean") -> DataFrame:
    """Decisions aa, ano, kf, of, oa per (site, parameter, year, week); other weeks stay.

    ``mean_verified`` keeps PASS only; FLAGGED values stay in the analysis value.
    """
    d = df.join(decisions.select(*BLOCK, F.col("decision").alias("_d"), F.col("user").alias("_u")), BLOCK, "left")
    code, omit, flagged = F.col("_d"), F.coalesce("brush_omit", F.lit(False)), F.col("user_flag").isNotNull()
    decided = code.isNotNull()
    final = (
        F.when(code == "aa", "PASS")
        .when(code == "oa", "OMIT")
        .when(omit, "OMIT")
        .when(~flagged | (code == "ano"), "PASS")
        .when(code == "kf", "FLAGGED")
        .when(code == "of", "OMIT")
    )
    new_omit = F.when(code == "aa", False).when(code == "oa", True).when((code == "of") & flagged & ~omit, True).otherwise(omit)

    def if_decided(new: Column, old: str) -> Column:
        return F.when(decided, new).otherwise(F.col(old)) if old in df.columns else F.when(decided, new)

    cols = {
        "final_status": if_decided(final, "final_status"),
        "brush_omit": new_omit,
        "user_flag": F.when(code == "aa", F.lit(None).cast("string")).otherwise(F.col("user_flag")),
        "user": if_decided(F.col("_u"), "user"),
        "week_decision": if_decided(code, "week_decision"),
        "is_verified": if_decided(F.lit(True), "is_verified"),
        "verification_status": if_decided(final, "verification_status"),
        "mean_verified": if_decided(F.when(final == "PASS", F.col(value)), "mean_verified"),
    }
    return d.withColumns(cols).drop("_d", "_u")


def box_decisions(df: DataFrame, boxes: DataFrame, spec: Series, value: str = "mean") -> DataFrame:
    """Time x value rectangles: A accepts, F flags, O omits; of overlapping boxes the last wins."""
    keys = list(spec.keys)
    b = boxes.select(*keys, "seq", "dt_min", "dt_max", "mean_min", "mean_max", "action", F.col("flags").alias("_flags"), F.col("user").alias("_user"))
    hit = interval_join(df.select(*keys, spec.time, F.col(value).alias("_v")), b, keys, spec.time, "dt_min", "dt_max", spec.chunk_seconds, "inner")
    hit = hit.filter(F.col("_v").between(F.col("mean_min"), F.col("mean_max")))
    last = hit.groupBy(*keys, spec.time).agg(F.max_by(F.struct("action", "_flags", "_user"), "seq").alias("_b"))
    d = df.join(last, [*keys, spec.time], "left")
    act = F.col("_b.action")
    cols = {
        "user_flag": F.when(act == "A", F.lit(None).cast("string")).when(act.isin("F", "O"), F.col("_b._flags")).otherwise(F.col("user_flag")),
        "brush_omit": F.when(act == "O", True).when(act.isin("A", "F"), False).otherwise(F.col("brush_omit")),
        "user": F.when(act.isNotNull(), F.col("_b._user")).otherwise(F.col("user")),
    }
    return d.withColumns(cols).drop("_b")


def reset_weeks(df: DataFrame, weeks: DataFrame) -> DataFrame:
    """Back to the uploaded state for the listed weeks."""
    d = df.join(weeks.select(*BLOCK).distinct().withColumn("_r", F.lit(True)), BLOCK, "left")
    hit = F.coalesce("_r", F.lit(False))
    none = F.lit(None).cast("string")
    initial = {
        "user_flag": F.col("flag"),
        "brush_omit": F.lit(False),
        "final_status": none,
        "week_decision": none,
        "user": none,
        "is_verified": F.lit(None).cast("boolean"),
    }
    return d.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in initial.items() if c in df.columns}).drop("_r")


# Older decision -> (values kept, status of unflagged, status of flagged).
OLD_DECISIONS = {
    "PASS ALL": ("unflagged", "PASS", "PASS"),
    "FAIL NONE": ("unflagged", "PASS", "PASS"),
    "PASS VALID": ("all", "PASS", "FAIL"),
    "FAIL FLAGGED": ("all", "PASS", "FAIL"),
    "PASS FLAGGED": ("none", "FAIL", "PASS"),
    "FAIL VALID": ("none", "FAIL", "PASS"),
    "PASS NONE": ("flagged", "FAIL", "FAIL"),
    "FAIL ALL": ("flagged", "FAIL", "FAIL"),
    "SKIP": ("unflagged", "SKIP", "SKIP"),
}


def old_decision(df: DataFrame, decision: str = "decision", flag: str = "flag", value: str = "mean") -> DataFrame:
    flagged = F.col(flag).isNotNull()
    verified, status = F.lit(None).cast("double"), F.lit(None).cast("string")
    for name, (keep, plain, marked) in OLD_DECISIONS.items():
        kept = {"unflagged": F.when(~flagged, F.col(value)), "flagged": F.when(flagged, F.col(value)), "all": F.col(value), "none": F.lit(None).cast("double")}[keep]
        verified = F.when(F.col(decision) == name, kept).otherwise(verified)
        status = F.when(F.col(decision) == name, F.when(flagged, marked).otherwise(plain)).otherwise(status)
    return df.withColumns({"mean_verified": verified, "is_verified": F.col(decision).isin(*OLD_DECISIONS), "verification_status": status})


# Flags a reviewer cannot lift.
NON_REMOVABLE = (
    "sensor biofouling",
    "sonde burial",
    "sensor malfunction",
    "frozen",
    "missing data",
    "sonde not employed",
    "sonde unsubmerged",
    "depth calibration malfunction",
)


def keep_non_removable(df: DataFrame, flag: str = "flag", listed=NON_REMOVABLE) -> DataFrame:
    """Rows whose flag holds a listed text anywhere, in any case, lose their value and pass."""
    hit = F.coalesce(F.lower(flag).rlike("|".join(re.escape(t.lower()) for t in listed)), F.lit(False))
    return df.withColumns(
        {
            "mean_verified": F.when(~hit, F.col("mean_verified")),
            "is_verified": F.lit(True),
            "verification_status": F.when(hit, "PASS").otherwise(F.col("verification_status")),
        }
    )


def interval_corrections(df: DataFrame, intervals: DataFrame, spec: Series, status: str = "FAIL", text: str | None = None, flag: str = "flag") -> DataFrame:
    """Listed periods lose their value and take a status; optionally a flag text is added."""
    m = mark_covered(df, intervals, list(spec.keys), spec.time, "start_dt", "end_dt", spec.chunk_seconds, "_in")
    cols = {"mean_verified": F.when(~F.col("_in"), F.col("mean_verified")), "verification_status": F.when(F.col("_in"), status).otherwise(F.col("verification_status"))}
    if text:
        added = tokens.render(tokens.add(tokens.parse(flag), F.col("_in"), text))
        cols[flag] = F.when(F.col("_in"), added).otherwise(F.col(flag))
    return m.withColumns(cols).drop("_in")


def ready_to_finalise(df: DataFrame, keys=("site", "parameter")) -> DataFrame:
    skip = F.bool_or(F.coalesce(F.col("verification_status") == "SKIP", F.lit(False)))
    all_done = F.bool_and(F.coalesce("is_verified", F.lit(False)) & F.coalesce("is_finalized", F.lit(False)))
    return df.groupBy(*keys).agg((~skip & all_done).alias("ready"))


def move_tiers(tier_table: DataFrame, ready: DataFrame, keys=("site", "parameter")) -> DataFrame:
    """Series that pass the gate go from 'intermediary' to 'verified'."""
    d = tier_table.join(ready.filter("ready").select(*keys).withColumn("_r", F.lit(True)), list(keys), "left")
    return d.withColumn("tier", F.when(F.col("_r") & (F.col("tier") == "intermediary"), "verified").otherwise(F.col("tier"))).drop("_r")


def invariant_violations(df: DataFrame) -> DataFrame:
    """Rows that must not be in the verified tier."""
    return df.filter((F.col("verification_status") == "SKIP") | ~F.coalesce("is_verified", F.lit(False)))


def unfinalise(df: DataFrame, series: DataFrame, keys=("site", "parameter")) -> DataFrame:
    d = df.join(series.select(*keys).distinct().withColumn("_r", F.lit(True)), list(keys), "left")
    hit = F.coalesce("_r", F.lit(False))
    return d.withColumns({"is_finalized": F.when(hit, False).otherwise(F.col("is_finalized")), "tier": F.when(hit, "intermediary").otherwise(F.col("tier"))}).drop("_r")


def progress(tier_table: DataFrame, parameters: list[str]) -> DataFrame:
    return tier_table.groupBy("site").pivot("parameter", parameters).agg(F.max("tier"))


def week_slice(df: DataFrame, weeks: DataFrame, time: str = "dt_round", margin: int = 2 * 86400, bucket_seconds: int = 7 * 86400) -> DataFrame:
    """Rows of each asked week with a margin on both sides; ``asked_week`` tells which."""
    bounds = df.join(weeks.select(*BLOCK), BLOCK, "left_semi").groupBy(*BLOCK).agg(F.min(time).alias("_a"), F.max(time).alias("_b"))
    spans = bounds.select("site", "parameter", F.col("week").alias("asked_week"), tm.shift("_a", -margin).alias("_from"), tm.shift("_b", margin).alias("_to"))
    return interval_join(df, spans, ["site", "parameter"], time, "_from", "_to", bucket_seconds, "inner").drop("_from", "_to")


def next_week(df: DataFrame) -> DataFrame:
    return df.groupBy("site", "parameter").agg(F.min(F.when(~F.col("is_verified"), F.col("week"))).alias("next_week"))


def approval_status(flag: str = "flag", status: str = "verification_status") -> Column:
    f, s = F.col(flag).isNotNull(), F.col(status)
    return F.when(~f & (s == "PASS"), "PASS").when(s.isin("PASS", "FAIL"), "OMIT")

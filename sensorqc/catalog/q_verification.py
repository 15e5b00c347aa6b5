"""Verification queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorqc.catalog.fixtures import PARAMETERS, S
from sensorqc.catalog.registry import query
from sensorqc.functions import tokens
from sensorqc.operators import verification as vf

KEYS = ["site", "parameter", "dt_round"]
NAMES = sorted(PARAMETERS.values())
SEP = "';' || chr(10)"
CODES = ("aa", "ano", "kf", "of", "oa")
CODE_SQL = "CASE (CAST(substr(site, 2) AS BIGINT) + week) % 6 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CODES)) + " END"
VER = "vx AS (SELECT *, flag AS user_flag FROM fx_verification)"


def verification(t):
    return t.verification.withColumn("user_flag", F.col("flag"))


def decisions(t):
    blocks = t.verification.select("site", "parameter", "year", "week").distinct()
    n = (F.substring("site", 2, 9).cast("long") + F.col("week")) % 6
    code = F.lit(None).cast("string")
    for i, c in enumerate(CODES):
        code = F.when(n == i, F.lit(c)).otherwise(code)
    return blocks.select("*", code.alias("decision"), F.lit("reviewer1").alias("user")).filter("decision is not null")


WEEKLY = f"""{VER}, d AS (SELECT *, {CODE_SQL} AS c FROM vx),
  e AS (SELECT *, CASE WHEN c IS NULL THEN NULL WHEN c = 'aa' THEN 'PASS' WHEN c = 'oa' THEN 'OMIT' WHEN brush_omit THEN 'OMIT' WHEN user_flag IS NULL OR c = 'ano' THEN 'PASS' WHEN c = 'kf' THEN 'FLAGGED' WHEN c = 'of' THEN 'OMIT' END AS fs FROM d)"""


@query(
    "v01_weekly_decision",
    f"""WITH {WEEKLY} SELECT site, parameter, dt_round, fs AS final_status, CASE WHEN c = 'aa' THEN false WHEN c = 'oa' THEN true WHEN c = 'of' AND user_flag IS NOT NULL AND NOT brush_omit THEN true ELSE brush_omit END AS brush_omit,
      CASE WHEN c = 'aa' THEN NULL ELSE user_flag END AS user_flag, CASE WHEN c IS NOT NULL THEN 'reviewer1' END AS "user", c AS week_decision, c IS NOT NULL OR is_verified AS is_verified,
      CASE WHEN c IS NOT NULL THEN fs ELSE verification_status END AS verification_status, CASE WHEN fs = 'PASS' THEN round(mean, 6) END AS mean_verified FROM e""",
)
def _(t):
    out = vf.weekly_decision(verification(t), decisions(t))
    return out.select(*KEYS, "final_status", "brush_omit", "user_flag", "user", "week_decision", "is_verified", "verification_status", "mean_verified")


@query(
    "v02_box_decision",
    f"""WITH {VER}, h AS (SELECT v.site, v.parameter, v.dt_round, max_by(b.action, b.seq) AS a, max_by(b."user", b.seq) AS u FROM vx v JOIN fx_boxes b ON b.site = v.site AND b.parameter = v.parameter
      AND v.dt_round BETWEEN b.dt_min AND b.dt_max AND v.mean BETWEEN b.mean_min AND b.mean_max GROUP BY 1, 2, 3)
    SELECT v.site, v.parameter, v.dt_round, CASE WHEN a = 'A' THEN NULL WHEN a IN ('F', 'O') THEN 'reviewed' ELSE user_flag END AS user_flag,
      CASE WHEN a = 'O' THEN true WHEN a IN ('A', 'F') THEN false ELSE brush_omit END AS brush_omit, coalesce(u, 'none') AS "user" FROM vx v LEFT JOIN h ON h.site = v.site AND h.parameter = v.parameter AND h.dt_round = v.dt_round""",
)
def _(t):
    d = verification(t).withColumn("user", F.lit("none"))
    out = vf.box_decisions(d, t.boxes.withColumn("flags", F.lit("reviewed")), S)
    return out.select(*KEYS, "user_flag", "brush_omit", "user")


@query(
    "v03_reset_week",
    f"""WITH {VER} SELECT site, parameter, dt_round, CASE WHEN week % 2 = 0 THEN flag ELSE upper(user_flag) END AS user_flag, CASE WHEN week % 2 = 0 THEN false ELSE brush_omit END AS brush_omit,
      week % 2 <> 0 AND is_verified AS is_verified, verification_status FROM vx""",
)
def _(t):
    d = t.verification.withColumn("user_flag", F.upper("flag"))
    weeks = t.verification.select("site", "parameter", "year", "week").distinct().filter("week % 2 = 0")
    out = vf.reset_weeks(d, weeks).withColumn("is_verified", F.coalesce("is_verified", F.lit(False)))
    return out.select(*KEYS, "user_flag", "brush_omit", "is_verified", "verification_status")


NAMES9 = list(vf.OLD_DECISIONS)
OLD_SQL = "CASE CAST(substr(site, 2) AS BIGINT) % 10 " + " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(NAMES9)) + " END"


def _old(t):
    n = F.substring("site", 2, 9).cast("long") % 10
    code = F.lit(None).cast("string")
    for i, c in enumerate(NAMES9):
        code = F.when(n == i, F.lit(c)).otherwise(code)
    return vf.old_decision(t.flagged.withColumn("decision", code))


OLDX = f"""x AS (SELECT *, {OLD_SQL} AS d FROM fx_flagged), y AS (SELECT *,
  CASE WHEN d IN ('PASS ALL', 'FAIL NONE', 'SKIP') THEN CASE WHEN flag IS NULL THEN mean END WHEN d IN ('PASS VALID', 'FAIL FLAGGED') THEN mean WHEN d IN ('PASS NONE', 'FAIL ALL') THEN CASE WHEN flag IS NOT NULL THEN mean END END AS mv,
  CASE WHEN d IN ('PASS ALL', 'FAIL NONE') THEN 'PASS' WHEN d = 'SKIP' THEN 'SKIP' WHEN d IN ('PASS NONE', 'FAIL ALL') THEN 'FAIL' WHEN d IN ('PASS VALID', 'FAIL FLAGGED') THEN CASE WHEN flag IS NULL THEN 'PASS' ELSE 'FAIL' END
    WHEN d IN ('PASS FLAGGED', 'FAIL VALID') THEN CASE WHEN flag IS NULL THEN 'FAIL' ELSE 'PASS' END END AS vs FROM x)"""


@query("v04_old_decision", f"WITH {OLDX} SELECT site, parameter, dt_round, round(mv, 6) AS mean_verified, vs AS verification_status FROM y")
def _(t):
    return _old(t).select(*KEYS, "mean_verified", "verification_status")


@query(
    "v05_non_removable",
    f"""WITH {OLDX} SELECT site, parameter, dt_round, CASE WHEN NOT coalesce(regexp_matches(flag, 'missing data'), false) THEN round(mv, 6) END AS mean_verified,
      CASE WHEN coalesce(regexp_matches(flag, 'missing data'), false) THEN 'PASS' ELSE vs END AS verification_status FROM y""",
)
def _(t):
    return vf.keep_non_removable(_old(t)).select(*KEYS, "mean_verified", "verification_status")


@query(
    "v06_interval_corrections",
    f"""WITH z AS (SELECT *, EXISTS (SELECT 1 FROM fx_malfunctions m WHERE m.site = v.site AND m.parameter = v.parameter AND v.dt_round BETWEEN m.start_dt AND m.end_dt) AS c FROM fx_verification v)
    SELECT site, parameter, dt_round, CASE WHEN NOT c THEN round(mean, 6) END AS mean_verified, CASE WHEN c THEN 'FAIL' ELSE verification_status END AS verification_status,
      CASE WHEN c THEN concat_ws({SEP}, flag, 'deployment error') ELSE flag END AS flag FROM z""",
)
def _(t):
    d = t.verification.withColumn("mean_verified", F.col("mean"))
    return vf.interval_corrections(d, t.malfunctions, S, text="deployment error").select(*KEYS, "mean_verified", "verification_status", "flag")


@query(
    "v07_final_gate",
    "SELECT site, parameter, NOT bool_or(verification_status = 'SKIP') AND bool_and(is_verified AND is_finalized) AS ready FROM fx_verification GROUP BY 1, 2",
)
def _(t):
    return vf.ready_to_finalise(t.verification)


TIERS = "SELECT site, parameter, CASE WHEN site < 's06' THEN 'intermediary' ELSE 'pre' END AS tier FROM (SELECT DISTINCT site, parameter FROM fx_slots)"


def tiers(t):
    s = t.slots.select("site", "parameter").distinct()
    return s.withColumn("tier", F.when(F.col("site") < "s06", "intermediary").otherwise("pre"))


@query(
    "v07_move_tiers",
    f"""WITH r AS (SELECT site, parameter, bool_and(is_verified AND is_finalized) AS ready FROM fx_verification GROUP BY 1, 2)
    SELECT site, parameter, CASE WHEN tier = 'intermediary' AND ready THEN 'verified' ELSE tier END AS tier FROM ({TIERS}) JOIN r USING (site, parameter)""",
)
def _(t):
    return vf.move_tiers(tiers(t), vf.ready_to_finalise(t.verification))


@query("v08_invariant", "SELECT site, parameter, dt_round, verification_status FROM fx_verification WHERE NOT is_verified")
def _(t):
    return vf.invariant_violations(t.verification).select(*KEYS, "verification_status")


@query(
    "v09_unfinalise",
    f"SELECT site, parameter, CASE WHEN site = 's01' THEN false ELSE site IN ('s01', 's05') END AS is_finalized, CASE WHEN site = 's01' THEN 'intermediary' ELSE tier END AS tier FROM ({TIERS})",
)
def _(t):
    d = tiers(t).withColumn("is_finalized", F.col("site").isin("s01", "s05"))
    return vf.unfinalise(d, tiers(t).filter("site = 's01'"))


@query(
    "v10_progress",
    "SELECT site, " + ", ".join(f"max(tier) FILTER (parameter = '{p}') AS \"{p}\"" for p in NAMES) + f" FROM ({TIERS}) GROUP BY 1",
)
def _(t):
    return vf.progress(tiers(t), NAMES)


@query(
    "v11_week_slice",
    """WITH b AS (SELECT site, parameter, week AS asked_week, min(dt_round) AS a, max(dt_round) AS z FROM fx_verification WHERE week % 2 = 1 GROUP BY 1, 2, 3)
    SELECT v.site, v.parameter, v.dt_round, b.asked_week FROM fx_verification v JOIN b ON b.site = v.site AND b.parameter = v.parameter AND v.dt_round BETWEEN a - INTERVAL 2 DAY AND z + INTERVAL 2 DAY""",
)
def _(t):
    weeks = t.verification.select("site", "parameter", "year", "week").distinct().filter("week % 2 = 1")
    return vf.week_slice(t.verification.select(*KEYS, "year", "week"), weeks).select(*KEYS, "asked_week")


@query(
    "v12_next_week",
    "SELECT site, parameter, coalesce(min(week) FILTER (NOT is_verified OR week > 3), 0) AS next_week FROM fx_verification GROUP BY 1, 2",
)
def _(t):
    d = t.verification.withColumn("is_verified", F.col("is_verified") & (F.col("week") <= 3))
    return vf.next_week(d).fillna(0, ["next_week"])


@query(
    "v13_approval_status",
    """SELECT site, parameter, dt_round, CASE WHEN flag IS NULL AND s = 'PASS' THEN 'PASS' WHEN s IS NOT NULL THEN 'OMIT' END AS approval_status FROM
      (SELECT *, CASE WHEN n_obs >= 3 THEN 'FAIL' WHEN n_obs >= 1 THEN 'PASS' END AS s FROM fx_flagged)""",
)
def _(t):
    status = F.when(F.col("n_obs") >= 3, "FAIL").when(F.col("n_obs") >= 1, "PASS")
    return t.flagged.withColumn("verification_status", status).select(*KEYS, vf.approval_status().alias("approval_status"))

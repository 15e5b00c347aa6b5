"""Publication queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorqc.catalog.fixtures import PARAMETERS, S, STEP, slot_sql
from sensorqc.catalog.registry import query
from sensorqc.operators import publication as pb

KEYS = ["site", "parameter", "dt_round"]
NAMES = sorted(PARAMETERS.values())
UNITS = {"Turbidity": "NTU", "DO": "mg/L", "Temperature": "C", "Specific Conductivity": "µS/cm", "FDOM Fluorescence": "RFU"}
UNIT_SQL = "CASE parameter " + " ".join(f"WHEN '{p}' THEN '{u}'" for p, u in UNITS.items()) + " END"


def units(parameter="parameter"):
    out = F.lit(None).cast("string")
    for p, u in UNITS.items():
        out = F.when(F.col(parameter) == p, F.lit(u)).otherwise(out)
    return out


# Sixteenths keep the three-decimal rounding of both engines on exact binary values.
Q = "round(mean * 16) / 16"
STAGES = f"""st AS (SELECT site, parameter, dt_round, flag AS user_qc_flag, {Q} AS value_raw, CASE WHEN n_obs = 2 THEN {Q} + 0.25 ELSE {Q} END AS value_post_cal_corr,
    CASE WHEN verification_status <> 'OMIT' THEN CASE WHEN n_obs = 2 THEN {Q} + 0.25 ELSE {Q} END END AS value_post_ver FROM fx_verification),
  sd AS (SELECT *, CASE WHEN contains(user_qc_flag, 'drift') AND site < 's10' THEN value_post_ver - 5 WHEN value_raw > 100 THEN NULL ELSE value_post_ver END AS value_post_drift_corr FROM st)"""
LINEAGE = f"""{STAGES}, l0 AS (SELECT * REPLACE (CASE WHEN parameter IN ('Turbidity', 'FDOM Fluorescence') THEN coalesce(value_post_drift_corr, value_post_ver) ELSE value_post_ver END AS value_post_drift_corr) FROM sd),
  l1 AS (SELECT *, CASE WHEN value_post_ver IS NULL AND value_raw IS NOT NULL THEN 'manual data exclusion' WHEN value_raw = value_post_cal_corr AND value_post_ver <> value_post_drift_corr THEN 'drift correction'
    WHEN value_raw <> value_post_cal_corr AND value_post_ver = value_post_drift_corr THEN 'calibration correction' WHEN value_raw <> value_post_cal_corr AND value_post_ver <> value_post_drift_corr THEN 'calibration correction;drift correction' END AS modifications FROM l0)"""


def stages(t):
    v = t.verification
    raw = F.round(F.col("mean") * 16) / 16
    cal = F.when(F.col("n_obs") == 2, raw + 0.25).otherwise(raw)
    ver = F.when(F.col("verification_status") != "OMIT", cal)
    drift = F.when(F.coalesce(F.col("flag").contains("drift") & (F.col("site") < "s10"), F.lit(False)), ver - 5).when(raw > 100, F.lit(None)).otherwise(ver)
    return v.select(
        *KEYS,
        F.col("flag").alias("user_qc_flag"),
        raw.alias("value_raw"),
        cal.alias("value_post_cal_corr"),
        ver.alias("value_post_ver"),
        drift.alias("value_post_drift_corr"),
    )


def lineage(t):
    s = stages(t)
    corrected = s.filter(F.col("parameter").isin("Turbidity", "FDOM Fluorescence"))
    return pb.lineage(corrected, s.drop("value_post_drift_corr"))


BROUND = ", ".join(f"round_even({c}, 3) AS {c}" for c in pb.VALUES)


@query("p01_lineage", f"WITH {LINEAGE} SELECT site, parameter, dt_round, user_qc_flag, modifications, {BROUND} FROM l1")
def _(t):
    return lineage(t).select(*KEYS, "user_qc_flag", "modifications", *pb.VALUES)


@query(
    "p02_modifications",
    f"""WITH {STAGES} SELECT site, parameter, dt_round, CASE WHEN value_post_ver IS NULL AND value_raw IS NOT NULL THEN 'manual data exclusion'
      WHEN value_raw = value_post_cal_corr AND value_post_ver = value_post_drift_corr AND contains(user_qc_flag, 'drift') THEN 'non-resolved drift'
      WHEN value_raw = value_post_cal_corr AND value_post_ver <> value_post_drift_corr THEN 'drift correction' WHEN value_raw <> value_post_cal_corr AND value_post_ver = value_post_drift_corr THEN 'calibration correction'
      WHEN value_raw <> value_post_cal_corr AND value_post_ver <> value_post_drift_corr THEN 'calibration correction;drift correction' END AS modifications FROM sd""",
)
def _(t):
    return stages(t).select(*KEYS, pb.modifications(non_resolved=True).alias("modifications"))


@query("p03_units", f"SELECT site, parameter, dt_round, @mean, {UNIT_SQL} AS units FROM fx_slots")
def _(t):
    d = t.slots.select(*KEYS, "mean", F.when(F.col("n_obs") > 1, units()).alias("units"))
    return pb.rebuild_units(d)


@query("p03_units_ambiguous", f"SELECT parameter, count(*) AS n_units FROM (SELECT DISTINCT parameter, CASE WHEN site = 's01' THEN lower({UNIT_SQL}) ELSE {UNIT_SQL} END AS units FROM fx_slots) GROUP BY 1 HAVING count(*) > 1")
def _(t):
    d = t.slots.select("parameter", F.when(F.col("site") == "s01", F.lower(units())).otherwise(units()).alias("units"))
    return pb.ambiguous_units(pb.units_lookup(d))


OVERRIDE = f"""{STAGES}, ov AS (SELECT *, CASE drift_type WHEN 'linear' THEN 'null' WHEN 'uniform' THEN 'raw' ELSE 'subtract' END AS action FROM fx_windows),
  oh AS (SELECT s.site, s.parameter, s.dt_round, min_by(action, seq) AS act FROM sd s JOIN ov w ON w.site = s.site AND w.parameter = s.parameter AND s.dt_round BETWEEN w.start_dt AND w.end_dt GROUP BY 1, 2, 3),
  oj AS (SELECT sd.*, CASE WHEN value_post_ver IS NOT NULL THEN act END AS act FROM sd LEFT JOIN oh USING (site, parameter, dt_round)),
  oz AS (SELECT site, parameter, dt_round, value_raw, CASE WHEN act = 'subtract' THEN value_post_cal_corr - 3 ELSE value_post_cal_corr END AS value_post_cal_corr,
    CASE WHEN act = 'raw' THEN value_raw WHEN act = 'subtract' THEN value_post_ver - 3 ELSE value_post_ver END AS value_post_ver,
    CASE WHEN act = 'null' THEN NULL WHEN act = 'raw' THEN value_raw WHEN act = 'subtract' THEN value_post_drift_corr - 3 ELSE coalesce(value_post_drift_corr, value_post_ver) END AS value_post_drift_corr FROM oj)"""


def overridden(t):
    kind = F.col("drift_type")
    o = t.windows.select(
        "site", "parameter", "seq", "start_dt", "end_dt", F.when(kind == "linear", "null").when(kind == "uniform", "raw").otherwise("subtract").alias("action"), F.lit(3.0).alias("amount")
    )
    return pb.manual_overrides(stages(t), o, S)


@query("p04_manual_overrides", f"WITH {OVERRIDE} SELECT site, parameter, dt_round, @value_raw, @value_post_cal_corr, @value_post_ver, @value_post_drift_corr FROM oz")
def _(t):
    return overridden(t).select(*KEYS, *pb.VALUES)


@query(
    "p05_positive_floor",
    "SELECT site, parameter, dt_round, round(CASE WHEN parameter = 'Turbidity' AND mean - 10 <= 0 THEN 0.1 ELSE mean - 10 END, 6) AS mean FROM fx_series",
)
def _(t):
    d = t.series.select(*KEYS, (F.col("mean") - 10).alias("mean"))
    return pb.positive_floor(d, ["mean"])


@query(
    "p06_recover_stages",
    """SELECT s.site, s.parameter, s.dt_round, round(s.mean, 6) AS value_raw, CASE WHEN s.n_obs >= 2 THEN round(s.mean + 1, 6) END AS value_post_cal_corr FROM fx_series s""",
)
def _(t):
    calibrated = t.slots.filter("n_obs >= 2").withColumn("mean", F.col("mean") + 1)
    return pb.recover_stages(t.series.select(*KEYS), t.slots, calibrated, S)


STATUS_SQL = "CASE WHEN n_obs >= 2 THEN 'in_progress_verified' ELSE 'auto_flagged' END"
CODED = f"""cd AS (SELECT site, parameter, dt_round, mean AS final_value, CASE WHEN mean IS NULL THEN 'R' WHEN {STATUS_SQL} = 'auto_flagged' THEN 'P' WHEN flag IS NULL THEN 'A' ELSE 'P' END AS final_status FROM fx_flagged)"""


def coded(t):
    d = t.flagged.select(*KEYS, F.col("mean").alias("final_value"), F.col("flag").alias("final_flag"), F.when(F.col("n_obs") >= 2, "in_progress_verified").otherwise("auto_flagged").alias("status"))
    return d.select(*KEYS, "final_value", pb.status_code().alias("final_status"))


@query("p07_status_codes", f"WITH {CODED} SELECT site, parameter, dt_round, @final_value, final_status FROM cd")
def _(t):
    return coded(t)


@query(
    "p08_colocated",
    """WITH r AS (SELECT id, CASE WHEN user_id % 2 = 0 THEN site || '_virridy' ELSE site END AS site, parameter FROM fx_events)
    SELECT id, replace(site, '_virridy', '') AS site, parameter FROM r WHERE NOT (ends_with(site, '_virridy') AND parameter IN ('DO', 'Turbidity') AND site < 's05')""",
)
def _(t):
    site = F.when(F.col("user_id") % 2 == 0, F.concat("site", F.lit("_virridy"))).otherwise(F.col("site"))
    r = t.events.select("id", site.alias("site"), "parameter")
    rules = r.filter(F.col("site").endswith("_virridy") & F.col("parameter").isin("DO", "Turbidity") & (F.col("site") < "s05")).select("site", "parameter")
    return pb.drop_colocated(r, rules)


FLOW = f"""fw AS (SELECT site, {slot_sql('ts')} AS dt_round, 'Discharge' AS parameter, avg(value) * 0.0283168 AS final_value, CASE WHEN count(*) FILTER (k < 20) = 0 THEN 'A' ELSE 'R' END AS final_status
  FROM fx_events WHERE event_type = 'view' GROUP BY 1, 2)"""


def flow(t):
    gauge = F.concat(F.lit("g"), "site").alias("gauge")
    f = t.events.filter("event_type = 'view'").select(gauge, "ts", "value", F.when(F.col("k") < 20, "bad").alias("flag"))
    return pb.clean_flow(f, t.sites.select("site", gauge), "ts", "value", "flag", STEP)


@query("p09_flow", f"WITH {CODED}, {FLOW} SELECT site, parameter, dt_round, @final_value, final_status FROM cd UNION ALL SELECT site, parameter, dt_round, @final_value, final_status FROM fw")
def _(t):
    return coded(t).unionByName(flow(t))


def stem(p):
    return p.lower().replace(" ", "_").replace("-", "_")


WIDE = ", ".join(
    f"round(max(final_value) FILTER (parameter = '{p}'), 6) AS {stem(p)}_value, max(final_status) FILTER (parameter = '{p}') AS {stem(p)}_status" for p in NAMES
)


@query("p10_wide_publish", f"WITH {CODED} SELECT site, dt_round, {WIDE} FROM cd GROUP BY 1, 2")
def _(t):
    return pb.wide_publish(coded(t), ["site", "dt_round"], NAMES, {"final_value": "value", "final_status": "status"})


@query(
    "p11_clip_to_sites",
    """WITH b AS (SELECT site, min(ts) AS a, max(ts) AS z FROM fx_events WHERE k = 70 GROUP BY 1)
    SELECT s.site, s.parameter, s.dt_round FROM fx_slots s JOIN b USING (site) WHERE dt_round BETWEEN a - INTERVAL 1 DAY AND z + INTERVAL 1 DAY""",
)
def _(t):
    marks = t.events.filter("k = 70").select("site", F.col("ts").alias("dt_round"))
    return pb.clip_to_sites(t.slots.select(*KEYS), marks, margin=86400)


@query(
    "p12_share_export",
    """SELECT site, parameter, dt_round, round(mean * CASE parameter WHEN 'Temperature' THEN 1.8 ELSE 1 END, 6) AS mean FROM fx_flagged f WHERE flag IS NULL AND dt_round BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'
      AND NOT EXISTS (SELECT 1 FROM fx_malfunctions m WHERE m.site = f.site AND m.parameter = f.parameter AND f.dt_round BETWEEN m.start_dt AND m.end_dt)""",
)
def _(t):
    return pb.share_export(t.flagged, "2024-01-05", "2024-01-25", t.malfunctions, S, {"Temperature": 1.8}).select(*KEYS, "mean")


@query(
    "p13_location_metadata",
    """SELECT o_orderkey, date_trunc('day', o_orderdate) AS data_start, CASE WHEN o_orderstatus = 'F' THEN date_trunc('day', o_orderdate) + INTERVAL 400 DAY ELSE TIMESTAMP '2030-01-01' END AS data_end,
      CASE WHEN o_orderstatus = 'F' AND year(o_orderdate) = year(o_orderdate + INTERVAL 400 DAY) THEN CAST(year(o_orderdate) AS VARCHAR)
        ELSE concat_ws('-', year(o_orderdate), year(CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 400 DAY ELSE TIMESTAMP '2030-01-01' END)) END AS years FROM orders""",
)
def _(t):
    last = F.when(F.col("o_orderstatus") == "F", F.date_format(F.date_add("o_orderdate", 400), "MM/dd/yyyy"))
    d = t.table("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("first"), last.alias("last"))
    return pb.location_metadata(d, "first", "last", "2030-01-01").drop("first", "last")


SITES3 = ["s00", "s01", "s02"]


@query(
    "p14_site_compare",
    "SELECT parameter, dt_round, " + ", ".join(f"round(max(mean) FILTER (site = '{s}'), 6) AS {s}" for s in SITES3) + " FROM fx_slots GROUP BY 1, 2",
)
def _(t):
    return pb.site_compare(t.slots, SITES3, ["parameter", "dt_round"])

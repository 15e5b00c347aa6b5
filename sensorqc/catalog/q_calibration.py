"""Calibration queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorqc.catalog.fixtures import S
from sensorqc.catalog.registry import query
from sensorqc.functions import time as tm
from sensorqc.operators import calibration as cal

CHUNK = 6 * 3600
KEYS = ["site", "parameter", "dt_round"]
LL = """SELECT *, lag(slope) OVER w AS slope_lag, lag("offset") OVER w AS offset_lag, lag(sensor_date) OVER w AS sensor_date_lag,
  lead(slope) OVER w AS slope_lead, lead("offset") OVER w AS offset_lead, lead(sensor_date) OVER w AS sensor_date_lead
  FROM fx_calibrations WINDOW w AS (PARTITION BY site, parameter ORDER BY sensor_date, id)"""
JOINED = f"""ll AS ({LL}), j AS (SELECT s.site, s.parameter, s.dt_round, s.mean, l.* EXCLUDE (site, parameter, id) FROM fx_series s
  ASOF LEFT JOIN ll l ON l.site = s.site AND l.parameter = s.parameter AND s.dt_round >= l.sensor_date)"""
WEIGHTED = f"""{JOINED}, w AS (SELECT *, min(dt_round) OVER p AS a, max(dt_round) OVER p AS b FROM j WHERE sensor_date IS NOT NULL WINDOW p AS (PARTITION BY site, parameter, sensor_date)),
  x AS (SELECT *, CASE WHEN b > a THEN (epoch(dt_round) - epoch(a)) / (epoch(b) - epoch(a)) ELSE 0 END AS wt,
    (mean - "offset") / slope AS mean_raw, coalesce(slope_lead, slope) AS slope_final, coalesce(offset_lead, "offset") AS offset_final FROM w)"""
COEFS = ["slope", "offset", "slope_lag", "offset_lag", "slope_lead", "offset_lead"]


def joined(t):
    c = cal.lag_lead(t.calibrations, ["site", "parameter"], chunk_seconds=CHUNK)
    return cal.join_calibration(t.series.select(*KEYS, "mean"), c, S, ["sensor_date", *COEFS])


def weighted(t):
    d = cal.temporal_weight(joined(t).filter("sensor_date is not null"), ["site", "parameter", "sensor_date"], "dt_round")
    return d.withColumns(
        {
            "mean_raw": cal.inverse_linear(F.col("mean"), F.col("slope"), F.col("offset")),
            "slope_final": F.coalesce("slope_lead", "slope"),
            "offset_final": F.coalesce("offset_lead", "offset"),
        }
    )


@query("c01_asof_calibration", f'WITH {JOINED} SELECT site, parameter, dt_round, sensor_date, @slope, round("offset", 6) AS "offset" FROM j')
def _(t):
    return joined(t).select(*KEYS, "sensor_date", "slope", "offset")


@query(
    "c02_lag_lead",
    f"""SELECT id, site, parameter, sensor_date, @slope_lag, @offset_lag, sensor_date_lag, @slope_lead, @offset_lead, sensor_date_lead FROM ({LL})""",
)
def _(t):
    return cal.lag_lead(t.calibrations, ["site", "parameter"], chunk_seconds=CHUNK).drop("slope", "offset")


@query(
    "c03_cal_windows",
    f"""WITH {JOINED}, c AS (SELECT *, (row_number() OVER w > 1 AND sensor_date IS DISTINCT FROM lag(sensor_date) OVER w)::INT AS ch FROM j WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round))
    SELECT site, parameter, dt_round, CAST(sum(ch) OVER (PARTITION BY site, parameter ORDER BY dt_round) AS BIGINT) AS cal_window_id FROM c""",
)
def _(t):
    return cal.calibration_windows(joined(t), S).select(*KEYS, "cal_window_id")


@query("c04_weight", f"WITH {WEIGHTED} SELECT site, parameter, dt_round, sensor_date, @wt FROM x")
def _(t):
    return weighted(t).select(*KEYS, "sensor_date", "wt")


@query("c05_inverse_linear", f"WITH {WEIGHTED} SELECT site, parameter, dt_round, @mean_raw FROM x")
def _(t):
    return weighted(t).select(*KEYS, "mean_raw")


SLOPE_T, OFFSET_T = "(slope + wt * (slope_lead - slope))", '("offset" + wt * (offset_lead - "offset"))'


def _args(t):
    d = weighted(t)
    return d, [F.col(c) for c in ("mean_raw", "slope", "offset", "slope_lead", "offset_lead", "wt")]


@query("c06_linear_transform", f"WITH {WEIGHTED} SELECT site, parameter, dt_round, round(mean_raw * {SLOPE_T} + {OFFSET_T}, 6) AS mean_lm_trans FROM x")
def _(t):
    d, a = _args(t)
    return d.select(*KEYS, cal.linear_transform(*a).alias("mean_lm_trans"))


@query("c07_ph_transform", f"WITH {WEIGHTED} SELECT site, parameter, dt_round, round((mean_raw - {OFFSET_T}) / {SLOPE_T}, 6) AS mean_lm_trans FROM x")
def _(t):
    d, a = _args(t)
    return d.select(*KEYS, cal.ph_transform(*a).alias("mean_lm_trans"))


CHOICE = """CASE (epoch_us(sensor_date) // 1000000) % 4 WHEN 0 THEN 'Original' WHEN 1 THEN 'Lag' WHEN 2 THEN 'Lead' END"""
CHOSEN = f"""{WEIGHTED}, f AS (SELECT *, CASE WHEN dt_round = a THEN {CHOICE} END AS d0 FROM x),
  g AS (SELECT *, coalesce(last_value(d0 IGNORE NULLS) OVER dn, first_value(d0 IGNORE NULLS) OVER up) AS pick FROM f
    WINDOW dn AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), up AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
  h AS (SELECT *, CASE pick WHEN 'Original' THEN slope WHEN 'Lag' THEN slope_lag WHEN 'Lead' THEN slope_lead ELSE slope_final END AS sf,
    CASE pick WHEN 'Original' THEN "offset" WHEN 'Lag' THEN offset_lag WHEN 'Lead' THEN offset_lead ELSE offset_final END AS of_,
    CASE pick WHEN 'Original' THEN slope WHEN 'Lag' THEN slope_lag ELSE slope_lead END AS st,
    CASE pick WHEN 'Original' THEN "offset" WHEN 'Lag' THEN offset_lag ELSE offset_lead END AS ot FROM g),
  k AS (SELECT *, CASE WHEN parameter <> 'Temperature' THEN mean_raw * (sf + wt * (st - sf)) + (of_ + wt * (ot - of_)) END AS mean_lm_trans FROM h)"""


def _chosen(t):
    d = weighted(t)
    firsts = d.groupBy("site", "parameter", "sensor_date").agg(F.min("dt_round").alias("dt_round"))
    epoch = F.unix_seconds("sensor_date") % 4
    pick = F.when(epoch == 0, "Original").when(epoch == 1, "Lag").when(epoch == 2, "Lead")
    decisions = firsts.withColumns({"from": pick, "to": pick})
    return cal.choose_coefficients(d, decisions, S)


@query(
    "c10_reviewer_choice",
    f"""WITH {CHOSEN} SELECT site, parameter, dt_round, pick AS "from", round(sf, 6) AS updated_slope_from, round(of_, 6) AS updated_offset_from, round(st, 6) AS updated_slope_to, round(ot, 6) AS updated_offset_to FROM h""",
)
def _(t):
    return _chosen(t).select(*KEYS, "from", "updated_slope_from", "updated_offset_from", "updated_slope_to", "updated_offset_to")


CHECK = "(mean_lm_trans IS NOT NULL AND coalesce(pick, '') <> 'Original')"


@query("c08_cal_check", f"WITH {CHOSEN} SELECT site, parameter, dt_round, @mean_lm_trans, {CHECK} AS cal_check FROM k")
def _(t):
    return cal.recalibrate(_chosen(t)).select(*KEYS, "mean_lm_trans", "cal_check")


@query("c09_final_value", f"WITH {CHOSEN} SELECT site, parameter, dt_round, round(CASE WHEN {CHECK} THEN mean_lm_trans ELSE mean END, 6) AS mean_cal FROM k")
def _(t):
    return cal.recalibrate(_chosen(t)).select(*KEYS, "mean_cal")


@query(
    "c11_merge_calibrated",
    f"""WITH {CHOSEN} SELECT k.site, k.parameter, k.dt_round, round(k.mean, 6) AS mean_pre_cal, round(CASE WHEN {CHECK} THEN mean_lm_trans ELSE k.mean END, 6) AS mean,
      CAST(coalesce((NOT (slope = st AND slope = sf))::INT, -1) AS BIGINT) AS back_cal_performed, coalesce(s.n_obs, 0) AS n_obs, round(s.spread, 6) AS spread FROM k JOIN fx_series s USING (site, parameter, dt_round) WHERE k.parameter <> 'Temperature'
    UNION ALL SELECT site, parameter, dt_round, @mean, @mean, 0, coalesce(n_obs, 0), @spread FROM fx_series WHERE parameter = 'Temperature'""",
)
def _(t):
    c = cal.recalibrate(_chosen(t)).filter("parameter <> 'Temperature'")
    out = cal.merge_calibrated(c, t.series, S)
    return out.withColumn("back_cal_performed", F.coalesce(F.col("back_cal_performed").cast("long"), F.lit(-1).cast("long"))).fillna(0, ["n_obs"])


@query(
    "c12_first_of_calibration",
    f"WITH {JOINED} SELECT site, parameter, sensor_date, min(dt_round) AS dt_round, round(min_by(coalesce(mean, -1), dt_round), 6) AS mean FROM j WHERE sensor_date IS NOT NULL GROUP BY 1, 2, 3",
)
def _(t):
    d = joined(t).filter("sensor_date is not null").select(*KEYS, "sensor_date", F.coalesce("mean", F.lit(-1.0)).alias("mean"))
    return cal.first_of_calibration(d, S)


STEPS = """st AS (SELECT *, lag(mean, 2) OVER w AS before, lead(mean, 5) OVER w AS after FROM fx_flagged WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round)),
  sp AS (SELECT *, after - before AS difference, CASE WHEN after <> 0 AND before <> 0 THEN (after - before) / abs(before) * 100 END AS percent_change,
    CASE WHEN after <> 0 AND before <> 0 THEN abs(after - before) / abs((after + before) / 2) * 100 END AS percent_difference FROM st)"""


@query("c13_visit_steps", f"WITH {STEPS} SELECT site, parameter, dt_round, @before, @after, @difference, @percent_change, @percent_difference FROM sp")
def _(t):
    return cal.visit_steps(t.flagged, S).drop("mean", "spread", "n_obs", "flag")


RATED = f"""{STEPS}, u AS (SELECT site, parameter, avg(percent_difference) AS mean_dif, avg(percent_change) AS mean_change FROM sp WHERE NOT coalesce(regexp_matches(flag, 'site visit|sv window'), false) GROUP BY 1, 2),
  rt AS (SELECT sp.*, mean_dif, mean_change, CASE WHEN percent_difference > mean_dif THEN 'BAD' WHEN percent_difference <= mean_dif THEN 'GOOD' END AS acceptable_dif,
    CASE WHEN percent_change > mean_change THEN 'BAD' WHEN percent_change <= mean_change THEN 'GOOD' END AS acceptable_change FROM sp LEFT JOIN u USING (site, parameter) WHERE contains(flag, 'site visit') AND percent_difference IS NOT NULL)"""


def _rated(t):
    s = cal.visit_steps(t.flagged, S)
    near = F.coalesce(F.col("flag").rlike("site visit|sv window"), F.lit(False))
    return cal.rate_visit_steps(s, F.coalesce(F.col("flag").contains("site visit"), F.lit(False)), near)


@query("c14_visit_rating", f"WITH {RATED} SELECT site, parameter, dt_round, @mean_dif, @mean_change, acceptable_dif, acceptable_change FROM rt")
def _(t):
    return _rated(t).select(*KEYS, "mean_dif", "mean_change", "acceptable_dif", "acceptable_change")


@query("c14_bad_counts", f"WITH {RATED} SELECT site, parameter, count(*) AS instances FROM rt WHERE acceptable_change = 'BAD' GROUP BY 1, 2")
def _(t):
    return cal.count_bad(_rated(t))


@query(
    "c15_fill_both_ways",
    """WITH c AS (SELECT site, parameter, make_timestamp(CAST((epoch_us(sensor_date) // 21600000000) * 21600000000 AS BIGINT)) AS dt_round, max(slope) AS slope FROM fx_calibrations GROUP BY 1, 2, 3),
      f AS (SELECT * FROM (SELECT site, parameter, dt_round, mean FROM fx_series) FULL JOIN c USING (site, parameter, dt_round))
    SELECT site, parameter, dt_round, @mean, round(coalesce(first_value(slope IGNORE NULLS) OVER up, last_value(slope IGNORE NULLS) OVER dn), 6) AS slope FROM f
    WINDOW dn AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), up AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
)
def _(t):
    c = t.calibrations.groupBy("site", "parameter", tm.floor_slot("sensor_date", S.step).alias("dt_round")).agg(F.max("slope").alias("slope"))
    return cal.fill_calibration(t.series.select(*KEYS, "mean"), c, S, ["slope"])

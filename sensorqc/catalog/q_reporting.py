"""Report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorqc.catalog.fixtures import S, slot_sql
from sensorqc.catalog.q_thresholds import SEASON, T_TAIL, YEARS, years
from sensorqc.catalog.registry import query
from sensorqc.functions import time as tm
from sensorqc.operators import reporting as rp
from sensorqc.plans.chunks import time_chunk
from sensorqc.series import Series

KEYS = ["site", "parameter", "dt_round"]
SEP = "';' || chr(10)"
FLAGS = ["drift", "site visit", "missing data", "outside of sensor specification range", "repeated value"]
DAY = 86400

MISSING_SETS = ", ".join("list_sort([" + ", ".join(f"'{x}'" for x in sorted(s)) + "])" for s in rp.MISSING_ONLY)
REPORT = f"""a AS (SELECT site, parameter, CAST(dt_round AS DATE) AS d, flag IS NULL AS nf, string_split(coalesce(flag, ''), {SEP}) AS tk, list_sort(list_distinct(string_split(coalesce(flag, ''), {SEP}))) NOT IN ({MISSING_SETS}) AS re FROM fx_flagged),
  t AS (SELECT site, parameter, count(*) AS tot_data, count(DISTINCT d) AS tot_date, count(*) FILTER (nf) AS no_flag_data, count(DISTINCT d) FILTER (nf) AS no_flag_date, count(*) FILTER (re) AS tot_nona_data,
    count(DISTINCT d) FILTER (re) AS tot_nona_date, count(*) FILTER (nf AND re) AS no_flag_nona_data, count(DISTINCT d) FILTER (nf AND re) AS no_flag_nona_date FROM a GROUP BY 1, 2),
  g AS (SELECT site, parameter, f.flag, count(*) AS flag_data, count(DISTINCT d) AS flag_date, count(*) FILTER (re) AS flag_nona_data, count(DISTINCT d) FILTER (re) AS flag_nona_date FROM a, (SELECT unnest({FLAGS!r}) AS flag) f WHERE list_contains(tk, f.flag) GROUP BY 1, 2, 3)"""
PCT = ", ".join(
    f"CASE WHEN {w}_{k} > 0 THEN round({p}_{k} / {w}_{k} * 100, 6) END AS {p}_{k}_pct" for k in ("data", "date") for p, w in (("no_flag", "tot"), ("flag", "tot"), ("flag_nona", "tot_nona"), ("no_flag_nona", "tot_nona"))
)


@query(
    "r01_flag_report",
    f"""WITH {REPORT}, z AS (SELECT t.*, f.flag, coalesce(flag_data, 0) AS flag_data, coalesce(flag_date, 0) AS flag_date, coalesce(flag_nona_data, 0) AS flag_nona_data, coalesce(flag_nona_date, 0) AS flag_nona_date
      FROM t CROSS JOIN (SELECT unnest({FLAGS!r}) AS flag) f LEFT JOIN g ON g.site = t.site AND g.parameter = t.parameter AND g.flag = f.flag) SELECT *, {PCT} FROM z""",
)
def _(t):
    return rp.flag_report(t.flagged, FLAGS)


YS = """c AS (SELECT *, CAST(year(dt_round) AS BIGINT) AS yr FROM fx_flagged WHERE NOT coalesce(regexp_matches(flag, 'site visit|missing data'), false)),
  y AS (SELECT site, parameter, yr AS year, count(*) AS total, unnest(['drift', 'spec']) AS name, unnest([count(*) FILTER (contains(flag, 'drift')), count(*) FILTER (contains(flag, 'sensor specification range'))]) AS value FROM c GROUP BY 1, 2, 3)"""
CLASSES = {"drift": "drift", "spec": "sensor specification range"}


@query("r02_yearly_shares", f"WITH {YS} SELECT *, round(value / total * 100, 6) AS percentage FROM y")
def _(t):
    return rp.yearly_shares(t.flagged, classes=CLASSES)


@query("r02_parameter_year_mean", f"WITH {YS} SELECT parameter, year, round(avg(value / total * 100), 6) AS mean FROM y GROUP BY 1, 2")
def _(t):
    return rp.parameter_year_mean(rp.yearly_shares(t.flagged, classes=CLASSES))


@query("r03_flag_combinations", "SELECT flag, count(*) AS n FROM fx_flagged GROUP BY 1")
def _(t):
    return rp.flag_combinations(t.flagged)


COUNTED = "(SELECT * FROM fx_verification WHERE coalesce(parameter, '') NOT IN ('Depth', 'FDOM Fluorescence', 'Chl-a Fluorescence'))"
BAD = """b AS (SELECT site, parameter, CAST(dt_round AS DATE) AS date, count(*) FILTER (flag IS NOT NULL AND mean IS NOT NULL AND (regexp_matches(flag, 'sonde unsubmerged|outside of sensor specification range|sensor malfunction|sonde burial')
    OR (parameter = 'Turbidity' AND contains(flag, 'drift') AND mean >= 40) OR verification_status = 'OMIT')) AS nb, count(*) FILTER (parameter = 'Temperature' AND mean IS NULL) AS ng FROM """ + COUNTED + """ {} GROUP BY 1, 2, 3),
  bd AS (SELECT DISTINCT site, date FROM b WHERE nb >= 2 OR ng >= 2)"""
DOWN = BAD + """, dn AS (SELECT site, days, coalesce(bad_days, 0) AS bad_days, coalesce(bad_days, 0) / days * 100 AS perc_days FROM (SELECT site, count(DISTINCT CAST(dt_round AS DATE)) AS days FROM """ + COUNTED + """ {} GROUP BY 1)
  LEFT JOIN (SELECT site, count(*) AS bad_days FROM bd GROUP BY 1) USING (site))"""


@query("r04_bad_days", f"WITH {BAD.format('')} SELECT site, CAST(date AS TIMESTAMP) AS date FROM bd")
def _(t):
    d = rp.bad_days(t.verification, min_rows=2)
    return d.withColumn("date", F.col("date").cast("timestamp"))


@query("r04_down_days", f"WITH {DOWN.format('', '')} SELECT site, days, bad_days, @perc_days FROM dn")
def _(t):
    return rp.down_days(t.verification, min_rows=2)


HALF = "WHERE dt_round {} TIMESTAMP '2024-01-16'"


@query(
    "r05_compare_years",
    f"""WITH p AS (WITH {DOWN.format(HALF.format('<'), HALF.format('<'))} SELECT * FROM dn), q AS (WITH {DOWN.format(HALF.format('>='), HALF.format('>='))} SELECT * FROM dn)
    SELECT q.site, q.bad_days, round(q.perc_days, 6) AS perc_days, p.bad_days AS bad_days_previous, round(p.perc_days, 6) AS perc_days_previous, q.bad_days - p.bad_days AS bad_days_change,
      round(q.perc_days - p.perc_days, 6) AS perc_days_change FROM p JOIN q USING (site)""",
)
def _(t):
    a, b = (rp.down_days(t.verification.filter(c), min_rows=2) for c in ("dt_round < '2024-01-16'", "dt_round >= '2024-01-16'"))
    return rp.compare_years(b.drop("days"), a, ["site"], ["bad_days", "perc_days"])


@query("r06_date_grid", "SELECT site, CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-03-31', INTERVAL 1 DAY)) AS TIMESTAMP) AS date FROM fx_sites")
def _(t):
    d = rp.date_grid(t.sites, "2024-01-01", "2024-03-31")
    return d.withColumn("date", F.col("date").cast("timestamp"))


@query(
    "r07_accuracy",
    """WITH a AS (SELECT site, parameter, ((flag IS NULL) = (n_obs >= 2))::INT::DOUBLE AS ok FROM (SELECT site, parameter, flag, coalesce(n_obs, 0) AS n_obs FROM fx_flagged))
    SELECT site, parameter, round(avg(ok) * 100, 6) AS accuracy FROM a GROUP BY 1, 2 UNION ALL SELECT 'Network Total', parameter, round(avg(ok) * 100, 6) FROM a GROUP BY 2""",
)
def _(t):
    d = t.flagged.withColumn("user_flag", F.when(F.coalesce("n_obs", F.lit(0)) < 2, "user"))
    return rp.flag_accuracy(d)


@query(
    "r08_summary_statistics",
    """SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n, round(avg(l_extendedprice), 6) AS mean, round(stddev_samp(l_extendedprice), 6) AS sd, round(min(l_extendedprice), 6) AS min,
      round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, round(median(l_extendedprice), 6) AS median, round(quantile_cont(l_extendedprice, 0.75), 6) AS q3, round(max(l_extendedprice), 6) AS max FROM lineitem GROUP BY 1, 2""",
)
def _(t):
    return rp.summary_statistics(t.table("lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")


REPORT_SEASON = "CASE WHEN month(dt_round) IN (11,12,1,2,3,4) THEN 'Nov-Apr' WHEN month(dt_round) IN (5,6) THEN 'May-Jun' WHEN month(dt_round) IN (7,8) THEN 'Jul-Aug' ELSE 'Sep-Oct' END"


@query(
    "r09_seasonal_statistics",
    f"SELECT site, {REPORT_SEASON} AS season, round(avg(mean), 6) AS mean, round(stddev_samp(mean), 6) AS sd, round(quantile_cont(mean, 0.01), 6) AS p01, round(quantile_cont(mean, 0.99), 6) AS p99 FROM ({YEARS}) GROUP BY 1, 2",
)
def _(t):
    return rp.seasonal_statistics(years(t), ["site"], "dt_round")


@query(
    "r10_histogram",
    f"""SELECT parameter, season, year, bin, count(*) AS n FROM (SELECT parameter, {SEASON} AS season, CAST(year(dt_round) AS BIGINT) AS year, floor(mean / w) * w AS bin FROM
      (SELECT *, CASE parameter WHEN 'Specific Conductivity' THEN 10.0::DOUBLE WHEN 'Turbidity' THEN 10.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM fx_slots)) GROUP BY 1, 2, 3, 4""",
)
def _(t):
    d = t.slots.withColumns({"season": tm.season("dt_round"), "year": F.year("dt_round").cast("long")})
    return rp.histogram(d, ["parameter", "season", "year"])


CAP = "CASE WHEN parameter = 'Turbidity' AND mean > 1000 THEN 1000 {} ELSE mean END"


@query(
    "r11_plausible_verified",
    f"""SELECT site, parameter, dt_round, round({CAP.format("WHEN parameter = 'Turbidity' AND mean <= 1 THEN 1")}, 6) AS mean FROM (SELECT * REPLACE (mean * 12 AS mean) FROM fx_verification) WHERE mean <> 0
      AND (verification_status = 'PASS' OR (verification_status = 'FLAGGED' AND NOT coalesce(contains(flag, 'drift'), false)))""",
)
def _(t):
    d = t.verification.withColumns({"final_status": F.col("verification_status"), "user_flag": F.col("flag"), "mean": F.col("mean") * 12})
    return rp.plausible(d, True).select(*KEYS, "mean")


@query(
    "r11_plausible_raw",
    f"""SELECT site, parameter, dt_round, round({CAP.format('')}, 6) AS mean FROM (SELECT * REPLACE (mean * 12 AS mean) FROM fx_verification) WHERE mean <> 0 AND coalesce(n_obs, 0) < 4
      AND NOT coalesce(contains(flag, 'site visit'), false) AND NOT (parameter = 'Temperature' AND mean > 30) AND NOT (parameter = 'DO' AND mean < 2) AND NOT (parameter = 'Specific Conductivity' AND mean > 3000)""",
)
def _(t):
    d = t.verification.withColumns({"auto_flag": F.col("flag"), "mal_flag": F.when(F.col("n_obs") >= 4, "mal"), "mean": F.col("mean") * 12})
    return rp.plausible(d, False).select(*KEYS, "mean")


@query(
    "r12_climatology",
    f"SELECT site, parameter, CAST(dayofyear(dt_round) AS BIGINT) AS doy, round(median(mean), 6) AS median, round(min(mean), 6) AS min, round(max(mean), 6) AS max FROM ({YEARS}) WHERE mean IS NOT NULL GROUP BY 1, 2, 3",
)
def _(t):
    return rp.climatology(years(t))


@query(
    "r13_event_slice",
    f"""WITH m AS (SELECT site, parameter, {slot_sql('ts', True, 7200)} AS dt_round, median(value) AS median FROM fx_readings GROUP BY 1, 2, 3),
      g AS (SELECT site, parameter, unnest(generate_series(min(dt_round), max(dt_round), INTERVAL 2 HOUR)) AS dt_round FROM m GROUP BY 1, 2)
    SELECT site, parameter, dt_round, @median FROM g LEFT JOIN m USING (site, parameter, dt_round) WHERE dt_round BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'""",
)
def _(t):
    return rp.event_slice(t.readings, Series(step=7200, chunk=64), "ts", "value", "2024-01-10", "2024-01-20")


WK = "CAST(year({0}) AS BIGINT) AS year, CAST((dayofyear({0}) - 1) // 7 + 1 AS BIGINT) AS week"


@query(
    "r14_weekly_means",
    f"""SELECT site, parameter, {WK.format('dt_round')}, round(avg(mean), 6) AS mean FROM (SELECT site, parameter, dt_round, mean FROM ({YEARS}) UNION ALL SELECT site, 'Flow', ts, value FROM fx_readings) GROUP BY 1, 2, 3, 4""",
)
def _(t):
    flow = t.readings.select("site", F.lit("Flow").alias("parameter"), F.col("ts").alias("dt_round"), F.col("value").alias("mean"))
    return rp.weekly_means(years(t).unionByName(flow), ["site", "parameter"], "dt_round")


@query(
    "r15_hour_profile",
    f"""SELECT site, {SEASON.replace('dt_round', 'ts')} AS season, CAST(hour(ts) AS BIGINT) AS hour, round(avg(value), 6) AS hour_mean, round(median(value), 6) AS hour_median FROM fx_readings GROUP BY 1, 2, 3""",
)
def _(t):
    return rp.hour_profile(t.readings, ["site"], "ts", "value")


PRECIP = "pr AS (SELECT site AS station, CAST(substr(site, 2) AS BIGINT) // 5 AS watershed, ts, CASE WHEN k < 30 THEN 0 ELSE value / 10 END AS p_cm FROM fx_events WHERE event_type = 'purchase')"


def precip(t):
    d = t.events.filter("event_type = 'purchase'")
    ws = F.floor(F.substring("site", 2, 9).cast("long") / 5)
    return d.select(F.col("site").alias("station"), ws.alias("watershed"), "ts", F.when(F.col("k") < 30, 0.0).otherwise(F.col("value") / 10).alias("p_cm"))


@query(
    "r16_watershed_precip",
    f"""WITH {PRECIP} SELECT watershed, {slot_sql('ts', True, DAY)} AS day, round(sum(p_cm), 6) AS total_precip, count(DISTINCT station) AS num_sites, round(sum(p_cm) / count(DISTINCT station), 6) AS avg_precip
     FROM pr WHERE p_cm > 0 AND p_cm < 20 GROUP BY 1, 2""",
)
def _(t):
    return rp.watershed_precip(precip(t), "ts")


@query(
    "r17_daily_precip",
    f"WITH {PRECIP} SELECT station, date_trunc('day', ts)::TIMESTAMP AS date, round(sum(p_cm), 6) AS daily_precip, sum(p_cm) > 0 AS is_wet FROM pr WHERE p_cm < 20 GROUP BY 1, 2",
)
def _(t):
    return rp.daily_precip(precip(t), "ts").withColumn("date", F.col("date").cast("timestamp"))


STORM = f"""{PRECIP}, h AS (SELECT station, {slot_sql('ts', True, 3600)} AS dt_round, sum(p_cm) AS v FROM pr WHERE p_cm < 20 GROUP BY 1, 2),
  gd AS (SELECT station, unnest(generate_series(min(dt_round), max(dt_round), INTERVAL 1 HOUR)) AS dt_round FROM h GROUP BY 1), f AS (SELECT station, dt_round, coalesce(v, 0) AS value FROM gd LEFT JOIN h USING (station, dt_round)),
  l AS (SELECT *, last_value(CASE WHEN value > 0 THEN dt_round END IGNORE NULLS) OVER w AS last_rain_time, last_value(CASE WHEN value > 0 THEN dt_round END IGNORE NULLS) OVER p AS prev_rain FROM f
    WINDOW w AS (PARTITION BY station ORDER BY dt_round), p AS (PARTITION BY station ORDER BY dt_round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  n AS (SELECT *, CAST(sum(coalesce({{}}, false)::INT) OVER (PARTITION BY station ORDER BY dt_round) AS BIGINT) AS storm_id FROM l)
  SELECT station, dt_round, @value, last_rain_time, storm_id, round(sum(value) OVER (PARTITION BY station, storm_id ORDER BY dt_round), 6) AS cumulative_storm_precip FROM n"""


@query("r18_storms", f"WITH {STORM.format('epoch(dt_round) - epoch(last_rain_time) > 21600')}")
def _(t):
    return rp.storms(precip(t), "ts", chunk=96)


@query("r18_storm_sessions", f"WITH {STORM.format('value > 0 AND epoch(dt_round) - epoch(prev_rain) > 21600')}")
def _(t):
    return rp.storms(precip(t), "ts", chunk=96, sessions=True)


@query(
    "r19_peak_hours",
    f"""WITH {PRECIP}, h AS (SELECT watershed, CAST(hour(ts) AS BIGINT) AS hour, round(sum(p_cm), 6) AS total FROM pr GROUP BY 1, 2)
    SELECT watershed, hour, total FROM (SELECT *, rank() OVER (PARTITION BY watershed ORDER BY total DESC) AS rk FROM h) WHERE rk = 1""",
)
def _(t):
    return rp.peak_hours(precip(t), ["watershed"], "ts", "p_cm")


@query(
    "r20_standards",
    f"""WITH s AS (SELECT site, CASE WHEN CAST(substr(site, 2) AS INT) % 2 = 0 THEN 11 ELSE 4 END AS a, CASE WHEN CAST(substr(site, 2) AS INT) % 2 = 0 THEN 3 ELSE 9 END AS z FROM fx_sites)
    SELECT y.site, CAST(month(dt_round) AS BIGINT) AS month, count(mean) AS n, count(*) FILTER (mean < 500 OR mean > 2000) AS n_exceed FROM ({YEARS}) y JOIN s ON s.site = y.site
      AND (CASE WHEN a <= z THEN month(dt_round) BETWEEN a AND z ELSE month(dt_round) >= a OR month(dt_round) <= z END) GROUP BY 1, 2""",
)
def _(t):
    odd = F.substring("site", 2, 9).cast("int") % 2 == 1
    standards = t.sites.select("site", F.when(odd, "April-September").otherwise("November-March").alias("season"), F.lit(500.0).alias("low"), F.lit(2000.0).alias("high"))
    return rp.standards_check(years(t), standards, "dt_round")


@query(
    "r21_monthly_box",
    f"SELECT site, parameter, CAST(month(dt_round) AS BIGINT) AS month, round(quantile_cont(mean, 0.25), 6) AS q1, round(median(mean), 6) AS median, round(quantile_cont(mean, 0.75), 6) AS q3 FROM ({YEARS}) WHERE mean IS NOT NULL GROUP BY 1, 2, 3",
)
def _(t):
    return rp.monthly_box(years(t), "dt_round")


@query(
    "r22_water_year",
    f"""WITH y AS (SELECT site, strftime(dt_round, '%m-%d') AS month_day, CASE WHEN month(dt_round) >= 10 THEN year(dt_round) + 1 ELSE year(dt_round) END AS wy, mean FROM ({YEARS})),
      p AS (SELECT site, month_day, round(median(mean), 6) AS past_median, round(min(mean), 6) AS past_min, round(max(mean), 6) AS past_max FROM y WHERE wy <> 1997 AND mean IS NOT NULL GROUP BY 1, 2),
      c AS (SELECT site, month_day, round(avg(mean), 6) AS current_mean FROM y WHERE wy = 1997 GROUP BY 1, 2)
    SELECT * FROM p LEFT JOIN c USING (site, month_day)""",
)
def _(t):
    return rp.water_year_compare(years(t), ["site"], "dt_round", "mean", 1997)


LM = "xy AS (SELECT a.site, a.dt_round, a.mean AS y, b.mean AS x FROM fx_slots a JOIN fx_slots b ON a.site = b.site AND a.dt_round = b.dt_round AND a.parameter = 'Turbidity' AND b.parameter = 'Temperature')"


def _xy(t):
    y = t.slots.filter("parameter = 'Turbidity'").select("site", "dt_round", F.col("mean").alias("y"))
    x = t.slots.filter("parameter = 'Temperature'").select("site", "dt_round", F.col("mean").alias("x"))
    return y.join(x, ["site", "dt_round"])


@query("r23_linear_model", f"WITH {LM} SELECT site, round(regr_slope(y, x), 6) AS slope, round(regr_r2(y, x), 6) AS r_squared, CAST(regr_count(y, x) AS BIGINT) AS n FROM xy GROUP BY 1")
def _(t):
    return rp.linear_models(_xy(t), ["site"], "y", "x", pvalue=False)


@query(
    "r23_linear_model_p",
    f"""WITH {LM}, f AS (SELECT site, regr_slope(y, x) AS slope, regr_r2(y, x) AS r_squared, CAST(regr_count(y, x) AS BIGINT) AS n FROM xy GROUP BY 1),
      a AS (SELECT *, n - 2 AS d, atan(sqrt(r_squared / (1 - r_squared))) AS theta FROM f)
    SELECT site, @slope, @r_squared, n, CASE WHEN n > 2 AND r_squared < 1 THEN round({T_TAIL.format('theta', 'd')}, 6) END AS p_value FROM a""",
)
def _(t):
    return rp.linear_models(_xy(t), ["site"], "y", "x")


PAIR = """pr AS (SELECT p.site AS site1, p.neighbour AS site2, a.parameter, a.mean AS y, b.mean AS x FROM fx_pairs p JOIN fx_slots a ON a.site = p.site JOIN fx_slots b ON b.site = p.neighbour AND b.parameter = a.parameter AND b.dt_round = a.dt_round),
  ft AS (SELECT site1, site2, parameter, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_r2(y, x) AS r_squared, count(*) AS n FROM pr GROUP BY 1, 2, 3),
  rs AS (SELECT site1, site2, parameter, count(*) * regr_r2(power(y - intercept - slope * x, 2), x) AS bp_statistic FROM pr JOIN ft USING (site1, site2, parameter) GROUP BY 1, 2, 3)"""


@query("r24_pair_regression", f"WITH {PAIR} SELECT site1, site2, parameter, @slope, @intercept, @r_squared, n, @bp_statistic FROM ft JOIN rs USING (site1, site2, parameter)")
def _(t):
    pairs = t.pairs.select(F.col("site").alias("site1"), F.col("neighbour").alias("site2"))
    return rp.pair_regression(t.slots, pairs, "dt_round", "mean", pvalue=False)


#: Upper tail of chi-squared with one degree of freedom: the normal density beyond its root on both sides, by Simpson's rule.
CHI_TAIL = """(SELECT sum((CASE WHEN k = 0 OR k = 2000 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * exp(-power(sqrt({0}) + k * 12 / 2000.0, 2) / 2)) * 12 / 6000 FROM (SELECT unnest(range(2001)) AS k)) * 2 / sqrt(2 * pi())"""


@query(
    "r24_pair_regression_p",
    f"""WITH {PAIR}, b AS (SELECT site1, site2, parameter, slope, intercept, r_squared, n, bp_statistic FROM ft JOIN rs USING (site1, site2, parameter))
    SELECT site1, site2, parameter, @slope, @intercept, @r_squared, n, @bp_statistic, round({CHI_TAIL.format('bp_statistic')}, 6) AS bp_p_value FROM b""",
)
def _(t):
    pairs = t.pairs.select(F.col("site").alias("site1"), F.col("neighbour").alias("site2"))
    return rp.pair_regression(t.slots, pairs, "dt_round", "mean")


ALARM = """lm AS (SELECT site, avg(value) + stddev_samp(value) AS warning, avg(value) + 2 * stddev_samp(value) AS alarm FROM fx_readings GROUP BY 1),
  tg AS (SELECT r.*, CASE WHEN value >= alarm THEN 'Alarm' WHEN value >= warning THEN 'Warning' ELSE 'None' END AS "trigger" FROM fx_readings r JOIN lm USING (site))"""


def limits(t):
    m, s = F.avg("value"), F.stddev_samp("value")
    return t.readings.groupBy("site").agg((m + s).alias("warning"), (m + 2 * s).alias("alarm"))


@query(
    "r25_alarm_counts",
    f"WITH {ALARM} SELECT site, count(*) FILTER (\"trigger\" = 'Alarm') AS \"Alarm\", count(*) FILTER (\"trigger\" = 'Warning') AS \"Warning\", count(*) FILTER (\"trigger\" = 'None') AS \"None\", count(*) AS total FROM tg GROUP BY 1",
)
def _(t):
    return rp.alarm_counts(rp.classify_alarms(t.readings, limits(t), "value"))


SUPPRESSED = f"""WITH {ALARM} SELECT id, site, ts, "trigger", CASE WHEN "trigger" = 'Alarm' AND lag("trigger") OVER w = 'Alarm' THEN 'Alarm_no_message' ELSE "trigger" END AS trigger_reduced FROM tg WINDOW w AS (PARTITION BY site ORDER BY ts, id)"""


@query("r26_alarm_suppression", SUPPRESSED)
def _(t):
    d = rp.classify_alarms(t.readings, limits(t), "value")
    return rp.suppress_alarms(d, ["site"], ["ts", "id"], time_chunk("ts", 6 * 3600)).select("id", "site", "ts", "trigger", "trigger_reduced")


CHARGE = """ch AS (SELECT category, staff, sum(hours) AS hours, sum(hours * rate) AS cost, string_agg(DISTINCT note, '; ' ORDER BY note) AS notes FROM
   (SELECT o_orderstatus AS category, 'p' || CAST(o_custkey % 5 AS VARCHAR) AS staff, o_totalprice / 10000 AS hours, 20 + o_custkey % 5 AS rate, o_orderpriority AS note FROM orders) GROUP BY 1, 2)"""


def _charges(t):
    staff = F.concat(F.lit("p"), (F.col("o_custkey") % 5).cast("string"))
    o = t.table("orders").select(F.col("o_orderstatus").alias("category"), staff.alias("staff"), (F.col("o_totalprice") / 10000).alias("hours"), F.col("o_orderpriority").alias("note"))
    rates = t.table("orders").select(staff.alias("staff"), (20 + F.col("o_custkey") % 5).alias("rate")).distinct()
    return rp.charges(o, rates, ["P"])


@query("r27_charges", f"WITH {CHARGE} SELECT category, staff, @hours, @cost, notes, category <> 'P' AS include FROM ch")
def _(t):
    return _charges(t)


@query(
    "r28_visit_summary",
    """WITH v AS (SELECT site, count(*) AS n, string_agg(DISTINCT CASE WHEN visit_type = 'Sensor Calibration & Check' THEN strftime(start_dt, '%Y-%m-%d') END, ', ' ORDER BY CASE WHEN visit_type = 'Sensor Calibration & Check' THEN strftime(start_dt, '%Y-%m-%d') END) AS c FROM fx_visits GROUP BY 1)
    SELECT s.site, coalesce(n, 0) AS n_visits, coalesce(c, 'None') AS calibrations FROM (SELECT site FROM fx_sites UNION ALL SELECT 'new site') s LEFT JOIN v USING (site)""",
)
def _(t):
    listed = t.sites.unionByName(t.sites.select(F.lit("new site").alias("site")).distinct())
    return rp.visit_summary(listed, t.visits, F.col("visit_type") == "Sensor Calibration & Check")


@query("r29_availability", "SELECT o_custkey, count(*) AS n, min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders GROUP BY 1")
def _(t):
    return rp.availability(t.table("orders"), ["o_custkey"], "o_orderdate")


@query("r30_years_per_site", "SELECT o_custkey, count(DISTINCT year(o_orderdate)) AS n_years FROM orders GROUP BY 1 HAVING count(DISTINCT year(o_orderdate)) >= 3")
def _(t):
    return rp.years_per_site(t.table("orders"), ["o_custkey"], "o_orderdate", 3)


@query(
    "r31_flagged_share",
    """SELECT site, parameter, label, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY site, parameter), 6) AS share FROM
     (SELECT site, parameter, CASE WHEN coalesce(regexp_matches(flag, 'drift|specification range'), false) THEN 'flag' ELSE 'no flag' END AS label FROM fx_flagged) GROUP BY 1, 2, 3""",
)
def _(t):
    return rp.flagged_share(t.flagged, ["drift", "outside of sensor specification range"])


@query("r32_charge_totals", f"WITH {CHARGE} SELECT CASE WHEN category <> 'P' THEN 'Billed' ELSE 'Contributed' END AS label, round(sum(cost), 4) AS total FROM ch GROUP BY 1")
def _(t):
    return rp.charge_totals(_charges(t)).withColumn("total", F.round("total", 4))

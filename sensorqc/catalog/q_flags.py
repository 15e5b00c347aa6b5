"""Flag queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorqc.catalog.fixtures import S, SPEC, STEP
from sensorqc.catalog.registry import query
from sensorqc.functions import tokens
from sensorqc.operators import flags as fl, grid
from sensorqc.plans.chunks import over_slots
from sensorqc.session import materialise

MIN = STEP // 60
SEP = "';' || chr(10)"
W = "WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round)"
KEYS = ["site", "parameter", "dt_round"]


def bare(df, mean=False):
    return df.select(*KEYS, tokens.render("flags").alias("flag"))


def unflagged(df):
    return df.withColumn("flags", tokens.empty())


def parsed(t):
    return t.flagged.withColumn("flags", tokens.parse("flag"))


def flag_sql(condition: str, text: str, source: str = "fx_series", window: str = "") -> str:
    return f"SELECT site, parameter, dt_round, CASE WHEN {condition} THEN '{text}' END AS flag FROM {source} {window}"


@query(
    "f01_add_flag",
    f"SELECT site, parameter, dt_round, nullif(concat_ws({SEP}, flag, CASE WHEN mean > 70 THEN 'high' END), '') AS flag FROM fx_flagged",
)
def _(t):
    return bare(parsed(t).withColumn("flags", tokens.add("flags", F.col("mean") > 70, "high")))


@query(
    "f02_alter_flag",
    "SELECT site, parameter, dt_round, CASE WHEN mean > 70 THEN replace(flag, 'drift', 'drift confirmed') ELSE flag END AS flag FROM fx_flagged",
)
def _(t):
    return bare(parsed(t).withColumn("flags", tokens.replace("flags", F.col("mean") > 70, "drift", "drift confirmed")))


@query(
    "f03_remove_tokens",
    f"""SELECT site, parameter, dt_round, nullif(array_to_string(list_filter(string_split(coalesce(flag, ''), {SEP}), lambda x: x NOT IN ('drift', 'site visit', '')), {SEP}), '') AS flag FROM fx_flagged""",
)
def _(t):
    return bare(parsed(t).withColumn("flags", tokens.remove("flags", "drift", "site visit")))


@query("f04_tidy_flags", "SELECT site, parameter, dt_round, flag FROM fx_flagged")
def _(t):
    messy = t.flagged.withColumn("raw", F.concat(F.coalesce("flag", F.lit("")), F.lit(";\n;")))
    return bare(messy.withColumn("flags", tokens.parse("raw")))


@query("f05_not_employed", flag_sql("sonde_employed = 1", "sonde not employed", "fx_state"))
def _(t):
    return bare(unflagged(t.state).withColumn("flags", tokens.add("flags", F.col("sonde_employed") == 1, fl.NOT_EMPLOYED)))


@query("f06_site_visit", flag_sql("last_site_visit = dt_round", "site visit", "fx_state"))
def _(t):
    return bare(unflagged(t.state).withColumn("flags", tokens.add("flags", F.col("last_site_visit") == F.col("dt_round"), fl.SITE_VISIT)))


FIELD_SQL = """WITH s AS (SELECT *, (coalesce(last_site_visit = dt_round, false))::INT AS v FROM fx_state WHERE on_grid)
  SELECT site, parameter, dt_round, nullif(concat_ws(';' || chr(10), CASE WHEN sonde_employed = 1 THEN 'sonde not employed' END, CASE WHEN v = 1 THEN 'site visit' END,
   CASE WHEN {} THEN 'sv window' END), '') AS flag FROM s
  WINDOW b AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
   a AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)"""


@query("f07_sv_window", FIELD_SQL.format("max(v) OVER b = 1"))
def _(t):
    return bare(over_slots(unflagged(t.state.filter("on_grid")), S, 3, 3, *fl.field_steps()))


@query("f07_sv_window_both", FIELD_SQL.format("greatest(max(v) OVER b, max(v) OVER a) = 1"))
def _(t):
    return bare(over_slots(unflagged(t.state.filter("on_grid")), S, 3, 3, *fl.field_steps(both_sides=True)))


@query("f08_missing", flag_sql("mean IS NULL", "missing data"))
def _(t):
    return bare(over_slots(unflagged(t.series), S, 0, 0, fl.missing_step()))


COARSE = "(SELECT site, parameter, dt_round, round(mean / 10) AS mean FROM fx_series)"


@query("f09_repeated_value", flag_sql("mean = lag(mean) OVER w OR mean = lead(mean) OVER w", "repeated value", COARSE, W))
def _(t):
    coarse = t.series.withColumn("mean", F.round(F.col("mean") / 10))
    return bare(over_slots(unflagged(coarse), S, 1, 1, fl.repeated_step()))


@query("f10_spec_range", flag_sql("mean < lo OR mean > hi", "outside of sensor specification range", "fx_series JOIN fx_spec USING (parameter)"))
def _(t):
    return bare(fl.range_flag(unflagged(t.series), t.spec, ["parameter"], fl.SPEC_RANGE))


@query(
    "f11_realistic_range",
    flag_sql("mean < lo OR mean > hi", "outside of sensor realistic range", "fx_series JOIN (SELECT site, parameter, lo * 2 AS lo, hi - CAST(substr(site, 2) AS INT) AS hi FROM fx_spec, fx_sites) USING (site, parameter)"),
)
def _(t):
    sites = t.sites.withColumn("n", F.substring("site", 2, 9).cast("int"))
    parameters = [F.struct(F.lit(p).alias("parameter"), F.lit(lo).alias("a"), F.lit(hi).alias("b")) for p, (lo, hi, _) in SPEC.items()]
    limits = sites.select("site", "n", F.inline(F.array(*parameters))).select("site", "parameter", (F.col("a") * 2).alias("lo"), (F.col("b") - F.col("n")).alias("hi"))
    return bare(fl.range_flag(unflagged(t.series), limits, ["site", "parameter"], fl.REALISTIC_RANGE))


TH_SQL = f"""th AS (SELECT site, parameter, 'winter_baseflow' AS season, quantile_cont(mean, 0.05) AS t_mean01, quantile_cont(mean, 0.95) AS t_mean99,
    quantile_cont(sb, 0.05) AS t_slope_behind_01, quantile_cont(sb, 0.95) AS t_slope_behind_99
  FROM (SELECT *, (mean - back1) / {MIN}.0 AS sb FROM fx_steps) GROUP BY 1, 2)"""


def thresholds(t):
    from sensorqc.operators import thresholds as th

    return th.build_thresholds(t.series, S, low=0.05, high=0.95)


def _summarised(t):
    return fl.with_thresholds(unflagged(t.series), thresholds(t))


@query("f12_seasonal_range", f"WITH {TH_SQL} " + flag_sql("mean < t_mean01 OR mean > t_mean99", "outside of seasonal range", "fx_series JOIN th USING (site, parameter)"))
def _(t):
    return bare(over_slots(_summarised(t), S, 0, 0, fl.rule(fl.outside("t_mean01", "t_mean99"), fl.SEASONAL_RANGE)))


STEEP = f"""(front1 - mean) / {MIN}.0 >= t_slope_behind_99 OR (mean - back1) / {MIN}.0 >= t_slope_behind_99
  OR (front1 - mean) / {MIN}.0 <= t_slope_behind_01 OR (mean - back1) / {MIN}.0 <= t_slope_behind_01"""


@query("f13_slope_violation", f"WITH {TH_SQL} " + flag_sql(STEEP, "slope violation", "fx_steps JOIN th USING (site, parameter)"))
def _(t):
    return bare(over_slots(_summarised(t), S, 1, 1, grid.slopes(MIN), fl.seasonal_steps()[1]))


@query(
    "f14_sd_range",
    """WITH r AS (SELECT *, count(mean) OVER f AS c, avg(mean) OVER f AS ra, stddev_samp(mean) OVER (PARTITION BY site, parameter) AS sd FROM fx_series
      WINDOW f AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))
    SELECT site, parameter, dt_round, CASE WHEN c = 7 AND abs(mean - ra) > sd * 3 / 2 THEN 'outside sd range' END AS flag FROM r""",
)
def _(t):
    d = fl.with_season_sd(unflagged(t.series), S).withColumn("season_sd", F.col("season_sd") / 2)
    far = fl.rule(F.abs(F.col("mean") - F.col("rollavg")) > 3 * F.col("season_sd"), fl.SD_RANGE)
    return bare(over_slots(d, S, 3, 3, grid.rolling(), far))


@query(
    "f15_slope_suspect",
    f"""SELECT site, parameter, dt_round, CASE WHEN a AND b THEN 'slope flag actual' WHEN a OR b THEN 'slope flag suspect' END AS flag FROM
     (SELECT *, (front1 - mean) / {MIN}.0 >= slope_threshold AS a, (mean - back1) / {MIN}.0 >= slope_threshold AS b FROM
       (SELECT *, lead(mean) OVER w AS front1, lag(mean) OVER w AS back1 FROM (SELECT site, parameter, dt_round, mean, slope_threshold / 20 AS slope_threshold FROM fx_series JOIN fx_spec USING (parameter)) {W}))""",
)
def _(t):
    d = unflagged(grid.with_slopes(t.series, S))
    return bare(fl.slope_suspect(d, t.spec.withColumn("slope_threshold", F.col("slope_threshold") / 20)))


QUIET = " , ".join("list_sort([" + ", ".join(f"'{x}'" for x in sorted(s)) + "])" for s in fl.QUIET_SETS)
ANOMALY_SQL = f"""a AS (SELECT *, (flag IS NOT NULL AND list_sort(list_distinct(string_split(flag, {SEP}))) NOT IN ({QUIET}))::INT AS loud FROM {{src}}),
  b AS (SELECT *, nullif(concat_ws({SEP}, flag, CASE WHEN count(*) OVER f = 9 AND sum(loud) OVER f >= 4.5 THEN '24hr anomaly' END), '') AS f2 FROM a
    WINDOW f AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING)),
  c AS (SELECT *, coalesce(contains(f2, '24hr anomaly'), false)::INT AS d FROM b),
  e AS (SELECT *, greatest(max(d) OVER p, max(d) OVER n) = 1 AS near FROM c
    WINDOW p AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), n AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING))"""


@query("f16_24hr_anomaly", f"WITH {ANOMALY_SQL.format(src='fx_flagged')} SELECT site, parameter, dt_round, f2 AS flag FROM e")
def _(t):
    out = fl.large_anomalies(parsed(t), S, half=4)
    return bare(out.withColumn("flags", tokens.remove("flags", fl.ANOMALY_WINDOW)))


@query(
    "f17_anomaly_window",
    f"WITH {ANOMALY_SQL.format(src='fx_flagged')} SELECT site, parameter, dt_round, nullif(concat_ws({SEP}, f2, CASE WHEN near AND f2 IS NOT NULL THEN 'anomaly window' END), '') AS flag FROM e",
)
def _(t):
    return bare(fl.large_anomalies(parsed(t), S, half=4))


@query(
    "f17_anomaly_window_all",
    f"WITH {ANOMALY_SQL.format(src='fx_flagged')} SELECT site, parameter, dt_round, nullif(concat_ws({SEP}, f2, CASE WHEN near THEN 'anomaly window' END), '') AS flag FROM e",
)
def _(t):
    return bare(fl.large_anomalies(parsed(t), S, half=4, skip_unflagged=False))


def _r2_sql(n: int, label: str) -> str:
    out = []
    for side, frame in (("right", f"{n - 1} PRECEDING AND CURRENT ROW"), ("left", f"CURRENT ROW AND {n - 1} FOLLOWING")):
        f = f"(PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN {frame})"
        out.append(
            f"CASE WHEN count(*) OVER {f} = {n} THEN CASE WHEN count(mean) OVER {f} > {n} - 0.1 * {n} AND regr_slope(mean, i) OVER {f} <> 0 THEN regr_r2(mean, i) OVER {f} ELSE 0 END END AS r2_{label}_{side}"
        )
    return ", ".join(out)


ROLL_SQL = f"""s AS (SELECT *, epoch(dt_round) / {STEP} AS i FROM fx_series), r AS (SELECT *, {_r2_sql(4, 's')}, {_r2_sql(8, 'l')} FROM s),
  g AS (SELECT *, greatest(r2_s_right, r2_s_left, r2_l_right, r2_l_left) AS tightest_r FROM r),
  q AS (SELECT *, CASE WHEN count(tightest_r) OVER f = 4 THEN (avg(tightest_r) OVER f >= 0.3)::INT END AS steady FROM g
    WINDOW f AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))"""


@query(
    "f18_rolling_r2",
    f"WITH {ROLL_SQL} SELECT site, parameter, dt_round, @r2_s_right, @r2_s_left, @r2_l_right, @r2_l_left, @tightest_r, CAST(coalesce(steady, -1) AS BIGINT) AS steady FROM q",
)
def _(t):
    out = fl.rolling_r2(t.series, S, short=4, long=8, share=0.3)
    return out.drop("mean", "spread", "n_obs").fillna(-1, ["steady"])


@query(
    "f19_biofouling",
    f"""WITH {ROLL_SQL}, x AS (SELECT *, max(steady) FILTER (parameter = 'Turbidity') OVER p AS tb, max(steady) FILTER (parameter = 'Specific Conductivity') OVER p AS sc FROM q WINDOW p AS (PARTITION BY site, dt_round))
    SELECT site, parameter, dt_round, CASE WHEN parameter = 'Turbidity' AND tb = 1 AND sc <> 1 THEN 'drift' END AS flag FROM x""",
)
def _(t):
    out = fl.rolling_r2(t.series, S, short=4, long=8, share=0.3)
    return bare(fl.biofouling_contrast(unflagged(out)))


WIN = fl.DriftWindows(short_half=4, short_back=8, long_half=6, long_back=12, exp_half=6, exp_back=14, trail=4, min_points=5, share=0.25)


def _linear_sql(name: str, a: str, b: str) -> str:
    f = f"(PARTITION BY site, parameter, visit_group ORDER BY dt_round ROWS BETWEEN {a} AND {b})"
    return f"""CASE WHEN count(*) OVER {f} >= 5 AND count(mean) OVER {f} >= ceil(0.9 * count(*) OVER {f}) AND regr_slope(mean, i) OVER {f} <> 0
      AND CASE WHEN parameter = 'FDOM Fluorescence' THEN regr_slope(mean, i) OVER {f} <= 0 ELSE regr_slope(mean, i) OVER {f} > 0 END THEN regr_r2(mean, i) OVER {f} ELSE 0 END AS r2_{name}"""


def _exp_sql(name: str, back: int, ahead: int) -> str:
    return f"""{name} AS (SELECT site, parameter, dt_round, CASE WHEN parameter <> 'FDOM Fluorescence' AND count(y) >= 5 AND regr_slope(ln(y - low + 0.1), x) > 0 THEN regr_r2(ln(y - low + 0.1), x) ELSE 0 END AS r2 FROM
      (SELECT a.site, a.parameter, a.dt_round, b.i AS x, b.mean AS y, min(b.mean) OVER (PARTITION BY a.site, a.parameter, a.dt_round) AS low
       FROM g a LEFT JOIN g b ON a.site = b.site AND a.parameter = b.parameter AND a.visit_group = b.visit_group AND b.mean IS NOT NULL AND b.i BETWEEN a.i - {back} AND a.i + {ahead}) GROUP BY 1, 2, 3)"""


@query(
    "f20_time_drift",
    f"""WITH g AS (SELECT *, CAST(epoch(dt_round) / {STEP} AS BIGINT) AS i, sum(coalesce(mean > 150, false)::INT) OVER (PARTITION BY site, parameter ORDER BY dt_round) AS visit_group FROM fx_series),
      l AS (SELECT *, {_linear_sql('s_center', '4 PRECEDING', '4 FOLLOWING')}, {_linear_sql('s_right', '8 PRECEDING', 'CURRENT ROW')},
        {_linear_sql('l_center', '6 PRECEDING', '6 FOLLOWING')}, {_linear_sql('l_right', '12 PRECEDING', 'CURRENT ROW')} FROM g),
      {_exp_sql('er', 14, 0)}, {_exp_sql('ec', 6, 6)},
      j AS (SELECT l.*, er.r2 AS r2_l_right_exp, ec.r2 AS r2_l_center_exp FROM l JOIN er USING (site, parameter, dt_round) JOIN ec USING (site, parameter, dt_round)),
      z AS (SELECT *, greatest(r2_s_center, r2_s_right, r2_l_center, r2_l_right, r2_l_right_exp, r2_l_center_exp) AS tightest_r FROM j)
    SELECT site, parameter, dt_round, CAST(visit_group AS BIGINT) AS visit_group, @r2_s_center, @r2_s_right, @r2_l_center, @r2_l_right, @r2_l_right_exp, @r2_l_center_exp, @tightest_r,
      CAST(avg(tightest_r) OVER (PARTITION BY site, parameter, visit_group ORDER BY dt_round ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) >= 0.25 AS BIGINT) AS failed FROM z""",
)
def _(t):
    out = fl.time_drift(t.series, S, F.coalesce(F.col("mean") > 150, F.lit(False)), WIN)
    return out.drop("mean", "spread", "n_obs")


@query("f21_do_noise", flag_sql("parameter = 'DO' AND abs(mean - back1) + abs(front1 - mean) >= 40", "DO interference", "fx_steps"))
def _(t):
    return bare(over_slots(unflagged(t.series), S, 1, 1, fl.do_noise_step(40.0)))


@query(
    "f22_depth_shift",
    """WITH m AS (SELECT site, start_dt, CASE WHEN sensor_pulled IS NULL THEN 0 ELSE pre_clean / 100 END AS depth_change FROM fx_visits)
    SELECT s.site, s.parameter, s.dt_round, round(m.depth_change, 6) AS depth_change, coalesce(m.depth_change <> 0, false) AS sonde_moved
    FROM fx_series s ASOF LEFT JOIN m ON m.site = s.site AND s.dt_round >= m.start_dt""",
)
def _(t):
    v = t.visits.withColumn("depth_change", F.when(F.col("sensor_pulled").isNull(), 0.0).otherwise(F.col("pre_clean") / 100))
    return fl.depth_shift(t.series, v, S).drop("mean", "spread", "n_obs")


def slot_any(condition: str, text: str) -> str:
    return f"SELECT site, parameter, dt_round, CASE WHEN max(coalesce({condition}, false)::INT) OVER (PARTITION BY site, dt_round) = 1 THEN '{text}' END AS flag FROM fx_series"


@query("f23_frozen", slot_any("parameter = 'Temperature' AND mean < 8", "frozen"))
def _(t):
    return bare(fl.frozen_flag(unflagged(t.series), freezing=8.0))


@query("f24_unsubmerged", slot_any("parameter = 'Specific Conductivity' AND mean < 10", "sonde unsubmerged"))
def _(t):
    return bare(fl.unsubmerged_flag(unflagged(t.series)))


@query(
    "f25_burial",
    """WITH n AS (SELECT *, CASE WHEN parameter = 'DO' THEN coalesce(abs(mean - back1) + abs(front1 - mean) >= 40, false)::INT END AS noisy FROM fx_steps),
      b AS (SELECT *, coalesce(avg(noisy) OVER (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) >= 0.5, false) AS bury FROM n)
    SELECT site, parameter, dt_round, nullif(concat_ws(';' || chr(10), CASE WHEN noisy = 1 THEN 'DO interference' END, CASE WHEN max(bury::INT) OVER (PARTITION BY site, dt_round) = 1 THEN 'sonde burial' END), '') AS flag FROM b""",
)
def _(t):
    d = over_slots(unflagged(t.series), S, 1, 1, fl.do_noise_step(40.0))
    return bare(fl.burial_flag(d, S, half=2))


SLOPED = f"""x AS (SELECT s.site, s.parameter, s.dt_round, s.mean, coalesce({STEEP}, false) AS steep, coalesce(mean < t_mean01 OR mean > t_mean99, false) AS odd FROM fx_steps s JOIN th USING (site, parameter))"""


def _sloped(t):
    return over_slots(_summarised(t), S, 1, 1, grid.slopes(MIN), *fl.seasonal_steps())


@query(
    "f26_intersensor_check",
    f"""WITH {TH_SQL}, {SLOPED} SELECT site, parameter, dt_round, nullif(concat_ws({SEP}, CASE WHEN odd THEN 'outside of seasonal range' END,
      CASE WHEN steep AND NOT (parameter <> 'Temperature' AND max((steep AND parameter = 'Temperature')::INT) OVER (PARTITION BY site, dt_round) = 1) THEN 'slope violation' END), '') AS flag FROM x""",
)
def _(t):
    return bare(fl.intersensor_check(_sloped(t)))


@query(
    "f27_malfunction",
    """SELECT site, parameter, dt_round, CASE WHEN EXISTS (SELECT 1 FROM fx_malfunctions m WHERE m.site = s.site AND m.parameter = s.parameter AND s.dt_round BETWEEN m.start_dt AND m.end_dt)
      THEN 'sensor malfunction' END AS mal_flag FROM fx_series s""",
)
def _(t):
    return fl.malfunction_flag(t.series, t.malfunctions, S).drop("mean", "spread", "n_obs")


@query(
    "f28_network_check",
    f"""WITH {TH_SQL}, {SLOPED}, e AS (SELECT DISTINCT p.neighbour AS site, x.parameter, x.dt_round FROM x JOIN fx_pairs p USING (site) WHERE steep OR odd),
      y AS (SELECT x.*, EXISTS (SELECT 1 FROM e WHERE e.site = x.site AND e.parameter = x.parameter AND e.dt_round BETWEEN x.dt_round - INTERVAL 6 HOUR AND x.dt_round + INTERVAL 6 HOUR) AS echo FROM x)
    SELECT site, parameter, dt_round, nullif(concat_ws({SEP}, CASE WHEN odd AND NOT echo THEN 'outside of seasonal range' END, CASE WHEN steep AND NOT echo THEN 'slope violation' END), '') AS flag FROM y""",
)
def _(t):
    return bare(fl.network_check(materialise(_sloped(t), "sloped"), t.pairs, S, reach=1))


SUSPECT_SQL = f"""c AS (SELECT *, (flag IS NOT NULL)::INT AS fl FROM fx_flagged),
  d AS (SELECT *, (sum(fl) OVER f - fl) / nullif(count(*) OVER f - 1, 0)::DOUBLE AS crowd FROM c WINDOW f AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING)),
  e AS (SELECT site, parameter, dt_round, CASE WHEN flag IS NULL AND crowd >= 0.5 THEN 'suspect data' ELSE flag END AS flag FROM d)"""


@query("f29_suspect", f"WITH {SUSPECT_SQL} SELECT * FROM e")
def _(t):
    return bare(over_slots(parsed(t), S, 4, 4, *fl.suspect_steps()))


@query(
    "f30_lone_suspect",
    f"WITH {SUSPECT_SQL} SELECT site, parameter, dt_round, CASE WHEN flag = 'suspect data' AND lag(flag) OVER w IS NULL AND lead(flag) OVER w IS NULL THEN NULL ELSE flag END AS flag FROM e {W}",
)
def _(t):
    return bare(fl.suspect_flags(parsed(t), S))


@query(
    "f31_seed_verification",
    "SELECT site, parameter, dt_round, CASE WHEN contains(flag, 'missing data') THEN 'fail' WHEN flag IS NULL THEN 'pass' END AS status FROM fx_flagged",
)
def _(t):
    return t.flagged.select(*KEYS, fl.seed_verification().alias("status"))


@query("f32_public_value", "SELECT site, parameter, dt_round, CASE WHEN flag IS NULL THEN round(mean, 6) END AS mean_public FROM fx_flagged")
def _(t):
    return t.flagged.select(*KEYS, fl.public_value().alias("mean_public"))


#: The whole pass as the parts above in their order; one table per step.
PASS_SQL = f"""WITH {TH_SQL}, vd AS (SELECT site, dt_round, max_by(CASE WHEN sensor_pulled IS NULL THEN 0 ELSE pre_clean / 100 END, start_dt) AS dep FROM fx_visits GROUP BY 1, 2),
  st AS (SELECT s.*, last_value(CASE WHEN has_visit THEN v.dep END IGNORE NULLS) OVER u AS depth_change,
      last_value(CASE WHEN has_visit THEN s.dt_round END IGNORE NULLS) OVER (PARTITION BY s.site, s.parameter ORDER BY s.dt_round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pv
    FROM fx_state s LEFT JOIN vd v ON v.site = s.site AND v.dt_round = s.dt_round WINDOW u AS (PARTITION BY s.site, s.parameter ORDER BY s.dt_round)),
  sw AS (SELECT *, coalesce(epoch(dt_round) - epoch(pv) <= {3 * STEP}, false) AS win FROM st WHERE on_grid),
  g AS (SELECT *, CAST(epoch(dt_round) / {STEP} AS BIGINT) AS i, CASE WHEN has_visit OR win THEN epoch(dt_round) ELSE coalesce(epoch(last_site_visit) + {3 * STEP}, 0) END AS visit_group FROM sw),
  l AS (SELECT *, {_linear_sql('s_center', '4 PRECEDING', '4 FOLLOWING')}, {_linear_sql('s_right', '8 PRECEDING', 'CURRENT ROW')},
    {_linear_sql('l_center', '6 PRECEDING', '6 FOLLOWING')}, {_linear_sql('l_right', '12 PRECEDING', 'CURRENT ROW')} FROM g),
  {_exp_sql('er', 14, 0)}, {_exp_sql('ec', 6, 6)},
  tr AS (SELECT l.*, greatest(r2_s_center, r2_s_right, r2_l_center, r2_l_right, er.r2, ec.r2) AS tight FROM l JOIN er USING (site, parameter, dt_round) JOIN ec USING (site, parameter, dt_round)),
  dr AS (SELECT *, parameter IN ('FDOM Fluorescence', 'Chl-a Fluorescence', 'Turbidity')
      AND avg(tight) OVER (PARTITION BY site, parameter, visit_group ORDER BY dt_round ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) >= 0.25 AS drifts FROM tr),
  x AS (SELECT d.*, back1, front1, lo, hi, coalesce({STEEP}, false) AS steep, coalesce(d.mean < t_mean01 OR d.mean > t_mean99, false) AS odd,
      coalesce(d.parameter = 'DO' AND abs(d.mean - back1) + abs(front1 - d.mean) >= 40, false) AS noisy
    FROM dr d JOIN (SELECT site, parameter, dt_round, back1, front1 FROM fx_steps) USING (site, parameter, dt_round) JOIN fx_spec USING (parameter) LEFT JOIN th ON th.site = d.site AND th.parameter = d.parameter),
  y AS (SELECT *, parameter = 'DO' AND avg(noisy::INT) OVER (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) >= 0.5 AS bury FROM x),
  z AS (SELECT *, max((parameter = 'Temperature' AND coalesce(mean < 5, false))::INT) OVER c = 1 AS ice, max((parameter = 'Specific Conductivity' AND coalesce(mean < 10, false))::INT) OVER c = 1 AS dry,
      max((parameter = 'Temperature' AND steep)::INT) OVER c = 1 AS shared, max(bury::INT) OVER c = 1 AS buried, coalesce(mean = lag(mean) OVER q OR mean = lead(mean) OVER q, false) AS same
    FROM y WINDOW c AS (PARTITION BY site, dt_round), q AS (PARTITION BY site, parameter ORDER BY dt_round)),
  k AS (SELECT *, steep AND NOT (shared AND parameter <> 'Temperature') AS sloped FROM z),
  ev AS (SELECT DISTINCT p.neighbour AS site, k.parameter, k.dt_round FROM k JOIN fx_pairs p USING (site) WHERE sloped OR odd),
  n AS (SELECT *, EXISTS (SELECT 1 FROM ev WHERE ev.site = k.site AND ev.parameter = k.parameter AND ev.dt_round BETWEEN k.dt_round - INTERVAL {STEP} SECOND AND k.dt_round + INTERVAL {STEP} SECOND) AS echo FROM k),
  fp AS (SELECT *, nullif(concat_ws({SEP}, CASE WHEN sonde_employed = 1 THEN 'sonde not employed' END, CASE WHEN has_visit THEN 'site visit' END, CASE WHEN win THEN 'sv window' END,
      CASE WHEN mean IS NULL THEN 'missing data' END, CASE WHEN noisy THEN 'DO interference' END, CASE WHEN same THEN 'repeated value' END, CASE WHEN drifts THEN 'drift' END,
      CASE WHEN mean < lo OR mean > hi THEN 'outside of sensor specification range' END, CASE WHEN odd AND NOT echo THEN 'outside of seasonal range' END, CASE WHEN sloped AND NOT echo THEN 'slope violation' END,
      CASE WHEN ice THEN 'frozen' END, CASE WHEN buried THEN 'sonde burial' END, CASE WHEN dry THEN 'sonde unsubmerged' END), '') AS flag FROM n),
  {ANOMALY_SQL.format(src='fp')},
  su AS (SELECT * EXCLUDE flag, nullif(concat_ws({SEP}, f2, CASE WHEN near AND f2 IS NOT NULL THEN 'anomaly window' END), '') AS flag FROM e),
  sc AS (SELECT *, (sum((flag IS NOT NULL)::INT) OVER f - (flag IS NOT NULL)::INT) / nullif(count(*) OVER f - 1, 0)::DOUBLE AS crowd FROM su
    WINDOW f AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING)),
  sd AS (SELECT * EXCLUDE flag, CASE WHEN flag IS NULL AND crowd >= 0.5 THEN 'suspect data' ELSE flag END AS flag FROM sc)
SELECT site, parameter, dt_round, @mean, @spread, coalesce(n_obs, -1) AS n_obs, CASE WHEN flag = 'suspect data' AND lag(flag) OVER w IS NULL AND lead(flag) OVER w IS NULL THEN NULL ELSE flag END AS auto_flag,
  sonde_employed, last_site_visit, 'winter_baseflow' AS season, @depth_change, coalesce(depth_change <> 0, false) AS sonde_moved,
  CASE WHEN EXISTS (SELECT 1 FROM fx_malfunctions m WHERE m.site = sd.site AND m.parameter = sd.parameter AND sd.dt_round BETWEEN m.start_dt AND m.end_dt) THEN 'sensor malfunction' END AS mal_flag
FROM sd {W}"""


@query("f33_flag_pass", PASS_SQL)
def _(t):
    settings = fl.FlagSettings(do_noise=40.0, anomaly_half=4, drift=WIN, freezing=5.0, burial_half=2, network_reach=1)
    v = t.visits.withColumn("depth_change", F.when(F.col("sensor_pulled").isNull(), 0.0).otherwise(F.col("pre_clean") / 100))
    t.series = t.stored("series")
    return fl.flag_pass(t.series, v, t.spec, thresholds(t), t.malfunctions, t.pairs, S, settings).fillna(-1, ["n_obs"])


@query(
    "f34_site_override",
    f"""SELECT site, parameter, dt_round, CASE WHEN site IN ('s02', 's06') THEN nullif(array_to_string(list_filter(string_split(coalesce(flag, ''), {SEP}), lambda x: x NOT IN ('drift', 'site visit', '')), {SEP}), '') ELSE flag END AS flag FROM fx_flagged""",
)
def _(t):
    pairs = F.array(F.lit("drift"), F.lit("site visit"))
    rules = t.sites.filter(F.col("site").isin("s02", "s06")).select("site", F.explode(pairs).alias("token"))
    return bare(fl.site_overrides(parsed(t), rules))

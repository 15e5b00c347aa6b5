"""Threshold queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorqc.catalog.fixtures import PARAMETERS, S, STEP
from sensorqc.catalog.registry import query
from sensorqc.functions import time as tm
from sensorqc.operators import thresholds as th
from sensorqc.plans.joins import rows_update

MIN = STEP // 60
KEYS = ["site", "parameter", "dt_round"]
# orders as a long series over years: (site, parameter, dt_round, mean)
YEARS = """SELECT 's' || lpad(CAST(o_custkey % 15 AS VARCHAR), 2, '0') AS site, o_orderpriority AS parameter, o_orderdate AS dt_round,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 100 END AS mean FROM orders"""
SEASON = """CASE WHEN month(dt_round) IN (12,1,2,3,4) THEN 'winter_baseflow' WHEN month(dt_round) IN (5,6) THEN 'snowmelt'
  WHEN month(dt_round) IN (7,8,9) THEN 'monsoon' ELSE 'fall_baseflow' END"""


def years(t):
    return t.table("orders").select(
        F.concat(F.lit("s"), F.lpad((F.col("o_custkey") % 15).cast("string"), 2, "0")).alias("site"),
        F.col("o_orderpriority").alias("parameter"),
        F.col("o_orderdate").alias("dt_round"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 100).alias("mean"),
    )


@query(
    "t01_clean_values",
    "SELECT site, parameter, dt_round, CASE WHEN flag IS NULL AND n_obs % 2 = 0 AND spread <= 100 THEN round(mean, 6) END AS clean_mean FROM fx_flagged",
)
def _(t):
    d = t.flagged.select(
        *KEYS,
        "mean",
        F.col("flag").alias("auto_flag"),
        (F.col("n_obs") % 2).alias("sonde_employed"),
        (F.col("spread") > 100).alias("sonde_moved"),
        F.when(F.col("n_obs").isNull(), "gone").alias("mal_flag"),
    )
    return th.clean_for_thresholds(d).select(*KEYS, "clean_mean")


@query(
    "t02_old_scheme",
    """SELECT site, parameter, dt_round, CASE WHEN (flag IS NULL) = (verification_status = 'PASS') THEN round(mean, 6) END AS clean_mean,
      CASE WHEN flag IS NOT NULL AND verification_status = 'PASS' THEN flag WHEN flag IS NULL AND verification_status = 'FAIL' THEN 'MANUAL FLAG' END AS clean_flag
    FROM (SELECT site, parameter, dt_round, mean, flag, CASE WHEN coalesce(n_obs, 0) >= 2 THEN 'FAIL' ELSE 'PASS' END AS verification_status FROM fx_flagged)""",
)
def _(t):
    status = F.when(F.coalesce("n_obs", F.lit(0)) >= 2, "FAIL").otherwise("PASS")
    return t.flagged.select(*KEYS, *[c.alias(n) for n, c in th.old_scheme(F.col("flag"), status, F.col("mean")).items()])


@query(
    "t03_rows_update",
    """WITH u AS (SELECT site, parameter, dt_round, CASE WHEN n_obs >= 4 THEN NULL ELSE mean * 2 END AS mean FROM fx_slots WHERE n_obs >= 3)
    SELECT s.site, s.parameter, s.dt_round, round(CASE WHEN u.site IS NOT NULL THEN u.mean ELSE s.mean END, 6) AS mean FROM fx_series s
    LEFT JOIN u ON u.site = s.site AND u.parameter = s.parameter AND u.dt_round = s.dt_round""",
)
def _(t):
    u = t.slots.filter("n_obs >= 3").select(*KEYS, F.when(F.col("n_obs") < 4, F.col("mean") * 2).alias("mean"))
    return rows_update(t.series.select(*KEYS, "mean"), u, KEYS, ["mean"])


@query(
    "t04_null_by_flag",
    """SELECT site, parameter, dt_round, CASE WHEN NOT coalesce(regexp_matches(flag, 'drift|site visit|missing data'), false) AND NOT coalesce(parameter = 'Turbidity' AND x > 1000, false) THEN round(x, 6) END AS clean_mean
    FROM (SELECT *, mean * 10 AS x FROM fx_flagged)""",
)
def _(t):
    d = t.flagged.withColumn("mean", F.col("mean") * 10)
    return th.null_by_flag(d, 2025).select(*KEYS, "clean_mean")


SUFF = f"""SELECT site, parameter, {SEASON} AS season, count(*) AS n_rows, count(mean) AS n_values, count(DISTINCT year(dt_round)) AS n_years,
  count(mean) / count(*) AS share, count(*) >= 40 AND count(mean) >= 35 AND count(mean) / count(*) >= 0.85 AND count(DISTINCT year(dt_round)) >= 2 AS sufficient FROM ({YEARS}) GROUP BY 1, 2, 3"""


@query("t05_sufficiency", f"SELECT site, parameter, season, n_rows, n_values, n_years, @share, sufficient FROM ({SUFF})")
def _(t):
    return th.sufficiency(years(t), min_rows=40, min_values=35, min_share=0.85, min_years=2)


TH = f"""SELECT site, parameter, 'winter_baseflow' AS season, quantile_cont(mean, 0.01) AS t_mean01, quantile_cont(mean, 0.99) AS t_mean99,
  quantile_cont(sb, 0.01) AS t_slope_behind_01, quantile_cont(sb, 0.99) AS t_slope_behind_99
  FROM (SELECT *, (mean - back1) / {MIN}.0 AS sb FROM fx_steps) GROUP BY 1, 2"""
TH_COLS = "@t_mean01, @t_mean99, @t_slope_behind_01, @t_slope_behind_99"


@query("t06_thresholds", f"SELECT site, parameter, season, {TH_COLS} FROM ({TH})")
def _(t):
    return th.build_thresholds(t.series, S)


@query("t06_thresholds_absolute", f"SELECT site, parameter, season, {TH_COLS} FROM ({TH.replace('(mean - back1)', 'abs(mean - back1)')})")
def _(t):
    return th.build_thresholds(t.series, S, absolute_slope=True)


GRID = "SELECT site, p.parameter, s.season FROM fx_sites, (SELECT DISTINCT parameter FROM fx_spec) p, (VALUES ('winter_baseflow'), ('snowmelt'), ('monsoon'), ('fall_baseflow')) s(season)"


@query("t07_combination_grid", GRID)
def _(t):
    return th.combination_grid(t.sites, list(PARAMETERS.values()))


FINAL = f"""g AS ({GRID}), th AS ({TH}),
  ok AS (SELECT site, parameter, 'winter_baseflow' AS season, count(mean) >= 80 AS sufficient FROM fx_series GROUP BY 1, 2),
  j AS (SELECT g.site, g.parameter, g.season, t_mean01, t_mean99, t_slope_behind_01, t_slope_behind_99, coalesce(sufficient, false) AS s, lo, hi * 2 AS hi,
     min(t_slope_behind_01) OVER (PARTITION BY g.parameter, g.season) AS a, max(t_slope_behind_99) OVER (PARTITION BY g.parameter, g.season) AS b
    FROM g LEFT JOIN th USING (site, parameter, season) LEFT JOIN ok USING (site, parameter, season) JOIN fx_spec p ON p.parameter = g.parameter),
  k AS (SELECT *, CASE WHEN s THEN t_mean01 ELSE lo END AS m1, CASE WHEN s THEN t_mean99 ELSE hi END AS m9 FROM j),
  f AS (SELECT site, parameter, season, CASE WHEN m1 < lo THEN lo ELSE m1 END AS t_mean01, CASE WHEN (CASE WHEN m9 >= 150 THEN 140 ELSE m9 END) > hi THEN hi ELSE CASE WHEN m9 >= 150 THEN 140 ELSE m9 END END AS t_mean99,
    coalesce(t_slope_behind_01, a) AS t_slope_behind_01, coalesce(t_slope_behind_99, b) AS t_slope_behind_99 FROM k)"""


def _final(t):
    g = th.combination_grid(t.sites, list(PARAMETERS.values()))
    ok = th.sufficiency(t.series, min_rows=0, min_values=80, min_share=0.0)
    return g, th.finalise(g, th.build_thresholds(t.series, S), ok, t.spec.withColumn("hi", F.col("hi") * 2), 150.0, 140.0)


@query("t08_finalise", f"WITH {FINAL} SELECT site, parameter, season, {TH_COLS} FROM f")
def _(t):
    return _final(t)[1]


@query(
    "t09_backfill",
    f"""WITH {FINAL}, n AS (SELECT * FROM f WHERE site <> 's05'), o AS (SELECT site, parameter, season, 1.0::DOUBLE AS t_mean01, 2.0::DOUBLE AS t_mean99, 3.0::DOUBLE AS t_slope_behind_01, 4.0::DOUBLE AS t_slope_behind_99 FROM f)
    SELECT site, parameter, season, {TH_COLS} FROM n UNION ALL SELECT * FROM o WHERE site = 's05'""",
)
def _(t):
    g, f = _final(t)
    old = f.select("site", "parameter", "season", *[F.lit(float(i + 1)).alias(c) for i, c in enumerate(f.columns[3:])])
    return th.backfill(f.filter("site <> 's05'"), old.unionByName(old.withColumn("site", F.lit("gone")).distinct()), g)


#: Two-sided tail of Student's t by Simpson's rule, with t = sqrt(d) tan(theta).
T_TAIL = """(SELECT sum((CASE WHEN k = 0 OR k = 2000 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * power(cos({0} + (pi() / 2 - {0}) * k / 2000), {1} - 1)) * (pi() / 2 - {0}) / 6000
  FROM (SELECT unnest(range(2001)) AS k)) * 2 * exp(lgamma(({1} + 1) / 2.0) - lgamma({1} / 2.0)) / sqrt(pi())"""


def _alarm_sql() -> str:
    """Quantiles of Student's t by halving the angle's range until its tail is right."""
    mid = "((low + high) / 2)"
    return f"""WITH RECURSIVE s AS (SELECT site, avg(mean) AS m, stddev_samp(mean) AS sd, count(mean) AS n FROM fx_slots WHERE parameter = 'Turbidity' GROUP BY 1),
      b AS (SELECT site, n - 1 AS d, q AS tail, 0.0::DOUBLE AS low, pi() / 2 AS high, 0 AS i FROM s, (VALUES (0.05), (0.01)) v(q) WHERE n > 1
        UNION ALL SELECT site, d, tail, CASE WHEN p > tail THEN {mid} ELSE low END, CASE WHEN p > tail THEN high ELSE {mid} END, i + 1 FROM (SELECT *, {T_TAIL.format(mid, 'd')} AS p FROM b WHERE i < 50)),
      t AS (SELECT site, max(CASE WHEN tail = 0.05 THEN sqrt(d) * tan(low) END) AS w, max(CASE WHEN tail = 0.01 THEN sqrt(d) * tan(low) END) AS a FROM b WHERE i = 50 GROUP BY 1)
    SELECT site, n, round(m + sd * w, 6) AS warning, round(m + sd * a, 6) AS alarm FROM s LEFT JOIN t USING (site)"""


@query("t10_alarm_thresholds", _alarm_sql())
def _(t):
    return th.alarm_thresholds(t.slots.filter("parameter = 'Turbidity'"), ["site"])


@query(
    "t11_sd_comparison",
    f"""WITH y AS (SELECT *, {SEASON} AS season, CAST(month(dt_round) AS BIGINT) AS month FROM ({YEARS})),
      s AS (SELECT site, parameter, season, stddev_samp(mean) AS season_sd FROM y GROUP BY 1, 2, 3), m AS (SELECT site, parameter, season, month, stddev_samp(mean) AS month_sd FROM y GROUP BY 1, 2, 3, 4)
    SELECT site, parameter, season, month, @month_sd, @season_sd, round(abs(month_sd - season_sd), 6) AS sd_difference FROM m JOIN s USING (site, parameter, season)""",
)
def _(t):
    return th.sd_comparison(years(t), S)

"""Gridding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorqc.catalog.fixtures import S, STEP
from sensorqc.catalog.registry import query
from sensorqc.functions import time as tm
from sensorqc.operators import grid
from sensorqc.plans.chunks import over_slots

W = "WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round)"
MIN = STEP // 60
TIE = 1e-9  # moves exact decimal ties off the rounding border in both engines


@query("g01_slot_agg", "SELECT site, parameter, dt_round, @mean, @spread, n_obs FROM fx_slots")
def _(t):
    return t.slots


@query("g02_pad_grid", "SELECT site, parameter, dt_round, @mean, @spread, coalesce(n_obs, 0) AS n_obs FROM fx_series")
def _(t):
    return t.series.fillna(0, ["n_obs"])


@query(
    "g03_spacing_audit",
    """WITH l AS (SELECT site, parameter, CAST(epoch(dt_round) - epoch(lag(dt_round) OVER w) AS BIGINT) AS gap FROM fx_slots
      WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round))
    SELECT site, parameter, count(DISTINCT gap) AS n_gaps, min(gap) AS min_gap, max(gap) AS max_gap,
      count(DISTINCT gap) <= 1 AS evenly_spaced FROM l GROUP BY 1, 2""",
)
def _(t):
    return grid.spacing_audit(t.slots, S)


@query(
    "g04_neighbours",
    "SELECT site, parameter, dt_round, "
    + ", ".join(f"round(lead(mean, {i}) OVER w, 6) AS front{i}, round(lag(mean, {i}) OVER w, 6) AS back{i}" for i in (1, 2, 3))
    + f" FROM fx_series {W}",
)
def _(t):
    return grid.with_neighbours(t.series, S).drop("mean", "spread", "n_obs")


@query(
    "g05_rolling7",
    f"""SELECT site, parameter, dt_round,
      CASE WHEN count(mean) OVER f = 7 THEN round(median(mean) OVER f, 6) END AS rollmed,
      CASE WHEN count(mean) OVER f = 7 THEN round(avg(mean) OVER f, 6) END AS rollavg,
      CASE WHEN count(mean) OVER f = 7 THEN round(stddev_samp(mean) OVER f, 6) END AS rollsd FROM fx_series
    WINDOW f AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""",
)
def _(t):
    return grid.with_rolling(t.series, S).drop("mean", "spread", "n_obs")


@query(
    "g06_slopes",
    f"""SELECT site, parameter, dt_round, round((lead(mean) OVER w - mean) / {MIN}.0, 6) AS slope_ahead,
      round((mean - lag(mean) OVER w) / {MIN}.0, 6) AS slope_behind FROM fx_series {W}""",
)
def _(t):
    return grid.with_slopes(t.series, S).drop("mean", "spread", "n_obs")


@query(
    "g07_month_sd",
    """SELECT site, parameter, dt_round, strftime(dt_round, '%Y-%m') AS y_m,
      round(stddev_samp(mean) OVER (PARTITION BY site, parameter, strftime(dt_round, '%Y-%m')), 6) AS month_sd FROM fx_series""",
)
def _(t):
    return grid.with_month_sd(t.series, S).select("site", "parameter", "dt_round", "y_m", "month_sd")


SEASON_SQL = """CASE WHEN month({0}) IN (12,1,2,3,4) THEN 'winter_baseflow' WHEN month({0}) IN (5,6) THEN 'snowmelt'
  WHEN month({0}) IN (7,8,9) THEN 'monsoon' ELSE 'fall_baseflow' END"""


@query(
    "g08_calendar",
    f"""SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
      CAST((dayofyear(o_orderdate) - 1) // 7 + 1 AS BIGINT) AS week, CAST(dayofweek(o_orderdate) + 1 AS BIGINT) AS weekday,
      CAST(dayofyear(o_orderdate) AS BIGINT) AS day, concat_ws(' - ', year(o_orderdate), month(o_orderdate)) AS y_m,
      concat_ws(' - ', year(o_orderdate), (dayofyear(o_orderdate) - 1) // 7 + 1) AS y_w,
      concat_ws(' - ', year(o_orderdate), dayofyear(o_orderdate)) AS y_d, {SEASON_SQL.format('o_orderdate')} AS season FROM orders""",
)
def _(t):
    return t.table("orders").select("o_orderkey", "o_orderdate").withColumns(tm.calendar("o_orderdate"))


@query(
    "g09_first_pass",
    """WITH c AS (SELECT s.site, s.parameter, s.dt_round, coalesce(mean < lo OR mean > hi, false) AS removed,
        CASE WHEN NOT coalesce(mean < lo OR mean > hi, false) THEN mean END AS mean FROM fx_series s JOIN fx_spec USING (parameter)),
      n AS (SELECT *, list_filter([lag(mean,1) OVER w, lead(mean,1) OVER w, lag(mean,2) OVER w, lead(mean,2) OVER w,
        lag(mean,3) OVER w, lead(mean,3) OVER w], lambda x: x IS NOT NULL) AS a FROM c WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round)),
      m AS (SELECT *, list_avg(a) AS mean_around, CASE WHEN len(a) > 1 THEN list_stddev_samp(a) END AS sd_around FROM n)
    SELECT site, parameter, dt_round, removed, @mean, @mean_around, @sd_around,
      coalesce(abs(mean - mean_around) > 3 * sd_around, false) AS anomalous FROM m""",
)
def _(t):
    return grid.first_pass(t.series, t.spec, S).drop("spread", "n_obs")


FILL = """SELECT site, parameter, dt_round, mean,
   last_value(mean IGNORE NULLS) OVER p AS bv, last_value(CASE WHEN mean IS NOT NULL THEN epoch(dt_round) END IGNORE NULLS) OVER p AS bt,
   first_value(mean IGNORE NULLS) OVER n AS av, first_value(CASE WHEN mean IS NOT NULL THEN epoch(dt_round) END IGNORE NULLS) OVER n AS at_
  FROM fx_series WINDOW p AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   n AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


def interpolated_sql(maxgap: int) -> str:
    return f"""WITH f AS ({FILL}) SELECT site, parameter, dt_round, round(CASE WHEN mean IS NOT NULL THEN mean
      WHEN at_ - bt <= {STEP * (maxgap + 1)} THEN bv + (av - bv) * (epoch(dt_round) - bt) / (at_ - bt) END, 6) AS mean FROM f"""


@query("g10_interpolate_gap", interpolated_sql(4))
def _(t):
    return grid.interpolate_gaps(t.series, S).drop("spread", "n_obs")


@query("g10_interpolate_gap2", interpolated_sql(2))
def _(t):
    return grid.interpolate_gaps(t.series, S, maxgap=2).drop("spread", "n_obs")


def _pass(src: str, out: str, base: str) -> str:
    return f"""SELECT * EXCLUDE (x), (lag(x,2) OVER w + 4*lag(x) OVER w + 6*x + 4*lead(x) OVER w + lead(x,2) OVER w) / 16.0 AS x
      FROM {src} WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round)"""


@query(
    "g12_lowpass",
    f"""WITH p0 AS (SELECT site, parameter, dt_round, mean, mean AS x FROM fx_series), p1 AS ({_pass('p0', 'x', 'x')}),
      p2 AS ({_pass('p1', 'x', 'x')}), p3 AS ({_pass('p2', 'x', 'x')})
    SELECT site, parameter, dt_round, round(CASE WHEN parameter = 'Turbidity' THEN x ELSE mean END + {TIE}, 6) AS smoothed FROM p3""",
)
def _(t):
    return grid.low_pass(t.series, S).select("site", "parameter", "dt_round", (F.col("smoothed") + TIE).alias("smoothed"))


@query(
    "g12_lowpass_single",
    f"""WITH p0 AS (SELECT site, parameter, dt_round, mean, mean AS x FROM fx_series), p1 AS ({_pass('p0', 'x', 'x')})
    SELECT site, parameter, dt_round, round(CASE WHEN parameter = 'Turbidity' THEN x ELSE mean END + {TIE}, 6) AS smoothed FROM p1""",
)
def _(t):
    return grid.low_pass(t.series, S, passes=1).select("site", "parameter", "dt_round", (F.col("smoothed") + TIE).alias("smoothed"))


@query(
    "g13_triangular",
    """WITH n AS (SELECT site, parameter, dt_round, lag(mean,2) OVER w a, lag(mean) OVER w b, mean c, lead(mean) OVER w d, lead(mean,2) OVER w e
      FROM fx_series WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round)),
     s AS (SELECT *, coalesce(a,0)+2*coalesce(b,0)+3*coalesce(c,0)+2*coalesce(d,0)+coalesce(e,0) AS num,
      (a IS NOT NULL)::INT + 2*(b IS NOT NULL)::INT + 3*(c IS NOT NULL)::INT + 2*(d IS NOT NULL)::INT + (e IS NOT NULL)::INT AS den FROM n)
    SELECT site, parameter, dt_round, CASE WHEN den > 0 THEN round(num / den, 6) END AS smoothed FROM s""",
)
def _(t):
    return grid.triangular(t.series, S).select("site", "parameter", "dt_round", "smoothed")


@query(
    "g14_gaussian_weekly",
    f"""WITH wk AS (SELECT 's' || lpad(CAST(o_custkey % 15 AS VARCHAR), 2, '0') AS site, CAST(year(o_orderdate) AS BIGINT) AS year,
       CAST((dayofyear(o_orderdate) - 1) // 7 + 1 AS BIGINT) AS week, avg(o_totalprice / 1000) AS mean FROM orders GROUP BY 1, 2, 3)
     SELECT a.site, a.year, a.week, round(sum(b.mean * exp(-0.5 * power((b.week - a.week) / {grid.KERNEL_SD_PER_BANDWIDTH * 3}, 2)))
       / sum(exp(-0.5 * power((b.week - a.week) / {grid.KERNEL_SD_PER_BANDWIDTH * 3}, 2))), 6) AS smoothed
     FROM wk a JOIN wk b ON a.site = b.site AND a.year = b.year AND abs(a.week - b.week) <= {4 * grid.KERNEL_SD_PER_BANDWIDTH * 3}
     GROUP BY 1, 2, 3""",
)
def _(t):
    o = t.table("orders").select(
        F.concat(F.lit("s"), F.lpad((F.col("o_custkey") % 15).cast("string"), 2, "0")).alias("site"),
        F.year("o_orderdate").cast("long").alias("year"),
        tm.week_number("o_orderdate").alias("week"),
        (F.col("o_totalprice") / 1000).alias("v"),
    )
    weekly = o.groupBy("site", "year", "week").agg(F.avg("v").alias("mean"))
    return grid.gaussian_smooth(weekly, ["site", "year"], "week", "mean").drop("mean")


def _trunc(unit, agg):
    return f"SELECT site, parameter, date_trunc('{unit}', dt_round) AS dt_round, round({agg}(mean) + {TIE}, 6) AS mean, count(mean) AS n FROM fx_series GROUP BY 1, 2, 3"


@query("g15_daily_mean", _trunc("day", "avg"))
def _(t):
    return grid.resample(t.series, S, "day").withColumn("mean", F.col("mean") + TIE)


@query("g15_daily_median", _trunc("day", "median"))
def _(t):
    return grid.resample(t.series, S, "day", how="median").withColumn("mean", F.col("mean") + TIE)


@query("g15_weekly_mean", _trunc("week", "avg"))
def _(t):
    return grid.resample(t.series, S, "week").withColumn("mean", F.col("mean") + TIE)


@query(
    "g15_hourly_median",
    "SELECT site, parameter, date_trunc('hour', ts) AS dt_round, round(median(value), 6) AS mean, count(value) AS n FROM fx_readings GROUP BY 1, 2, 3",
)
def _(t):
    per_minute = t.readings.withColumnRenamed("ts", "dt_round").withColumnRenamed("value", "mean")
    return grid.resample(per_minute, S, "hour", how="median")


def _moving(width):
    half = width // 2
    return f"""WITH d AS (SELECT site, parameter, date_trunc('day', dt_round) AS day, CAST(year(dt_round) AS BIGINT) AS year, avg(mean) AS mean
       FROM fx_series GROUP BY 1, 2, 3, 4)
     SELECT site, parameter, year, day, CASE WHEN count(mean) OVER f = {width} THEN round(avg(mean) OVER f, 6) END AS rolled FROM d
     WINDOW f AS (PARTITION BY site, parameter, year ORDER BY day ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"""


def _daily(t):
    return t.series.groupBy("site", "parameter", F.year("dt_round").cast("long").alias("year"), F.date_trunc("day", "dt_round").alias("day")).agg(
        F.avg("mean").alias("mean")
    )


@query("g16_moving_average5", _moving(5))
def _(t):
    return grid.moving_average(_daily(t), ["site", "parameter", "year"], "day", "mean", 5, chunk=8).drop("mean")


@query("g16_moving_average7", _moving(7))
def _(t):
    return grid.moving_average(_daily(t), ["site", "parameter", "year"], "day", "mean", 7, chunk=8).drop("mean")


@query(
    "g17_rescale",
    """WITH b AS (SELECT site, min(mean) AS c, max(mean) AS d FROM fx_slots WHERE parameter = 'DO' GROUP BY 1),
      a AS (SELECT site, min(mean) AS lo, max(mean) AS hi FROM fx_slots WHERE parameter = 'Turbidity' GROUP BY 1)
    SELECT s.site, s.dt_round, round((s.mean - lo) / (hi - lo) * (d - c) + c, 6) AS scaled
    FROM fx_slots s JOIN a USING (site) JOIN b USING (site) WHERE s.parameter = 'Turbidity'""",
)
def _(t):
    turb, do = t.slots.filter("parameter = 'Turbidity'"), t.slots.filter("parameter = 'DO'")
    return grid.rescale_to(turb, do, ["site"], "mean", "mean").select("site", "dt_round", "scaled")


@query(
    "g_summary_statistics",
    f"""WITH r AS (SELECT *, count(mean) OVER f AS c, avg(mean) OVER f AS ra, stddev_samp(mean) OVER f AS rs, lead(mean) OVER w AS front1, lag(mean) OVER w AS back1 FROM fx_series
       WINDOW f AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), w AS (PARTITION BY site, parameter ORDER BY dt_round))
     SELECT site, parameter, dt_round, @front1, @back1, CASE WHEN c = 7 THEN round(ra, 6) END AS rollavg, CASE WHEN c = 7 THEN round(rs, 6) END AS rollsd,
       round((front1 - mean) / {MIN}.0, 6) AS slope_ahead, round((mean - back1) / {MIN}.0, 6) AS slope_behind FROM r""",
)
def _(t):
    out = over_slots(t.series, S, 3, 3, *grid.summary_steps(S))
    return out.drop("mean", "spread", "n_obs", "rollmed")

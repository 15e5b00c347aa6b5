"""Drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorqc.catalog.fixtures import S, STEP
from sensorqc.catalog.registry import query
from sensorqc.operators import drift as dr, flags as fl, grid
from sensorqc.plans.chunks import over_slots

KEYS = ["site", "parameter", "dt_round"]
SEP = "';' || chr(10)"
BEFORE, GAP = 12 * 3600, 500.0
TIE = 1e-9  # moves exact decimal ties off the rounding border in both engines

RANGES = """cl AS (SELECT site, parameter, dt_round, mean_analysis AS v, row_number() OVER (PARTITION BY site, parameter ORDER BY dt_round) AS rk FROM fx_drift WHERE mean_analysis IS NOT NULL),
  wr AS (SELECT w.*, coalesce((SELECT max(rk) FROM cl WHERE cl.site = w.site AND cl.parameter = w.parameter AND cl.dt_round <= w.end_dt), 0) AS r FROM fx_windows w),
  ar AS (SELECT w.seq, w.site, w.parameter, w.end_dt, w.r, c.rk, c.v, c.dt_round FROM wr w LEFT JOIN cl c ON c.site = w.site AND c.parameter = w.parameter AND c.rk BETWEEN w.r - 3 AND w.r + 4),
  ag AS (SELECT seq, avg(v) FILTER (rk <= r AND dt_round >= end_dt - INTERVAL 12 HOUR) AS from_a, avg(v) FILTER (rk > r) AS to_a, min(dt_round) FILTER (rk > r) AS nxt, avg(v) FILTER (rk <= r) AS from_c FROM ar GROUP BY seq),
  nb AS (SELECT a.seq, avg(c.v) FILTER (n2.pos < n1.pos) AS up, avg(c.v) FILTER (n2.pos > n1.pos) AS down FROM ar a JOIN fx_network n1 ON n1.site = a.site JOIN fx_network n2 ON abs(n2.pos - n1.pos) = 1
    JOIN cl c ON c.site = n2.site AND c.parameter = a.parameter AND c.dt_round = a.dt_round WHERE a.rk <= a.r GROUP BY a.seq),
  rv AS (SELECT w.seq, w.site, w.parameter, w.start_dt, w.end_dt, w.drift_type, w.correction_type, from_a, to_a, from_c, (epoch_us(nxt) - epoch_us(w.end_dt)) / 60000000.0 AS gap_minutes,
    (SELECT arg_max(pre_clean, note_dt) FROM fx_notes n WHERE n.site = w.site AND n.parameter = w.parameter AND n.note_dt <= w.end_dt AND pre_clean IS NOT NULL) AS from_b,
    (SELECT arg_max(post_clean, note_dt) FROM fx_notes n WHERE n.site = w.site AND n.parameter = w.parameter AND n.note_dt <= w.end_dt AND post_clean IS NOT NULL) AS to_b,
    CASE WHEN NOT coalesce(w.parameter = 'Turbidity' AND abs(up - down) > 10, false) THEN (coalesce(up, down) + coalesce(down, up)) / 2 END AS to_c
    FROM wr w LEFT JOIN ag USING (seq) LEFT JOIN nb USING (seq)),
  ok AS (SELECT *, """ + ", ".join(
    f"coalesce(abs(from_{x} - to_{x}) < 1000 AND CASE WHEN parameter = 'Turbidity' THEN from_{x} >= to_{x} ELSE to_{x} >= from_{x} END, false) AS ok_{x}" for x in "abc"
) + """ FROM rv),
  bs AS (SELECT *, greatest(""" + ", ".join(f"CASE WHEN ok_{x} THEN abs(from_{x} - to_{x}) END" for x in "abc") + """) AS best FROM ok),
  sr AS (SELECT *, CASE WHEN (gap_minutes IS NULL OR gap_minutes > 500) AND ok_c THEN 'C' WHEN ok_a AND abs(from_a - to_a) = best THEN 'A' WHEN ok_c AND abs(from_c - to_c) = best THEN 'C'
    WHEN ok_b AND abs(from_b - to_b) = best THEN 'B' WHEN from_a IS NOT NULL AND to_a IS NOT NULL THEN 'A_fallback' ELSE 'mixed_fallback' END AS pre_post_source FROM bs),
  rg AS (SELECT *, CASE WHEN pre_post_source IN ('A', 'A_fallback') THEN from_a WHEN pre_post_source = 'B' THEN from_b WHEN pre_post_source = 'C' THEN from_c ELSE coalesce(from_a, from_b) END AS pre_val,
    CASE WHEN pre_post_source IN ('A', 'A_fallback') THEN to_a WHEN pre_post_source = 'B' THEN to_b WHEN pre_post_source = 'C' THEN to_c ELSE coalesce(to_a, to_b) END AS post_val FROM sr)"""
ROWS = RANGES + """, r0 AS (SELECT g.seq, g.site, g.parameter, g.drift_type, g.correction_type, g.pre_post_source, g.pre_val AS pre, g.post_val AS post, d.dt_round, d.mean_analysis AS y,
    min(d.dt_round) OVER p AS a, max(d.dt_round) OVER p AS b FROM rg g JOIN fx_drift d ON d.site = g.site AND d.parameter = g.parameter AND d.dt_round BETWEEN g.start_dt AND g.end_dt WINDOW p AS (PARTITION BY g.seq)),
  r1 AS (SELECT *, CASE WHEN b > a THEN (epoch(dt_round) - epoch(a)) / (epoch(b) - epoch(a)) ELSE 0 END AS wt FROM r0),
  r2 AS (SELECT *, regr_slope(y, wt) OVER p AS bs, count(y) OVER p AS np FROM r1 WINDOW p AS (PARTITION BY seq))"""


def ranges(t):
    return dr.range_values(t.drift, t.windows, t.notes, t.network, S, BEFORE, gap_minutes=GAP)


def rows(t):
    w = t.windows.join(ranges(t).select("seq", "pre_val", "post_val", "pre_post_source"), "seq")
    return dr.window_rows(t.drift, w, S)


@query("d01_analysis_columns", "SELECT site, parameter, dt_round, drift, @mean_analysis FROM fx_drift")
def _(t):
    return t.drift.select(*KEYS, "drift", "mean_analysis")


GAPW = """g0 AS (SELECT *, lag(dt_round) OVER w AS pv FROM fx_drift WHERE drift AND mean_analysis IS NOT NULL WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round)),
  g1 AS (SELECT *, sum((pv IS NULL OR epoch(dt_round) - epoch(pv) > 86400)::INT) OVER (PARTITION BY site, parameter ORDER BY dt_round) AS window_id FROM g0)"""


@query(
    "d02_gap_windows",
    f"""WITH {GAPW} SELECT site, parameter, CAST(window_id AS BIGINT) AS window_id, min(dt_round) AS start_dt, max(dt_round) AS end_dt, round(max_by(mean_analysis, dt_round), 6) AS end_data_val,
     'None' AS drift_type, 'additive' AS correction_type FROM g1 GROUP BY 1, 2, 3""",
)
def _(t):
    return dr.gap_windows(t.drift, S)


@query("d03_range_option_a", f"WITH {RANGES} SELECT seq, @from_a, @to_a, @gap_minutes FROM rg")
def _(t):
    return ranges(t).select("seq", "from_a", "to_a", "gap_minutes")


@query("d04_range_option_b", f"WITH {RANGES} SELECT seq, @from_b, @to_b FROM rg")
def _(t):
    return ranges(t).select("seq", "from_b", "to_b")


@query("d05_range_option_c", f"WITH {RANGES} SELECT seq, @from_c, @to_c FROM rg")
def _(t):
    return ranges(t).select("seq", "from_c", "to_c")


@query("d06_range_selection", f"WITH {RANGES} SELECT seq, pre_post_source, @pre_val, @post_val FROM rg")
def _(t):
    return ranges(t).select("seq", "pre_post_source", "pre_val", "post_val")


def args():
    return [F.col(c) for c in ("_y", "wt", "pre_val", "post_val")]


@query("d07_linear_additive", f"WITH {ROWS} SELECT seq, dt_round, round(y + wt * (post - pre), 6) AS corrected FROM r2")
def _(t):
    return rows(t).select("seq", "dt_round", dr.additive(*args()).alias("corrected"))


@query("d08_linear_multiplicative", f"WITH {ROWS} SELECT seq, dt_round, round(y * (1 - wt + wt * post / pre), 6) AS corrected FROM r2")
def _(t):
    return rows(t).select("seq", "dt_round", dr.multiplicative(*args()).alias("corrected"))


@query(
    "d09_weight_curves",
    f"""WITH {ROWS} SELECT seq, dt_round, @wt, round((exp(2 * wt) - 1) / (exp(2) - 1), 6) AS wt_exp, round(ln(1 + wt * (exp(2) - 1)) / 2, 6) AS wt_log, 1.0::DOUBLE AS wt_uniform FROM r2""",
)
def _(t):
    k = F.lit(2.0)
    curves = {f"wt_{n}": dr.weight_curve(kind, F.col("wt"), k) for n, kind in (("exp", "exponential"), ("log", "log"), ("uniform", "uniform"))}
    return rows(t).select("seq", "dt_round", "wt", *[c.alias(n) for n, c in curves.items()])


FIT = "CASE WHEN np >= 3 AND pre IS NOT NULL AND post IS NOT NULL AND bs IS NOT NULL THEN y * post / (post + bs * wt) ELSE {} END"


@query("d10_fitted_linear", f"WITH {ROWS} SELECT seq, dt_round, round(bs + {TIE}, 5) AS b_slope, np AS n_points, round({FIT.format('y + wt * (post - pre)')} + {TIE}, 5) AS corrected FROM r2")
def _(t):
    d = rows(t)
    d = d.join(dr.window_slopes(d, ["site", "parameter"]), ["site", "parameter", "seq"])
    out = dr.fitted(*args(), F.col("b_slope"), F.col("n_points"), dr.additive(*args()))
    return d.select("seq", "dt_round", F.round(F.col("b_slope") + TIE, 5).alias("b_slope"), "n_points", F.round(out + TIE, 5).alias("corrected"))


def _rate_pass(prev: str, name: str, points: int = 30) -> str:
    """The check's own search: more and other rates than the operator tries, written out as plain sums."""
    curve = "CASE WHEN kk = 0 THEN wt WHEN kk > 0 THEN exp(kk * (wt - 1)) * (1 - exp(-kk * wt)) / (1 - exp(-kk)) ELSE (1 - exp(kk * wt)) / (1 - exp(kk)) END"
    return f"""{name}e AS (SELECT seq, i, s0, w, sum(power({curve} - f, 2)) AS e
      FROM (SELECT d.seq, d.wt, d.f, q.i, p.s AS s0, p.w, sinh(p.s + p.w * q.i / {points}) AS kk FROM fa d JOIN {prev} p USING (seq), (SELECT unnest(range({-points}, {points + 1})) AS i) q WHERE d.f IS NOT NULL) GROUP BY 1, 2, 3, 4),
  {name} AS (SELECT seq, min_by(s0 + w * i / {points}, (e, i)) AS s, any_value(w) / {points} AS w, min_by(i, (e, i)) AS i, min(e) AS e FROM {name}e GROUP BY seq)"""


RATES = (
    ROWS
    + """, fa AS (SELECT seq, wt, (y - post) / nullif(pre - post, 0) AS f FROM r2),
  fw AS (SELECT seq, count(f) AS nf, asinh(60.0::DOUBLE * greatest(count(*), 2)) AS w, 0.0::DOUBLE AS s FROM fa GROUP BY seq),
  k0 AS (SELECT seq, s, w FROM fw WHERE nf >= 3), """
    + _rate_pass("k0", "k1")
    + ", ki AS (SELECT k1.* FROM k1 JOIN (SELECT seq, min(e) FILTER (abs(i) = 30) AS far FROM k1e GROUP BY seq) USING (seq) WHERE e < far * (1 - 1e-6)), "
    + ", ".join(_rate_pass(a, b) for a, b in (("ki", "k2"), ("k2", "k3"), ("k3", "k4")))
    + """, ks AS (SELECT k4.seq, k4.s + CASE WHEN a.e - 2 * k4.e + c.e > 0 THEN k4.w / 2 * (a.e - c.e) / (a.e - 2 * k4.e + c.e) ELSE 0 END AS s
    FROM k4 LEFT JOIN k4e a ON a.seq = k4.seq AND a.i = k4.i - 1 LEFT JOIN k4e c ON c.seq = k4.seq AND c.i = k4.i + 1),
  kr AS (SELECT fw.seq, coalesce(sinh(round(ks.s, 5)), 1) AS k,
    CASE WHEN ks.seq IS NOT NULL THEN 'fitted' WHEN nf = 0 THEN 'no drift' WHEN nf < 3 THEN 'too few rows' ELSE 'diverged' END AS reason FROM fw LEFT JOIN ks USING (seq))"""
)


@query("d11_fit_rate", f"WITH {RATES} SELECT seq, round(asinh(k), 4) AS asinh_k, reason FROM kr")
def _(t):
    return dr.fit_rate(rows(t), ["site", "parameter"]).select("seq", F.round(F.asinh("k"), 4).alias("asinh_k"), "reason")


LOGW = "(CASE WHEN k = 0 OR wt <= 0 OR wt >= 1 THEN wt WHEN k > 0 THEN 1 + ln(wt + (1 - wt) * exp(-k)) / k ELSE ln(1 + wt * (exp(k) - 1)) / k END)"
GRID_EXPR = {
    "linear_add": "y + wt * (post - pre)",
    "linear_mult": "y * (1 - wt + wt * post / pre)",
    "exp_add": f"y + {LOGW} * (post - pre)",
    "exp_mult": f"y * (1 - {LOGW} + {LOGW} * post / pre)",
    "uniform_add": "y + (post - pre)",
    "uniform_mult": "y * post / pre",
    "fitted_add": FIT.format("y + wt * (post - pre)"),
    "fitted_mult": FIT.format("y * (1 - wt + wt * post / pre)"),
}
STRATEGY = (
    "CASE "
    + " ".join(
        f"WHEN drift_type = '{kind}' AND correction_type {'=' if form == 'mult' else '<>'} 'multiplicative' THEN {GRID_EXPR[f'{label}_{form}']}"
        for kind, label in (("linear", "linear"), ("exponential", "exp"), ("uniform", "uniform"), ("fitted_linear", "fitted"))
        for form in ("add", "mult")
    )
    + " END"
)


@query(
    "d12_apply_corrections",
    f"""WITH {RATES}, cc AS (SELECT site, parameter, dt_round, min_by(ROW({STRATEGY}), seq) AS g FROM r2 JOIN kr USING (seq) GROUP BY 1, 2, 3)
    SELECT d.site, d.parameter, d.dt_round, round(coalesce(struct_extract_at(g, 1), d.mean_analysis) + {TIE}, 6) AS mean_drift_trans FROM fx_drift d LEFT JOIN cc ON cc.site = d.site AND cc.parameter = d.parameter AND cc.dt_round = d.dt_round""",
)
def _(t):
    out = dr.apply_corrections(t.drift, t.windows, ranges(t), S)
    return out.select(*KEYS, (F.col("mean_drift_trans") + TIE).alias("mean_drift_trans"))


NODRIFT = f"nullif(array_to_string(list_filter(string_split(coalesce(user_flag, ''), {SEP}), lambda x: x NOT IN ('drift', '')), {SEP}), '')"


@query(
    "d13_unflag_windows",
    f"""SELECT site, parameter, dt_round, CASE WHEN c THEN {NODRIFT} ELSE user_flag END AS user_flag, drift AND NOT c AS drift FROM (SELECT *, EXISTS (SELECT 1 FROM fx_windows w WHERE w.site = d.site AND w.parameter = d.parameter AND d.dt_round BETWEEN w.start_dt AND w.end_dt) AS c FROM fx_drift d)""",
)
def _(t):
    return dr.unflag_windows(t.drift, t.windows, S).select(*KEYS, "user_flag", "drift")


GRID = (
    RATES
    + ", gr AS (SELECT site, parameter, dt_round, arg_min(pre_post_source, seq) AS pre_post_source, "
    + ", ".join(f"min_by(ROW({e}), seq) AS {n}" for n, e in GRID_EXPR.items())
    + " FROM r2 JOIN kr USING (seq) WHERE drift_type <> 'non_resolved' GROUP BY 1, 2, 3), gd AS (SELECT d.*, pre_post_source, "
    + ", ".join(f"coalesce(struct_extract_at({n}, 1), mean_analysis) AS {n}" for n in GRID_EXPR)
    + " FROM fx_drift d LEFT JOIN gr USING (site, parameter, dt_round))"
)


@query("d14_scenario_grid", f"WITH {GRID} SELECT site, parameter, dt_round, pre_post_source, " + ", ".join(f"round({n} + {TIE}, 6) AS {n}" for n in GRID_EXPR) + " FROM gd")
def _(t):
    out = dr.scenario_grid(t.drift, t.windows, ranges(t), S)
    return out.select(*KEYS, "pre_post_source", *[(F.col(c) + TIE).alias(c) for c in dr.GRID_COLUMNS])


def _cleanup_sql(high: str) -> str:
    f = "WINDOW f AS (PARTITION BY site, parameter, vg ORDER BY dt_round ROWS BETWEEN 3 PRECEDING AND 4 FOLLOWING)"
    return f"""WITH q AS (SELECT *, sum(coalesce(contains(user_flag, 'site visit'), false)::INT) OVER (PARTITION BY site, parameter ORDER BY dt_round) AS vg FROM fx_drift),
      p AS (SELECT *, CASE WHEN mean IS NULL OR (epoch(dt_round) // {STEP}) % 5 < 2 THEN NULL ELSE drift::INT END AS pr FROM q),
      a AS (SELECT *, CASE WHEN count(*) OVER f = 8 THEN coalesce(sum(pr) OVER f, 0) / 8.0 END AS dd FROM p {f}),
      b AS (SELECT *, CASE WHEN pr IS NULL OR (pr = 1 AND dd IS NULL) THEN NULL WHEN pr = 1 AND dd < 0.25 THEN 0 ELSE pr END AS pc FROM a),
      c AS (SELECT *, (mean IS NULL OR pc IS NULL)::INT AS gone FROM b),
      e AS (SELECT *, CASE WHEN count(*) OVER f = 8 THEN sum(gone) OVER f / 8.0 END AS ms FROM c {f})
    SELECT site, parameter, dt_round, round(dd, 6) AS drift_density, CAST(coalesce(pc, -1) AS BIGINT) AS drift_pred_clean, coalesce(mean IS NOT NULL AND ms >= {high}, false) AS is_isolated,
      CAST(coalesce(CASE WHEN NOT coalesce(mean IS NOT NULL AND ms >= {high}, false) THEN pc END, -1) AS BIGINT) AS drift_pred_final FROM e"""


def _cleanup(t, **limits):
    from sensorqc.operators import visits as vz

    skipped = F.pmod(F.floor(F.unix_seconds("dt_round") / STEP), F.lit(5)) < 2
    d = vz.visit_groups(t.drift, S, F.coalesce(F.col("user_flag").contains("site visit"), F.lit(False)))
    d = d.withColumn("drift_pred", F.when(F.col("mean").isNotNull() & ~skipped, F.col("drift").cast("long")))
    out = dr.clean_predictions(d, S, group="visit_group", **limits)
    return out.select(*KEYS, "drift_density", "drift_pred_clean", "is_isolated", "drift_pred_final").fillna(-1, ["drift_pred_clean", "drift_pred_final"])


@query("d15_prediction_cleanup", _cleanup_sql("8.0 / 9"))
def _(t):
    return _cleanup(t)


@query("d15_prediction_cleanup_wide", _cleanup_sql("0.5"))
def _(t):
    return _cleanup(t, high=0.5)


@query(
    "d16_stitch",
    f"""WITH {GRID}, hw AS (SELECT d.site, d.parameter, d.dt_round, max_by(w.drift_type, w.seq) AS kind, max_by(w.correction_type, w.seq) AS form, bool_or(w.drift_type = 'non_resolved') AS om, bool_or(w.drift_type = 'unflag') AS un
       FROM fx_drift d JOIN fx_windows w ON w.site = d.site AND w.parameter = d.parameter AND d.dt_round BETWEEN w.start_dt AND w.end_dt GROUP BY 1, 2, 3),
      s0 AS (SELECT gd.*, kind, form, coalesce(om, false) AS om, coalesce(un, false) AS un, coalesce(un, false) OR (drift AND kind IS NULL) AS clr FROM gd LEFT JOIN hw USING (site, parameter, dt_round)),
      s1 AS (SELECT *, CASE WHEN clr THEN {NODRIFT} ELSE user_flag END AS uf, CASE WHEN om THEN NULL ELSE mean_analysis END AS ma, CASE WHEN om THEN 'OMIT' ELSE verification_status END AS vs FROM s0)
    SELECT site, parameter, dt_round, uf AS user_flag, drift AND NOT clr AS drift, CASE WHEN clr AND uf IS NULL AND vs <> 'OMIT' THEN 'PASS' ELSE vs END AS verification_status,
      CASE WHEN kind IS NULL OR kind = 'unflag' THEN 'raw' ELSE kind END AS correction_type, CASE WHEN NOT (om OR un) THEN pre_post_source END AS pre_post_source,
      round(CASE WHEN kind IS NULL OR kind = 'unflag' THEN ma WHEN kind = 'linear' AND form = 'multiplicative' THEN linear_mult WHEN kind = 'linear' THEN linear_add
        WHEN kind = 'exponential' AND form = 'multiplicative' THEN exp_mult WHEN kind = 'exponential' THEN exp_add WHEN kind = 'uniform' AND form = 'multiplicative' THEN uniform_mult
        WHEN kind = 'uniform' THEN uniform_add WHEN kind = 'fitted_linear' AND form = 'multiplicative' THEN fitted_mult WHEN kind = 'fitted_linear' THEN fitted_add END + {TIE}, 6) AS mean_drift_trans FROM s1""",
)
def _(t):
    g = dr.scenario_grid(t.drift, t.windows, ranges(t), S)
    out = dr.stitch(g, t.windows, S)
    cols = ["user_flag", "drift", "verification_status", "correction_type", "pre_post_source"]
    return out.select(*KEYS, *cols, (F.col("mean_drift_trans") + TIE).alias("mean_drift_trans"))


def _smooth(src: str) -> str:
    return f"""SELECT * EXCLUDE x, CASE WHEN parameter = 'Turbidity' THEN (lag(x, 2) OVER w + 4 * lag(x) OVER w + 6 * x + 4 * lead(x) OVER w + lead(x, 2) OVER w) / 16 ELSE x END AS x
    FROM {src} WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round)"""


CHAIN = (
    RATES
    + f""", w1 AS (SELECT site, parameter, dt_round, min_by(ROW(y, {STRATEGY}), seq) FILTER (drift_type = 'linear') AS lin, min_by(ROW(y, {STRATEGY}), seq) FILTER (drift_type = 'exponential') AS ex,
      bool_or(drift_type = 'unflag') AS un FROM r2 JOIN kr USING (seq) GROUP BY 1, 2, 3),
  c0 AS (SELECT d.*, lin, ex, coalesce(un, false) AS un FROM fx_drift d LEFT JOIN w1 USING (site, parameter, dt_round)),
  c1 AS (SELECT site, parameter, dt_round, CASE WHEN un THEN {{NODRIFT}} ELSE user_flag END AS user_flag, drift AND NOT un AS drift,
      CASE WHEN lin IS NOT NULL THEN 'linear' WHEN ex IS NOT NULL THEN 'exponential' WHEN un THEN 'unflagged' ELSE 'raw' END AS correction_type,
      CASE WHEN lin IS NOT NULL THEN coalesce(struct_extract_at(lin, 2), mean_analysis) WHEN ex IS NOT NULL THEN coalesce(struct_extract_at(ex, 2), mean_analysis) ELSE mean_analysis END AS v FROM c0),
  c2 AS (SELECT *, last_value(v IGNORE NULLS) OVER p AS bv, last_value(CASE WHEN v IS NOT NULL THEN epoch(dt_round) END IGNORE NULLS) OVER p AS bt,
      first_value(v IGNORE NULLS) OVER n AS av, first_value(CASE WHEN v IS NOT NULL THEN epoch(dt_round) END IGNORE NULLS) OVER n AS at_ FROM c1
    WINDOW p AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
  c3 AS (SELECT site, parameter, dt_round, user_flag, drift, correction_type, v, CASE WHEN v IS NOT NULL THEN v WHEN at_ - bt <= {STEP * 5} THEN bv + (av - bv) * (epoch(dt_round) - bt) / (at_ - bt) END AS filled FROM c2),
  c4 AS (SELECT *, filled AS x FROM c3), c5 AS ({_smooth('c4')}), c6 AS ({_smooth('c5')}), c7 AS ({_smooth('c6')})"""
)


@query(
    "d17_correct_series",
    f"""WITH {CHAIN.replace('{NODRIFT}', NODRIFT)} SELECT site, parameter, dt_round, user_flag, drift, correction_type, round(v + {TIE}, 6) AS mean_drift_trans, round(filled + {TIE}, 6) AS mean_filled, round(x + {TIE}, 6) AS mean_smoothed FROM c7""",
)
def _(t):
    out = dr.correct_series(t.drift, t.windows, t.notes, t.network, S, BEFORE, GAP)
    values = [(F.col(c) + TIE).alias(c) for c in ("mean_drift_trans", "mean_filled", "mean_smoothed")]
    return out.select(*KEYS, "user_flag", "drift", "correction_type", *values)


CALM = "SELECT *, drift AND user_flag IS NOT NULL AND site < 's04' AS dx FROM fx_drift"


@query(
    "d18_auto_pass",
    f"""WITH x AS ({CALM}) SELECT site, parameter, dt_round, round(mean_analysis, 6) AS mean_drift_trans, 'raw' AS correction_type FROM x WHERE (site, parameter) IN
      (SELECT (site, parameter) FROM x WHERE mean_analysis IS NOT NULL GROUP BY site, parameter HAVING NOT bool_or(dx))""",
)
def _(t):
    d = t.drift.withColumn("drift", F.col("drift") & (F.col("site") < "s04"))
    return dr.auto_pass(d, ["site", "parameter"]).select(*KEYS, "mean_drift_trans", "correction_type")


@query("d19_remaining_work", "SELECT DISTINCT site, parameter FROM fx_drift WHERE (site, parameter) NOT IN (SELECT (site, parameter) FROM fx_windows)")
def _(t):
    return dr.remaining(t.drift, t.windows, ["site", "parameter"])


@query(
    "d20_decision_upsert",
    """WITH f AS (SELECT seq + 1000000 AS seq, site, parameter, start_dt, 'uniform' AS drift_type FROM fx_windows WHERE drift_type = 'linear')
    SELECT seq, site, parameter, start_dt, drift_type FROM fx_windows WHERE (site, parameter) NOT IN (SELECT (site, parameter) FROM f) UNION ALL SELECT * FROM f""",
)
def _(t):
    base = t.windows.select("seq", "site", "parameter", "start_dt", "drift_type")
    fresh = base.filter("drift_type = 'linear'").withColumns({"seq": F.col("seq") + 1000000, "drift_type": F.lit("uniform")})
    return dr.upsert_decisions(base, fresh, ["site", "parameter"])


CONF = """o AS (SELECT site, parameter, drift::INT AS tr, (mean > 70)::INT AS pr FROM fx_drift), c AS (SELECT site, count(*) FILTER (tr = 1 AND pr = 1) AS tp, count(*) FILTER (tr = 0 AND pr = 1) AS fp,
  count(*) FILTER (tr = 1 AND coalesce(pr, 0) <> 1) AS fn, count(*) FILTER (tr = 0 AND coalesce(pr, 0) <> 1) AS tn FROM o GROUP BY site),
  m AS (SELECT *, tp + fp + fn + tn AS n, (tp + tn) / (tp + fp + fn + tn) AS accuracy, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / power(tp + fp + fn + tn, 2) AS pe FROM c)"""


def _labelled(t):
    return t.drift.select("site", "parameter", F.col("drift").cast("long").alias("drift_cat"), (F.col("mean") > 70).cast("long").alias("drift_pred"))


@query("d21_confusion", f"WITH {CONF} SELECT site, tp, fp, fn, tn, @accuracy, round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((accuracy - pe) / (1 - pe), 6) AS kappa FROM m")
def _(t):
    return dr.scores(_labelled(t), "drift_cat", "drift_pred", ["site"])


@query(
    "d21_outcome_shares",
    """WITH o AS (SELECT site, CASE WHEN drift AND coalesce(mean > 70, false) THEN 'True Positive' WHEN NOT drift AND coalesce(mean > 70, false) THEN 'False Positive' WHEN drift THEN 'False Negative' ELSE 'True Negative' END AS outcome FROM fx_drift)
    SELECT site, outcome, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY site) * 100, 6) AS percent FROM o GROUP BY 1, 2""",
)
def _(t):
    return dr.outcome_shares(_labelled(t), ["site"], "drift_cat", "drift_pred")


@query(
    "d22_min_max_scaling",
    """WITH m AS (SELECT parameter, min(mean) AS a, max(mean) AS b, min(spread) AS c, max(spread) AS d FROM fx_slots WHERE site < 's08' GROUP BY 1)
    SELECT site, parameter, dt_round, round((mean - a) / (b - a), 6) AS mean_scaled, round((spread - c) / (d - c), 6) AS spread_scaled FROM fx_slots JOIN m USING (parameter)""",
)
def _(t):
    fitted = dr.fit_scaling(t.slots.filter("site < 's08'"), ["mean", "spread"], ["parameter"])
    return dr.apply_scaling(t.slots, fitted, ["mean", "spread"], ["parameter"]).select(*KEYS, "mean_scaled", "spread_scaled")


@query("d23_drift_classifier")
def _(t):
    d = over_slots(t.drift, S, 3, 3, *grid.summary_steps(S))
    d = fl.rolling_r2(d, S, short=4, long=8, share=0.3).withColumn("drift_cat", F.col("drift").cast("long"))
    features = ["mean", "rollavg", "rollsd", "slope_ahead", "slope_behind", "r2_s_right", "r2_l_right"]
    _, scored = dr.train_drift_classifier(d, features, "drift_cat", [f"s{i:02d}" for i in range(0, 10)], iterations=5, depth=3)
    return scored.select(*KEYS, "drift_cat", "drift_pred")


@query(
    "d_interpolated_and_smoothed",
    f"""WITH i AS ({{}}) SELECT site, parameter, dt_round, round(CASE WHEN parameter = 'Turbidity' THEN (lag(mean, 2) OVER w + 4 * lag(mean) OVER w + 6 * mean + 4 * lead(mean) OVER w + lead(mean, 2) OVER w) / 16 ELSE mean END, 6) AS smoothed
    FROM i WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round)""".replace(
        "{}",
        f"""SELECT site, parameter, dt_round, CASE WHEN mean IS NOT NULL THEN mean WHEN at_ - bt <= {STEP * 5} THEN bv + (av - bv) * (epoch(dt_round) - bt) / (at_ - bt) END AS mean FROM (SELECT site, parameter, dt_round, mean_analysis AS mean,
   last_value(mean_analysis IGNORE NULLS) OVER p AS bv, last_value(CASE WHEN mean_analysis IS NOT NULL THEN epoch(dt_round) END IGNORE NULLS) OVER p AS bt,
   first_value(mean_analysis IGNORE NULLS) OVER n AS av, first_value(CASE WHEN mean_analysis IS NOT NULL THEN epoch(dt_round) END IGNORE NULLS) OVER n AS at_
  FROM fx_drift WINDOW p AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   n AS (PARTITION BY site, parameter ORDER BY dt_round ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
    ),
)
def _(t):
    d = grid.interpolate_gaps(t.drift, S, "mean_analysis", 4, "filled")
    return grid.low_pass(d, S, "filled", 1).select(*KEYS, "smoothed")


#: The spline's equations solved row by row: forward elimination, then back substitution, as recursive tables.
SPLINE_SQL = f"""WITH RECURSIVE kn AS (SELECT site, parameter, epoch(dt_round) / {STEP} AS x, mean AS y, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY site, parameter) AS n
    FROM fx_series WHERE mean IS NOT NULL WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round)),
  d1 AS (SELECT *, lead(x) OVER w - x AS h, (lead(y) OVER w - y) / (lead(x) OVER w - x) AS s, lead(x, 2) OVER w - x AS x2, lead(x, 3) OVER w - x AS x3 FROM kn WINDOW w AS (PARTITION BY site, parameter ORDER BY i)),
  d2 AS (SELECT *, (lead(s) OVER w - s) / x2 AS s2 FROM d1 WINDOW w AS (PARTITION BY site, parameter ORDER BY i)),
  d3 AS (SELECT *, 6 * (lead(s2) OVER w - s2) / x3 AS third, lag(h) OVER w AS hb, lag(s) OVER w AS sb FROM d2 WINDOW w AS (PARTITION BY site, parameter ORDER BY i)),
  d4 AS (SELECT *, first_value(third) OVER w AS t0, max(CASE WHEN i = n - 4 THEN third END) OVER w AS t1 FROM d3 WINDOW w AS (PARTITION BY site, parameter ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
  eq AS (SELECT site, parameter, i, n, CASE WHEN i = 0 THEN 0 WHEN i = n - 1 THEN -1 ELSE hb END AS lo, CASE WHEN i = 0 THEN -1 WHEN i = n - 1 THEN 1 ELSE 2 * (hb + h) END AS mi,
      CASE WHEN i = 0 THEN 1 WHEN i = n - 1 THEN 0 ELSE h END AS up, CASE WHEN i = 0 THEN h * t0 WHEN i = n - 1 THEN hb * t1 ELSE 6 * (s - sb) END AS r FROM d4),
  fw AS (SELECT site, parameter, i, n, mi::DOUBLE AS mi, up::DOUBLE AS up, r::DOUBLE AS r FROM eq WHERE i = 0
    UNION ALL SELECT e.site, e.parameter, e.i, e.n, e.mi - e.lo / f.mi * f.up, e.up, e.r - e.lo / f.mi * f.r FROM fw f JOIN eq e ON e.site = f.site AND e.parameter = f.parameter AND e.i = f.i + 1),
  bw AS (SELECT site, parameter, i, r / mi AS m FROM fw WHERE i = n - 1
    UNION ALL SELECT f.site, f.parameter, f.i, (f.r - f.up * b.m) / f.mi FROM bw b JOIN fw f ON f.site = b.site AND f.parameter = b.parameter AND f.i = b.i - 1),
  pc AS (SELECT k.site, k.parameter, k.x, k.y, lead(k.x) OVER w AS xn, lead(k.y) OVER w AS yn, m, lead(m) OVER w AS mn FROM kn k JOIN bw USING (site, parameter, i) WINDOW w AS (PARTITION BY k.site, k.parameter ORDER BY k.i)),
  ho AS (SELECT site, parameter, dt_round, mean, epoch(dt_round) / {STEP} AS z FROM fx_series)
SELECT o.site, o.parameter, o.dt_round, @mean, round(CASE WHEN mean IS NOT NULL THEN mean
    WHEN xn - x <= 5 THEN (xn - z) / (xn - x) * y + (z - x) / (xn - x) * yn
      + ((power((xn - z) / (xn - x), 3) - (xn - z) / (xn - x)) * m + (power((z - x) / (xn - x), 3) - (z - x) / (xn - x)) * mn) * power(xn - x, 2) / 6 END, 6) AS splined
FROM ho o LEFT JOIN pc ON pc.site = o.site AND pc.parameter = o.parameter AND o.mean IS NULL AND o.z > pc.x AND o.z < pc.xn"""


@query("g11_spline_gaps", SPLINE_SQL)
def _(t):
    from sensorqc.functions.numeric import spline_gaps

    return spline_gaps(t.series.select(*KEYS, "mean"), S)

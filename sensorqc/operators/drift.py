"""Drift windows, range values, corrections and their evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorqc.functions import time as tm, tokens
from sensorqc.operators import grid
from sensorqc.operators.calibration import weight
from sensorqc.operators.visits import chain_neighbours
from sensorqc.plans.chunks import carry_series, over_slots, rank_rows
from sensorqc.plans.joins import asof_join, interval_join, mark_covered
from sensorqc.plans.segments import pick_winners
from sensorqc.series import Series
from sensorqc.session import materialise

DRIFT = "drift"
OWNER_SUFFIX = "_virridy"


def analysis_columns(df: DataFrame, flag: str = "user_flag", value: str = "mean") -> DataFrame:
    kept = F.col("verification_status").isin("FLAGGED", "PASS")
    return df.withColumns({"drift": F.coalesce(F.col(flag).contains(DRIFT), F.lit(False)), "mean_analysis": F.when(kept, F.col(value))})


def gap_windows(df: DataFrame, spec: Series, gap_seconds: int = 86400, strategy: str = "None", formulation: str = "additive") -> DataFrame:
    """Islands of drifting rows separated by more than ``gap_seconds``."""
    d = df.filter(F.col("drift") & F.col("mean_analysis").isNotNull()).select(*spec.keys, spec.time, "mean_analysis")
    d = carry_series(d, spec, fills={"_prev": F.col(spec.time)}, exclusive=True)
    fresh = F.col("_prev").isNull() | (tm.seconds_between(spec.time, "_prev") > gap_seconds)
    d = carry_series(d.withColumn("_new", fresh.cast("long")), spec, sums={"window_id": F.col("_new")})
    out = d.groupBy(*spec.keys, "window_id").agg(
        F.min(spec.time).alias("start_dt"), F.max(spec.time).alias("end_dt"), F.max_by("mean_analysis", spec.time).alias("end_data_val")
    )
    return out.withColumns({"drift_type": F.lit(strategy), "correction_type": F.lit(formulation)})


def range_values(
    series: DataFrame,
    windows: DataFrame,
    notes: DataFrame | None,
    network: DataFrame | None,
    spec: Series,
    before_seconds: int = 3600,
    first: int = 4,
    gap_minutes: float = 120.0,
) -> DataFrame:
    """Windows with the three pairs of range values and the selected one.

    ``series`` has ``mean_analysis``; ``notes`` has (keys, note_dt, pre_clean, post_clean);
    ``network`` has (network, pos, site). Neighbouring readings are found by their rank in the
    series, so each window touches a fixed number of rows through one equi-join.
    """
    keys = list(spec.keys)
    clean = series.filter(F.col("mean_analysis").isNotNull()).select(*keys, spec.time, "mean_analysis")
    ranked = materialise(rank_rows(clean, spec), "ranked")
    w = windows.select(*keys, "seq", "start_dt", "end_dt")
    pos = ranked.select(*keys, F.col(spec.time).alias("_rt"), F.col("row_index").alias("_rank"))
    w = asof_join(w, pos, keys, "end_dt", "_rt", ["_rank"], spec.chunk_seconds).withColumn("_rank", F.coalesce("_rank", F.lit(0)))
    back = max(first, before_seconds // spec.step + 1)
    around = w.select(*keys, "seq", "end_dt", "_rank", F.explode(F.sequence(F.col("_rank") - (back - 1), F.col("_rank") + first)).alias("row_index"))
    around = around.filter("row_index > 0").join(ranked, [*keys, "row_index"])
    v, t = F.col("mean_analysis"), F.col(spec.time)
    is_after = F.col("row_index") > F.col("_rank")
    is_last = ~is_after & (F.col("row_index") > F.col("_rank") - first)
    near = ~is_after & (t >= tm.shift("end_dt", -before_seconds))
    agg = around.groupBy(*keys, "seq").agg(
        F.avg(F.when(near, v)).alias("from_a"),
        F.avg(F.when(is_after, v)).alias("to_a"),
        F.min(F.when(is_after, t)).alias("_next"),
        F.avg(F.when(is_last, v)).alias("from_c"),
    )
    out = w.drop("_rank").join(agg, [*keys, "seq"], "left")
    out = out.withColumn("gap_minutes", tm.seconds_between("_next", "end_dt") / 60).drop("_next")
    if notes is not None:
        n = notes.select(*keys, F.col("note_dt").alias("_nt"), F.col("pre_clean").alias("from_b"), F.col("post_clean").alias("to_b"))
        out = asof_join(out, n, keys, "end_dt", "_nt", ["from_b", "to_b"], spec.chunk_seconds, each=True)
    else:
        out = out.withColumns({c: F.lit(None).cast("double") for c in ("from_b", "to_b")})
    if network is not None:
        # a site stands in the network without its owner's suffix; of several networks the first (by name) counts
        last = around.filter(is_last).select(*keys, "seq", spec.time, F.regexp_replace("site", f"{OWNER_SUFFIX}$", "").alias("_listed"))
        first = chain_neighbours(network).groupBy("site").agg(F.min_by(F.struct("upstream", "downstream"), "network").alias("_w"))
        near_sites = first.select(F.col("site").alias("_listed"), F.stack(F.lit(2), F.lit("up"), F.col("_w.upstream"), F.lit("down"), F.col("_w.downstream")).alias("side", "_n"))
        asked = last.join(near_sites.filter("_n is not null"), "_listed").drop("_listed")
        other = clean.select(F.col("site").alias("_n"), *[k for k in keys if k != "site"], spec.time, "mean_analysis")
        seen = asked.join(other, ["_n", *[k for k in keys if k != "site"], spec.time])
        sides = seen.groupBy(*keys, "seq").agg(
            F.avg(F.when(F.col("side") == "up", v)).alias("_up"), F.avg(F.when(F.col("side") == "down", v)).alias("_down")
        )
        out = out.join(sides, [*keys, "seq"], "left")
        disagree = F.coalesce((F.col("parameter") == "Turbidity") & (F.abs(F.col("_up") - F.col("_down")) > 10), F.lit(False))
        both = (F.coalesce("_up", "_down") + F.coalesce("_down", "_up")) / 2
        out = out.withColumn("to_c", F.when(~disagree, both)).drop("_up", "_down")
    else:
        out = out.withColumn("to_c", F.lit(None).cast("double")).withColumn("from_c", F.lit(None).cast("double"))
    return select_range(out, gap_minutes)


def select_range(df: DataFrame, gap_minutes: float = 120.0) -> DataFrame:
    """C after a long gap, else the largest correction in the right direction, else fallbacks."""
    falling = F.col("parameter") == "Turbidity"

    def option(x: str):
        a, b = F.col(f"from_{x}"), F.col(f"to_{x}")
        right = F.when(falling, a >= b).otherwise(b >= a)
        ok = F.coalesce(a.isNotNull() & b.isNotNull() & (F.abs(a - b) < 1000) & right, F.lit(False))
        return ok, a, b

    options = {x: option(x) for x in ("a", "c", "b")}
    size = {x: F.when(ok, F.abs(a - b)) for x, (ok, a, b) in options.items()}
    best = F.greatest(*size.values())
    long_gap = F.col("gap_minutes").isNull() | (F.col("gap_minutes") > gap_minutes)
    a_valid = F.col("from_a").isNotNull() & F.col("to_a").isNotNull()
    source = F.when(long_gap & options["c"][0], "C")
    for x in ("a", "c", "b"):
        source = source.when(size[x] == best, x.upper())
    source = source.when(a_valid, "A_fallback").otherwise("mixed_fallback")

    def value(end: str) -> Column:
        s, a, b, c = F.col("pre_post_source"), F.col(f"{end}_a"), F.col(f"{end}_b"), F.col(f"{end}_c")
        return F.when(s.isin("A", "A_fallback"), a).when(s == "B", b).when(s == "C", c).otherwise(F.coalesce(a, b))

    return df.withColumn("pre_post_source", source).withColumns({"pre_val": value("from"), "post_val": value("to")})


# --- corrections -------------------------------------------------------------------------------


def weight_curve(kind: str, wt: Column, k: Column) -> Column:
    """Share of the drift reached at ``wt``; ``k = 0`` is the straight line.

    Written so that no rate, however large, overflows; the log curve is the inverse of the exponential one.
    """
    if kind == "exponential":
        rising = F.exp(k * (wt - 1)) * F.expm1(-k * wt) / F.expm1(-k)
        return F.when(k == 0, wt).when(k > 0, rising).otherwise(F.expm1(k * wt) / F.expm1(k))
    if kind == "log":
        rising = 1 + F.log(wt + (1 - wt) * F.exp(-k)) / k
        return F.when((k == 0) | (wt <= 0) | (wt >= 1), wt).when(k > 0, rising).otherwise(F.log1p(wt * F.expm1(k)) / k)
    return F.lit(1.0) if kind == "uniform" else wt


def additive(y: Column, wt: Column, pre: Column, post: Column) -> Column:
    return y + wt * (post - pre)


def multiplicative(y: Column, wt: Column, pre: Column, post: Column) -> Column:
    return F.when(pre != 0, y * (1 - wt + wt * post / pre))


def fitted(y: Column, wt: Column, pre: Column, post: Column, slope: Column, n: Column, fallback: Column) -> Column:
    bottom = post + slope * wt
    known = pre.isNotNull() & post.isNotNull()
    return F.when(known & (n >= 3) & slope.isNotNull(), F.when(bottom != 0, y * post / bottom)).otherwise(fallback)


def window_rows(series: DataFrame, windows: DataFrame, spec: Series, value: str = "mean_analysis") -> DataFrame:
    """Rows of each window with ``wt``; the grid gives the first and last slot of a window directly."""
    keys = list(spec.keys)
    ends = series.groupBy(*keys).agg(F.min(spec.time).alias("_lo"), F.max(spec.time).alias("_hi"))
    up = tm.floor_slot(tm.shift("start_dt", spec.step - 1e-6), spec.step)
    w = windows.join(ends, keys).withColumns({"_first": F.greatest(up, "_lo"), "_last": F.least(tm.floor_slot("end_dt", spec.step), "_hi")})
    rows = interval_join(series.select(*keys, spec.time, F.col(value).alias("_y")), w.drop("_lo", "_hi"), keys, spec.time, "start_dt", "end_dt", spec.chunk_seconds, "inner")
    return rows.withColumn("wt", weight(spec.time, "_first", "_last")).drop("_first", "_last")


def window_slopes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """OLS slope of the value on ``wt`` and the number of points per window.

    The sums are decimals, so they don't depend on the order in which partial sums meet.
    """
    y, x = F.col("_y").cast("decimal(27,13)"), F.col("wt").cast("decimal(16,15)")
    both = F.col("_y").isNotNull() & F.col("wt").isNotNull()
    sums = {"_sx": x, "_sy": y, "_sxy": x * y, "_sxx": x * x}
    s = rows.groupBy(*keys, "seq").agg(F.count("_y").alias("n_points"), F.count(F.when(both, 1)).alias("_n"), *[F.sum(F.when(both, c)).cast("double").alias(n) for n, c in sums.items()])
    spread = F.col("_n") * F.col("_sxx") - F.col("_sx") * F.col("_sx")
    slope = F.when((F.col("_n") > 1) & (spread > 1e-9), (F.col("_n") * F.col("_sxy") - F.col("_sx") * F.col("_sy")) / spread)
    return s.select(*keys, "seq", slope.alias("b_slope"), "n_points")


#: Rates are sought evenly in asinh(k), in so many steps to each side, so often; then a parabola gives the last digits.
RATE_STEPS, RATE_PASSES, RATE_DIGITS = 20, 4, 5

#: A rate must lower the squared errors of the steepest curves by this share, else it can't be told from them.
RATE_GAIN = 1e-6

#: With this many times as steep a curve as a window has rows, all but one of its rows lie where the curve is flat to the last bit.
STEEPEST = 40.0


def fit_rate(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Exponential rate k per window by least squares, and the reason where it is 1 by default.

    No bound cuts the rates: a window's search reaches as far as its rows can tell two curves apart, in steps that are
    even in asinh(k). The errors of a grid of rates are summed in one partial aggregate, so a window may hold any number
    of rows, and the grid is narrowed around the best rate; a window whose errors are no lower than those of the steepest
    curves diverges and leaves the search. ``reason`` is 'fitted', 'no drift' (ends equal or unknown), 'too few rows' (under three) or 'diverged'.
    """
    ids = [*keys, "seq"]
    frac = (F.col("_y") - F.col("post_val")) / F.when(F.col("pre_val") != F.col("post_val"), F.col("pre_val") - F.col("post_val"))
    data = materialise(rows.select(*ids, "wt", frac.alias("_f")), "rate-rows")
    windows = data.groupBy(*ids).agg(F.count("_f").alias("_n"), F.asinh(STEEPEST * F.greatest(F.count(F.lit(1)), F.lit(2)).cast("double")).alias("_far"))
    data = data.filter("_f is not null")
    m = RATE_STEPS
    state = windows.filter("_n >= 3").select(*ids, F.lit(0.0).alias("_s"), F.col("_far").alias("_reach"))
    # as text: one expression instead of thousands of calls
    curve = "if(k = 0, wt, if(k > 0, exp(k * (wt - 1)) * expm1(-k * wt) / expm1(-k), expm1(k * wt) / expm1(k)))"
    errors = ", ".join(f"sum(pow({curve.replace('k', f'sinh(_s + _reach * ({i}d / {m}))')} - _f, 2))" for i in range(-m, m + 1))
    errors = errors.replace(f"sinh(_s + _reach * (0d / {m}))", "sinh(_s)")
    for n_pass in range(RATE_PASSES):
        got = data.join(state, ids).groupBy(*ids, "_s", "_reach").agg(F.expr(f"array({errors})").alias("_e"))
        got = got.withColumn("_j", F.array_position("_e", F.array_min("_e")).cast("int"))
        step = F.col("_reach") / m
        if n_pass == 0:
            limit = F.least(F.col("_e")[0], F.col("_e")[2 * m])  # the errors of a step at the end or at the start
            got = got.filter(F.array_min("_e") < limit * (1 - RATE_GAIN))  # the others diverge
        here = F.col("_s") + (F.col("_j") - 1 - m) * step
        if n_pass == RATE_PASSES - 1:
            a, b, c = (F.try_element_at("_e", F.col("_j") + o) for o in (-1, 0, 1))
            inner = (F.col("_j") > 1) & (F.col("_j") <= 2 * m) & ((a - 2 * b + c) > 0)
            here = here + F.when(inner, step / 2 * (a - c) / (a - 2 * b + c)).otherwise(0.0)
        state = got.select(*ids, here.alias("_s"), step.alias("_reach"))
    out = windows.join(state.select(*ids, F.sinh(F.round("_s", RATE_DIGITS)).alias("k")), ids, "left")
    reason = F.when(F.col("k").isNotNull(), "fitted").when(F.col("_n") == 0, "no drift").when(F.col("_n") < 3, "too few rows").otherwise("diverged")
    return out.select(*ids, F.coalesce("k", F.lit(1.0)).alias("k"), reason.alias("reason"))


COLUMN_OF = {"linear": "linear", "exponential": "exp", "uniform": "uniform", "fitted_linear": "fitted"}
GRID_COLUMNS = ("linear_add", "linear_mult", "exp_add", "exp_mult", "uniform_add", "uniform_mult", "fitted_add", "fitted_mult")

#: Windows of the exponential strategy fit an exponential rate and correct along the log curve of that rate.
CURVES = (("linear", "linear"), ("exp", "log"), ("uniform", "uniform"))


def correction_columns(y: Column, window: Column, wt: Column) -> dict[str, Column]:
    """All eight strategies as expressions over a row and the struct of its window's facts."""
    pre, post, k = window["pre_val"], window["post_val"], F.coalesce(window["k"], F.lit(1.0))
    cols = {}
    for label, kind in CURVES:
        curve = weight_curve(kind, wt, k)
        cols[f"{label}_add"] = additive(y, curve, pre, post)
        cols[f"{label}_mult"] = multiplicative(y, curve, pre, post)
    for form in ("add", "mult"):
        cols[f"fitted_{form}"] = fitted(y, wt, pre, post, window["b_slope"], window["n_points"], cols[f"linear_{form}"])
    return cols


def window_facts(series: DataFrame, windows: DataFrame, ranged: DataFrame, spec: Series, value: str, fit: bool = True) -> DataFrame:
    """Windows with range values, first and last slot, slope and fitted rate: all that a row's correction needs.

    Fits read each window's rows; everything else is one row per window.
    """
    keys = list(spec.keys)
    ranged = materialise(ranged, "ranges")
    w = windows.join(ranged.select(*keys, "seq", "pre_val", "post_val", "pre_post_source"), [*keys, "seq"])
    rows = materialise(window_rows(series, w, spec, value), "window-rows")
    ends = rows.groupBy(*keys, "seq").agg(F.min(spec.time).alias("_first"), F.max(spec.time).alias("_last"))
    stats = ends.join(window_slopes(rows, keys), [*keys, "seq"])
    rates = fit_rate(rows, keys).drop("reason") if fit else stats.select(*keys, "seq", F.lit(1.0).alias("k"))
    return materialise(w.join(stats, [*keys, "seq"]).join(rates, [*keys, "seq"]), "window-facts")


FACTS = ("pre_val", "post_val", "pre_post_source", "_first", "_last", "b_slope", "n_points", "k", "drift_type", "correction_type")


def scenario_grid(series: DataFrame, windows: DataFrame, ranged: DataFrame, spec: Series, fit: bool = True, value: str = "mean_analysis") -> DataFrame:
    """Series with the eight corrected columns; outside windows they equal the input.

    Range values, slopes and rates are computed once per window; of overlapping windows the first
    one (by ``seq``) counts, found by segments, so each row meets one window.
    """
    windows = windows.filter("drift_type <> 'non_resolved'")
    facts = window_facts(series, _first_somewhere(series, windows, spec), ranged, spec, value, fit)
    d, wt = _with_first_window(series, facts, spec)
    cols = {c: F.coalesce(x, F.col(value)) for c, x in correction_columns(F.col(value), F.col("_w"), wt).items()}
    return d.withColumns({**cols, "pre_post_source": F.col("_w.pre_post_source")}).drop("_w")


def _first_somewhere(series: DataFrame, windows: DataFrame, spec: Series) -> DataFrame:
    """The windows that are the first one of some row; no other one's slope and rate are ever asked for."""
    keys = list(spec.keys)
    first = {"_seq": (F.col("seq"), -F.col("seq"))}
    d = pick_winners(series.select(*keys, spec.time), windows, keys, spec.time, "start_dt", "end_dt", first, spec.chunk_seconds)
    used = d.filter("_seq is not null").select(*keys, F.col("_seq").alias("seq")).distinct()
    return materialise(windows.join(used, [*keys, "seq"], "left_semi"), "first-windows")


def _with_first_window(series: DataFrame, facts: DataFrame, spec: Series) -> tuple[DataFrame, Column]:
    """Each row with the facts of the first window that holds it (``_w``, null outside), and its weight there."""
    first = {"_w": (F.struct(*FACTS), -F.col("seq"))}
    d = pick_winners(series, facts, list(spec.keys), spec.time, "start_dt", "end_dt", first, spec.chunk_seconds)
    return d, weight(F.col(spec.time), F.col("_w._first"), F.col("_w._last"))


def apply_corrections(series: DataFrame, windows: DataFrame, ranged: DataFrame, spec: Series, value: str = "mean_analysis", kind: str | None = None, name: str = "mean_drift_trans") -> DataFrame:
    """Each window's own strategy with its fitted rate; rows outside windows keep the input.

    Overlapping windows give the value of the first one. ``kind`` forces one strategy.
    """
    facts = window_facts(series, _first_somewhere(series, windows, spec), ranged, spec, value)
    d, wt = _with_first_window(series, facts, spec)
    cols = correction_columns(F.col(value), F.col("_w"), wt)
    strategy = F.when(F.col("_w").isNotNull(), F.lit(kind)) if kind else F.col("_w.drift_type")
    form = F.when(F.col("_w.correction_type") == "multiplicative", "mult").otherwise("add")
    chosen = F.lit(None).cast("double")
    for s, label in COLUMN_OF.items():
        for f in ("add", "mult"):
            chosen = F.when((strategy == s) & (form == f), cols[f"{label}_{f}"]).otherwise(chosen)
    return d.withColumn(name, F.coalesce(chosen, F.col(value))).drop("_w")


def unflag_windows(df: DataFrame, windows: DataFrame, spec: Series, flag: str = "user_flag") -> DataFrame:
    m = mark_covered(df, windows, list(spec.keys), spec.time, "start_dt", "end_dt", spec.chunk_seconds, "_in")
    text = tokens.render(tokens.remove(tokens.parse(flag), DRIFT))
    return m.withColumns({flag: F.when(F.col("_in"), text).otherwise(F.col(flag)), "drift": F.when(F.col("_in"), F.lit(False)).otherwise(F.col("drift"))}).drop("_in")


def stitch(grid_df: DataFrame, windows: DataFrame, spec: Series) -> DataFrame:
    """Chosen column per window, the last window wins; unresolved windows become OMIT.

    A window of any type, also an undecided one, keeps the drift flag of its rows.
    """
    seq, kind = F.col("seq"), F.col("drift_type")
    known = F.when(kind.isin(*COLUMN_OF, "non_resolved", "unflag"), F.struct("drift_type", "correction_type"))
    picks = {
        "_last": (known, seq),
        "_omit": (F.when(kind == "non_resolved", True), seq),
        "_unflag": (F.when(kind == "unflag", True), seq),
        "_any": (F.lit(True), seq),
    }
    d = pick_winners(materialise(grid_df, "scenarios"), windows, list(spec.keys), spec.time, "start_dt", "end_dt", picks, spec.chunk_seconds)
    d = d.withColumn("_any", F.coalesce("_any", F.lit(False)))
    kind, form = F.col("_last.drift_type"), F.col("_last.correction_type")
    omit, unflag = (F.coalesce(c, F.lit(False)) for c in ("_omit", "_unflag"))
    analysis = F.when(~omit, F.col("mean_analysis"))
    value = F.when(kind.isNull() | (kind == "unflag"), analysis)
    for s, label in COLUMN_OF.items():
        value = value.when((kind == s) & (form == "multiplicative"), F.col(f"{label}_mult")).when(kind == s, F.col(f"{label}_add"))
    clear = unflag | (F.col("drift") & ~F.col("_any"))
    flag = F.when(clear, tokens.render(tokens.remove(tokens.parse("user_flag"), DRIFT))).otherwise(F.col("user_flag"))
    d = d.withColumns(
        {
            "mean_drift_trans": value,
            "correction_type": F.when(kind.isNull() | (kind == "unflag"), "raw").otherwise(kind),
            "_flag": flag,
        }
    )

    def status(c: str) -> Column:
        s = F.when(omit, "OMIT").otherwise(F.col(c))
        return F.when(clear & F.col("_flag").isNull() & (s != "OMIT"), "PASS").otherwise(s)

    statuses = {c: status(c) for c in ("verification_status", "final_status") if c in d.columns}
    source = F.when(~(omit | unflag), F.col("pre_post_source")) if "pre_post_source" in d.columns else F.lit(None).cast("string")
    d = d.withColumns({**statuses, "mean_analysis": analysis, "user_flag": F.col("_flag"), "drift": F.col("drift") & ~clear, "pre_post_source": source})
    return d.drop("_flag", "_last", "_omit", "_unflag", "_any", *GRID_COLUMNS)


def correct_series(series: DataFrame, windows: DataFrame, notes: DataFrame, network: DataFrame, spec: Series, before_seconds: int = 3600, gap_minutes: float = 120.0) -> DataFrame:
    """Unflag, correct linear windows and exponential ones (linear wins), fill short gaps, smooth Turbidity."""
    d = materialise(unflag_windows(series, windows.filter("drift_type = 'unflag'"), spec), "unflagged")
    ranged = range_values(d, windows, notes, network, spec, before_seconds, gap_minutes=gap_minutes)
    facts = window_facts(d, windows.filter(F.col("drift_type").isin("linear", "exponential")), ranged, spec, "mean_analysis")
    both = facts.unionByName(windows.filter("drift_type = 'unflag'"), allowMissingColumns=True)
    kind, earlier = F.col("drift_type"), -F.col("seq")
    picks = {f"_{k}": (F.when(kind == k, F.struct(*FACTS)), earlier) for k in ("linear", "exponential", "unflag")}
    d = pick_winners(d, both, list(spec.keys), spec.time, "start_dt", "end_dt", picks, spec.chunk_seconds)
    y = F.col("mean_analysis")
    value, label = y, F.when(F.col("_unflag").isNotNull(), "unflagged").otherwise("raw")
    for k in ("exponential", "linear"):
        w = F.col(f"_{k}")
        cols = correction_columns(y, w, weight(F.col(spec.time), w["_first"], w["_last"]))
        short = COLUMN_OF[k]
        own = F.when(w["correction_type"] == "multiplicative", cols[f"{short}_mult"]).otherwise(cols[f"{short}_add"])
        value = F.when(w.isNotNull(), F.coalesce(own, y)).otherwise(value)
        label = F.when(w.isNotNull(), k).otherwise(label)
    d = materialise(d.withColumns({"mean_drift_trans": value, "correction_type": label}).drop(*picks), "corrected")
    d = grid.interpolate_gaps(d, spec, "mean_drift_trans", 4, "mean_filled")
    return grid.low_pass(d, spec, "mean_filled", 3, name="mean_smoothed")


# --- book-keeping -------------------------------------------------------------------------------


def no_drift_series(df: DataFrame, keys: list[str]) -> DataFrame:
    has = df.filter("mean_analysis is not null").groupBy(*keys).agg(F.bool_or("drift").alias("_any"))
    return has.filter("not _any").select(*keys)


def auto_pass(df: DataFrame, keys: list[str]) -> DataFrame:
    done = df.join(no_drift_series(df, keys), keys, "left_semi")
    return done.withColumns({"mean_drift_trans": F.col("mean_analysis"), "correction_type": F.lit("raw")})


def remaining(all_keys: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return all_keys.select(*keys).distinct().join(done.select(*keys), keys, "left_anti")


def upsert_decisions(table: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Replace the rows of the series present in ``fresh``."""
    return table.join(fresh.select(*keys).distinct(), keys, "left_anti").unionByName(fresh)


# --- evaluation -----------------------------------------------------------------------------------


def clean_predictions(df: DataFrame, spec: Series, prediction: str = "drift_pred", value: str = "mean", width: int = 8, low: float = 0.25, high: float = 8 / 9, group: str | None = None) -> DataFrame:
    """Drop lone hits and void hits on isolated points; even windows reach one row further ahead.

    Windows end where a visit group ends: a frame counts only if all its rows are of the row's own ``group``
    (the running number of visits; None: the whole series is one group).
    """
    before, after = (width - 1) // 2, width // 2

    def whole(frame):
        full = F.count(F.lit(1)).over(frame) == width
        return full if group is None else full & (F.min(group).over(frame) == F.max(group).over(frame))

    def density(w):
        frame = w.rowsBetween(-before, after)
        return {"drift_density": F.when(whole(frame), F.coalesce(F.sum(prediction).over(frame), F.lit(0)) / width)}

    def clean(w):
        blip = (F.col(prediction) == 1) & (F.col("drift_density") < low)
        verdict = F.when(F.col(prediction).isNull() | ((F.col(prediction) == 1) & F.col("drift_density").isNull()), F.lit(None).cast("long"))
        return {"drift_pred_clean": verdict.when(blip, F.lit(0).cast("long")).otherwise(F.col(prediction))}

    def missing(w):
        gone = F.col(value).isNull() | F.col("drift_pred_clean").isNull()
        return {"_gone": gone.cast("int")}

    def isolated(w):
        frame = w.rowsBetween(-before, after)
        share = F.when(whole(frame), F.sum("_gone").over(frame) / width)
        return {"is_isolated": F.coalesce(F.col(value).isNotNull() & (share >= high), F.lit(False))}

    def final(w):
        return {"drift_pred_final": F.when(~F.col("is_isolated"), F.col("drift_pred_clean"))}

    return over_slots(df, spec, 2 * before, 2 * after, density, clean, missing, isolated, final).drop("_gone")


def outcome(truth: str, prediction: str) -> Column:
    hit, said = F.col(truth) == 1, F.coalesce(F.col(prediction) == 1, F.lit(False))
    return (
        F.when(hit & said, "True Positive").when(~hit & said, "False Positive").when(hit & ~said, "False Negative").when(~hit & ~said, "True Negative")
    )


def scores(df: DataFrame, truth: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """Counts, accuracy, F1 and kappa."""
    o = outcome(truth, prediction)
    counts = df.groupBy(*(by or [])).agg(
        *[F.count(F.when(o == full, 1)).alias(short) for short, full in (("tp", "True Positive"), ("fp", "False Positive"), ("fn", "False Negative"), ("tn", "True Negative"))]
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    accuracy = F.when(n > 0, (tp + tn) / n)
    chance = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / F.when(n > 0, n * n)
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn))
    return counts.withColumns({"accuracy": accuracy, "f1": f1, "kappa": F.when(chance < 1, (accuracy - chance) / (1 - chance))})


def outcome_shares(df: DataFrame, by: list[str], truth: str, prediction: str) -> DataFrame:
    c = df.withColumn("outcome", outcome(truth, prediction)).filter("outcome is not null").groupBy(*by, "outcome").agg(F.count(F.lit(1)).alias("n"))
    totals = c.groupBy(*by).agg(F.sum("n").alias("_t"))
    return c.join(totals, by).withColumn("percent", F.col("n") / F.col("_t") * 100).drop("_t")


def fit_scaling(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[f(c).alias(f"{c}_{n}") for c in columns for f, n in ((F.min, "min"), (F.max, "max"))])


def apply_scaling(df: DataFrame, fitted_scaling: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    d = df.join(fitted_scaling, by, "left")

    def scaled(c: str) -> Column:
        span = F.col(f"{c}_max") - F.col(f"{c}_min")
        return F.when(span > 0, (F.col(c) - F.col(f"{c}_min")) / span).otherwise(F.when(F.col(c).isNotNull(), 0.0))

    return d.withColumns({f"{c}_scaled": scaled(c) for c in columns}).drop(*[f"{c}_{n}" for c in columns for n in ("min", "max")])


def train_drift_classifier(df: DataFrame, features: list[str], label: str, train_sites: list[str], iterations: int = 20, depth: int = 4):
    """Gradient-boosted trees with class weights, trained on some sites; returns (model, scored rows)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    d = materialise(df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features}), "classifier-rows")
    train = d.filter(F.col("site").isin(*train_sites))
    share = train.agg(F.avg(F.col(label).cast("double")).alias("p")).first()["p"] or 0.5
    w = F.when(F.col(label) == 1, F.lit(1.0 - share)).otherwise(F.lit(share))
    stages = [
        VectorAssembler(inputCols=features, outputCol="features"),
        GBTClassifier(featuresCol="features", labelCol="_label", weightCol="_weight", maxIter=iterations, maxDepth=depth, seed=7),
    ]
    model = Pipeline(stages=stages).fit(train.withColumns({"_label": F.col(label).cast("double"), "_weight": w}))
    scored = model.transform(d).withColumn("drift_pred", F.col("prediction").cast("long"))
    return model, scored.drop("features", "rawPrediction", "probability", "prediction")



"""Report statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorqc.functions import time as tm, tokens
from sensorqc.operators import grid
from sensorqc.operators.flags import MISSING, NOT_EMPLOYED, SITE_VISIT, SV_WINDOW, ANOMALY_24H, ANOMALY_WINDOW
from sensorqc.plans.chunks import carry, time_chunk
from sensorqc.plans.quantiles import exact_quantiles
from sensorqc.series import Series
from sensorqc.session import materialise

# Token sets of rows that only say "no data".
MISSING_ONLY = [
    {MISSING},
    {NOT_EMPLOYED, MISSING},
    {MISSING, ANOMALY_WINDOW},
    {MISSING, ANOMALY_24H},
    {NOT_EMPLOYED, MISSING, ANOMALY_WINDOW},
    {MISSING, ANOMALY_24H, ANOMALY_WINDOW},
    {SITE_VISIT, MISSING, ANOMALY_24H, ANOMALY_WINDOW},
    {SV_WINDOW, MISSING, ANOMALY_24H, ANOMALY_WINDOW},
]


def share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole) * 100)


def flag_report(df: DataFrame, flags: list[str], time: str = "dt_round", flag: str = "flag") -> DataFrame:
    """Points and dates per site, parameter and flag, with and without missing-only rows.

    One pass for the totals and one over the exploded tokens, both with partial aggregation.
    """
    keys = ["site", "parameter"]
    d = df.select(*keys, F.to_date(time).alias("_d"), tokens.parse(flag).alias("_f"))
    d = d.withColumn("_real", ~tokens.equals_any_set("_f", MISSING_ONLY))
    none, real = F.size("_f") == 0, F.col("_real")

    def pair(cond: Column, name: str) -> list[Column]:
        return [F.count(F.when(cond, 1)).alias(f"{name}_data"), F.count_distinct(F.when(cond, F.col("_d"))).alias(f"{name}_date")]

    totals = d.groupBy(*keys).agg(*pair(F.lit(True), "tot"), *pair(none, "no_flag"), *pair(real, "tot_nona"), *pair(none & real, "no_flag_nona"))
    wanted = F.array(*[F.lit(f) for f in flags])
    hits = d.withColumn("flag", F.explode(F.array_intersect("_f", wanted)))
    per_flag = hits.groupBy(*keys, "flag").agg(*pair(F.lit(True), "flag"), *pair(F.col("_real"), "flag_nona"))
    names = [f"flag{s}" for s in ("_data", "_date", "_nona_data", "_nona_date")]
    out = totals.withColumn("flag", F.explode(wanted)).join(per_flag, [*keys, "flag"], "left").fillna(0, names)
    pct = {}
    for kind in ("data", "date"):
        pct[f"no_flag_{kind}_pct"] = share(f"no_flag_{kind}", f"tot_{kind}")
        pct[f"flag_{kind}_pct"] = share(f"flag_{kind}", f"tot_{kind}")
        pct[f"flag_nona_{kind}_pct"] = share(f"flag_nona_{kind}", f"tot_nona_{kind}")
        pct[f"no_flag_nona_{kind}_pct"] = share(f"no_flag_nona_{kind}", f"tot_nona_{kind}")
    return out.withColumns(pct)


# Class name -> text looked for in the flag.
FLAG_CLASSES = {
    "spec": "sensor specification range",
    "repeated": "repeated value",
    "slope_violation": "slope",
    "sensor_malfunction": "sensor malfunction",
    "outside_range": "outside of seasonal range",
    "outside_sd": "outside sd range",
    "suspect": "suspect data",
}
NOT_COLLECTING = "sonde not employed|site visit|sv window|missing data"


def yearly_shares(df: DataFrame, time: str = "dt_round", flag: str = "flag", classes: dict[str, str] | None = None) -> DataFrame:
    """Share of each flag class per site, parameter and year among collecting rows."""
    classes = classes or FLAG_CLASSES
    f = F.coalesce(F.lower(flag), F.lit(""))
    d = df.filter(~f.rlike(NOT_COLLECTING))
    c = F.coalesce(F.col(flag), F.lit(""))
    ids = ["site", "parameter", "year", "total"]
    agg = d.groupBy("site", "parameter", F.year(time).cast("long").alias("year")).agg(
        F.count(F.lit(1)).alias("total"), *[F.count(F.when(c.contains(text), 1)).alias(n) for n, text in classes.items()]
    )
    return agg.unpivot(ids, list(classes), "name", "value").withColumn("percentage", F.col("value") / F.col("total") * 100)


def parameter_year_mean(shares: DataFrame) -> DataFrame:
    return shares.groupBy("parameter", "year").agg(F.avg("percentage").alias("mean"))


def flag_combinations(df: DataFrame, flag: str = "flag") -> DataFrame:
    return df.groupBy(flag).agg(F.count(F.lit(1)).alias("n"))


DOWN_TEXTS = "sonde unsubmerged|outside of sensor specification range|sensor malfunction|sonde burial"  # fixed value


# Parameters that the report of down days leaves out.
UNCOUNTED = ("Depth", "FDOM Fluorescence", "Chl-a Fluorescence")


def counted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("parameter").isNull() | ~F.col("parameter").isin(*UNCOUNTED))


def bad_days(df: DataFrame, time: str = "dt_round", flag: str = "flag", status: str = "verification_status", min_rows: int = 64, turbidity: float = 40.0) -> DataFrame:
    """Distinct (site, date) with many bad rows of a parameter or much missing temperature."""
    d = counted(df).withColumn("date", F.to_date(time))
    f, omit = F.col(flag), F.col(status) == "OMIT"
    bad = f.rlike(DOWN_TEXTS) | ((F.col("parameter") == "Turbidity") & f.contains("drift") & (F.col("mean") >= turbidity)) | omit
    bad = f.isNotNull() & F.coalesce(bad, F.lit(False)) & F.col("mean").isNotNull()
    gone = (F.col("parameter") == "Temperature") & F.col("mean").isNull()
    days = d.groupBy("site", "parameter", "date").agg(F.count(F.when(bad, 1)).alias("_bad"), F.count(F.when(gone, 1)).alias("_gone"))
    return days.filter((F.col("_bad") >= min_rows) | (F.col("_gone") >= min_rows)).select("site", "date").distinct()


def down_days(df: DataFrame, time: str = "dt_round", **kwargs) -> DataFrame:
    bad = bad_days(df, time, **kwargs).groupBy("site").agg(F.count(F.lit(1)).alias("bad_days"))
    total = counted(df).groupBy("site").agg(F.count_distinct(F.to_date(time)).alias("days"))
    out = total.join(bad, "site", "left").fillna(0, ["bad_days"])
    return out.withColumn("perc_days", F.col("bad_days") / F.col("days") * 100)


def compare_years(this: DataFrame, other: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    o = other.select(*on, *[F.col(v).alias(f"{v}_previous") for v in values])
    out = this.join(o, on)
    return out.withColumns({f"{v}_change": F.col(v) - F.col(f"{v}_previous") for v in values})


def date_grid(sites: DataFrame, first: str, last: str) -> DataFrame:
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))
    return sites.select("site", F.explode(days).alias("date"))


def flag_accuracy(df: DataFrame, auto: str = "flag", user: str = "user_flag") -> DataFrame:
    """Agreement of automatic and user flags per site and parameter and for the network."""
    agree = (F.col(auto).isNull() == F.col(user).isNull()).cast("double")
    d = df.select("site", "parameter", agree.alias("_a"))
    sets = d.groupingSets([["site", "parameter"], ["parameter"]], "site", "parameter").agg(F.avg("_a").alias("_m"), F.grouping("site").alias("_g"))
    return sets.select(F.when(F.col("_g") == 1, "Network Total").otherwise(F.col("site")).alias("site"), "parameter", (F.col("_m") * 100).alias("accuracy"))


QUARTILES = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


def summary_statistics(df: DataFrame, keys: list[str], value: str = "mean") -> DataFrame:
    base = df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    return base.join(exact_quantiles(df, keys, value, QUARTILES), keys, "left")


def seasonal_statistics(df: DataFrame, keys: list[str], time: str, value: str = "mean", months=None) -> DataFrame:
    d = df.withColumn("season", tm.season(time, months or tm.REPORT_SEASON_MONTHS))
    k = [*keys, "season"]
    base = d.groupBy(*k).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    return base.join(exact_quantiles(d, k, value, {"p01": 0.01, "p99": 0.99}), k, "left")


# Bin width by parameter; others use 1.
BIN_WIDTHS = {"Specific Conductivity": 10.0, "Actual Conductivity": 10.0, "Turbidity": 10.0, "ORP": 0.05, "pH": 0.05, "Depth": 0.05}


def histogram(df: DataFrame, keys: list[str], value: str = "mean", widths: dict[str, float] | None = None) -> DataFrame:
    width = F.lit(1.0)
    for p, w in (widths or BIN_WIDTHS).items():
        width = F.when(F.col("parameter") == p, w).otherwise(width)
    d = df.filter(F.col(value).isNotNull()).withColumn("bin", F.floor(F.col(value) / width) * width)
    return d.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))


def plausible(df: DataFrame, verified: bool) -> DataFrame:
    """Rows fit for a report with capped turbidity and depth in feet."""
    p, v = F.col("parameter"), F.col("mean")
    if verified:
        s = F.col("final_status")
        drifting = F.coalesce(F.col("user_flag").contains("drift"), F.lit(False))
        keep = (s.isNull() | (s == "PASS") | ((s == "FLAGGED") & ~drifting)) & (v != 0)
        low = F.when((p == "Turbidity") & (v <= 1), 1.0)
    else:
        flag = F.coalesce(F.col("auto_flag"), F.lit(""))
        bad_flag = flag.rlike("site visit|sv window|sonde unsubmerged|sonde not employed|sensor malfunction")
        outside = (
            ((p == "Specific Conductivity") & (v > 3000))
            | ((p == "pH") & ((v < 4.5) | (v > 11)))
            | ((p == "Temperature") & ((v < 0) | (v > 30)))
            | ((p == "Depth") & (v < 0))
            | ((p == "DO") & (v < 2))
        )
        keep = F.col("mal_flag").isNull() & ~bad_flag & ~outside & (v != 0)
        low = F.lit(None).cast("double")
    capped = F.when((p == "Turbidity") & (v > 1000), 1000.0).otherwise(F.coalesce(low, F.when(p == "Depth", v / 0.3048).otherwise(v)))
    return df.filter(F.coalesce(keep, F.lit(False))).withColumn("mean", capped)


def climatology(df: DataFrame, time: str = "dt_round", value: str = "mean", keys=("site", "parameter")) -> DataFrame:
    d = df.withColumn("doy", F.dayofyear(time).cast("long"))
    return exact_quantiles(d, [*keys, "doy"], value, {"median": 0.5, "min": 0.0, "max": 1.0})


def event_slice(readings: DataFrame, spec: Series, ts: str, value: str, start: str, end: str) -> DataFrame:
    """Median per slot of a coarser step, padded to the grid and clipped to the event."""
    d = readings.select(*spec.keys, tm.round_slot(ts, spec.step).alias(spec.time), value)
    m = exact_quantiles(d, [*spec.keys, spec.time], value, {"median": 0.5})
    return grid.pad_grid(m, spec).filter(F.col(spec.time).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def weekly_means(df: DataFrame, keys: list[str], time: str, value: str = "mean") -> DataFrame:
    return df.groupBy(*keys, F.year(time).cast("long").alias("year"), tm.week_number(time).alias("week")).agg(F.avg(value).alias(value))


def hour_profile(df: DataFrame, keys: list[str], time: str, value: str = "mean") -> DataFrame:
    d = df.withColumns({"hour": F.hour(time).cast("long"), "season": tm.season(time)})
    k = [*keys, "season", "hour"]
    base = d.groupBy(*k).agg(F.avg(value).alias("hour_mean"))
    return base.join(exact_quantiles(d, k, value, {"hour_median": 0.5}), k, "left")


# --- precipitation and flow --------------------------------------------------------------------


def watershed_precip(df: DataFrame, time: str, value: str = "p_cm", cap: float = 20.0) -> DataFrame:
    d = df.filter((F.col(value) > 0) & (F.col(value) < cap))
    day = tm.round_slot(time, 86400).alias("day")
    out = d.groupBy("watershed", day).agg(F.sum(value).alias("total_precip"), F.count_distinct("station").alias("num_sites"))
    return out.withColumn("avg_precip", F.col("total_precip") / F.col("num_sites"))


def daily_precip(df: DataFrame, time: str, value: str = "p_cm", cap: float = 20.0) -> DataFrame:
    d = df.filter((F.col(value) >= 0) & (F.col(value) < cap)).groupBy("station", F.to_date(time).alias("date")).agg(F.sum(value).alias("daily_precip"))
    return d.withColumn("is_wet", F.col("daily_precip") > 0)


def storms(df: DataFrame, time: str, value: str = "p_cm", dry_hours: float = 6.0, cap: float = 20.0, chunk: int = 4096, sessions: bool = False) -> DataFrame:
    """Hourly grid with storm ids and the running total of each storm.

    The id grows on every hour more than ``dry_hours`` after the last rain; with ``sessions`` it
    grows once per storm.
    """
    spec = Series(("station",), "dt_round", 3600, chunk)
    keys, order = ["station"], ["dt_round"]
    where = time_chunk("dt_round", spec.chunk_seconds)
    d = df.filter(F.col(value) < cap).groupBy("station", tm.round_slot(time, 3600).alias("dt_round")).agg(F.sum(value).alias("value"))
    # every carry reads its input twice, so each gets a table
    d = materialise(grid.pad_grid(d, spec).fillna(0.0, ["value"]), "rain-hours")
    rains = F.col("value") > 0
    d = carry(d, keys, where, order, fills={"_prev_rain": F.when(rains, F.col("dt_round"))}, exclusive=True)
    d = d.withColumn("last_rain_time", F.when(rains, F.col("dt_round")).otherwise(F.col("_prev_rain")))
    dry = tm.seconds_between("dt_round", "last_rain_time") > dry_hours * 3600
    if sessions:
        dry = rains & (tm.seconds_between("dt_round", "_prev_rain") > dry_hours * 3600)
    d = materialise(d.withColumn("_n", F.coalesce(dry, F.lit(False)).cast("long")).drop("_prev_rain"), "rain-gaps")
    d = materialise(carry(d, keys, where, order, sums={"storm_id": F.col("_n")}).drop("_n"), "storm-hours")
    return carry(d, ["station", "storm_id"], where, order, sums={"cumulative_storm_precip": F.col("value")})


def peak_hours(df: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """Hours with the largest total; ties stay."""
    h = df.groupBy(*keys, F.hour(time).cast("long").alias("hour")).agg(F.sum(value).alias("total"))
    top = h.groupBy(*keys).agg(F.max("total").alias("_top"))
    return h.join(top, keys).filter(F.col("total") == F.col("_top")).drop("_top")


MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def season_months(standards: DataFrame, season: str = "season") -> DataFrame:
    """'november-march' to one row per month, across the end of the year if needed."""
    names = F.array(*[F.lit(m) for m in MONTHS])
    parts = F.split(F.lower(F.trim(F.col(season))), r"\s*-\s*")
    a, b = F.array_position(names, parts[0]), F.array_position(names, F.element_at(parts, -1))
    n = F.pmod(b - a, F.lit(12))
    months = F.transform(F.sequence(F.lit(0), n.cast("int")), lambda i: (F.pmod(a.cast("int") - 1 + i, F.lit(12)) + 1).cast("long"))
    return standards.withColumn("month", F.explode(months))


def standards_check(df: DataFrame, standards: DataFrame, time: str, value: str = "mean") -> DataFrame:
    """Exceedances per site and month against the standard of the season; (low, high) may be NULL."""
    s = season_months(standards).select("site", "month", "low", "high")
    d = df.withColumn("month", F.month(time).cast("long")).join(s, ["site", "month"])
    over = (F.col(value) < F.col("low")) | (F.col(value) > F.col("high"))
    return d.groupBy("site", "month").agg(F.count(value).alias("n"), F.count(F.when(over, 1)).alias("n_exceed"))


def monthly_box(df: DataFrame, time: str, value: str = "mean") -> DataFrame:
    d = df.withColumn("month", F.month(time).cast("long"))
    return exact_quantiles(d, ["site", "parameter", "month"], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})


def water_year_compare(df: DataFrame, keys: list[str], time: str, value: str, current: int) -> DataFrame:
    """Median, least and largest of past water years per calendar day beside the current year."""
    d = df.withColumns({"water_year": tm.water_year(time), "month_day": F.date_format(time, "MM-dd")})
    k = [*keys, "month_day"]
    past = exact_quantiles(d.filter(F.col("water_year") != current), k, value, {"past_median": 0.5, "past_min": 0.0, "past_max": 1.0})
    now = d.filter(F.col("water_year") == current).groupBy(*k).agg(F.avg(value).alias("current_mean"))
    return past.join(now, k, "left")


# --- models --------------------------------------------------------------------------------------


def linear_models(df: DataFrame, keys: list[str], y: str, x: str, pvalue: bool = True) -> DataFrame:
    from sensorqc.functions.numeric import t_pvalue

    a = df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_r2(y, x).alias("r_squared"), F.regr_count(y, x).alias("n"))
    if not pvalue:
        return a
    r2 = F.col("r_squared")
    t = F.when((F.col("n") > 2) & (r2 < 1), F.sqrt(r2 * (F.col("n") - 2) / (1 - r2)))
    return a.withColumn("p_value", t_pvalue(t, F.col("n") - 2))


def pair_regression(df: DataFrame, pairs: DataFrame, time: str, value: str, keys=("parameter",), pvalue: bool = True) -> DataFrame:
    """OLS of one site on another at equal times with the studentised Breusch-Pagan statistic.

    ``pairs`` has (site1, site2). Two aggregate passes: coefficients, then squared residuals.
    """
    from sensorqc.functions.numeric import chi2_one_pvalue

    k = [*keys, time]
    one = df.select(F.col("site").alias("site1"), *k, F.col(value).alias("_y")).join(pairs, "site1")
    two = df.select(F.col("site").alias("site2"), *k, F.col(value).alias("_x"))
    both = one.join(two, ["site2", *k]).filter("_x is not null and _y is not null")
    g = ["site1", "site2", *keys]
    fit = both.groupBy(*g).agg(
        F.regr_slope("_y", "_x").alias("slope"), F.regr_intercept("_y", "_x").alias("intercept"), F.regr_r2("_y", "_x").alias("r_squared"), F.count(F.lit(1)).alias("n")
    )
    res = both.join(fit, g).withColumn("_e2", F.pow(F.col("_y") - F.col("intercept") - F.col("slope") * F.col("_x"), F.lit(2)))
    aux = res.groupBy(*g).agg((F.count(F.lit(1)) * F.regr_r2("_e2", "_x")).alias("bp_statistic"))
    out = fit.join(aux, g)
    return out.withColumn("bp_p_value", chi2_one_pvalue(F.col("bp_statistic"))) if pvalue else out


# --- alarms --------------------------------------------------------------------------------------


def classify_alarms(df: DataFrame, limits: DataFrame, value: str = "mean") -> DataFrame:
    d = df.join(limits.select("site", "warning", "alarm"), "site", "left")
    v = F.col(value)
    return d.withColumn("trigger", F.when(v >= F.col("alarm"), "Alarm").when(v >= F.col("warning"), "Warning").otherwise("None"))


def alarm_counts(df: DataFrame, column: str = "trigger", values=("Alarm", "Warning", "None")) -> DataFrame:
    aggs = [F.count(F.when(F.col(column) == v, 1)).alias(v) for v in values]
    return df.groupBy("site").agg(*aggs, F.count(F.lit(1)).alias("total"))


def suppress_alarms(df: DataFrame, keys: list[str], order: list[str], chunk: Column, trigger: str = "trigger") -> DataFrame:
    """Only the first Alarm of a run sends a message."""
    d = carry(df, keys, chunk, order, fills={"_previous": F.col(trigger)}, exclusive=True)
    again = (F.col(trigger) == "Alarm") & (F.col("_previous") == "Alarm")
    return d.withColumn("trigger_reduced", F.when(again, "Alarm_no_message").otherwise(F.col(trigger))).drop("_previous")


# --- charges, visits, availability ----------------------------------------------------------------


def charges(df: DataFrame, rates: DataFrame, excluded: list[str], by=("category", "staff"), text: str = "note") -> DataFrame:
    """Hours times rate with the distinct notes of each group; notes are deduplicated before they meet."""
    keys = list(by)
    d = df.join(rates, "staff")
    cost = d.groupBy(*keys).agg(F.sum("hours").alias("hours"), F.sum(F.col("hours") * F.col("rate")).alias("cost"))
    notes = df.select(*keys, text).distinct().groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(text)), "; ").alias("notes"))
    return cost.join(notes, keys, "left").withColumn("include", ~F.col(keys[0]).isin(*excluded))


def charge_totals(charged: DataFrame) -> DataFrame:
    t = charged.groupBy("include").agg(F.sum("cost").alias("total"))
    return t.select(F.when(F.col("include"), "Billed").otherwise("Contributed").alias("label"), "total")


def visit_summary(sites: DataFrame, visits: DataFrame, calibration: Column, time: str = "start_dt") -> DataFrame:
    """Visits and calibration dates of every listed site, with defaults for unvisited ones."""
    n = visits.groupBy("site").agg(F.count(F.lit(1)).alias("n_visits"))
    dates = visits.filter(calibration).select("site", F.date_format(time, "yyyy-MM-dd").alias("_d")).distinct()
    dates = dates.groupBy("site").agg(F.array_join(F.array_sort(F.collect_list("_d")), ", ").alias("calibrations"))
    out = sites.select("site").distinct().join(n, "site", "left").join(dates, "site", "left")
    return out.fillna(0, ["n_visits"]).fillna("None", ["calibrations"])


def availability(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("first"), F.max(time).alias("last"))


def years_per_site(df: DataFrame, keys: list[str], time: str, at_least: int = 1) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(F.year(time)).alias("n_years")).filter(F.col("n_years") >= at_least)


def flagged_share(df: DataFrame, listed: list[str], flag: str = "flag") -> DataFrame:
    hit = tokens.has_any(tokens.parse(flag), listed)
    label = F.when(hit, "flag").otherwise("no flag")
    c = df.groupBy("site", "parameter", label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = c.groupBy("site", "parameter").agg(F.sum("n").alias("_t"))
    return c.join(total, ["site", "parameter"]).withColumn("share", F.col("n") / F.col("_t")).drop("_t")

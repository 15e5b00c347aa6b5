"""Small hand-made series for the rules that are easy to get wrong."""

import math
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from helpers import T0, at, column, series
from sensorqc import Series
from sensorqc.functions import numeric, time as tm, tokens
from sensorqc.operators import calibration as cal, drift as dr, flags as fl, grid, normalize as nz, publication as pb, reporting as rp, verification as vf, visits as vz
from sensorqc.plans.chunks import over_slots
from sensorqc.sources import readers

S = Series(chunk=7)


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_nearest_and_floor_slots(spark):
    ts = F.lit("2024-03-01 00:07:30").cast("timestamp")
    r = one(spark, tm.round_slot(ts).alias("n"), tm.floor_slot(ts).alias("f"), tm.round_slot(F.lit("2024-03-01 00:07:29").cast("timestamp")).alias("b"))
    assert [r[c].minute for c in "nfb"] == [15, 0, 0]


def test_two_zones(spark):
    ts = F.lit("2024-07-01 12:00:00").cast("timestamp")
    r = one(spark, tm.to_zone(ts, "MST").alias("m"), tm.to_zone(ts, "America/Denver").alias("d"))
    assert (r["m"].hour, r["d"].hour) == (5, 6)


def test_week_is_not_iso(spark):
    r = one(spark, tm.week_number(F.lit("2024-01-08").cast("timestamp")).alias("a"), tm.week_number(F.lit("2023-01-01").cast("timestamp")).alias("b"))
    assert (r["a"], r["b"]) == (2, 1)


def test_gaps_up_to_four_are_filled(spark):
    v = [None, 0.0, None, 2.0, None, None, None, None, 7.0, None, None, None, None, None, 13.0, None]
    out = column(grid.interpolate_gaps(series(spark, v), S), "mean")
    assert out[2] == 1.0 and out[4:8] == pytest.approx([3, 4, 5, 6])
    assert out[9:14] == [None] * 5 and out[0] is None and out[15] is None


def test_low_pass_spreads_missing_values(spark):
    v = [float(i) for i in range(15)]
    v[7] = None
    d = series(spark, v, parameter="Turbidity")
    one_pass, three = (column(grid.low_pass(d, S, passes=p), "smoothed") for p in (1, 3))
    assert [i for i, x in enumerate(one_pass) if x is not None] == [2, 3, 4, 10, 11, 12]
    assert all(x is None for x in three)


def test_flag_tokens(spark):
    r = one(
        spark,
        tokens.render(tokens.remove(tokens.parse(F.lit("drift;\nsite visit;\ndrift;")), "drift")).alias("a"),
        tokens.render(tokens.add(tokens.empty(), F.lit(None).cast("boolean"), "x")).alias("b"),
        tokens.equals_any_set(tokens.parse(F.lit("missing data;\nsonde not employed")), fl.QUIET_SETS).alias("c"),
    )
    assert (r["a"], r["b"], r["c"]) == ("site visit", None, True)


@pytest.mark.parametrize("flagged,expected", [(48, False), (49, True)])
def test_half_of_97_slots(spark, flagged, expected):
    values = [(("x",) if i < flagged else (None,)) for i in range(97)]
    d = series(spark, [1.0] * 97, extra=values).withColumn("flags", tokens.parse("flag"))
    out = fl.large_anomalies(d, Series(chunk=20))
    hits = [i for i, f in enumerate(column(out, "flags")) if fl.ANOMALY_24H in f]
    assert hits == ([48] if expected else [])
    if expected:
        marked = [i for i, f in enumerate(column(out, "flags")) if fl.ANOMALY_WINDOW in f]
        assert marked == list(range(0, 48))


def test_sv_window_is_one_token(spark):
    d = series(spark, [1.0] * 8).withColumns({"sonde_employed": F.lit(0), "last_site_visit": F.lit(at(2)).cast("timestamp"), "flags": tokens.empty()})
    out = [tuple(f) for f in column(over_slots(d, S, 3, 3, *fl.field_steps()), "flags")]
    assert out == [(), (), ("site visit",), ("sv window",), ("sv window",), ("sv window",), (), ()]


def test_visit_state_before_and_after_a_visit(spark):
    v = spark.createDataFrame([("a", at(3), at(3), "DO", None)], "site string, start_dt timestamp, dt_round timestamp, sensor_pulled string, sensor_deployed string")
    out = vz.visit_state(series(spark, [1.0] * 8), v, S)
    assert column(out, "sonde_employed") == [1, 1, 1, 1, 1, 1, 1, 1]
    assert column(out, "in_sv_window") == [False] * 4 + [True] * 3 + [False]
    groups = column(out, "visit_group")
    assert len(set(groups[:3])) == 1 and groups[6] == groups[7] and len(set(groups)) == 5


def test_correction_formulas(spark):
    y, wt = F.lit(10.0), F.lit(0.5)
    r = one(
        spark,
        dr.multiplicative(y, wt, F.lit(4.0), F.lit(4.0)).alias("same"),
        dr.multiplicative(y, wt, F.lit(0.0), F.lit(4.0)).alias("zero"),
        dr.additive(y, F.lit(0.0), F.lit(1.0), F.lit(9.0)).alias("head"),
        dr.fitted(y, wt, F.lit(2.0), F.lit(4.0), F.lit(1.0), F.lit(2), F.lit(-1.0)).alias("few"),
        dr.weight_curve("exponential", wt, F.lit(0.0)).alias("flat"),
    )
    assert (r["same"], r["zero"], r["head"], r["few"], r["flat"]) == (10.0, None, 10.0, -1.0, 0.5)


RANGE = "seq int, parameter string, gap_minutes double, from_a double, to_a double, from_b double, to_b double, from_c double, to_c double"


@pytest.mark.parametrize(
    "row,source",
    [
        (("DO", 15.0, 1.0, 5.0, None, None, None, None), "A"),
        (("DO", 15.0, None, None, 1.0, 5.0, None, None), "B"),
        (("DO", 500.0, 1.0, 50.0, None, None, 1.0, 5.0), "C"),
        (("DO", 15.0, 5.0, 1.0, None, None, None, None), "A_fallback"),
        (("Turbidity", 15.0, 5.0, 1.0, 9.0, 1.0, None, None), "B"),
        (("DO", 15.0, 1.0, 5.0, 1.0, 5.0, 1.0, 5.0), "A"),
        (("DO", 15.0, 1.0, None, 3.0, 2.0, None, None), "mixed_fallback"),
    ],
)
def test_range_selection(spark, row, source):
    d = spark.createDataFrame([(1, *row)], RANGE)
    assert dr.select_range(d).first()["pre_post_source"] == source


@pytest.mark.parametrize("k", [-40.0, -25.0, -1.5, 0.0, 0.3, 2.5, 25.0, 60.0])
def test_rate_fit_recovers_the_rate(spark, k):
    d = spark.range(1, 200).withColumns({"site": F.lit("a"), "parameter": F.lit("p"), "seq": F.lit(1), "wt": F.col("id") / 200, "pre_val": F.lit(10.0), "post_val": F.lit(4.0)})
    d = d.withColumn("_y", 4.0 + 6.0 * dr.weight_curve("exponential", F.col("wt"), F.lit(k)))
    row = dr.fit_rate(d, ["site", "parameter"]).first()
    assert row["k"] == pytest.approx(k, rel=1e-4, abs=1e-4) and row["reason"] == "fitted"


def test_rates_that_cannot_be_fitted(spark):
    rows = [(1, i / 9, 4.0, 10.0, 4.0) for i in range(9)] + [(1, 1.0, 10.0, 10.0, 4.0)]  # a step at the end
    rows += [(2, i / 9, 10.0 if i else 4.0, 10.0, 4.0) for i in range(10)]  # a step at the start
    rows += [(3, i / 9, float(i), 5.0, 5.0) for i in range(10)] + [(4, i / 9, float(i), None, 5.0) for i in range(10)]
    rows += [(5, 0.0, 1.0, 10.0, 4.0), (5, 0.5, None, 10.0, 4.0), (5, 1.0, 2.0, 10.0, 4.0)]
    d = spark.createDataFrame(rows, "seq long, wt double, _y double, pre_val double, post_val double").withColumns({"site": F.lit("a"), "parameter": F.lit("p")})
    got = {r.seq: (r.k, r.reason) for r in dr.fit_rate(d, ["site", "parameter"]).collect()}
    assert got == {1: (1.0, "diverged"), 2: (1.0, "diverged"), 3: (1.0, "no drift"), 4: (1.0, "no drift"), 5: (1.0, "too few rows")}


def test_slopes_do_not_depend_on_partitions(spark):
    import random

    r = random.Random(4)
    rows = [("a", "p", w, i / 300, r.uniform(-50, 90) if r.random() < 0.9 else None) for w in range(3) for i in range(301)]
    d = spark.createDataFrame(rows, "site string, parameter string, seq int, wt double, _y double")
    seen = {tuple((x.seq, x.b_slope, x.n_points) for x in dr.window_slopes(d.repartition(n, "wt"), ["site", "parameter"]).orderBy("seq").collect()) for n in (1, 7, 64)}
    assert len(seen) == 1
    plain = {x.seq: x.s for x in d.groupBy("seq").agg(F.regr_slope("_y", "wt").alias("s")).collect()}
    assert all(slope == pytest.approx(plain[seq], rel=1e-9) for seq, slope, _ in seen.pop())


def test_log_curve_inverts_the_exponential_one(spark):
    for k in (-800.0, -3.0, 1e-3, 4.0, 900.0):
        x = one(spark, *[dr.weight_curve("log", dr.weight_curve("exponential", F.lit(w), F.lit(k)), F.lit(k)) for w in (0.0, 0.3, 0.5, 1.0)])
        ends = one(spark, *[dr.weight_curve(c, F.lit(w), F.lit(k)) for c in ("log", "exponential") for w in (0.0, 1.0)])
        assert list(ends) == pytest.approx([0.0, 1.0, 0.0, 1.0])
        if abs(k) < 30:
            assert list(x) == pytest.approx([0.0, 0.3, 0.5, 1.0])


def test_isolated_predictions_with_an_even_window(spark):
    d = series(spark, [1.0] * 12).withColumn("drift_pred", F.when(F.col("dt_round") == F.lit(at(5)), 1).otherwise(0).cast("long"))
    out = dr.clean_predictions(d, S)
    density = column(out, "drift_density")
    assert density[:3] == [None] * 3 and density[8:] == [None] * 4 and density[3] == 0.125
    assert column(out, "drift_pred_final")[5] == 0


@pytest.mark.parametrize("dry,storms", [(6, 1), (7, 1), (8, 2)])
def test_storm_sessions(spark, dry, storms):
    rows = [("p", T0, 1.0), ("p", T0 + timedelta(hours=dry), 2.0)]
    d = spark.createDataFrame(rows, "station string, t timestamp, p_cm double")
    out = rp.storms(d, "t", chunk=3)
    ids = column(out, "storm_id")
    assert ids[-1] == max(0, dry - 7) and len(ids) == dry + 1
    assert column(rp.storms(d, "t", chunk=3, sessions=True), "storm_id")[-1] == (1 if dry > 6 else 0)


def test_swap_chain(spark):
    cols = "site string, swap_time timestamp, removed string, deployed string"
    good = spark.createDataFrame([("a", at(0), None, "s1"), ("a", at(9), "s1", "s2")], cols)
    bad = spark.createDataFrame([("a", at(0), None, "s1"), ("a", at(9), "s9", "s2")], cols)
    assert column(vz.swap_audit(good, ["site"], chunk_seconds=900), "mismatch", "swap_time") == [False, False]
    assert column(vz.swap_audit(bad, ["site"], chunk_seconds=900), "mismatch", "swap_time") == [False, True]


DECISIONS = {
    "aa": ["PASS", "PASS", "PASS", "PASS"],
    "ano": ["PASS", "PASS", "OMIT", "OMIT"],
    "kf": ["PASS", "FLAGGED", "OMIT", "OMIT"],
    "of": ["PASS", "OMIT", "OMIT", "OMIT"],
    "oa": ["OMIT", "OMIT", "OMIT", "OMIT"],
}


@pytest.mark.parametrize("code", DECISIONS)
def test_weekly_decisions(spark, code):
    rows = [("a", "DO", 2024, 9, i, float(i), f, o) for i, (f, o) in enumerate([(None, False), ("x", False), (None, True), ("x", True)])]
    d = spark.createDataFrame(rows, "site string, parameter string, year int, week int, dt_round int, mean double, user_flag string, brush_omit boolean")
    dec = spark.createDataFrame([("a", "DO", 2024, 9, code, "me")], "site string, parameter string, year int, week int, decision string, user string")
    out = vf.weekly_decision(d, dec)
    assert column(out, "final_status") == DECISIONS[code]
    assert [v is not None for v in column(out, "mean_verified")] == [s == "PASS" for s in DECISIONS[code]]


@pytest.mark.parametrize(
    "values,label",
    [
        ((1.0, 1.0, None, None), "manual data exclusion"),
        ((1.0, 1.0, 1.0, 2.0), "drift correction"),
        ((1.0, 2.0, 2.0, 2.0), "calibration correction"),
        ((1.0, 2.0, 2.0, 3.0), "calibration correction;drift correction"),
        ((1.0, 1.0, 1.0, 1.0), None),
        ((None, 1.0, 1.0, 2.0), None),
    ],
)
def test_modifications(spark, values, label):
    d = spark.createDataFrame([values], ", ".join(f"{c} double" for c in pb.VALUES))
    assert d.select(pb.modifications().alias("m")).first()["m"] == label


def test_report_with_a_missing_section(spark):
    html = "<div>RDO Slope 1.05 Offset 0.2 mg/L</div><div>Conductivity Cell Constant 1.01 Reference Temperature 25</div>"
    r = readers.calibration_reports(spark.createDataFrame([(1, html)], "id int, html string"), "html").first()
    assert (r["rdo_slope"], r["rdo_offset"], r["cond_cell_constant"], r["ntu_slope"]) == (1.05, 0.2, 1.01, None)
    assert r["factory_defaults"] == "Turbidity pH ORP Conductivity"  # no reading after the calibration


def test_report_with_all_fields(spark):
    ph = "<div>pH/ORP Offset 1 Slope -57 mV/pH Offset 10 mV Slope and Offset 2 Slope -57 mV/pH Offset 11.5 mV ORP ORP Post Measurement pH {} 7.000 pH mV -12.5 mV Cal</div>"
    html = (
        "<div>RDO Slope 1.05 Offset 0.2 mg/L Concentration 8.1 mg/L Pre Measurement 99.5 %Sat Post Measurement Temperature 21.5 °C Pressure 840 mbar</div>"
        "<div>Conductivity TDS Conversion Factor (ppm) 0.65 Cell Constant 1.01 Reference Temperature 25 Pre Measurement Actual 1400 Specific Conductivity 1410 µS/cm"
        " Post Measurement Actual 1405 Specific Conductivity 1413 µS/cm</div>"
    )
    rows = [(i, html + ph.format(n)) for i, n in enumerate(("7", "6"))]
    want = {"rdo_100": 99.5, "rdo_conc": 8.1, "rdo_temp": 21.5, "rdo_pressure": 840.0, "ph_offset_post": 11.5, "ph_7": -12.5, "tds_conversion_ppm": 0.65, "cond_pre": 1410.0, "cond_post": 1413.0}
    for r in readers.calibration_reports(spark.createDataFrame(rows, "id int, html string"), "html").collect():
        assert {k: r[k] for k in want} == want


def test_calibration_transforms(spark):
    r = one(
        spark,
        cal.linear_transform(F.lit(2.0), F.lit(1.0), F.lit(0.0), F.lit(3.0), F.lit(1.0), F.lit(0.5)).alias("lin"),
        cal.ph_transform(F.lit(-58.0), F.lit(-58.0), F.lit(0.0), F.lit(-58.0), F.lit(0.0), F.lit(0.3)).alias("ph"),
        cal.usable(F.lit(float("inf"))).alias("bad"),
    )
    assert (r["lin"], r["ph"], r["bad"]) == (4.5, 1.0, False)


def test_student_t():
    assert numeric.t_inverse(0.975, 10) == pytest.approx(2.228138852)
    assert numeric.t_two_sided(2.0, 5) == pytest.approx(0.101939479)


def test_seasons_over_the_new_year(spark):
    d = spark.createDataFrame([("a", "November-March")], "site string, season string")
    assert sorted(r["month"] for r in rp.season_months(d).collect()) == [1, 2, 3, 11, 12]


def test_anonymised_crew(spark):
    r = one(spark, nz.initials(F.lit("Ann Bo, Cy Other (please specify)")).alias("c"))
    assert r["c"] == "AB, CO"


def test_upload_needs_its_columns(spark):
    with pytest.raises(ValueError, match="mean"):
        readers.normalise_upload(series(spark, [1.0]).drop("mean"))


def test_telemetry_slots_sentinels_and_go_live(spark):
    lines = [
        ("a", "04/02/2024 10:07:30 1.0 x x"),  # nearest slot is 10:15
        ("a", "04/02/2024 10:22:29 3.0 x x"),  # and here too
        ("a", "04/02/2024 10:29:00 -9999 x x"),  # mean of sentinel and value stays
        ("a", "04/02/2024 10:31:00 1.0 x x"),
        ("a", "04/02/2024 10:45:00 638.30 x x"),
        ("a", "04/02/2024 10:00:00 5.0 x x"),  # go-live itself is out
        ("a", "2024-04-02 11:00:00 5.0 x x"),
        ("b", "04/02/2024 10:15:00 1.0 x x"),  # no go-live
    ]
    d = spark.createDataFrame([(s, "Depth", t) for s, t in lines], "site string, parameter string, line string")
    live = spark.createDataFrame([("a",)], "site string").withColumn("go_live", F.to_timestamp(F.lit("2024-04-02 10:00:00")))
    out = readers.telemetry_rows(d, live, S).orderBy("dt_round").select(F.date_format("dt_round", "HH:mm").alias("t"), "value").collect()
    assert [tuple(r) for r in out] == [("10:15", 2.0), ("10:30", -4999.0)]


def test_non_removable_flags_match_in_any_case(spark):
    rows = [("Missing Data (late)", 1.0), ("frozen;drift", 2.0), ("drift", 3.0), (None, 4.0)]
    d = spark.createDataFrame(rows, "flag string, mean_verified double").withColumn("verification_status", F.lit("FAIL"))
    out = {r["flag"]: (r["mean_verified"], r["verification_status"]) for r in vf.keep_non_removable(d).collect()}
    assert out == {"Missing Data (late)": (None, "PASS"), "frozen;drift": (None, "PASS"), "drift": (3.0, "FAIL"), None: (4.0, "FAIL")}


def test_down_days_leave_parameters_out(spark):
    rows = [("Depth", 0), ("pH", 96), ("pH", 97)]
    d = spark.createDataFrame([("a", p, at(i), 1.0, "sonde burial", None) for p, i in rows], "site string, parameter string, dt_round timestamp, mean double, flag string, verification_status string")
    assert [tuple(r) for r in rp.down_days(d, min_rows=1).select("days", "bad_days").collect()] == [(1, 1)]


def test_network_check_clears_shared_events(spark):
    rows = [("a", 5), ("b", 11), ("c", 40)]
    d = spark.createDataFrame([(s, "DO", at(i), 1.0) for s, i in rows], "site string, parameter string, dt_round timestamp, mean double")
    d = d.withColumn("flags", F.array(F.lit(fl.SLOPE), F.lit(fl.MISSING)))
    net = spark.createDataFrame([("n", i, s) for i, s in enumerate("abc")], "network string, pos int, site string")
    out = fl.network_check(d, vz.neighbour_pairs(net), S)
    assert column(out, "flags", "site") == [[fl.MISSING], [fl.MISSING], [fl.SLOPE, fl.MISSING]]


def test_fixed_date_of_epoch():
    assert T0 == datetime(2024, 3, 1, tzinfo=timezone.utc)


def test_open_interval_covers_everything_after_its_start(spark):
    from sensorqc.plans.joins import mark_covered

    df = series(spark, [1.0] * 6)
    gaps = spark.createDataFrame([("a", "DO", at(3), None), ("a", "DO", at(0), at(0))], "site string, parameter string, start_dt timestamp, end_dt timestamp")
    out = mark_covered(df, gaps, ["site", "parameter"], "dt_round", "start_dt", "end_dt", 1800)
    assert column(out, "covered") == [True, False, False, True, True, True]


def test_undecided_windows_keep_the_drift_flag(spark):
    from sensorqc import Series
    from sensorqc.operators import drift as dr

    cols = {c: F.lit(0.0) for c in dr.GRID_COLUMNS}
    df = series(spark, [1.0] * 4).withColumns({"mean_analysis": F.lit(1.0), "drift": F.lit(True), "user_flag": F.lit("drift"), "verification_status": F.lit("FLAGGED"), **cols})
    windows = spark.createDataFrame([("a", "DO", 1, at(0), at(0), "None", None), ("a", "DO", 2, at(1), at(1), "log", None), ("a", "DO", 3, at(2), at(2), "unflag", None)], "site string, parameter string, seq int, start_dt timestamp, end_dt timestamp, drift_type string, correction_type string")
    out = dr.stitch(df, windows, Series())
    assert column(out, "drift") == [True, True, False, False]
    assert column(out, "verification_status") == ["FLAGGED", "FLAGGED", "PASS", "PASS"]


def test_chained_step_shifts(spark):
    """The second shift's anchors see the first shift; ends are excluded; a shift without an end stays open."""
    from sensorqc import Series
    from sensorqc.operators import normalize as nz

    df = series(spark, [1.0, 1.0, 3.0, 3.1, 3.0, 7.0, 7.0, 2.0]).withColumnRenamed("mean", "value")
    rows = [("a", "DO", at(0), at(2), at(1), at(2), 1), ("a", "DO", at(4), None, at(1), at(5), 2), ("a", "DO", at(0), at(9), at(0), at(40), 3), ("z", "DO", at(0), None, at(0), at(1), 4)]
    shifts = spark.createDataFrame(rows, "site string, parameter string, start_dt timestamp, end_dt timestamp, anchor1 timestamp, anchor2 timestamp, seq int")
    out = nz.step_shifts(df, shifts, Series())
    # first: |1 - 3| = 2 on rows 0 and 1; second: |(1 + 2) - 7| = 4 from row 4 on; the third has no reading at an anchor
    assert column(out, "value") == [3.0, 3.0, 3.0, 3.1, 7.0, 11.0, 11.0, 6.0]
    assert column(nz.step_shifts(df, shifts.filter("seq = 2"), Series()), "value")[4:] == [9.0, 13.0, 13.0, 8.0]


def test_windows_behind_earlier_ones_are_not_fitted(spark):
    from sensorqc import Series
    from sensorqc.operators import drift as dr

    d = series(spark, [1.0] * 12)
    rows = [("a", "DO", at(0), at(5), 1), ("a", "DO", at(1), at(4), 2), ("a", "DO", at(2), at(8), 3), ("a", "DO", at(6), at(8), 4), ("a", "DO", at(50), at(60), 5)]
    windows = spark.createDataFrame(rows, "site string, parameter string, start_dt timestamp, end_dt timestamp, seq long")
    assert column(dr._first_somewhere(d, windows, Series(chunk=5)), "seq", "seq") == [1, 3]


def test_many_step_shifts_equal_a_plain_fold_and_no_series_is_gathered(spark):
    import random

    from sensorqc import Series
    from sensorqc.operators import normalize as nz

    r = random.Random(5)
    values = [float(r.randrange(100)) for _ in range(300)]
    df = series(spark, values).withColumnRenamed("mean", "value")
    shifts = []
    for seq in range(120):
        a = r.randrange(290)
        shifts.append((a, r.choice([None, a, a + r.randrange(1, 12), a - 3]), a + r.randrange(3), max(0, a - r.randrange(4)), seq))
    shifts.sort(key=lambda x: (x[0] % 7, x[4]))
    done, rows = [], []
    for seq, (a, e, one, two, _) in enumerate(shifts):
        seen = [values[i] + sum(d for b, f, d in done if b <= i and (f is None or i < f)) for i in (one, two)]
        done.append((a, e, abs(seen[0] - seen[1])))
        rows.append(("a", "DO", at(a), None if e is None else at(e), at(one), at(two), seq))
    want = [v + sum(d for b, f, d in done if b <= i and (f is None or i < f)) for i, v in enumerate(values)]
    made = spark.createDataFrame(rows, "site string, parameter string, start_dt timestamp, end_dt timestamp, anchor1 timestamp, anchor2 timestamp, seq int")
    for part in (made, made.filter("end_dt is not null")):
        steps = nz.step_shifts(df, part, Series(), bucket_seconds=3600)
        assert "collect_list" not in steps._jdf.queryExecution().optimizedPlan().toString()
        if part is made:
            assert column(steps, "value") == want
    # 40,000 windows over each other: a fold over the list of earlier ones would take 800 million looks
    n = 40_000
    steps = nz.chained_steps(list(range(n + 1)), list(range(n)), [None] * n, list(range(n)), list(range(1, n + 1)), [3] * n, [1] * n)
    assert steps == [2] * n


def test_prediction_windows_end_at_visits(spark):
    from sensorqc import Series
    from sensorqc.operators import drift as dr

    groups = [0] * 9 + [1] * 9
    df = series(spark, [1.0] * 18, extra=[(None,)] * 18).withColumn("i", F.expr("(unix_seconds(dt_round) - unix_seconds(timestamp'2024-03-01 00:00:00')) / 900"))
    df = df.withColumns({"visit_group": (F.col("i") >= 9).cast("long"), "drift_pred": F.when(F.col("i").isin(4, 8, 9, 13), 1).otherwise(0).cast("long")})
    out = dr.clean_predictions(df, Series(chunk=5), group="visit_group")
    density = column(out, "drift_density")
    assert [d is None for d in density] == [not (3 <= i <= 4) if g == 0 else not (12 <= i <= 13) for i, g in enumerate(groups)]
    assert density[3] == 1 / 8 and density[4] == 2 / 8
    assert column(dr.clean_predictions(df, Series(chunk=5)), "drift_density")[9] == 3 / 8


def test_station_replies(spark):
    from sensorqc.sources import replies

    station = '{"id":"s","numId":"1","name":"n","elevation":1.5,"latitude":null,"longitude":2,"extra":[1],"dataTypes":[%s],"ts":[%s]}'
    data = '{"data":[{"dt":"2024-03-01 00:15:00","v":"2","f":"E"},{"dt":"soon","v":"x","f":null}]}'
    empty = '{"data":[]}'
    good = '{"stationSummaries":[%s, %s]}' % (station % ('{"name":"A"},{"name":"A"},{"name":"Precip"}', f"{empty},{data}"), station % ('{"name":"Precip"}', data))
    rows = [(1, good), (2, good[:-5]), (3, '{"stationSummaries":[]}'), (4, None), (5, "[]"), (6, '{"stationSummaries":[' + station % ('{"name":"B"}', data) + "]}"), (7, "")]
    df = spark.createDataFrame(rows, "rid int, body string")
    told = {r.rid: (r.is_broken, r.station is not None) for r in replies.parse_replies(df).collect()}
    assert told == {1: (False, True), 2: (True, False), 3: (False, False), 4: (False, False), 5: (told[5][0], False), 6: (False, True), 7: (True, False)}
    got = replies.station_series(df).orderBy("ts").collect()
    assert [(r.rid, r.parameter, r.value, r.flag, r.ts and r.ts.minute) for r in got] == [(1, "p_cm", None, None, None), (1, "p_cm", 5.08, "E", 15)]
    assert got[0].station_elevation == 1.5 and got[0].station_longitude == 2.0


def test_flag_pass_tests_drift_by_default():
    from sensorqc.operators import flags as fl

    assert fl.FlagSettings().drift == fl.DriftWindows()


def test_network_neighbours_of_suffixed_sites_and_of_the_first_network(spark):
    from sensorqc import Series
    from sensorqc.operators import drift as dr

    sites = {"b_virridy": 5.0, "a": 10.0, "c": 20.0, "z": 1000.0, "b": 7.0}
    rows = [(s, "DO", at(i), v) for s, v in sites.items() for i in range(8)]
    d = spark.createDataFrame(rows, "site string, parameter string, dt_round timestamp, mean_analysis double")
    windows = spark.createDataFrame([("b_virridy", "DO", 1, at(2), at(6)), ("b", "DO", 2, at(2), at(6)), ("z", "DO", 3, at(2), at(6))], "site string, parameter string, seq int, start_dt timestamp, end_dt timestamp")
    network = spark.createDataFrame([("n1", i, s) for i, s in enumerate("abc")] + [("n2", 0, "b"), ("n2", 1, "z")], "network string, pos long, site string")
    out = {r.seq: (r.from_c, r.to_c) for r in dr.range_values(d, windows, None, network, Series()).collect()}
    assert out == {1: (5.0, 15.0), 2: (7.0, 15.0), 3: (1000.0, 7.0)}


def test_report_file_names(spark):
    names = ["bridge_cal_20240301_1538_mst.html", "bridge.html", "_20240230_1538_mst.html"]
    df = spark.createDataFrame([(n, "<div>RDO Slope 1 Offset 2 mg/L</div>") for n in names * 2], "file string, html string")
    got = sorted(((r.site, r.dt and r.dt.strftime("%m-%d %H:%M"), r.rdo_slope) for r in readers.report_files(df, "html", "file").collect()), key=str)
    assert got == sorted([("bridge", "03-01 15:45", 1.0), ("bridge.html", None, 1.0), ("", None, 1.0)], key=str)

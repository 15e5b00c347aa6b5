"""Chunked windows give the same answer as one window over the whole series."""

import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from helpers import at, column, series
from sensorqc import Series
from sensorqc.functions.numeric import cubic_through, spline_gaps
from sensorqc.operators import flags as fl, grid
from sensorqc.plans.chunks import carry_series, frame_total, full_frame, over_slots, rank_rows, running_total
from sensorqc.plans.joins import asof_join, interval_join, mark_covered, nearest_join
from sensorqc.plans.quantiles import exact_quantiles

SMALL, WHOLE = Series(chunk=5), Series(chunk=100_000)


def noise(n, gap=0.2, seed=3):
    r = random.Random(seed)
    return [None if r.random() < gap else round(r.uniform(0, 50), 2) for _ in range(n)]


@pytest.mark.parametrize("fn", [grid.with_rolling, grid.with_slopes, grid.interpolate_gaps, grid.low_pass, grid.triangular, lambda d, s: grid.with_neighbours(d, s, 3)])
def test_frames_do_not_depend_on_chunks(spark, fn):
    d = series(spark, noise(80, 0.1), parameter="Turbidity")
    a, b = (fn(d, s).orderBy("dt_round").collect() for s in (SMALL, WHOLE))
    assert a == b and len(a) == 80


def test_carry_matches_plain_window(spark):
    d = series(spark, noise(70, 0.6))
    w = Window.partitionBy("site").orderBy("dt_round").rowsBetween(Window.unboundedPreceding, 0)
    want = d.withColumns({"f": F.last("mean", True).over(w), "s": F.sum(F.coalesce("mean", F.lit(0.0))).over(w)})
    got = carry_series(d, SMALL, fills={"f": F.col("mean")}, sums={"s": F.coalesce("mean", F.lit(0.0))})
    assert column(got, "f") == column(want, "f")
    assert column(got, "s") == pytest.approx(column(want, "s"))


def test_carry_backward_and_exclusive(spark):
    d = series(spark, [None, 1.0, None, None, 2.0, None])
    back = carry_series(d, Series(chunk=2), fills={"f": F.col("mean")}, backward=True)
    assert column(back, "f") == [1.0, 1.0, 2.0, 2.0, 2.0, None]
    prev = carry_series(d, Series(chunk=2), fills={"f": F.col("mean")}, exclusive=True)
    assert column(prev, "f") == [None, None, 1.0, 1.0, 1.0, 2.0]


@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("exclusive", [False, True])
def test_next_fills_equal_a_frame_to_the_end_but_run_from_there(spark, backward, exclusive):
    d = series(spark, noise(70, 0.6))
    w = Window.partitionBy("site").orderBy(F.desc("dt_round") if backward else F.asc("dt_round")).rowsBetween(int(exclusive), Window.unboundedFollowing)
    want = d.withColumn("f", F.first("mean", True).over(w))
    got = carry_series(d, SMALL, next_fills={"f": F.col("mean")}, backward=backward, exclusive=exclusive)
    assert column(got, "f") == column(want, "f") and got.columns == want.columns
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan  # the latter is quadratic in the rows of a chunk


def test_rank_and_frame_totals(spark):
    d = rank_rows(series(spark, [1.0] * 23), SMALL)
    assert column(d, "row_index") == list(range(1, 24))
    wide = over_slots(d, SMALL, 8, 8, lambda w: {"t": running_total("mean", w)}, lambda w: {"n": frame_total("t", w, 4, 4), "full": full_frame(w, 4, 4)})
    assert column(wide, "n") == [min(i, 4) + min(22 - i, 4) + 1 for i in range(23)]
    assert column(wide, "full") == [4 <= i <= 18 for i in range(23)]


def test_pad_grid_fills_every_slot(spark):
    d = series(spark, [1.0] * 40).filter("minute(dt_round) <> 30 or hour(dt_round) % 2 = 0")
    out = grid.pad_grid(d, SMALL)
    assert column(out, "dt_round") == column(series(spark, [1.0] * 40), "dt_round")
    assert grid.spacing_audit(out, SMALL).first()["evenly_spaced"]
    assert not grid.spacing_audit(d, SMALL).first()["evenly_spaced"]


def test_asof_nearest_and_cover(spark):
    left = series(spark, [0.0] * 12)
    right = spark.createDataFrame([("a", at(2), 20.0), ("a", at(7), 70.0)], "site string, t timestamp, v double")
    assert column(asof_join(left, right, ["site"], "dt_round", "t", ["v"], 1800), "v") == [None, None] + [20.0] * 5 + [70.0] * 5
    after = asof_join(left, right, ["site"], "dt_round", "t", ["v"], 1800, following=True)
    assert column(after, "v") == [20.0] * 3 + [70.0] * 5 + [None] * 4
    near = nearest_join(left, right, ["site"], "dt_round", "t", ["v"], 1800)
    assert column(near, "v") == [20.0] * 5 + [70.0] * 7
    spans = spark.createDataFrame([("a", at(1), at(8)), ("a", at(2), at(3)), ("a", at(10), at(10))], "site string, s timestamp, e timestamp")
    cover = mark_covered(left, spans, ["site"], "dt_round", "s", "e", 1800)
    assert column(cover, "covered") == [False] + [True] * 8 + [False, True, False]
    assert interval_join(left, spans, ["site"], "dt_round", "s", "e", 1800, "inner").count() == 8 + 2 + 1


def test_window_fits_do_not_depend_on_chunks(spark):
    values = noise(90, 0.02)
    d = series(spark, values, parameter="Turbidity").withColumn("visit_group", (F.minute("dt_round") * 0).cast("long"))
    win = fl.DriftWindows(4, 8, 6, 12, 6, 14, 4, 5, 0.25)
    a, b = (fl.time_drift(d, s, None, win).orderBy("dt_round").collect() for s in (Series(chunk=10), WHOLE))
    for x, y in zip(a, b):
        assert [x[c] for c in fl.FITS] == pytest.approx([y[c] for c in fl.FITS], abs=1e-9)
    assert any(x["r2_l_right_exp"] > 0 for x in a)


def test_quantiles_of_a_hot_group(spark):
    d = spark.range(60_000).select(F.when(F.col("id") % 50 == 0, "cold").otherwise("hot").alias("k"), F.round(F.exp(F.randn(5)), 2).alias("v"))
    d = d.unionByName(spark.range(9_000).select(F.lit("hot").alias("k"), F.lit(1.0).alias("v")))
    probs = {"lo": 0.01, "q": 0.25, "m": 0.5, "hi": 0.99, "min": 0.0, "max": 1.0}
    got = {r["k"]: r for r in exact_quantiles(d, ["k"], "v", probs).collect()}
    pdf = d.toPandas()
    for k in ("hot", "cold"):
        want = np.quantile(pdf[pdf.k == k].v, list(probs.values()))
        assert [got[k][n] for n in probs] == pytest.approx(want)


@pytest.mark.parametrize(("cell", "bins"), [(1, 2), (3, 4), (50, 16)])
def test_quantiles_narrow_over_many_rounds(spark, cell, bins):
    """Outliers, ties, infinite and missing values, several columns; the result doesn't depend on the cells."""
    r = random.Random(9)
    rows = [("a", r.choice([1.0, 2.0, r.gauss(0, 1), 1e12 * r.random(), 1e-9]), r.random() if r.random() < 0.5 else None) for _ in range(300)]
    rows += [("b", 4.0, float("nan"))] * 40 + [("b", float("inf"), None), ("b", float("-inf"), None), ("c", None, None), (None, 1.0, 1.0)]
    d = spark.createDataFrame(rows, "k string, x double, y double")
    want = {"x": {"x0": 0.0, "x1": 0.1, "x5": 0.5}, "y": {"y9": 0.9, "y10": 1.0}}
    got = {q.k: q for q in exact_quantiles(d, ["k"], want, cell=cell, bins=bins).collect()}
    xs, ys = ([v for k, *v2 in rows if k == "a" and (v := v2[i]) is not None] for i in (0, 1))
    assert [got["a"][n] for n in ("x0", "x1", "x5")] == pytest.approx(list(np.quantile(xs, [0.0, 0.1, 0.5])))
    assert [got["a"][n] for n in ("y9", "y10")] == pytest.approx(list(np.quantile(ys, [0.9, 1.0])))
    assert (got["b"].x0, got["b"].x5, got["b"].y9) == (float("-inf"), 4.0, None) and "c" not in got


def test_spline_follows_a_cubic_across_chunks(spark):
    f = lambda i: 0.001 * i**3 - 0.1 * i**2 + i
    values = [None if i % 9 in (3, 4) else f(i) for i in range(402)]
    out = spline_gaps(series(spark, values), Series(chunk=10))
    assert column(out, "splined") == pytest.approx([f(i) for i in range(402)], rel=1e-8, abs=1e-6)
    assert cubic_through(np.array([0.0, 1.0]), np.array([0.0, 2.0]), np.array([0.5]))[0] == 1.0


def test_winner_segments_equal_pairs(spark):
    """Many overlapping, open, backward and equal intervals: the winner of each row as by all pairs."""
    from sensorqc.plans.segments import pick_winners, winner_segments

    r = random.Random(6)
    rows = [(s, at(i * 15)) for s in ("a", "b", "c") for i in range(400)]
    left = spark.createDataFrame(rows, "site string, t timestamp").withColumn("id", F.monotonically_increasing_id())
    spans = []
    for seq in range(1000):
        start = r.randrange(-50, 420) * 15 + r.choice([0, 7])
        end = None if r.random() < 0.05 else start + r.choice([0, 15, 100, 2000, -30])
        spans.append(("a" if seq % 3 else "b", at(start) if r.random() < 0.97 else None, None if end is None else at(end), seq, r.choice(["x", "y", None])))
    iv = spark.createDataFrame(spans, "site string, s timestamp, e timestamp, seq long, kind string")
    picks = {"last": (F.col("seq"), F.col("seq")), "first": (F.col("seq"), -F.col("seq")), "x": (F.when(F.col("kind") == "x", F.struct("seq", "kind")), F.col("seq"))}
    got = {q.id: (q.site, q.t, q["last"], q["first"], q.x and q.x.seq) for q in pick_winners(left, iv, ["site"], "t", "s", "e", picks, 3600).collect()}
    assert len(got) == 1200
    for site, t, last, first, x in got.values():
        t = t.replace(tzinfo=at(0).tzinfo)
        hit = [q for q in spans if q[0] == site and q[1] is not None and q[1] <= t and (q[2] is None or t <= q[2])]
        seqs = [q[3] for q in hit]
        assert (last, first) == ((max(seqs), min(seqs)) if seqs else (None, None))
        assert x == max((q[3] for q in hit if q[4] == "x"), default=None)
    # at most two segments for each interval, whatever the overlap
    assert winner_segments(iv, ["site"], "s", "e", picks, 3600).count() <= 2000


def test_open_intervals_join_like_covered_ones(spark):
    left = spark.createDataFrame([("a", at(i * 60)) for i in range(50)], "site string, t timestamp")
    iv = spark.createDataFrame([("a", at(300), None, 1), ("a", None, at(900), 2), ("a", at(900), at(300), 3), ("z", at(0), None, 4)], "site string, s timestamp, e timestamp, seq int")
    joined = interval_join(left, iv, ["site"], "t", "s", "e", 3600, "inner")
    covered = mark_covered(left, iv.filter("s is not null"), ["site"], "t", "s", "e", 3600).filter("covered")
    assert joined.count() == covered.count() == 45
    assert interval_join(left, iv, ["site"], "t", "s", "e", 3600, "left").count() == 50


def dense_sides(spark):
    """One key with nine tenths of the rows, half of them at one instant on either side."""
    r = random.Random(12)
    times = lambda n: [(("hot" if i % 10 else "cold"), at(r.choice([40, 40, r.randrange(90)]))) for i in range(n)]
    left = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(times(900))], "k string, t timestamp, id int")
    right = spark.createDataFrame([(k, t, i, None if i % 3 else i * 2) for i, (k, t) in enumerate(times(700))], "k string, u timestamp, a int, b int")
    return left, right


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("each", [False, True])
def test_dense_chunks_are_cut_in_asof_joins(spark, following, each):
    left, right = dense_sides(spark)
    whole, cut = (asof_join(left, right, ["k"], "t", "u", ["a", "b"], 3600 * 6, following, each, n) for n in (10**9, 40))
    want = sorted(map(tuple, whole.collect()))
    assert len(want) == 900 and sorted(map(tuple, cut.collect())) == want


def test_dense_chunks_are_cut_in_nearest_and_covered(spark):
    from sensorqc.plans import joins

    left, right = dense_sides(spark)
    near = [sorted(map(tuple, nearest_join(left, right, ["k"], "t", "u", ["a"], 3600 * 6, n).collect())) for n in (10**9, 40)]
    assert near[0] == near[1]
    spans = right.withColumn("e", F.expr("u + make_interval(0, 0, 0, 0, 0, a % 40)"))
    hits = [sorted(map(tuple, mark_covered(left, spans, ["k"], "t", "u", "e", 3600 * 6, chunk_rows=n).collect())) for n in (10**9, 40)]
    assert hits[0] == hits[1]
    l = left.select("k", F.col("t").alias("_t"), F.lit(1).alias("_side"), F.struct("id").alias("_l"))
    r = right.select("k", F.col("u").alias("_t"), F.lit(0).alias("_side"), F.struct("a").alias("_r"))
    both, chunk = joins._stacked(l, r, ["k"], 3600 * 6, lambda x: x.groupBy("k", "_t", "_side").agg(F.max("_r").alias("_r")), rows=40)
    largest = both.groupBy("k", chunk.alias("c")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    assert largest <= 60  # of 900 left rows, half at one instant


@pytest.mark.parametrize("frame", [(48, 48), (96, 0), (0, 31)])
def test_fits_from_running_sums_equal_frames(frame):
    from sensorqc.functions import fits

    r = np.random.default_rng(4)
    y = 20 + 8 * np.sin(np.arange(1500) / 15) + r.normal(size=1500)
    y[300:600], y[700:760], y[900] = 7.25, 7.25 + np.arange(60) * 1e-7, 1e7  # flat, nearly flat, an outlier
    y[r.random(1500) < 0.05] = np.nan
    group = np.sort(r.integers(0, 6, 1500))
    for g in (None, group):
        own = np.zeros(1500, int) if g is None else g
        got = fits.window_fit(y, *frame, g)
        want = fits._fit_frames(y, *frame, own, np.arange(1500), False)
        for a, b in zip(got, want, strict=True):
            assert np.allclose(a, b, rtol=1e-7, atol=1e-9)

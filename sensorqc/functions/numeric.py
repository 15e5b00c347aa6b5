"""Numeric helpers Spark has no built-in for; vectorised on Arrow batches or bounded chunks."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from sensorqc.functions import time as tm
from sensorqc.series import Series
from sensorqc.session import ship_package


def _beta_tail(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_tail(1.0 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    value, up, down = 1.0, 1.0, 0.0
    for i in range(400):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        down = 1.0 / (1.0 + term * down)
        up = 1.0 + term / up
        step = up * down
        value *= step
        if abs(1.0 - step) < 1e-14:
            break
    return front * (value - 1.0)


def t_two_sided(t: float, dof: float) -> float:
    """P(|T| > t)."""
    return _beta_tail(dof / (dof + t * t), dof / 2.0, 0.5)


def t_inverse(p: float, dof: float) -> float:
    lo, hi = 0.0, 1.0
    target = 2.0 * (1.0 - p)
    while t_two_sided(hi, dof) > target:
        hi *= 2.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if t_two_sided(mid, dof) > target:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0


def t_quantile(p: Column, dof: Column) -> Column:
    """Quantile above one half of Student's t; meant for small aggregates."""

    @F.pandas_udf(T.DoubleType())
    def udf(prob: pd.Series, d: pd.Series) -> pd.Series:
        known: dict[tuple[float, float], float] = {}
        out = []
        for a, b in zip(prob, d):
            if pd.isna(b) or b < 1:
                out.append(None)
                continue
            if (a, b) not in known:
                known[(a, b)] = t_inverse(a, b)
            out.append(known[(a, b)])
        return pd.Series(out, dtype="float64")

    return udf(p, dof)


def t_pvalue(t: Column, dof: Column) -> Column:
    @F.pandas_udf(T.DoubleType())
    def udf(stat: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(a) or pd.isna(b) or b < 1 else t_two_sided(abs(a), b) for a, b in zip(stat, d)], dtype="float64")

    return udf(t.cast("double"), dof.cast("double"))


def chi2_one_pvalue(stat: Column) -> Column:
    """Upper tail of chi-squared with one degree of freedom."""

    @F.pandas_udf(T.DoubleType())
    def udf(s: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(x) else math.erfc(math.sqrt(max(x, 0.0) / 2.0)) for x in s], dtype="float64")

    return udf(stat.cast("double"))


def cubic_through(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Cubic spline whose end pieces follow the cubic through the outer four knots."""
    n = len(x)
    if n == 1:
        return np.full(len(at), y[0])
    h = np.diff(x)
    s = np.diff(y) / h
    if n == 2:
        return y[0] + s[0] * (at - x[0])
    low, mid, up, rhs = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    mid[1:-1] = 2.0 * (h[:-1] + h[1:])
    low[1:-1], up[1:-1] = h[:-1], h[1:]
    rhs[1:-1] = 6.0 * np.diff(s)

    def third(i: int) -> float:
        if n < 4:
            return 0.0
        xs, ys = x[i : i + 4], y[i : i + 4]
        d = ys.copy()
        for k in range(1, 4):
            d = np.diff(d) / (xs[k:] - xs[:-k])
        return 6.0 * float(d[0])

    mid[0], up[0], rhs[0] = -1.0, 1.0, h[0] * third(0)
    low[-1], mid[-1], rhs[-1] = -1.0, 1.0, h[-1] * third(n - 4)
    for i in range(1, n):
        f = low[i] / mid[i - 1]
        mid[i] -= f * up[i - 1]
        rhs[i] -= f * rhs[i - 1]
    m = np.zeros(n)
    m[-1] = rhs[-1] / mid[-1]
    for i in range(n - 2, -1, -1):
        m[i] = (rhs[i] - up[i] * m[i + 1]) / mid[i]
    j = np.clip(np.searchsorted(x, at, side="right") - 1, 0, n - 2)
    a, b = (x[j + 1] - at) / h[j], (at - x[j]) / h[j]
    return a * y[j] + b * y[j + 1] + ((a**3 - a) * m[j] + (b**3 - b) * m[j + 1]) * h[j] ** 2 / 6.0


SPLINE_HALO = 40  # knots; the influence of a knot falls by 0.27 per knot


def spline_gaps(df: DataFrame, spec: Series, value: str = "mean", maxgap: int = 4, name: str = "splined") -> DataFrame:
    """Cubic spline inside runs of at most ``maxgap`` missing slots.

    Chunks are cut by knot number, so each pandas call sees a bounded number of knots whatever the
    length of the series; only knots and fillable slots travel to Python.
    """
    from sensorqc.plans.chunks import over_slots, rank_rows

    ship_package(df.sparkSession)
    keys = list(spec.keys)

    def around(w):
        t = F.when(F.col(value).isNotNull(), F.unix_seconds(spec.time))
        before, after = F.max(t).over(w.rowsBetween(-maxgap, -1)), F.min(t).over(w.rowsBetween(1, maxgap))
        return {"_fits": F.coalesce((after - before) <= spec.step * (maxgap + 1), F.lit(False))}

    marked = over_slots(df, spec, maxgap, maxgap, around)
    ranked = rank_rows(marked, spec, name="_knot", when=F.col(value).isNotNull())
    work = ranked.filter(F.col(value).isNotNull() | F.col("_fits")).select(
        *keys, F.unix_seconds(spec.time).alias("_t"), F.col(value).alias("_y"), "_knot"
    )
    size = max(spec.chunk, 4 * SPLINE_HALO)
    own = F.floor(F.col("_knot") / size)
    work = work.withColumn("_part", F.explode(F.sequence(F.floor((F.col("_knot") - SPLINE_HALO) / size), F.floor((F.col("_knot") + SPLINE_HALO) / size))))
    work = work.withColumn("_core", F.col("_part") == own)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_t")
        knots = pdf[pdf["_y"].notna()]
        holes = pdf[pdf["_y"].isna() & pdf["_core"]]
        at = holes["_t"].to_numpy("float64")
        origin = float(pdf["_t"].iloc[0])
        got = np.zeros(0)
        if len(knots) and len(at):
            got = cubic_through(knots["_t"].to_numpy("float64") - origin, knots["_y"].to_numpy("float64"), at - origin)
        out = holes[[*keys, "_t"]].copy()
        out["_s"] = got
        return out

    schema = ", ".join([*[f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys], "_t long", "_s double"])
    filled = work.groupBy(*keys, "_part").applyInPandas(fit, schema)
    filled = filled.select(*keys, F.timestamp_seconds("_t").alias(spec.time), "_s")
    out = df.join(filled, [*keys, spec.time], "left")
    return out.withColumn(name, F.coalesce(F.col(value), F.col("_s"))).drop("_s")

"""Exact type-7 quantiles of groups of any size, by histograms that narrow around the wanted ranks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorqc.session import materialise

#: Bins of one histogram, and the number of values that may be sorted in one cell.
BINS, CELL = 1024, 4096
_MOST = 1.7976931348623157e308


def exact_quantiles(df: DataFrame, keys: list[str], value: str | dict[str, dict[str, float]], probs: dict[str, float] | None = None, cell: int = CELL, bins: int = BINS) -> DataFrame:
    """``keys`` plus one column per named probability, linear between order statistics.

    ``value`` is a column with ``probs`` {name: probability}, or several columns {column: {name: probability}} that
    are looked up together. Every group starts with the range from its least to its greatest value. A round counts the
    values of each range by bins, in one partial aggregate for all groups, columns and ranks, and a rank's bin is its
    next range; a range is left as soon as it holds one distinct value or at most ``cell`` values, which are then
    sorted. So no task holds more than a cell of a group, whatever its size, and rounds read only what lies in ranges.
    """
    wanted = {value: probs} if isinstance(value, str) else value
    cells = F.array(*[F.struct(F.lit(i).alias("c"), F.col(v).cast("double").alias("v")) for i, v in enumerate(wanted)])
    d = df.select(*keys, F.explode(cells).alias("_x")).select(*keys, F.col("_x.c").alias("_c"), F.col("_x.v").alias("_v"))
    d = materialise(d.filter(F.col("_v").isNotNull() & ~F.isnan("_v")), "quantile-values")
    by = [*keys, "_c"]
    n, ranks = F.col("_n"), F.lit(None).cast("array<bigint>")
    for i, ps in enumerate(wanted.values()):
        ends = [f(F.lit(float(p)) * (n - 1)).cast("long") for p in ps.values() for f in (F.floor, F.ceil)]
        ranks = F.when(F.col("_c") == i, F.array_distinct(F.array(*ends))).otherwise(ranks)
    state = d.groupBy(*by).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    state = state.withColumns({"_in": n, "_below": F.lit(0).cast("long"), "_ranks": ranks})
    done = []
    while True:
        state = materialise(state, "quantile-ranges")
        wide = (F.col("_in") > cell) & (F.col("_lo") < F.col("_hi"))
        done.append(state.filter(~wide))
        state = state.filter(wide)
        if state.isEmpty():
            break
        state = _narrow(d, state, by, bins)
    ranges = reduce(DataFrame.unionByName, done)
    single = F.col("_lo") == F.col("_hi")
    held = _inside(d, ranges.filter(~single), by).groupBy(*by, "_n", "_below", "_ranks").agg(F.sort_array(F.collect_list("_v")).alias("_vs"))
    held = held.select(*by, "_n", F.explode("_ranks").alias("_r"), "_vs", "_below")
    found = held.select(*by, "_n", "_r", F.get("_vs", (F.col("_r") - F.col("_below")).cast("int")).alias("_v"))
    found = found.unionByName(ranges.filter(single).select(*by, "_n", F.explode("_ranks").alias("_r"), F.col("_lo").alias("_v")))
    out = []
    for i, ps in enumerate(wanted.values()):
        for name, p in ps.items():
            pos = F.lit(float(p)) * (n - 1)
            part = pos - F.floor(pos)
            share = F.when(F.col("_r") == F.floor(pos), 1 - part).otherwise(0.0) + F.when(F.col("_r") == F.ceil(pos), part).otherwise(0.0)
            mine = (F.col("_c") == i) & ((F.col("_r") == F.floor(pos)) | (F.col("_r") == F.ceil(pos)))
            # a share of an infinite neighbour that isn't wanted is not a number
            out.append(F.sum(F.when(mine, F.when(share > 0, F.col("_v") * share).otherwise(0.0))).alias(name))
    return found.groupBy(*keys).agg(*out)


def _inside(d: DataFrame, ranges: DataFrame, by: list[str]) -> DataFrame:
    return d.join(ranges, by).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def _half(c: str) -> Column:
    return F.greatest(F.least(F.col(c), F.lit(_MOST)), F.lit(-_MOST)) / 2


def _narrow(d: DataFrame, state: DataFrame, by: list[str], bins: int) -> DataFrame:
    """The bins that hold the wanted ranks, as ranges from their least to their greatest value."""
    # bins rise with the value, so a bin is just the values between its ends
    bin_ = F.floor((_half("_v") - _half("_lo")) / (_half("_hi") - _half("_lo")) * bins).cast("int")
    old = [*by, "_n", "_lo", "_hi", "_below", "_ranks"]
    b = _inside(d, state, by).groupBy(*old, bin_.alias("_bin")).agg(F.count(F.lit(1)).alias("_in"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    upto = Window.partitionBy(*by, "_lo").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # at most ``bins`` + 1 rows
    b = b.withColumn("_below", F.col("_below") + F.coalesce(F.sum("_in").over(upto), F.lit(0)))
    b = b.withColumn("_ranks", F.filter("_ranks", lambda r: (r >= F.col("_below")) & (r < F.col("_below") + F.col("_in"))))
    return b.filter(F.size("_ranks") > 0).select(*by, "_n", F.col("_a").alias("_lo"), F.col("_b").alias("_hi"), "_in", "_below", "_ranks")

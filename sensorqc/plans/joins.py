"""As-of, nearest and interval joins that stay equi-joins or chunked windows.

As-of and nearest joins stack both sides in time order and carry values along (key, time chunk). Chunks that hold too
many rows are cut further at quantiles of their own times (``_stacked``), so one key, one hour or one instant with a
third of all rows is spread over tasks; no chunk then holds much more than ``CHUNK_ROWS``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from sensorqc.functions.time import seconds_between
from sensorqc.plans.chunks import carry, time_chunk


#: Rows that one chunk may hold before it is cut, and the number of its quantiles at which it may be cut.
CHUNK_ROWS, CUTS = 500_000, 256


def _stacked(l: DataFrame, r: DataFrame, on: list[str], chunk_seconds: int, collapse: Callable[[DataFrame], DataFrame], following: bool = False, rows: int | None = None) -> tuple[DataFrame, Column]:
    """Both sides in one table, and a chunk that grows with time.

    Left rows (``_l``) take values, right rows give them. Right rows of one instant are collapsed by ``collapse`` where
    chunks are cut, and lie before the left rows of that instant (``following``: behind). So left rows of one
    instant may lie in any of the parts that the instant spans, and are dealt over them.
    """
    both = l.unionByName(r, allowMissingColumns=True)
    whole = time_chunk("_t", chunk_seconds)
    if both.isStreaming:
        return both, whole
    dense = both.groupBy(*on, whole.alias("_whole")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > F.lit(rows or CHUNK_ROWS))
    if dense.isEmpty():
        return both, whole
    both = l.unionByName(collapse(r), allowMissingColumns=True).withColumns({"_whole": whole, "_at": F.unix_micros("_t")})
    quantiles = F.percentile_approx("_at", [i / CUTS for i in range(1, CUTS)], 40 * CUTS)
    cuts = both.join(dense.drop("_n"), [*on, "_whole"], "left_semi").groupBy(*on, "_whole").agg(quantiles.alias("_cuts"))
    both = both.join(cuts, [*on, "_whole"], "left")
    below = F.size(F.filter("_cuts", lambda c: c < F.col("_at")))
    upto = F.size(F.filter("_cuts", lambda c: c <= F.col("_at")))
    dealt = below + F.pmod(F.monotonically_increasing_id(), (upto - below + 1).cast("long")).cast("int")
    part = F.when(F.col("_l").isNotNull(), dealt).otherwise(upto if following else below)
    both = both.withColumn("_part", F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(part)).drop("_cuts", "_at", "_whole")
    return both, F.struct(time_chunk("_t", chunk_seconds).alias("whole"), F.col("_part").alias("part"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_time: str,
    right_time: str,
    payload: list[str],
    chunk_seconds: int,
    following: bool = False,
    each: bool = False,
    chunk_rows: int | None = None,
) -> DataFrame:
    """For each left row the latest right row at or before it (``following``: earliest at or after).

    Both sides are stacked and the payload is carried along time, so no pair of rows is formed and
    a hot key is split by time chunk. Right rows at equal times are ordered by their payload. With
    ``each`` every payload column takes its own latest non-null value.
    """
    match = F.struct(*[F.col(c).alias(c) for c in payload])
    left_type = F.struct(*[F.col(c) for c in left.columns])
    l = left.select(*on, F.col(left_time).alias("_t"), F.lit(0 if following else 1).alias("_side"), left_type.alias("_l"))
    r = right.select(*on, F.col(right_time).alias("_t"), F.lit(1 if following else 0).alias("_side"), match.alias("_r"))

    def collapse(r: DataFrame) -> DataFrame:
        pick = F.min if following else F.max
        own = [(F.min_by if following else F.max_by)(F.col("_r")[c], F.when(F.col("_r")[c].isNotNull(), F.col("_r"))).alias(c) for c in payload]
        return r.groupBy(*on, "_t", "_side").agg((F.struct(*own) if each else pick("_r")).alias("_r"))

    both, chunk = _stacked(l, r, on, chunk_seconds, collapse, following, chunk_rows)
    fills = {f"_v{i}": F.col("_r")[c] for i, c in enumerate(payload)} if each else {"_match": F.col("_r")}
    filled = carry(both, on, chunk, ["_t", "_side", "_r"], fills=fills, backward=following)
    got = [(F.col(f"_v{i}") if each else F.col("_match")[c]).alias(c) for i, c in enumerate(payload)]
    return filled.filter(F.col("_l").isNotNull()).select("_l.*", *got)


def nearest_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, payload: list[str], chunk_seconds: int, chunk_rows: int | None = None) -> DataFrame:
    """Right row with the smallest time distance; the earlier one on ties."""
    here = F.struct(F.col(right_time).alias("_rt"), *[F.col(c).alias(c) for c in payload])
    rows = F.struct(*[F.col(c) for c in left.columns])
    l = left.select(*on, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), rows.alias("_l"))
    r = right.select(*on, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), here.alias("_r"))

    def collapse(r: DataFrame) -> DataFrame:
        ends = F.explode(F.array_distinct(F.array("_first", "_last")))
        return r.groupBy(*on, "_t", "_side").agg(F.min("_r").alias("_first"), F.max("_r").alias("_last")).select(*on, "_t", "_side", ends.alias("_r"))

    both, chunk = _stacked(l, r, on, chunk_seconds, collapse, rows=chunk_rows)
    out = carry(both, on, chunk, ["_t", "_side", "_r"], fills={"_p": F.col("_r")}, next_fills={"_n": F.col("_r")})
    back, ahead = seconds_between("_t", "_p._rt"), seconds_between("_n._rt", "_t")
    use_prev = F.col("_n").isNull() | (back <= ahead)
    best = [F.when(use_prev, F.col("_p")[c]).otherwise(F.col("_n")[c]).alias(c) for c in payload]
    return out.filter(F.col("_l").isNotNull()).select("_l.*", *best)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    time: str,
    start: str,
    end: str,
    bucket_seconds: int,
    how: str = "left",
) -> DataFrame:
    """Join rows to the intervals [start, end] that contain them (all matches).

    The interval side is spread over the time buckets in which its key has rows, so that the join is an
    equi-join on (keys, bucket); whether a side is broadcast is left to its measured size. An interval
    without an end stays open, one without a start holds no row.
    """
    span = left.groupBy(*on).agg(F.min(time).alias("_iv_lo"), F.max(time).alias("_iv_hi"))
    r = right.join(span, on).withColumns({"_iv_first": F.greatest(F.col(start), "_iv_lo"), "_iv_last": F.least(F.col(end), "_iv_hi")})
    r = r.filter(F.col(start).isNotNull() & (F.col("_iv_first") <= F.col("_iv_last")) & (F.col(end).isNull() | (F.col(start) <= F.col(end))))
    r = r.withColumn("_bucket", F.explode(F.sequence(time_chunk("_iv_first", bucket_seconds), time_chunk("_iv_last", bucket_seconds))))
    r = r.select(*[F.col(c).alias(f"_k_{c}") for c in on], "_bucket", "_iv_first", "_iv_last", *[F.col(c) for c in right.columns if c not in on])
    l = left.withColumn("_lb", time_chunk(time, bucket_seconds))
    cond: Column = (F.col("_lb") == F.col("_bucket")) & F.col(time).between(F.col("_iv_first"), F.col("_iv_last"))
    for c in on:
        cond = cond & (F.col(c) == F.col(f"_k_{c}"))
    return l.join(r, cond, how).drop("_lb", "_bucket", "_iv_first", "_iv_last", *[f"_k_{c}" for c in on])


def mark_covered(df: DataFrame, intervals: DataFrame, on: list[str], time: str, start: str, end: str, chunk_seconds: int, name: str = "covered", chunk_rows: int | None = None) -> DataFrame:
    """TRUE where any interval of the key contains the row.

    Starts are stacked with the rows and the running maximum of the ends is carried forward, so
    heavily overlapping intervals cost nothing extra. An interval without an end stays open.
    """
    packed = F.struct(*[F.col(c) for c in df.columns])
    rows = df.select(*on, F.col(time).alias("_t"), F.lit(1).alias("_side"), packed.alias("_l"))
    open_end = F.lit("9999-12-31 00:00:00").cast(intervals.schema[end].dataType)
    starts = intervals.select(*on, F.col(start).alias("_t"), F.lit(0).alias("_side"), F.coalesce(F.col(end), open_end).alias("_end")).filter("_t is not null")
    both, chunk = _stacked(rows, starts, on, chunk_seconds, lambda r: r.groupBy(*on, "_t", "_side").agg(F.max("_end").alias("_end")), rows=chunk_rows)
    out = carry(both, on, chunk, ["_t", "_side"], maxes={"_reach": F.col("_end")})
    hit = F.coalesce(F.col("_reach") >= F.col("_t"), F.lit(False))
    return out.filter(F.col("_l").isNotNull()).select("_l.*", hit.alias(name))


def rows_update(df: DataFrame, updates: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Overwrite matching rows by key, ignore unmatched updates."""
    marked = updates.select(*on, F.struct(*columns).alias("_new"))
    out = df.join(marked, on, "left")
    hit = F.col("_new").isNotNull()
    cols = {c: F.when(hit, F.col("_new")[c]).otherwise(F.col(c)) for c in columns}
    return out.withColumns(cols).drop("_new").select(*df.columns)


def newest_per_key(df: DataFrame, keys: list[str], order: list[Column | str], newest: bool = True) -> DataFrame:
    """One row per key by a total order, as a partial aggregate rather than a sort per key."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if newest else F.min_by
    row = F.struct(*rest)
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.groupBy(*keys).agg(pick(row, rank).alias("_row")).select(*keys, "_row.*").select(*df.columns)

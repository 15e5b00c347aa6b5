"""One answer per row from any number of overlapping intervals, without pairs of rows and intervals.

The ends of a key's intervals cut its time line into segments within which the same intervals hold. Over the numbered
segments every interval is a run, which splits into at most two dyadic nodes a level. A node keeps only the best of its
intervals (a partial aggregate, so copies and hot nodes collapse before the shuffle); a segment asks its ancestors, one
a level. So n intervals of a key cost n log n small rows however much they overlap, and rows then look up their
segment by one as-of join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorqc.plans.chunks import carry, time_chunk
from sensorqc.plans.joins import asof_join
from sensorqc.session import materialise

#: name -> (what the winner gives, by which the greatest wins); a null payload takes no part.
Picks = dict[str, tuple[Column, Column]]


def winner_segments(intervals: DataFrame, on: list[str], start: str, end: str, picks: Picks, chunk_seconds: int, name: str = "_from") -> DataFrame:
    """``on``, ``name`` (first instant of the segment) and one column per pick; null where no interval holds.

    Intervals are closed; one without an end stays open, one without a start or ending before it has no instant.
    The last segment of a key begins after its last end.
    """
    far = F.lit("9999-12-31 00:00:00").cast("timestamp")
    a, b = F.unix_micros(F.col(start).cast("timestamp")), F.unix_micros(F.coalesce(F.col(end).cast("timestamp"), far)) + 1
    cols = {f"_p_{n}": payload for n, (payload, _) in picks.items()} | {f"_o_{n}": F.when(payload.isNotNull(), order) for n, (payload, order) in picks.items()}
    iv = intervals.withColumns(cols).select(*on, a.alias("_a"), b.alias("_b"), *cols).filter("_a < _b")
    points = iv.select(*on, F.explode(F.array("_a", "_b")).alias("_p")).distinct()
    numbered = carry(points, on, time_chunk(F.timestamp_micros("_p"), chunk_seconds), ["_p"], sums={"_i": F.lit(1).cast("long")})
    for side, index in (("_a", "_ia"), ("_b", "_ib")):
        iv = iv.join(numbered.select(*on, F.col("_p").alias(side), F.col("_i").alias(index)), [*on, side])
    nodes = iv.withColumn("_node", F.explode(_dyadic(F.col("_ia"), F.col("_ib")))).groupBy(*on, "_node").agg(*_best(picks))
    count = numbered.groupBy(*on).agg(F.max("_i").alias("_n"))
    levels = F.sequence(F.lit(0), F.length(F.bin("_n")))
    ancestors = F.transform(levels, lambda l: F.struct(l.alias("level"), F.call_function("shiftright", F.col("_i"), l).alias("at")))
    asked = numbered.join(count, on).select(*on, "_p", F.explode(ancestors).alias("_node"))
    found = asked.join(nodes, [*on, "_node"], "left").groupBy(*on, "_p").agg(*_best(picks))
    return found.select(*on, F.timestamp_micros("_p").alias(name), *[F.col(f"_p_{n}").alias(n) for n in picks])


def _best(picks: Picks) -> list[Column]:
    return [c for n in picks for c in (F.max_by(f"_p_{n}", f"_o_{n}").alias(f"_p_{n}"), F.max(f"_o_{n}").alias(f"_o_{n}"))]


def _dyadic(first: Column, past: Column) -> Column:
    """The nodes (level, at) whose segments [at * 2^level, (at + 1) * 2^level) together are [first, past)."""

    def at_level(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        low, high = F.ceil(first / size).cast("long"), F.floor(past / size).cast("long")
        left = (low < high) & (low % 2 == 1)
        right = (low + low % 2 < high) & (high % 2 == 1)
        both = F.array(F.when(left, F.struct(level.alias("level"), low.alias("at"))), F.when(right, F.struct(level.alias("level"), (high - 1).alias("at"))))
        return F.filter(both, lambda x: x.isNotNull())

    return F.flatten(F.transform(F.sequence(F.lit(0), F.length(F.bin(past))), at_level))


def pick_winners(df: DataFrame, intervals: DataFrame, on: list[str], time: str, start: str, end: str, picks: Picks, chunk_seconds: int) -> DataFrame:
    """``df`` with one column per pick, taken from the intervals that hold each row.

    ``df`` is read three times, so hand in a stored table where it is costly.
    """
    segments = materialise(winner_segments(intervals, on, start, end, picks, chunk_seconds, "_segment"), "segments")
    return asof_join(df, segments, on, time, "_segment", list(picks), chunk_seconds)

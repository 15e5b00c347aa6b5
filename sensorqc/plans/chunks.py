"""Window work on series that may be too long for one task.

``over_slots``   bounded row frames on a gridded series: rows near a chunk border are copied to
                 the neighbour chunk, so every frame is complete inside (keys, chunk).
``carry``        unbounded frames (fill, running sum, running max): a window inside each chunk plus
                 one small window over chunk summaries.
``rank_rows``    dense row index per series, built from ``carry``; turns irregular rows into
                 something ``over_slots`` can frame exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F
from pyspark.sql import types as T

from sensorqc.functions.time import slot_number
from sensorqc.series import Series
from sensorqc.session import ship_package

Step = Callable[[WindowSpec], dict[str, Column]]


def _halo(df: DataFrame, index: Column, before: int, after: int, size: int) -> DataFrame:
    own = F.floor(F.col("_index") / size)
    first = F.floor((F.col("_index") - after) / size)
    last = F.floor((F.col("_index") + before) / size)
    return (
        df.withColumn("_index", index)
        .withColumn("_chunk", F.explode(F.sequence(first, last)))
        .withColumn("_core", F.col("_chunk") == own)
    )


def _apply(df: DataFrame, keys, order: str, steps) -> DataFrame:
    w = Window.partitionBy(*keys, "_chunk").orderBy(order)
    for step in steps:
        df = df.withColumns(step(w))
    return df.filter("_core").drop("_index", "_chunk", "_core")


def over_slots(df: DataFrame, spec: Series, before: int, after: int, *steps: Step) -> DataFrame:
    """Add columns computed over row frames reaching at most ``before``/``after`` slots.

    The input must be on the grid without holes (``pad_grid``). Steps run in order and may use
    columns of earlier steps; ``before``/``after`` then cover the sum of their frames. All steps
    share one shuffle and one sort.
    """
    out = _halo(df, slot_number(spec.time, spec.step), before, after, max(spec.chunk, 1))
    return _apply(out, spec.keys, spec.time, steps)


def over_index(df: DataFrame, keys, index: str, before: int, after: int, chunk: int, *steps: Step) -> DataFrame:
    """Like ``over_slots`` for an integer index column (row rank, week number)."""
    return _apply(_halo(df, F.col(index).cast("long"), before, after, chunk), keys, index, steps)


def over_slots_in_arrow(df: DataFrame, spec: Series, before: int, after: int, fn, columns: dict[str, str]) -> DataFrame:
    """``over_slots`` for frames that need numpy: ``fn(arrow table sorted by time) -> {name: array}``.

    One call sees one chunk with its halo, a bounded number of rows; other columns stay in Arrow.
    """
    ship_package(df.sparkSession)
    keys = list(spec.keys)
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T._parse_datatype_string(t)) for n, t in columns.items()]])
    out = _halo(df, slot_number(spec.time, spec.step), before, after, max(spec.chunk, 1))
    names = df.columns

    def call(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        table = table.take(pc.sort_indices(table["_index"]))
        got = fn(table)
        result = table.select(names)
        for n in columns:
            result = result.append_column(n, pa.array(got[n], from_pandas=True))
        return result.filter(table["_core"])

    return out.groupBy(*keys, "_chunk").applyInArrow(call, schema)


def running_total(column: str | Column, w: WindowSpec) -> Column:
    return F.sum(column).over(w.rowsBetween(Window.unboundedPreceding, 0))


def frame_total(running: str, w: WindowSpec, before: int, after: int) -> Column:
    """Sum over rows [-before, after] from a running total, whatever the width of the frame."""
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = F.coalesce(F.lead(running, after).over(w), F.last(running).over(whole))
    return upto - F.coalesce(F.lag(running, before + 1).over(w), F.lit(0))


def full_frame(w: WindowSpec, before: int, after: int) -> Column:
    one = F.lit(1)
    return F.lag(one, before).over(w).isNotNull() & F.lead(one, after).over(w).isNotNull()


def carry(
    df: DataFrame,
    keys,
    chunk: Column,
    order: list[str],
    fills: dict[str, Column] | None = None,
    sums: dict[str, Column] | None = None,
    maxes: dict[str, Column] | None = None,
    next_fills: dict[str, Column] | None = None,
    backward: bool = False,
    exclusive: bool = False,
) -> DataFrame:
    """Running last-non-null / sum / max per key in the given order, split by chunk.

    ``chunk`` must grow with the order. ``next_fills`` look the other way: the rows are numbered and sorted again from
    the end, as Spark computes a frame that reaches to the end of its partition anew for every row.
    ``exclusive`` leaves the current row out of the frames. The input is read twice (summary and
    rows), so hand in a stored table where it is costly.
    """
    fills, sums, maxes, next_fills = fills or {}, sums or {}, maxes or {}, next_fills or {}
    keys = list(keys)
    d = df.withColumn("_chunk", chunk)
    position = F.struct(*[F.col(c) for c in order])
    pick, other = (F.min_by, F.max_by) if backward else (F.max_by, F.min_by)
    aggs = [pick(c, F.when(c.isNotNull(), position)).alias(f"_f_{n}") for n, c in fills.items()]
    aggs += [other(c, F.when(c.isNotNull(), position)).alias(f"_f_{n}") for n, c in next_fills.items()]
    aggs += [F.sum(c).alias(f"_s_{n}") for n, c in sums.items()]
    aggs += [F.max(c).alias(f"_m_{n}") for n, c in maxes.items()]
    summary = d.groupBy(*keys, "_chunk").agg(*aggs)
    chunk_order = F.col("_chunk").desc() if backward else F.col("_chunk").asc()
    wc = Window.partitionBy(*keys).orderBy(chunk_order).rowsBetween(Window.unboundedPreceding, -1)
    wn = Window.partitionBy(*keys).orderBy(F.col("_chunk").asc() if backward else F.col("_chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(
        *keys,
        "_chunk",
        *[F.last(f"_f_{n}", ignorenulls=True).over(wn).alias(f"_f_{n}") for n in next_fills],
        *[F.last(f"_f_{n}", ignorenulls=True).over(wc).alias(f"_f_{n}") for n in fills],
        *[F.sum(f"_s_{n}").over(wc).alias(f"_s_{n}") for n in sums],
        *[F.max(f"_m_{n}").over(wc).alias(f"_m_{n}") for n in maxes],
    )
    ordering = [F.col(c).desc() if backward else F.col(c).asc() for c in order]
    ordered = Window.partitionBy(*keys, "_chunk").orderBy(*ordering)
    w = ordered.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    ahead = Window.partitionBy(*keys, "_chunk").orderBy(F.col("_place").desc()).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    out = d.join(summary, [*keys, "_chunk"], "left")
    if next_fills:
        out = out.withColumn("_place", F.row_number().over(ordered))
    cols = {n: F.coalesce(F.last(c, ignorenulls=True).over(w), F.col(f"_f_{n}")) for n, c in fills.items()}
    cols |= {n: F.coalesce(F.last(c, ignorenulls=True).over(ahead), F.col(f"_f_{n}")) for n, c in next_fills.items()}
    cols |= {n: F.coalesce(F.sum(c).over(w), F.lit(0)) + F.coalesce(F.col(f"_s_{n}"), F.lit(0)) for n, c in sums.items()}
    cols |= {n: F.greatest(F.max(c).over(w), F.col(f"_m_{n}")) for n, c in maxes.items()}
    drop = [f"_f_{n}" for n in [*fills, *next_fills]] + [f"_s_{n}" for n in sums] + [f"_m_{n}" for n in maxes]
    return out.withColumns(cols).drop("_chunk", "_place", *drop)


def time_chunk(time: Column | str, seconds: int) -> Column:
    return slot_number(time, seconds)


def carry_series(df: DataFrame, spec: Series, order: tuple[str, ...] = (), **kwargs) -> DataFrame:
    return carry(df, spec.keys, time_chunk(spec.time, spec.chunk_seconds), [spec.time, *order], **kwargs)


def rank_rows(df: DataFrame, spec: Series, order: tuple[str, ...] = (), name: str = "row_index", when: Column | None = None) -> DataFrame:
    """1-based position of each row in its series; with ``when``, counts only matching rows."""
    one = F.lit(1) if when is None else F.when(when, F.lit(1)).otherwise(F.lit(0))
    return carry_series(df, spec, order, sums={name: one.cast("long")})

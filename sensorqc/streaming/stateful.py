"""Streaming operators with state of their own: gap sessions and alarm suppression.

State is a few numbers per key, kept by Spark in the query's checkpoint, so a stopped stream goes on where it was.
Rows of a key are read as they come in Arrow batches; sessions keep no rows, alarms hold a key's rows of one
micro-batch as Arrow columns, which ``maxFilesPerTrigger`` bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sensorqc.session import ship_package
from sensorqc.streaming.live import WATERMARK

#: Rows that alarms hand on at once.
SLICE = 20_000

Span = tuple[int, int, int]  # first and last instant, rows


def merge_spans(spans: list[Span], times: np.ndarray, gap: int) -> list[Span]:
    """Sessions after new rows: rows less than ``gap`` apart share one."""
    if len(times):
        t = np.sort(times)
        cut = np.flatnonzero(np.diff(t) >= gap) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(t)]]) - 1
        spans = spans + list(zip(t[first].tolist(), t[last].tolist(), (last - first + 1).tolist(), strict=True))
    out: list[Span] = []
    for a, b, n in sorted(spans):
        if out and a - out[-1][1] < gap:
            out[-1] = (out[-1][0], max(out[-1][1], b), out[-1][2] + n)
        else:
            out.append((a, b, n))
    return out


def session_updates(readings: DataFrame, gap_seconds: int, keys: list[str], ts: str = "ts", watermark: str = WATERMARK) -> DataFrame:
    """``keys``, start_dt, end_dt (last row plus the gap), n of every session that a batch changes, open ones too.

    For update mode: the newest row of (``keys``, start_dt) counts, and n = 0 takes back a session that a late row has
    joined to an earlier one. A session leaves the state when the watermark passes its end; rows older than the
    watermark are dropped.
    """
    ship_package(readings.sparkSession)
    gap = gap_seconds * 1_000_000
    d = readings.filter(F.col(ts).isNotNull()).withWatermark(ts, watermark).select(*keys, ts, F.unix_micros(ts).alias("_at"))
    names = [*keys, "_start", "_end", "n"]
    out = T.StructType([*(d.schema[k] for k in keys), *(T.StructField(c, T.LongType()) for c in names[len(keys) :])])

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before: list[Span] = list(zip(*state.get, strict=True)) if state.exists else []
        spans = before
        if not state.hasTimedOut:
            for pdf in batches:
                spans = merge_spans(spans, pdf["_at"].to_numpy(np.int64), gap)
        known, now = {s[0]: s for s in before}, {s[0]: s for s in spans}
        changed = [(*key, a, b + gap, n) for a, b, n in spans if known.get(a) != (a, b, n)]
        changed += [(*key, a, b + gap, 0) for a, b, n in before if a not in now]
        mark = state.getCurrentWatermarkMs()
        kept = [s for s in spans if s[1] + gap > mark * 1000]
        if kept:
            state.update(tuple([list(x) for x in zip(*kept, strict=True)]))
            state.setTimeoutTimestamp(max(mark + 1, (max(s[1] for s in kept) + gap) // 1000 + 1))
        elif state.exists:
            state.remove()
        if changed:
            yield pd.DataFrame(changed, columns=names)

    lists = "starts array<long>, ends array<long>, counts array<long>"
    got = d.groupBy(*keys).applyInPandasWithState(update, out, lists, "update", GroupStateTimeout.EventTimeTimeout)
    return got.select(*keys, F.timestamp_micros("_start").alias("start_dt"), F.timestamp_micros("_end").alias("end_dt"), "n")


def alarm_states(classified: DataFrame, keys: list[str], order: list[str], trigger: str = "trigger") -> DataFrame:
    """Adds ``trigger_reduced``: only the first Alarm of a run sends a message, across micro-batches.

    The state is a key's newest trigger. Batches are expected in the order of ``order``, as the batch form of this
    operator does. A key's rows of a micro-batch are held as Arrow columns without the key and leave in slices of
    ``SLICE`` rows, so Python holds little more than the columns' own bytes.
    """
    ship_package(classified.sparkSession)
    out = T.StructType([*classified.schema.fields, T.StructField("trigger_reduced", T.StringType())])
    rest = [c for c in classified.columns if c not in keys]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        import pyarrow.compute as pc

        held, own = [], {}
        for pdf in batches:
            own = own or {k: pdf[k].iloc[0] for k in keys}
            held.append(pa.Table.from_pandas(pdf[rest], preserve_index=False))
        table = pa.concat_tables(held, promote_options="permissive")
        place = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in order]).to_numpy()
        del held
        last = state.get[0] if state.exists else None
        for i in range(0, len(place), SLICE):
            part = table.take(pa.array(place[i : i + SLICE])).to_pandas().assign(**own)
            now = part[trigger].astype(object).where(part[trigger].notna(), None)
            filled = now.ffill()
            previous = filled.shift(1).where(filled.shift(1).notna(), last)
            part["trigger_reduced"] = now.mask((now == "Alarm") & (previous == "Alarm"), "Alarm_no_message")
            last = last if pd.isna(filled.iloc[-1]) else filled.iloc[-1]
            yield part[out.names]
        state.update((last,))

    return classified.groupBy(*keys).applyInPandasWithState(step, out, "trigger string", "append", GroupStateTimeout.NoTimeout)

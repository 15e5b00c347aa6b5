"""Streams agree with the batch operators."""

import pytest
from pyspark.sql import functions as F

from helpers import at
from sensorqc import Series
from sensorqc.operators import grid, reporting as rp
from sensorqc.plans.chunks import time_chunk
from sensorqc.session import materialise, work_dir
from sensorqc.sources.store import SeriesStore
from sensorqc.streaming import incremental as inc, live, stateful


@pytest.fixture(scope="module")
def files(spark):
    """Readings landing in five files, one after the other."""
    d = spark.range(1000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 4).cast("string"))).alias("site"),
        F.lit("DO").alias("parameter"),
        F.timestamp_seconds(F.lit(1709251200) + F.col("id") * 700).alias("ts"),
        F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("value"),
    )
    path = work_dir(spark, "landing")
    for i in range(5):
        d.filter(F.col("id").between(i * 200, i * 200 + 199)).coalesce(1).write.mode("append").parquet(path)
    return path, spark.read.parquet(path)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_slots(spark, files):
    path, batch = files
    got = live.run_to_table(live.slot_stream(live.read_files(spark, path, batch.schema, files_per_trigger=1), 3600), "t")
    last = batch.agg(F.max("ts")).first()[0].timestamp() + 1800 - 86400
    want = grid.slot_aggregate(batch, Series(step=3600), "ts").filter(F.unix_seconds("dt_round") + 3600 <= last)
    assert rows(got, "site", "dt_round", "n_obs", "mean") == rows(want, "site", "dt_round", "n_obs", "mean")


def test_slots_still_open_over_several_batches(spark, files):
    path, batch = files
    slots = live.slot_stream(live.read_files(spark, path, batch.schema, files_per_trigger=1), 3600)
    got = live.run_updates(slots, "u", ["site", "parameter", "dt_round"])
    want = grid.slot_aggregate(batch, Series(step=3600), "ts")
    assert rows(got, "site", "dt_round", "n_obs", "mean") == rows(want, "site", "dt_round", "n_obs", "mean")


def test_sessions_written_and_open_make_all(spark, files):
    path, batch = files
    readings = live.read_files(spark, path, batch.schema, files_per_trigger=1)
    done = live.run_to_table(live.session_stream(readings, "40 minutes", ["site"]), "s")
    still = live.open_sessions(batch, done, "40 minutes", ["site"])
    whole = batch.groupBy("site", F.session_window("ts", "40 minutes")).agg(F.count(F.lit(1)).alias("n"))
    want = whole.select("site", F.col("session_window.start").alias("start_dt"), F.col("session_window.end").alias("end_dt"), "n")
    assert still.count() > 0
    assert rows(done.unionByName(still), "site", "start_dt", "end_dt", "n") == rows(want, "site", "start_dt", "end_dt", "n")


def test_alarms_across_batches(spark, files):
    path, batch = files
    limits = batch.select("site").distinct().withColumns({"warning": F.lit(40.0), "alarm": F.lit(50.0)})
    classify = lambda b: rp.classify_alarms(b, limits, "value")
    got = live.alarm_stream(live.read_files(spark, path, batch.schema, files_per_trigger=1), classify, ["site"], ["ts", "id"])
    want = rp.suppress_alarms(classify(batch), ["site"], ["ts", "id"], time_chunk("ts", 86400))
    assert rows(got, "id", "trigger_reduced") == rows(want, "id", "trigger_reduced")
    assert got.filter("trigger_reduced = 'Alarm_no_message'").count() > 50


def test_duplicates_are_dropped(spark, files):
    path, batch = files
    s = live.read_files(spark, path, batch.schema)
    assert live.run_to_table(live.dedupe_stream(s.unionByName(s), ["id"]), "t").count() == 1000


def test_restate_keeps_untouched_series(spark):
    def frame(sites, slots, flag):
        return spark.createDataFrame([(s, "DO", at(i), flag) for s in sites for i in slots], "site string, parameter string, dt_round timestamp, flag string")

    out = inc.restate_tail(frame("ab", range(200), "old"), frame("a", range(103, 210), "new"), Series())
    assert out.filter("site = 'b' and flag = 'old'").count() == 200
    assert out.filter("site = 'a' and flag = 'old'").count() == 103
    assert out.filter("site = 'a' and flag = 'new'").count() == 107


def test_materialised_table_is_in_the_shared_folder(spark):
    d = materialise(spark.range(5), "t")
    assert d.count() == 5 and "sensorqc" in d.inputFiles()[0]


def first_files(spark, batch, parts):
    """A landing folder with the first of ten files, and a way to add the next ones."""
    path = work_dir(spark, "growing")

    def land(n):
        for i in range(land.done, land.done + n):
            batch.filter(F.col("id").between(i * 100, i * 100 + 99)).coalesce(1).write.mode("append").parquet(path)
        land.done += n

    land.done = 0
    land(parts)
    return path, land


def test_sessions_from_state_go_on_after_a_restart(spark, files):
    _, batch = files
    path, land = first_files(spark, batch, 4)
    place, keys = work_dir(spark, "session-restart"), ["site", "start_dt"]

    def run():
        readings = live.read_files(spark, path, batch.schema, files_per_trigger=1)
        return live.run_updates(stateful.session_updates(readings, 2400, ["site"]), "s", keys, place).filter("n > 0")

    def want(rows_):
        whole = rows_.groupBy("site", F.session_window("ts", "40 minutes")).agg(F.count(F.lit(1)).alias("n"))
        return whole.select("site", F.col("session_window.start").alias("start_dt"), F.col("session_window.end").alias("end_dt"), "n")

    cols = ["site", "start_dt", "end_dt", "n"]
    assert rows(run(), *cols) == rows(want(batch.filter("id < 400")), *cols)
    land(6)  # the cut lies within a session of the dense site
    assert rows(run(), *cols) == rows(want(batch), *cols)


def test_late_rows_join_sessions(spark):
    assert stateful.merge_spans([(0, 10, 3), (30, 40, 2)], stateful.np.array([20, 45]), 11) == [(0, 45, 7)]
    assert stateful.merge_spans([(0, 10, 3)], stateful.np.array([21, 21]), 11) == [(0, 10, 3), (21, 21, 2)]
    assert stateful.merge_spans([], stateful.np.array([], "int64"), 5) == []
    batch = spark.createDataFrame([(i, "a", "DO", at(m, 1), 1.0) for i, m in enumerate([0, 10, 60, 70, 35])], "id long, site string, parameter string, ts timestamp, value double")
    path = work_dir(spark, "late")
    for i in range(5):
        batch.filter(F.col("id") == i).coalesce(1).write.mode("append").parquet(path)
    changes = stateful.session_updates(live.read_files(spark, path, batch.schema, files_per_trigger=1), 1800, ["site"])
    got = live.run_updates(changes, "late", ["site", "start_dt"]).filter("n > 0").collect()
    assert [(r.n, (r.end_dt - r.start_dt).total_seconds()) for r in got] == [(5, 70 * 60 + 1800)]


def test_alarms_from_state_go_on_after_a_restart(spark, files):
    _, batch = files
    path, land = first_files(spark, batch, 3)
    limits = batch.select("site").distinct().withColumns({"warning": F.lit(40.0), "alarm": F.lit(50.0)})
    place = work_dir(spark, "alarm-restart")

    def run():
        classified = rp.classify_alarms(live.read_files(spark, path, batch.schema, files_per_trigger=1), limits, "value")
        return live.run_to_table(stateful.alarm_states(classified, ["site"], ["ts", "id"]), "a", place)

    assert run().count() == 300
    land(7)
    want = rp.suppress_alarms(rp.classify_alarms(batch, limits, "value"), ["site"], ["ts", "id"], time_chunk("ts", 86400))
    assert rows(run(), "id", "trigger_reduced") == rows(want, "id", "trigger_reduced")


def test_alarms_from_state_leave_in_slices_and_keep_gaps(spark):
    """Rows come out of order and partly without a trigger; no more than a slice is a pandas table at a time."""
    import random
    from types import SimpleNamespace

    import pandas as pd

    made = {}
    d = spark.createDataFrame([], "site string, id long, note string, trigger string")
    catch = SimpleNamespace(applyInPandasWithState=lambda step, *_: made.setdefault("step", step))
    stub = SimpleNamespace(sparkSession=spark, schema=d.schema, columns=d.columns, groupBy=lambda *_: catch)
    stateful.alarm_states(stub, ["site"], ["id"])
    r = random.Random(2)
    n = 2 * stateful.SLICE + 5
    triggers = [r.choice(["Alarm", "Alarm", "Warning", "None", None]) for _ in range(n)]
    ids = r.sample(range(n), n)
    whole = pd.DataFrame({"site": "a", "id": ids, "note": None, "trigger": [triggers[i] for i in ids]})
    kept = []
    state = SimpleNamespace(exists=True, get=("Alarm",), update=kept.append)
    parts = list(made["step"](("a",), iter([whole[:100], whole[100:]]), state))
    assert max(map(len, parts)) <= stateful.SLICE
    got = pd.concat(parts)
    last, want = "Alarm", []
    for t in triggers:
        want.append("Alarm_no_message" if t == last == "Alarm" else t)
        last = t or last
    assert got["id"].tolist() == list(range(n)) and list(got.columns) == [*d.columns, "trigger_reduced"]
    assert [None if x is None or x != x else x for x in got["trigger_reduced"]] == want and kept == [(last,)]


def test_store_replaces_only_touched_partitions(spark):
    def frame(sites, days, flag):
        return spark.createDataFrame([(s, "DO", at(d, 1440), flag) for s in sites for d in days], "site string, parameter string, dt_round timestamp, flag string")

    names = lambda store: {f.split("/data/")[1] for f in store.read().inputFiles()}
    content = lambda store: sorted(tuple(r) for r in store.read().collect())
    old, new = frame("ab", range(0, 306, 3), "old"), frame("a", range(303, 320, 4), "new")  # the year ends at day 306
    store = SeriesStore(spark, work_dir(spark, "store"), old.schema).create(old)
    before = names(store)
    store.restate(new, "b1", overlap=2 * 86400)
    want = sorted(tuple(r) for r in inc.restate_tail(old, new, Series(), 2 * 86400).collect())
    assert content(store) == want and len(names(store)) == 3
    assert {n for n in names(store) if "site=b" in n} == {n for n in before if "site=b" in n}
    after = names(store)
    store.restate(new, "b1", overlap=2 * 86400)  # done: nothing happens
    assert names(store) == after
    # broken off between staging and replacing: the same rows again, though the store has moved on
    store._note("b2", "staged")
    spark.read.parquet(f"{store.path}/_staged/batch=b1").write.parquet(f"{store.path}/_staged/batch=b2")
    store.restate(new.limit(0), "b2")
    assert content(store) == want
    # a tail that goes without new rows leaves an empty partition
    late = frame("c", [305, 307], "old")
    store.append(late, "b3")
    store.append(late, "b4")
    assert content(store) == sorted(want + [tuple(r) for r in late.collect()])
    store.restate(frame("c", [306 - 1], "new"), "b5", overlap=2 * 86400)
    assert [tuple(r)[3] for r in store.read().filter("site = 'c'").collect()] == ["new"]


def test_work_tables_can_be_removed(spark):
    from pathlib import Path

    from sensorqc.session import build_session, clear_work

    folder = Path(work_dir(spark, "x")).parent
    assert folder.name == spark.sparkContext.applicationId and getattr(build_session().sparkContext, "_sensorqc_shipped", False)
    materialise(spark.range(3), "gone").count()
    elsewhere = folder.parent / f"another-{folder.name}"
    elsewhere.mkdir(exist_ok=True)
    clear_work(spark)
    assert not folder.exists() and elsewhere.exists()
    elsewhere.rmdir()

"""Incremental and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorqc.catalog.fixtures import PARAMETERS, S, STEP, slot_sql
from sensorqc.catalog.q_reporting import SUPPRESSED, limits
from sensorqc.catalog.registry import query
from sensorqc.operators import reporting as rp
from sensorqc.streaming import incremental as inc, live, stateful

KEYS = ["site", "parameter", "dt_round"]
CUT = "2024-01-20"


def stream(t):
    """The events file as a stream of readings."""
    schema = t.spark.read.parquet(f"{t.dir}/events.parquet").schema
    e = live.read_files(t.spark, f"{t.dir}/events*.parquet", schema)
    parameter = F.lit(None).cast("string")
    for event, name in PARAMETERS.items():
        parameter = F.when(F.col("event_type") == event, F.lit(name)).otherwise(parameter)
    site = F.concat(F.lit("s"), F.lpad((F.col("user_id") % 15).cast("string"), 2, "0"))
    return e.select(F.col("event_id").alias("id"), site.alias("site"), parameter.alias("parameter"), "ts", "value")


@query("x01_high_water_mark", "SELECT site, min(m) AS pull_from FROM (SELECT site, parameter, max(dt_round) AS m FROM fx_slots GROUP BY 1, 2) GROUP BY 1")
def _(t):
    return inc.high_water_marks(t.slots)


@query(
    "x02_overlap_combine",
    f"""WITH h AS (SELECT site, parameter, dt_round, mean, sonde_employed FROM fx_state WHERE dt_round < TIMESTAMP '{CUT}'), n AS (SELECT site, parameter, dt_round, mean FROM fx_slots WHERE dt_round >= TIMESTAMP '{CUT}' - INTERVAL 12 HOUR),
      tl AS (SELECT h.* FROM h JOIN (SELECT site, parameter, max(dt_round) AS m FROM h GROUP BY 1, 2) x ON x.site = h.site AND x.parameter = h.parameter WHERE h.dt_round >= m - INTERVAL 1 DAY),
      b AS (SELECT site, parameter, dt_round, mean, sonde_employed, true AS historical FROM tl UNION ALL SELECT site, parameter, dt_round, mean, NULL, false FROM n WHERE (site, parameter, dt_round) NOT IN (SELECT (site, parameter, dt_round) FROM tl))
    SELECT site, parameter, dt_round, @mean, historical, last_value(sonde_employed IGNORE NULLS) OVER (PARTITION BY site, parameter ORDER BY dt_round) AS sonde_employed FROM b""",
)
def _(t):
    h = t.state.filter(f"dt_round < '{CUT}'").select(*KEYS, "mean", "sonde_employed")
    n = t.slots.filter(F.col("dt_round") >= F.expr(f"timestamp '{CUT}' - interval 12 hours")).select(*KEYS, "mean")
    return inc.overlap_combine(h, n, S, ["sonde_employed"])


RESTATED = f"""WITH h AS (SELECT site, parameter, dt_round, mean, 'old' AS flag FROM fx_slots WHERE dt_round < TIMESTAMP '{CUT}'), m AS (SELECT site, parameter, max(dt_round) AS m FROM h GROUP BY 1, 2),
      n AS (SELECT site, parameter, dt_round, mean, 'new' AS flag FROM fx_slots JOIN m USING (site, parameter) WHERE dt_round >= m - INTERVAL 1 DAY AND site <> 's04')
    SELECT site, parameter, dt_round, @mean, flag FROM h JOIN m USING (site, parameter) WHERE dt_round < m - INTERVAL 1 DAY OR site = 's04' UNION ALL SELECT site, parameter, dt_round, @mean, flag FROM n"""


def _tails(t):
    h = t.slots.filter(f"dt_round < '{CUT}'").select(*KEYS, "mean", F.lit("old").alias("flag"))
    last = h.groupBy("site", "parameter").agg(F.max("dt_round").alias("_m"))
    n = t.slots.filter("site <> 's04'").join(last, ["site", "parameter"]).filter(F.col("dt_round") >= F.col("_m") - F.expr("interval 1 day"))
    return h, n.select(*KEYS, "mean", F.lit("new").alias("flag"))


@query("x03_restate_tail", RESTATED)
def _(t):
    return inc.restate_tail(*_tails(t), S)


@query("x03_restate_store", RESTATED)
def _(t):
    from sensorqc.session import work_dir
    from sensorqc.sources.store import SeriesStore

    h, n = _tails(t)
    store = SeriesStore(t.spark, work_dir(t.spark, "history"), h.schema).create(h)
    store.restate(n, "tail")
    return store.read()


@query(
    "x04_slot_stream",
    "SELECT site, parameter, dt_round, @mean, @spread, n_obs FROM fx_slots",
)
def _(t):
    return live.run_updates(live.slot_stream(stream(t), STEP), "slots", ["site", "parameter", "dt_round"])


@query("x05_dedupe_stream", "SELECT id, site, parameter, ts, @value FROM fx_readings")
def _(t):
    twice = stream(t).unionByName(stream(t))
    return live.run_to_table(live.dedupe_stream(twice, ["id"]), "dedupe")


SESSIONS = """WITH g AS (SELECT *, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 21600000000, true)::INT AS nw FROM fx_readings WINDOW w AS (PARTITION BY site, parameter ORDER BY ts)),
      s AS (SELECT *, sum(nw) OVER (PARTITION BY site, parameter ORDER BY ts) AS sid FROM g)
    SELECT site, parameter, min(ts) AS start_dt, max(ts) + INTERVAL 6 HOUR AS end_dt, count(*) AS n FROM s GROUP BY site, parameter, sid"""


@query("x06_session_state", SESSIONS)
def _(t):
    keys = ["site", "parameter"]
    changes = stateful.session_updates(stream(t), 6 * 3600, keys)
    return live.run_updates(changes, "session-state", [*keys, "start_dt"]).filter("n > 0")


@query("x06_gap_sessions", SESSIONS)
def _(t):
    keys = ["site", "parameter"]
    done = live.run_to_table(live.session_stream(stream(t), "6 hours", keys), "sessions")
    return done.unionByName(live.open_sessions(t.readings, done, "6 hours", keys))


@query("x07_alarm_state", SUPPRESSED)
def _(t):
    classified = rp.classify_alarms(stream(t), limits(t), "value").select("id", "site", "ts", "trigger")
    return live.run_to_table(stateful.alarm_states(classified, ["site"], ["ts", "id"]), "alarm-state")


@query("x07_alarm_stream", SUPPRESSED)
def _(t):
    fixed = limits(t)
    out = live.alarm_stream(stream(t), lambda b: rp.classify_alarms(b, fixed, "value"), ["site"], ["ts", "id"], chunk_seconds=6 * 3600)
    return out.select("id", "site", "ts", "trigger", "trigger_reduced")


@query(
    "x08_late_rows",
    f"""WITH m AS (SELECT site, max(ts) AS m FROM fx_readings WHERE ts < TIMESTAMP '{CUT}' GROUP BY 1) SELECT r.id, r.site, r.ts, coalesce(ts < m - INTERVAL 1 DAY, false) AS is_late FROM fx_readings r LEFT JOIN m USING (site)""",
)
def _(t):
    return inc.split_late(t.readings.select("id", "site", "ts"), t.readings.filter(f"ts < '{CUT}'"), "ts")


@query(
    "x09_flag_stream",
    f"""SELECT r.id, r.site, r.parameter, r.ts, nullif(concat_ws(';' || chr(10), CASE WHEN v.site IS NOT NULL THEN 'site visit' END, CASE WHEN value < lo OR value > hi THEN 'outside of sensor specification range' END), '') AS flag
    FROM (SELECT *, {slot_sql('ts')} AS dt_round FROM fx_readings) r JOIN fx_spec USING (parameter) LEFT JOIN fx_visit_slots v ON v.site = r.site AND v.dt_round = r.dt_round""",
)
def _(t):
    flagged = live.flag_stream(stream(t), t.spec, t.visits, STEP)
    return live.run_to_table(flagged.select("id", "site", "parameter", "ts", "flag"), "flags")

"""Visit, join and network queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorqc.catalog.fixtures import S, STEP, slot_sql
from sensorqc.catalog.registry import query
from sensorqc.functions import time as tm
from sensorqc.operators import visits as vz
from sensorqc.plans.chunks import carry, time_chunk
from sensorqc.plans.joins import asof_join, nearest_join

CHUNK = 6 * 3600


@query("j01_select_visits", "SELECT visit_id, site, start_dt, visit_type FROM fx_visits WHERE regexp_matches(lower(visit_type), 'sensor cleaning or check|sensor calibration')")
def _(t):
    return vz.select_visits(t.visits).select("visit_id", "site", "start_dt", "visit_type")


@query(
    "j02_deployment_state",
    "SELECT visit_id, CASE WHEN sensor_pulled IS NOT NULL AND sensor_deployed IS NULL THEN 1 ELSE 0 END AS sonde_employed FROM fx_visits",
)
def _(t):
    return t.visits.select("visit_id", vz.deployment_state().alias("sonde_employed"))


@query("j03_join_visits", "SELECT site, parameter, dt_round, has_visit, on_grid, @mean FROM fx_state")
def _(t):
    return t.state.select("site", "parameter", "dt_round", "has_visit", "on_grid", "mean")


@query("j04_ffill_state", "SELECT site, parameter, dt_round, sonde_employed, last_site_visit FROM fx_state")
def _(t):
    return t.state.select("site", "parameter", "dt_round", "sonde_employed", "last_site_visit")


@query(
    "j05_fill_pre_post",
    """WITH v AS (SELECT site, parameter, dt_round, avg(pre_clean) AS pre_clean, avg(post_clean) AS post_clean FROM fx_visits GROUP BY 1, 2, 3)
    SELECT s.site, s.parameter, s.dt_round, round(last_value(v.pre_clean IGNORE NULLS) OVER w, 6) AS pre_clean, round(last_value(v.post_clean IGNORE NULLS) OVER w, 6) AS post_clean
    FROM fx_series s LEFT JOIN v ON v.site = s.site AND v.parameter = s.parameter AND v.dt_round = s.dt_round
    WINDOW w AS (PARTITION BY s.site, s.parameter ORDER BY s.dt_round)""",
)
def _(t):
    v = t.visits.groupBy("site", "parameter", "dt_round").agg(F.avg("pre_clean").alias("pre_clean"), F.avg("post_clean").alias("post_clean"))
    d = t.series.select("site", "parameter", "dt_round").join(v, ["site", "parameter", "dt_round"], "left")
    return vz.fill_down(d, S, ["pre_clean", "post_clean"])


LONG_SQL = """SELECT visit_id, site, CASE WHEN event_code = 'orp' THEN 'ORP' WHEN event_code = 'turb' THEN 'Turbidity' ELSE 'DO' END AS parameter, type, value FROM (
  SELECT visit_id, site, 'turb' AS event_code, 'pre_clean' AS type, pre_clean AS value FROM fx_visits
  UNION ALL SELECT visit_id, site, 'turb', 'post_clean', post_clean FROM fx_visits WHERE sensor_pulled IS NOT NULL
  UNION ALL SELECT visit_id, site, 'orp', 'pre_clean', pre_clean * 10 FROM fx_visits
  UNION ALL SELECT visit_id, site, 'orp', 'post_clean', post_clean * 10 FROM fx_visits
  UNION ALL SELECT visit_id, site, 'do', 'post_cal', pre_clean + 1 FROM fx_visits)"""


def _long(t):
    v = t.visits.select(
        "visit_id",
        "site",
        F.col("pre_clean").alias("turb_pre_clean"),
        F.when(F.col("sensor_pulled").isNotNull(), F.col("post_clean")).alias("turb_post_clean"),
        (F.col("pre_clean") * 10).alias("orp_pre_clean"),
        (F.col("post_clean") * 10).alias("orp_post_clean"),
        (F.col("pre_clean") + 1).alias("do_post_cal"),
    )
    return vz.measurements_long(v, ["visit_id", "site"], v.columns[2:], {"turb": "Turbidity", "orp": "ORP", "do": "DO"})


@query("j06_measurements_long", f"SELECT visit_id, site, parameter, type, @value FROM ({LONG_SQL})")
def _(t):
    return _long(t)


@query(
    "j07_pre_post_pairs",
    f"""SELECT visit_id, site, parameter, round(max(CASE WHEN parameter = 'ORP' THEN value / 1000 ELSE value END) FILTER (type = 'pre_clean'), 6) AS pre_clean,
      round(max(CASE WHEN parameter = 'ORP' THEN value / 1000 ELSE value END) FILTER (type = 'post_clean'), 6) AS post_clean
    FROM ({LONG_SQL}) GROUP BY 1, 2, 3 HAVING count(*) FILTER (type = 'pre_clean') > 0 AND count(*) FILTER (type = 'post_clean') > 0""",
)
def _(t):
    return vz.pre_post_pairs(_long(t), ["visit_id", "site"])


@query(
    "j08_hours_since_cleaning",
    "SELECT site, parameter, dt_round, round((epoch(dt_round) - epoch(last_site_visit)) / 3600.0, 6) AS hours_since_cleaning FROM fx_state",
)
def _(t):
    return vz.hours_since_cleaning(t.state).select("site", "parameter", "dt_round", "hours_since_cleaning")


@query(
    "j09_visit_groups",
    "SELECT site, parameter, dt_round, CAST(sum(has_visit::INT) OVER (PARTITION BY site, parameter ORDER BY dt_round) AS BIGINT) AS visit_group FROM fx_state",
)
def _(t):
    return vz.visit_groups(t.state, S, F.col("has_visit")).select("site", "parameter", "dt_round", "visit_group")


@query("j10_malfunction_records", "SELECT visit_id, site, start_dt FROM fx_visits WHERE visit_type = 'Sensor malfunction'")
def _(t):
    return vz.malfunctions(t.visits).select("visit_id", "site", "start_dt")


@query(
    "j11_qc_samples",
    """WITH s AS (SELECT o_orderkey, 's' || lpad(CAST(o_custkey % 15 AS VARCHAR), 2, '0') AS site,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'DUPLICATE' WHEN '2-HIGH' THEN 'BLANK' ELSE 'GRAB' END AS sample_type FROM orders)
    SELECT s.*, CASE WHEN sample_type IN ('DUPLICATE', 'BLANK') THEN s.site || '_' || lower(sample_type) ELSE s.site END AS label, pos FROM s LEFT JOIN fx_network n ON n.site = s.site""",
)
def _(t):
    p = F.col("o_orderpriority")
    s = t.table("orders").select(
        "o_orderkey",
        F.concat(F.lit("s"), F.lpad((F.col("o_custkey") % 15).cast("string"), 2, "0")).alias("site"),
        F.when(p == "1-URGENT", "DUPLICATE").when(p == "2-HIGH", "BLANK").otherwise("GRAB").alias("sample_type"),
    )
    return vz.split_qc_samples(s, t.network.select("site", "pos"))


@query(
    "j12_missing_artifacts",
    """SELECT id, 'report_' || id AS file_name, CASE WHEN k < 60 THEN 'Yes' ELSE 'no' END AS collected,
      CASE WHEN k < 60 THEN 'missing' ELSE 'user error' END AS status FROM fx_events WHERE (k < 60) <> (user_id % 3 <> 0)""",
)
def _(t):
    name = F.concat(F.lit("report_"), F.col("id").cast("string")).alias("file_name")
    expected = t.events.select("id", name, F.when(F.col("k") < 60, "Yes").otherwise("no").alias("collected"))
    return vz.missing_artifacts(expected, t.events.filter("user_id % 3 <> 0").select(name))


@query(
    "j13_current_location",
    """WITH r AS (SELECT site, date_trunc('day', ts) AS report_time, user_id AS serial FROM fx_events),
      n AS (SELECT * FROM r JOIN (SELECT site, max(report_time) AS report_time FROM r GROUP BY 1) USING (site, report_time)),
      p AS (SELECT serial, max(site) AS location FROM n GROUP BY 1),
      i AS (SELECT DISTINCT user_id AS serial, CASE WHEN user_id % 4 = 0 THEN 'partner' END AS owner FROM fx_events)
    SELECT serial, owner, coalesce(location, CASE WHEN owner IS NOT NULL THEN 'Lent Out' ELSE 'Lab' END) AS location FROM i LEFT JOIN p USING (serial)""",
)
def _(t):
    reports = t.events.select("site", F.date_trunc("day", "ts").alias("report_time"), F.col("user_id").alias("serial"))
    inventory = t.events.select(F.col("user_id").alias("serial"), F.when(F.col("user_id") % 4 == 0, "partner").alias("owner")).distinct()
    return vz.current_locations(reports, inventory)


SWAP_SQL = """SELECT id, site, parameter, ts AS swap_time, id AS deployed,
  CASE WHEN user_id % 10 = 0 THEN -1 ELSE lag(id, 1, 0) OVER w END AS removed, lag(id) OVER w AS expected, lead(ts) OVER w AS until
  FROM fx_events WHERE k BETWEEN 40 AND 49 WINDOW w AS (PARTITION BY site, parameter ORDER BY ts)"""


def _swaps(t):
    e = t.events.filter("k between 40 and 49").select("id", "site", "parameter", "user_id", F.col("ts").alias("swap_time"), F.col("id").alias("deployed"))
    e = carry(e, ["site", "parameter"], time_chunk("swap_time", CHUNK), ["swap_time", "id"], fills={"_b": F.col("id")}, exclusive=True)
    removed = F.when(F.col("user_id") % 10 == 0, -1).otherwise(F.coalesce("_b", F.lit(0)))
    return e.withColumn("removed", removed.cast("long")).drop("_b", "user_id")


@query(
    "j14_swap_audit",
    f"SELECT id, site, parameter, swap_time, coalesce(expected, -5) AS expected, coalesce(expected IS NOT NULL AND removed <> expected, false) AS mismatch FROM ({SWAP_SQL})",
)
def _(t):
    out = vz.swap_audit(_swaps(t), ["site", "parameter"], chunk_seconds=CHUNK)
    return out.select("id", "site", "parameter", "swap_time", F.coalesce("expected", F.lit(-5)).alias("expected"), "mismatch")


@query("j14_swap_history", f"SELECT site, parameter, deployed AS serial, swap_time AS since, until, until IS NULL AS is_current FROM ({SWAP_SQL})")
def _(t):
    return vz.swap_history(_swaps(t), ["site", "parameter"], chunk_seconds=CHUNK)


@query(
    "j15_metadata_range_join",
    """SELECT r.id, r.site, r.ts, m.label FROM fx_readings r LEFT JOIN fx_metadata m ON m.site = r.site
      AND r.ts BETWEEN m.data_start - INTERVAL 1 DAY AND m.data_end + INTERVAL 1 DAY""",
)
def _(t):
    return vz.metadata_join(t.readings.select("id", "site", "ts"), t.metadata, "ts", CHUNK).select("id", "site", "ts", "label")


@query(
    "j16_asof_join",
    """SELECT r.id, r.site, r.parameter, r.ts, c.sensor_date, round(c.slope, 6) AS slope FROM fx_readings r
    ASOF LEFT JOIN fx_calibrations c ON c.site = r.site AND c.parameter = r.parameter AND r.ts >= c.sensor_date""",
)
def _(t):
    r = t.readings.select("id", "site", "parameter", "ts")
    c = t.calibrations.withColumn("t", F.col("sensor_date"))
    return asof_join(r, c, ["site", "parameter"], "ts", "t", ["sensor_date", "slope"], CHUNK)


@query(
    "j17_nearest_join",
    """WITH x AS (SELECT r.id, r.ts, v.start_dt, v.visit_id, row_number() OVER (PARTITION BY r.id ORDER BY abs(epoch_us(r.ts) - epoch_us(v.start_dt)), v.start_dt) AS rn
      FROM fx_readings r JOIN fx_visits v ON v.site = r.site)
    SELECT id, start_dt AS nearest_dt, visit_id FROM x WHERE rn = 1""",
)
def _(t):
    v = t.visits.select("site", F.col("start_dt").alias("nearest_dt"), "visit_id")
    return nearest_join(t.readings.select("id", "site", "ts"), v, ["site"], "ts", "nearest_dt", ["nearest_dt", "visit_id"], CHUNK).drop("site", "ts")


@query(
    "j18_media_slots",
    f"""WITH m AS (SELECT site, date_trunc('second', ts) AS taken, {slot_sql("date_trunc('second', ts)", True)} AS dt_round, id FROM fx_events WHERE event_type = 'view'),
      f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site, dt_round ORDER BY taken, id) AS rn FROM m) WHERE rn = 1)
    SELECT s.site, s.dt_round, s.parameter, f.taken, f.id FROM fx_slots s JOIN f ON f.site = s.site AND f.dt_round = s.dt_round""",
)
def _(t):
    name = F.concat("site", F.lit("_"), F.date_format("ts", "yyyyMMdd-HHmmss"), F.lit("_"), F.lpad(F.col("id").cast("string"), 12, "0"), F.lit(".jpg"))
    m = t.events.filter("event_type = 'view'").select("site", "id", name.alias("name"))
    media = vz.media_slots(m, "name", r"_(\d{8}-\d{6})_", "yyyyMMdd-HHmmss", STEP)
    return t.slots.select("site", "dt_round", "parameter").join(media.drop("name"), ["site", "dt_round"])


@query(
    "j19_neighbours",
    "SELECT network, pos, site, lag(site) OVER (PARTITION BY network ORDER BY pos) AS upstream, lead(site) OVER (PARTITION BY network ORDER BY pos) AS downstream FROM fx_network",
)
def _(t):
    return vz.chain_neighbours(t.network)


@query("j19_neighbour_pairs", "SELECT site, neighbour FROM fx_pairs")
def _(t):
    return t.pairs


@query(
    "j20_gauge_slice",
    """WITH b AS (SELECT site, min(dt_round) + INTERVAL 10 DAY AS lo, max(dt_round) - INTERVAL 10 DAY AS hi FROM fx_slots GROUP BY 1)
    SELECT r.id, r.site, 'g' || r.site AS gauge, r.ts, round(r.value, 6) AS value FROM fx_readings r JOIN b ON b.site = r.site WHERE r.ts BETWEEN lo - INTERVAL 2 DAY AND hi + INTERVAL 2 DAY""",
)
def _(t):
    gauge = F.concat(F.lit("g"), "site").alias("gauge")
    ten = 10 * 86400
    bounds = t.slots.groupBy("site").agg(tm.shift(F.min("dt_round"), ten).alias("first_dt"), tm.shift(F.max("dt_round"), -ten).alias("last_dt"))
    return vz.gauge_slice(t.readings.select("id", gauge, "ts", "value"), t.sites.select("site", gauge), bounds, "ts")


@query(
    "j21_alias_replication",
    "SELECT visit_id, site, start_dt FROM fx_visits UNION ALL SELECT visit_id, site || '_virridy', start_dt FROM fx_visits WHERE site IN ('s01', 's04', 's09') AND year(start_dt) = 2024",
)
def _(t):
    return vz.replicate_to_alias(t.visits.select("visit_id", "site", "start_dt"), ["s01", "s04", "s09"], 2024)

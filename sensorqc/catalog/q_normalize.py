"""Normalisation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorqc.catalog.fixtures import PARAMETERS, S, STEP
from sensorqc.catalog.registry import query
from sensorqc.functions import time as tm
from sensorqc.operators import normalize as nz

NAMES = sorted(PARAMETERS.values())
P_LIST = ", ".join(f"'{p}'" for p in NAMES)
QUARTER = 900_000_000


@query(
    "n01_round_slot",
    f"""WITH r AS (SELECT id, make_timestamp(CAST(((epoch_us(ts - INTERVAL 7 HOUR) + {QUARTER // 2}) // {QUARTER}) * {QUARTER} AS BIGINT)) AS dt_round FROM fx_readings)
    SELECT id, dt_round, strftime(dt_round, '%Y-%m-%d %H:%M:%S') AS dt_join FROM r""",
)
def _(t):
    return nz.localise(t.readings.select("id", "ts"), "ts").drop("ts")


@query(
    "n02_exclude_names",
    "SELECT doc_id, source, lang FROM documents WHERE NOT coalesce(regexp_matches(lower(source || '/' || lang), 'web|books|/de'), false)",
)
def _(t):
    d = t.table("documents").select("doc_id", "source", "lang", F.concat_ws("/", "source", "lang").alias("name"))
    return nz.exclude_names(d, "name", "web|books|/de").drop("name")


@query(
    "n03_site_alias",
    "SELECT id, CASE site WHEN 's01' THEN 'tamasag' WHEN 's02' THEN 'boxelder' ELSE site END AS site, parameter, @value FROM fx_readings",
)
def _(t):
    aliases = t.sites.withColumn("canonical", F.when(F.col("site") == "s01", "tamasag").when(F.col("site") == "s02", "boxelder"))
    aliases = aliases.filter("canonical is not null").withColumnRenamed("site", "alias")
    return nz.apply_aliases(t.readings, aliases).select("id", "site", "parameter", "value")


@query(
    "n04_site_moves",
    """WITH m AS (SELECT r.id, max_by('moved-' || w.seq, w.seq) AS new_site FROM fx_readings r JOIN fx_windows w ON r.site = w.site AND r.ts BETWEEN w.start_dt AND w.end_dt GROUP BY 1)
    SELECT id, coalesce(new_site, site) AS site, parameter, ts FROM fx_readings LEFT JOIN m USING (id)""",
)
def _(t):
    moves = t.windows.select("site", F.col("start_dt").alias("from_dt"), F.col("end_dt").alias("to_dt"), F.concat(F.lit("moved-"), F.col("seq").cast("string")).alias("new_site"), "seq")
    return nz.move_sites(t.readings.select("id", "site", "parameter", "ts"), moves, "ts", 86400)


@query(
    "n05_owner_suffix",
    """WITH r AS (SELECT id, CASE WHEN user_id % 2 = 0 THEN site || '_virridy' ELSE site END AS site, parameter, ts FROM fx_events),
      w AS (SELECT site || '_virridy' AS site, parameter, start_dt, end_dt FROM fx_windows),
      x AS (SELECT r.*, EXISTS (SELECT 1 FROM w WHERE w.site = r.site AND w.parameter = r.parameter AND r.ts BETWEEN start_dt AND end_dt) AS listed,
        EXISTS (SELECT 1 FROM w WHERE w.site = r.site AND r.ts BETWEEN start_dt AND end_dt) AS inside FROM r)
    SELECT id, CASE WHEN listed THEN replace(site, '_virridy', '') ELSE site END AS site, parameter, ts FROM x WHERE NOT (ends_with(site, '_virridy') AND inside AND NOT listed)""",
)
def _(t):
    site = F.when(F.col("user_id") % 2 == 0, F.concat("site", F.lit("_virridy"))).otherwise(F.col("site"))
    r = t.events.select("id", site.alias("site"), "parameter", "ts")
    rules = t.windows.select(F.concat("site", F.lit("_virridy")).alias("site"), "parameter", F.col("start_dt").alias("from_dt"), F.col("end_dt").alias("to_dt"))
    return nz.merge_owner_suffix(r, rules, "ts", bucket_seconds=86400)


@query("n06_dedupe_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def _(t):
    return nz.dedupe(t.table("lineitem").select("l_partkey", "l_suppkey", "l_returnflag"))


@query(
    "n06_dedupe_keys",
    """SELECT site, parameter, day, id, @value FROM (SELECT *, date_trunc('day', ts) AS day, row_number() OVER (PARTITION BY site, parameter, date_trunc('day', ts) ORDER BY ts, id) AS rn FROM fx_readings) WHERE rn = 1""",
)
def _(t):
    r = t.readings.withColumn("day", F.date_trunc("day", "ts"))
    return nz.dedupe(r, ["site", "parameter", "day"], ["ts", "id"]).drop("ts")


@query(
    "n07_ragged_union",
    """SELECT id, site, @value, CAST(NULL AS VARCHAR) AS visit_type FROM fx_readings
    UNION ALL SELECT visit_id, site, NULL, visit_type FROM fx_visits""",
)
def _(t):
    return nz.stack(t.readings.select("id", "site", "value"), t.visits.select(F.col("visit_id").alias("id"), "site", "visit_type"))


@query(
    "n08_unpivot",
    """SELECT l_orderkey, l_linenumber, variable, round(value, 6) AS value FROM
      (UNPIVOT (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem) ON l_quantity, l_extendedprice, l_discount INTO NAME variable VALUE value)""",
)
def _(t):
    return nz.to_long(t.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice", "l_discount"])


@query(
    "n09_units",
    """SELECT id, CASE event_type WHEN 'click' THEN 'ORP' WHEN 'error' THEN 'Depth' WHEN 'view' THEN 'DO' ELSE 'pH' END AS parameter,
      CASE event_type WHEN 'click' THEN 'V' WHEN 'error' THEN 'm' WHEN 'view' THEN 'mg/L' ELSE 'pH' END AS units,
      round(value * CASE event_type WHEN 'click' THEN 0.001 WHEN 'error' THEN 0.3048 ELSE 1 END, 6) AS value FROM fx_events""",
)
def _(t):
    e = F.col("event_type")
    var = F.when(e == "click", "ORP_mV").when(e == "error", "Depth_ft").when(e == "view", "DO_ppm").otherwise("pH")
    return nz.convert_units(t.events.select("id", var.alias("variable"), "value"))


@query(
    "n10_clock_repair",
    """SELECT o_orderkey, 's' || lpad(CAST(o_custkey % 15 AS VARCHAR), 2, '0') AS site,
      o_orderdate + INTERVAL 1 HOUR * (CASE WHEN year(o_orderdate) % 2 = 0 THEN CASE WHEN o_custkey % 15 < 8 THEN 6 ELSE 7 END ELSE 0 END) AS ts FROM orders""",
)
def _(t):
    site = F.concat(F.lit("s"), F.lpad((F.col("o_custkey") % 15).cast("string"), 2, "0"))
    o = t.table("orders").select("o_orderkey", site.alias("site"), F.col("o_orderdate").alias("ts"))
    rules = o.select("site", F.year("ts").alias("year")).distinct().filter("year % 2 = 0")
    rules = rules.withColumn("hours", F.when(F.col("site") < "s08", 6).otherwise(7))
    return nz.repair_clock(o, rules, "ts")


@query(
    "n11_clock_header",
    """WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate, CASE o_custkey % 5 WHEN 0 THEN 'Date Time (UTC)' WHEN 1 THEN 'Date Time (MST)' WHEN 2 THEN 'Time Offset = -07:00:00'
        WHEN 3 THEN 'Time Offset = -06:00:00' ELSE 'in telemetry device''s time zone' END AS header, max(o_orderdate) OVER (PARTITION BY o_custkey) AS newest FROM orders),
     m AS (SELECT unnest([1992,1993,1994,1995,1996,1997,1998,1999,2000,2001]) AS y),
     d AS (SELECT y, make_timestamp(y, 4, 1, 2, 0, 0) + INTERVAL 1 DAY * ((7 - dayofweek(make_date(y, 4, 1))) % 7) AS s,
       make_timestamp(y, 10, 31, 2, 0, 0) - INTERVAL 1 DAY * dayofweek(make_date(y, 10, 31)) AS e FROM m)
    SELECT o_orderkey, o_custkey, o_orderdate, header, o_orderdate + INTERVAL 1 HOUR * (CASE o_custkey % 5 WHEN 0 THEN -7 WHEN 3 THEN -1 WHEN 4 THEN CASE WHEN newest >= s AND newest < e THEN -1 ELSE 0 END ELSE 0 END) AS dt_mst
    FROM o JOIN d ON y = year(newest)""",
)
def _(t):
    k = F.col("o_custkey") % 5
    header = (
        F.when(k == 0, "Date Time (UTC)")
        .when(k == 1, "Date Time (MST)")
        .when(k == 2, "Time Offset = -07:00:00")
        .when(k == 3, "Time Offset = -06:00:00")
        .otherwise("in telemetry device's time zone")
    )
    o = t.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", header.alias("header"))
    return nz.clock_from_header(o, "header", "o_orderdate", "o_custkey")


@query(
    "n12_drop_outages",
    """SELECT id, site, parameter, ts FROM fx_readings r WHERE NOT EXISTS (SELECT 1 FROM fx_malfunctions m WHERE m.site = r.site AND r.ts BETWEEN m.start_dt AND m.end_dt)""",
)
def _(t):
    return nz.drop_outages(t.readings, t.malfunctions, "ts", 86400).drop("value")


@query(
    "n13_recode_window",
    """SELECT site, parameter, dt_round, CASE WHEN NOT c THEN round(mean, 6) END AS mean, CASE WHEN c THEN 'sensor maintenance' ELSE flag END AS flag FROM
      (SELECT *, EXISTS (SELECT 1 FROM fx_malfunctions m WHERE m.site = s.site AND m.parameter = s.parameter AND s.dt_round BETWEEN m.start_dt AND m.end_dt) AS c FROM fx_flagged s)""",
)
def _(t):
    out = nz.recode_maintenance(t.flagged, t.malfunctions, "dt_round", S.chunk_seconds, "sensor maintenance", on=("site", "parameter"))
    return out.drop("spread", "n_obs")


@query(
    "n14_step_shift",
    """WITH RECURSIVE a AS (SELECT site, parameter, id, ts, value, lead(ts) OVER w AS nt, lead(value) OVER w AS nv, lead(ts, 6) OVER w AS e, k FROM fx_events WINDOW w AS (PARTITION BY site, parameter ORDER BY ts)),
      s AS (SELECT site, parameter, ts AS a1, value AS v1, nt AS a2, nv AS v2, e, row_number() OVER (PARTITION BY site, parameter ORDER BY id) AS n FROM a WHERE k BETWEEN 30 AND 37 AND e IS NOT NULL),
      f AS (SELECT site, parameter, 0 AS n, []::STRUCT(a TIMESTAMP, e TIMESTAMP, d DECIMAL(27, 9))[] AS done FROM s GROUP BY 1, 2
        UNION ALL SELECT f.site, f.parameter, f.n + 1, list_append(done, {'a': a1, 'e': e, 'd':
          abs((v1::DECIMAL(27, 9) + coalesce(list_sum(list_transform(list_filter(done, lambda x: x.a <= a1 AND a1 < x.e), lambda x: x.d)), 0))
            - (v2::DECIMAL(27, 9) + coalesce(list_sum(list_transform(list_filter(done, lambda x: x.a <= a2 AND a2 < x.e), lambda x: x.d)), 0)))::DECIMAL(27, 9)})
        FROM f JOIN s ON s.site = f.site AND s.parameter = f.parameter AND s.n = f.n + 1),
      z AS (SELECT site, parameter, unnest(max_by(done, n), recursive := true) FROM f GROUP BY 1, 2)
    SELECT r.site, r.parameter, r.id, round(r.value + coalesce(sum(z.d), 0)::DOUBLE, 6) AS value FROM fx_readings r
    LEFT JOIN z ON z.site = r.site AND z.parameter = r.parameter AND r.ts >= z.a AND r.ts < z.e GROUP BY r.site, r.parameter, r.id, r.value""",
)
def _(t):
    from sensorqc.plans.chunks import rank_rows
    from sensorqc.session import materialise

    spec = S.at("ts")
    ranked = materialise(rank_rows(t.events.select("site", "parameter", "id", "ts", "k"), spec, ("id",)), "ranked")
    later = ranked.select("site", "parameter", "row_index", F.col("ts").alias("_ts"))
    starts = ranked.filter("k between 30 and 37").select("site", "parameter", "row_index", F.col("id").alias("seq"), F.col("ts").alias("start_dt"), F.col("ts").alias("anchor1"))
    for name, ahead in (("anchor2", 1), ("end_dt", 6)):
        nth = later.select("site", "parameter", (F.col("row_index") - ahead).alias("row_index"), F.col("_ts").alias(name))
        starts = starts.join(nth, ["site", "parameter", "row_index"])
    return nz.step_shifts(t.readings, materialise(starts, "starts"), spec, bucket_seconds=86400).drop("ts")


@query(
    "n15_cross_parameter_filter",
    """WITH w AS (SELECT site, dt_round, max(mean) FILTER (parameter = 'DO') AS d, max(mean) FILTER (parameter = 'Temperature') AS tt FROM fx_slots GROUP BY 1, 2)
    SELECT s.site, s.dt_round, s.parameter, round(mean, 6) AS mean FROM fx_slots s JOIN w USING (site, dt_round) WHERE NOT (d IS NULL AND coalesce(tt <= 30, false))""",
)
def _(t):
    return nz.drop_where_wide(t.slots, ["site", "dt_round"], NAMES, "DO is null and Temperature <= 30", "mean")


@query(
    "n16_metaparameters",
    """SELECT s.site, s.parameter, s.dt_round, round(s.mean, 6) AS mean, round(m.mean, 6) AS "Temperature", round(d.mean, 6) AS "DO" FROM fx_slots s
    LEFT JOIN fx_slots m ON m.site = s.site AND m.dt_round = s.dt_round AND m.parameter = 'Temperature'
    LEFT JOIN fx_slots d ON d.site = s.site AND d.dt_round = s.dt_round AND d.parameter = 'DO'""",
)
def _(t):
    base = t.slots.select("site", "parameter", "dt_round", "mean")
    return nz.attach_metaparameters(base, t.slots, ["site", "dt_round"], ["DO", "Temperature"])


@query(
    "n17_wide_table",
    "SELECT site, dt_round, "
    + ", ".join(f"round(max(mean) FILTER (parameter = '{p}'), 6) AS \"{p}\"" for p in NAMES)
    + " FROM fx_slots GROUP BY 1, 2",
)
def _(t):
    return nz.wide_table(t.slots, ["site", "dt_round"], NAMES)


@query(
    "n18_note_labels",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 'bigbend' ELSE event_type END AS site,
      CASE event_type WHEN 'error' THEN 'Sensor Calibration or Check, Grab' WHEN 'view' THEN 'Visit: ' || props ELSE 'Grab Sample' END AS visit_type FROM events""",
)
def _(t):
    e = F.col("event_type")
    d = t.table("events").select(
        "event_id",
        F.when(e == "click", "Other (please specify)").otherwise(e).alias("site"),
        F.lit("Big Bend").alias("site_other"),
        F.when(e == "error", "???, Grab").when(e == "view", "Visit: Other (please specify)").otherwise("Grab Sample").alias("visit_type"),
        F.col("props").alias("visit_type_other"),
    )
    return nz.clean_labels(d, "site", "site_other", "visit_type", "visit_type_other").select("event_id", "site", "visit_type")


@query(
    "n19_initials",
    """SELECT id, upper(event_type[1]) || CASE parameter WHEN 'Turbidity' THEN 'T' WHEN 'Temperature' THEN 'T' WHEN 'DO' THEN 'DO'
      WHEN 'Specific Conductivity' THEN 'SC' ELSE 'FDOMF' END || ', Other' AS crew FROM fx_events""",
)
def _(t):
    crew = F.concat(F.initcap("event_type"), F.lit(" "), F.col("parameter"), F.lit(", Other (please specify)"))
    out = t.events.select("id", nz.initials(crew).alias("crew"))
    return out.withColumn("crew", F.regexp_replace("crew", "O$", "Other"))


@query(
    "n20_date_parse",
    "SELECT id, date_trunc('minute', ts) AS dt FROM fx_events WHERE k < 75 UNION ALL SELECT id, NULL FROM fx_events WHERE k >= 75",
)
def _(t):
    forms = ("yyyy-MM-dd HH:mm:'00'", "MM/dd/yy HH:mm", "MM/dd/yyyy HH:mm")
    text = F.lit("unreadable")
    for i, f in enumerate(forms):
        text = F.when(F.col("k").between(25 * i, 25 * i + 24), F.date_format("ts", f)).otherwise(text)
    return t.events.select("id", nz.parse_note_time(text).alias("dt"))


@query(
    "n21_explode_pairs",
    r"""WITH x AS (SELECT event_id, string_split(event_type || ';' || user_id, ';') AS a, string_split(props || ', b, c', ', ') AS b FROM events)
    SELECT event_id, CAST(i AS BIGINT) AS pos, a[i] AS names, b[i] AS labels FROM x, LATERAL (SELECT unnest([1, 2, 3]) AS i)""",
)
def _(t):
    d = t.table("events").select(
        "event_id", F.concat_ws("; ", "event_type", F.col("user_id").cast("string")).alias("names"), F.concat("props", F.lit(", b, c")).alias("labels")
    )
    return nz.explode_pairs(d, "names", "labels")

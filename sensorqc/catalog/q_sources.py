"""Source and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorqc.catalog.fixtures import S, STEP, slot_sql
from sensorqc.catalog.registry import query
from sensorqc.functions import time as tm
from sensorqc.session import work_dir
from sensorqc.sources import readers, sinks

READINGS = "SELECT site, id, parameter, ts, @value FROM fx_readings"


@query("s01_scan_parquet", "SELECT event_id, ts, user_id, event_type, @value FROM events")
def _(t):
    d = readers.scan_parquet(t.spark, t.dir, "events*.parquet")
    return d.select("event_id", "ts", "user_id", "event_type", "value")


@query("s02_csv_scan", READINGS)
def _(t):
    path = work_dir(t.spark, "csv")
    t.readings.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).write.option("header", "true").csv(path)
    return readers.scan_csv(t.spark, path, "site string, id long, parameter string, ts timestamp, value double")


@query(
    "s03_note_table",
    "SELECT visit_id, site, start_dt, visit_type, sensor_pulled, sensor_deployed, @pre_clean FROM fx_visits",
)
def _(t):
    path = work_dir(t.spark, "notes")
    cols = ["visit_id", "site", "start_dt", "visit_type", "sensor_pulled", "sensor_deployed", "pre_clean"]
    t.visits.select(cols).write.parquet(path)
    return readers.require_columns(readers.scan_parquet(t.spark, path), *cols)


@query(
    "s04_threshold_table",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN user_id || '/15' ELSE CAST(user_id AS VARCHAR) END AS raw,
      round(CASE WHEN event_id % 2 = 0 THEN user_id / 15.0 ELSE user_id END, 6) AS threshold FROM events""",
)
def _(t):
    raw = F.when(F.col("event_id") % 2 == 0, F.concat(F.col("user_id").cast("string"), F.lit("/15"))).otherwise(F.col("user_id").cast("string"))
    d = t.table("events").select("event_id", raw.alias("raw"))
    return d.withColumn("threshold", readers.parse_rational("raw"))


LOG = (
    "concat('<html><table><tr><td>Device SN</td><td>', user_id, '</td></tr><tr><th>Date Time</th><th>Temperature</th><th>pH</th></tr>',"
    "'<tr><td>', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), '</td><td>', value, '</td><td> 7.5 </td></tr>',"
    "'<tr><td>', date_format(ts + interval 15 minutes, 'yyyy-MM-dd HH:mm:ss'), '</td><td><b>', value + 1, '</b></td><td>n/a</td></tr></table></html>')"
)


@query(
    "s05_instrument_log",
    """SELECT event_id, CAST(0 AS BIGINT) AS row_no, date_trunc('second', ts) AS dt, @value, 7.5::DOUBLE AS ph FROM events
    UNION ALL SELECT event_id, 1, date_trunc('second', ts + INTERVAL 15 MINUTE), round(value + 1, 6), NULL FROM events""",
)
def _(t):
    logs = t.table("events").select("event_id", F.expr(LOG).alias("html"))
    return readers.instrument_log(logs, "html", "Date Time", {2: "value", 3: "ph"})


@query(
    "s05_html_rows",
    r"""WITH r AS (SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1, 'si') AS rows FROM pages)
    SELECT page_id, CAST(i AS BIGINT) AS row_no, trim(regexp_replace(rows[i + 1], '<[^>]*>', '', 'g')) AS cell
    FROM r, LATERAL (SELECT unnest(range(len(rows))) AS i)""",
)
def _(t):
    rows = readers.html_rows(t.table("pages").select("page_id", "html"), "html", "li", "a")
    return rows.select("page_id", "row_no", F.try_element_at("cells", F.lit(1)).alias("cell"))


REPORT = """concat('<html><div>RDO Slope ', slope, ' Offset ', offset, ' mg/L Concentration ', slope * 8, ' mg/L Pre Measurement ', 99 - offset, ' %Sat Post Measurement Temperature 21.5 °C Pressure ', 840 + offset, ' mbar</div>',
  '<div>pH/ORP Offset 1 Slope -57.5 mV/pH Offset 10.25 mV Slope and Offset 2 Slope ', -58 - slope, ' mV/pH Offset ', 11 + offset, ' mV ORP ORP Post Measurement pH ', case when id % 2 = 0 then '7' else '6' end, ' 7.000 pH mV ', -12 - slope,
  ' mV Cal Zobell''s Offset ', offset + 3, ' mV Temperature</div>',
  case when id % 3 <> 0 then concat('<div><b>Turbidity</b> Slope ', slope + 1, ' Offset ', offset + 2, ' NTU Calibration Point 1 Pre Measurement ', 10 + offset, ' NTU Post Calibration Point 2 Pre Measurement ', 100 + slope, ' NTU Post</div>') else '' end,
  '<div>Conductivity TDS Conversion Factor (ppm) 0.65 Cell Constant ', slope * 2, ' Reference Temperature 25 Pre Measurement Actual 1400 Specific Conductivity ', 1400 + slope, ' µS/cm Post Measurement Actual 1405 Specific Conductivity ',
  case when id % 5 = 0 then 'n/a' else cast(1410 + slope as string) end, ' µS/cm</div></html>')"""
REPORT_SQL = """round(slope, 6) AS rdo_slope, round("offset", 6) AS rdo_offset, round(99 - "offset", 6) AS rdo_100, round(slope * 8, 6) AS rdo_conc, 21.5::DOUBLE AS rdo_temp, round(840 + "offset", 6) AS rdo_pressure,
      -57.5::DOUBLE AS ph_slope_pre, 10.25::DOUBLE AS ph_offset_pre, round(-58 - slope, 6) AS ph_slope_post, round(11 + "offset", 6) AS ph_offset_post, round(-12 - slope, 6) AS ph_7,
      round("offset" + 3, 6) AS orp_offset, 0.65::DOUBLE AS tds_conversion_ppm, round(1400 + slope, 6) AS cond_pre, CASE WHEN id % 5 <> 0 THEN round(1410 + slope, 6) END AS cond_post, round(slope * 2, 6) AS cond_cell_constant,
      CASE WHEN id % 3 <> 0 THEN round(slope + 1, 6) END AS ntu_slope, CASE WHEN id % 3 <> 0 THEN round("offset" + 2, 6) END AS ntu_offset,
      CASE WHEN id % 3 <> 0 THEN round(10 + "offset", 6) END AS ntu_10, CASE WHEN id % 3 <> 0 THEN round(100 + slope, 6) END AS ntu_100,
      concat_ws(' ', CASE WHEN id % 3 = 0 THEN 'Turbidity' END, CASE WHEN id % 5 = 0 THEN 'Conductivity' END) AS factory_defaults"""


@query("s06_calibration_reports", f"SELECT id, {REPORT_SQL} FROM fx_calibrations")
def _(t):
    html = t.calibrations.select("id", F.expr(REPORT).alias("html"))
    return readers.calibration_reports(html, "html")


@query(
    "s06_report_files",
    f"""SELECT site, make_timestamp(CAST(((epoch_us(date_trunc('minute', sensor_date)) + 450000000) // 900000000) * 900000000 AS BIGINT)) AS dt, {REPORT_SQL}
    FROM fx_calibrations GROUP BY ALL""",
)
def _(t):
    name = F.concat("site", F.lit("_cal_report_"), F.date_format("sensor_date", "yyyyMMdd_HHmm"), F.lit("_mst.html"))
    files = t.calibrations.select(F.expr(REPORT).alias("html"), name.alias("file"))
    return readers.report_files(files.unionByName(files), "html", "file")


@query(
    "s07_sensor_sections",
    """WITH l AS (SELECT user_id AS report, event_id AS line, props, CASE event_type WHEN 'click' THEN 'Sensor' WHEN 'error' THEN 'Serial Number' ELSE 'Last Calibrated' END AS attr FROM events),
      n AS (SELECT *, CAST(sum((attr = 'Sensor')::INT) OVER (PARTITION BY report ORDER BY line) AS BIGINT) AS sensor_port FROM l)
    SELECT report, sensor_port, min_by(props, line) FILTER (attr = 'Sensor') AS "Sensor",
      min_by(props, line) FILTER (attr = 'Serial Number') AS "Serial Number",
      min_by(props, line) FILTER (attr = 'Last Calibrated') AS "Last Calibrated" FROM n GROUP BY 1, 2""",
)
def _(t):
    e = F.col("event_type")
    attr = F.when(e == "click", "Sensor").when(e == "error", "Serial Number").otherwise("Last Calibrated")
    lines = t.table("events").select(F.col("user_id").alias("report"), F.col("event_id").alias("line"), attr.alias("attr"), F.col("props").alias("value"))
    return readers.sensor_sections(lines, "report", "line", "attr", "value", ["Sensor", "Serial Number", "Last Calibrated"])


@query(
    "s08_file_name_fields",
    """SELECT id, site AS file_site, parameter AS file_parameter, date_trunc('second', ts) AS file_time, printf('%x', id) AS file_hash,
      CASE WHEN id % 4 = 0 THEN user_id ELSE -1 END AS file_copy FROM fx_events""",
)
def _(t):
    copy = F.when(F.col("id") % 4 == 0, F.concat(F.lit(" ("), F.col("user_id").cast("string"), F.lit(")"))).otherwise("")
    name = F.concat("site", F.lit("-"), "parameter", F.lit("_"), F.date_format("ts", "yyyyMMdd-HHmmss"), F.lit("_"), F.lower(F.hex("id")), copy, F.lit(".parquet"))
    files = t.events.select("id", name.alias("name"))
    return readers.file_name_fields(files, "name").drop("name").fillna(-1, ["file_copy"])


@query(
    "s09_telemetry",
    f"""WITH s AS (SELECT site, parameter, {slot_sql("date_trunc('second', ts)", nearest=True)} AS dt_round,
       avg(CASE k WHEN 20 THEN -9999 WHEN 21 THEN 638.30 ELSE value END::DOUBLE) AS value FROM fx_events GROUP BY 1, 2, 3)
     SELECT site, parameter, dt_round, round(value, 6) AS value FROM s WHERE value NOT IN (-9999, 638.30)
       AND dt_round > TIMESTAMP '2024-01-03' + INTERVAL 1 DAY * CAST(substr(site, 2) AS INT)""",
)
def _(t):
    v = F.when(F.col("k") == 20, F.lit("-9999")).when(F.col("k") == 21, F.lit("638.30")).otherwise(F.col("value").cast("string"))
    line = F.concat_ws("  ", F.date_format("ts", "MM/dd/yyyy HH:mm:ss"), v)
    live = t.sites.select("site", tm.shift(F.lit("2024-01-03").cast("timestamp"), F.substring("site", 2, 9).cast("long") * 86400).alias("go_live"))
    return readers.telemetry_rows(t.events.select("site", "parameter", line.alias("line")), live, S)


@query(
    "s10_dictionaries",
    """SELECT o_orderkey, o_orderdate, round(o_totalprice, 6) AS value, n_name AS parameter, r_name AS units
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def _(t):
    o = t.table("orders").select("o_orderkey", "o_orderdate", F.col("o_totalprice").alias("value"), F.col("o_custkey").alias("location"))
    locations = t.table("customer").select(F.col("c_custkey").alias("location"), F.col("c_nationkey").alias("parameter_id"))
    parameters = t.table("nation").select(F.col("n_nationkey").alias("parameter_id"), F.col("n_name").alias("parameter"), F.col("n_regionkey").alias("unit_id"))
    units = t.table("region").select(F.col("r_regionkey").alias("unit_id"), F.col("r_name").alias("units"))
    return readers.attach_dictionaries(o, (locations, "location"), (parameters, "parameter_id"), (units, "unit_id"))


@query("s11_series_sink", "SELECT site, parameter, dt_round, @mean, @spread, n_obs FROM fx_slots")
def _(t):
    path = work_dir(t.spark, "series")
    sinks.write_series(t.slots, path, chunk_seconds=7 * 86400)
    return t.spark.read.parquet(path).select("site", "parameter", "dt_round", "mean", "spread", "n_obs")


@query("s12_site_csv", "SELECT site, strftime(dt_round, '%Y/%m/%d %H%M') AS dt_round, parameter, n_obs FROM fx_slots")
def _(t):
    path = work_dir(t.spark, "site-csv")
    sinks.write_site_csv(t.slots.select("site", "dt_round", "parameter", "n_obs"), path, chunk_seconds=7 * 86400)
    return t.spark.read.option("header", "true").schema("dt_round string, parameter string, n_obs long, site string").csv(path)


@query("s13_append_history", "SELECT DISTINCT site, id, parameter, ts, @value FROM fx_readings")
def _(t):
    r = t.readings
    return sinks.append_history(r.filter("ts < '2024-01-20'"), r.filter("ts >= '2024-01-19'"))


@query(
    "s14_latest_version",
    """SELECT o_custkey, o_orderkey, o_orderdate, round(o_totalprice, 6) AS o_totalprice FROM
     (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def _(t):
    o = t.table("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return readers.latest_version(o, ["o_custkey"], "o_orderdate", "o_totalprice", "o_orderkey")


@query(
    "s15_preferred_tier",
    """WITH a AS (SELECT site, parameter, dt_round, mean, n_obs, CAST((dayofyear(dt_round) - 1) // 7 + 1 AS BIGINT) AS week FROM fx_slots),
      x AS (SELECT *, 2 AS tier_rank FROM a UNION ALL SELECT *, 1 FROM a WHERE n_obs >= 4 UNION ALL SELECT *, 0 FROM a WHERE n_obs >= 5),
      b AS (SELECT *, min(tier_rank) OVER (PARTITION BY site, parameter, week) AS best FROM x)
    SELECT site, parameter, dt_round, @mean, n_obs, week, CAST(tier_rank AS BIGINT) AS tier_rank FROM b WHERE tier_rank = best""",
)
def _(t):
    a = t.slots.drop("spread").withColumn("week", tm.week_number("dt_round"))
    return readers.preferred_tier([a.filter("n_obs >= 5"), a.filter("n_obs >= 4"), a], ["site", "parameter", "week"])


@query(
    "s16_prefer_corrected",
    """WITH c AS (SELECT site, parameter, dt_round, mean * 1.1 AS mean FROM fx_slots WHERE parameter IN ('DO', 'Turbidity') AND site < 's08')
    SELECT site, parameter, dt_round, @mean FROM c UNION ALL SELECT site, parameter, dt_round, @mean FROM fx_slots s
    WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.site = s.site AND c.parameter = s.parameter)""",
)
def _(t):
    base = t.slots.select("site", "parameter", "dt_round", "mean")
    corrected = base.filter("parameter in ('DO', 'Turbidity') and site < 's08'").withColumn("mean", F.col("mean") * 1.1)
    return readers.prefer_corrected(base, corrected, ["site", "parameter"])


@query(
    "s17_content_hash",
    """SELECT site, parameter, count(*) AS n_rows, CAST(sum(CAST('0x' || substr(md5(concat_ws('|', id, epoch_us(ts), parameter)), 1, 12) AS BIGINT)) AS VARCHAR) AS content_hash
    FROM fx_readings GROUP BY 1, 2""",
)
def _(t):
    return readers.content_hash(t.readings, ["site", "parameter"], [F.col("id"), F.unix_micros("ts"), F.col("parameter")])


@query(
    "s18_normalise_upload",
    """SELECT site, parameter, dt_round, @mean, flag AS auto_flag, CASE WHEN n_obs >= 3 THEN 'busy' END AS mal_flag,
      nullif(concat_ws(';', flag, CASE WHEN n_obs >= 3 THEN 'busy' END), '') AS flag, CAST(2024 AS BIGINT) AS year, CAST(1 AS BIGINT) AS month,
      CAST((dayofyear(dt_round) - 1) // 7 + 1 AS BIGINT) AS week, CAST(dayofweek(dt_round) + 1 AS BIGINT) AS weekday, CAST(dayofyear(dt_round) AS BIGINT) AS day,
      concat('2024 - ', (dayofyear(dt_round) - 1) // 7 + 1) AS y_w, concat('2024 - ', dayofyear(dt_round)) AS y_d,
      'winter_baseflow' AS season, round(mean, 6) AS mean_verified, false AS is_verified, CAST(NULL AS VARCHAR) AS verification_status, CAST(NULL AS VARCHAR) AS "user",
      nullif(concat_ws(';', flag, CASE WHEN n_obs >= 3 THEN 'busy' END), '') AS user_flag, false AS brush_omit,
      CAST(NULL AS VARCHAR) AS final_status, CAST(NULL AS VARCHAR) AS week_decision, false AS is_finalized FROM fx_flagged""",
)
def _(t):
    up = t.flagged.withColumnRenamed("flag", "auto_flag").withColumn("mal_flag", F.when(F.col("n_obs") >= 3, "busy"))
    return readers.normalise_upload(up, S).drop("spread", "n_obs")


def _replies(t):
    """One reply per site and day, as the service writes them; some are cut off, some have no station."""
    e = t.events.withColumns({"day": F.to_date("ts"), "sec": F.date_format("ts", "yyyy-MM-dd HH:mm:ss")})
    v = F.when(F.col("id") % 11 == 0, "n/a").otherwise(F.col("value").cast("string"))
    cell = F.struct(F.col("sec").alias("dt"), v.alias("v"), F.when(F.col("id") % 5 == 0, "E").otherwise("").alias("f"))
    series = lambda p: F.struct(F.array_sort(F.collect_list(F.when(F.col("parameter") == p, cell))).alias("data"))
    names = [F.struct(F.lit(n).alias("name")) for n in ("Battery", "DischargeRiver", "Battery", "Precip")]
    d = e.groupBy("site", "day").agg(series("FDOM Fluorescence").alias("b"), series("Temperature").alias("q"), series("DO").alias("p"))
    station = F.struct(F.col("site").alias("id"), F.lit("7").alias("numId"), F.concat(F.lit("at "), "site").alias("name"), F.array(*names).alias("dataTypes"), F.array("b", "q", "p").alias("ts"))
    whole = F.to_json(F.struct(F.array(station).alias("stationSummaries")))
    cut = (F.col("site") == "s03") & (F.dayofmonth("day") % 4 == 0)
    body = F.when(F.col("site") == "s09", '{"stationSummaries": []}').when(cut, F.expr("substr(body, 1, length(body) - 9)")).otherwise(F.col("body"))
    return d.withColumn("body", whole).select("site", "day", body.alias("body"))


@query(
    "s19_station_replies",
    """SELECT site, site AS station_id, 'at ' || site AS station_name, date_trunc('second', ts) AS ts, CASE parameter WHEN 'DO' THEN 'p_cm' ELSE 'q_cfs' END AS parameter,
      round(CASE WHEN id % 11 <> 0 THEN value * CASE parameter WHEN 'DO' THEN 2.54 ELSE 1 END END, 6) AS value, CASE WHEN id % 5 = 0 THEN 'E' ELSE '' END AS flag
    FROM fx_readings WHERE parameter IN ('DO', 'Temperature') AND site <> 's09' AND NOT (site = 's03' AND day(ts) % 4 = 0)""",
)
def _(t):
    from sensorqc.sources import replies

    return replies.station_series(_replies(t)).select("site", "station_id", "station_name", "ts", "parameter", "value", "flag")


@query(
    "s19_broken_replies",
    "SELECT site, date_trunc('day', ts) AS day, site = 's03' AND day(any_value(ts)) % 4 = 0 AS is_broken, site <> 's09' AND NOT (site = 's03' AND day(any_value(ts)) % 4 = 0) AS has_station FROM fx_readings GROUP BY 1, 2",
)
def _(t):
    from sensorqc.sources import replies

    return replies.parse_replies(_replies(t)).select("site", F.col("day").cast("timestamp").alias("day"), "is_broken", F.col("station").isNotNull().alias("has_station"))

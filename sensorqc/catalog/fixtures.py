"""Sensor tables derived from the driver's tables, once in Spark and once as table expressions.

Every event is a reading. The number ``k`` inside ``props`` marks the events that also stand for a
visit, a malfunction, a calibration and so on.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorqc.functions import time as tm, tokens
from sensorqc.operators import grid
from sensorqc.series import Series
from sensorqc.session import materialise

STEP = 6 * 3600
S = Series(step=STEP, chunk=32)

PARAMETERS = {
    "click": "Turbidity",
    "error": "DO",
    "purchase": "Temperature",
    "signup": "Specific Conductivity",
    "view": "FDOM Fluorescence",
}
# parameter: (min, max, slope threshold per minute)
SPEC = {
    "Turbidity": (5.0, 120.0, 0.10),
    "DO": (4.0, 110.0, 0.12),
    "Temperature": (3.0, 130.0, 0.08),
    "Specific Conductivity": (6.0, 115.0, 0.11),
    "FDOM Fluorescence": (2.0, 125.0, 0.09),
}
STRATEGIES = ("linear", "exponential", "uniform", "fitted_linear", "non_resolved", "unflag")


def _case(column: str, mapping: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in mapping.items()) + " END"


def slot_sql(ts: str, nearest: bool = False, step: int = STEP) -> str:
    micros = step * 1_000_000
    half = micros // 2 if nearest else 0
    return f"make_timestamp(CAST(((epoch_us({ts}) + {half}) // {micros}) * {micros} AS BIGINT))"


SPEC_SQL = ", ".join(f"('{p}', {a}, {b}, {s})" for p, (a, b, s) in SPEC.items())

CTES: dict[str, str] = {
    "fx_events": f"""
SELECT event_id AS id, 's' || lpad(CAST(user_id % 15 AS VARCHAR), 2, '0') AS site,
  {_case('event_type', PARAMETERS)} AS parameter, value, ts, user_id, event_type,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events""",
    "fx_readings": "SELECT site, id, parameter, ts, value FROM fx_events",
    "fx_slots": f"""
SELECT site, parameter, {slot_sql('ts', True)} AS dt_round, avg(value) AS mean,
  max(value) - min(value) AS spread, count(value) AS n_obs FROM fx_readings GROUP BY 1, 2, 3""",
    "fx_grid": f"""
SELECT site, parameter, unnest(generate_series(min(dt_round), max(dt_round), INTERVAL {STEP} SECOND)) AS dt_round
FROM fx_slots GROUP BY site, parameter""",
    "fx_series": """
SELECT g.site, g.parameter, g.dt_round, s.mean, s.spread, s.n_obs
FROM fx_grid g LEFT JOIN fx_slots s USING (site, parameter, dt_round)""",
    "fx_visits": f"""
SELECT id AS visit_id, site, ts AS start_dt, {slot_sql('ts')} AS dt_round,
  CASE k WHEN 0 THEN 'Sensor Cleaning or Check' WHEN 1 THEN 'Sensor Calibration & Check'
    WHEN 2 THEN 'Sensor malfunction' ELSE 'Other' END AS visit_type,
  CASE WHEN event_type IN ('click', 'error') THEN parameter END AS sensor_pulled,
  CASE WHEN event_type IN ('error', 'view') THEN parameter END AS sensor_deployed,
  parameter, value AS pre_clean, value * 0.9 AS post_clean FROM fx_events WHERE k < 4""",
    "fx_malfunctions": """
SELECT id, site, parameter, ts AS start_dt, ts + INTERVAL 12 HOUR AS end_dt FROM fx_events WHERE k = 2""",
    "fx_calibrations": """
SELECT id, site, parameter, ts AS sensor_date, 1 + (user_id % 7) / 100.0::DOUBLE AS slope,
  (user_id % 5) / 10.0::DOUBLE AS "offset" FROM fx_events WHERE k BETWEEN 5 AND 9""",
    "fx_windows": f"""
SELECT id AS seq, site, parameter, ts AS start_dt, ts + INTERVAL 3 DAY AS end_dt,
  CASE user_id % 6 {' '.join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(STRATEGIES))} END AS drift_type,
  CASE WHEN user_id % 2 = 0 THEN 'additive' ELSE 'multiplicative' END AS correction_type
FROM fx_events WHERE k = 10""",
    "fx_boxes": """
SELECT id AS seq, site, parameter, ts - INTERVAL 1 DAY AS dt_min, ts + INTERVAL 1 DAY AS dt_max,
  value - 20 AS mean_min, value + 20 AS mean_max,
  CASE user_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'F' ELSE 'O' END AS action,
  'u' || CAST(user_id AS VARCHAR) AS "user" FROM fx_events WHERE k = 11 OR k = 12""",
    "fx_sites": "SELECT DISTINCT site FROM fx_readings",
    "fx_network": """
SELECT 'main' AS network, CAST(substr(site, 2) AS BIGINT) AS pos, site FROM fx_sites""",
    "fx_metadata": """
SELECT site, TIMESTAMP '2024-01-01' AS data_start, TIMESTAMP '2024-01-15' AS data_end, 'first' AS label FROM fx_sites
UNION ALL SELECT site, TIMESTAMP '2024-01-16', TIMESTAMP '2024-01-31', 'second' FROM fx_sites""",
    "fx_spec": f"SELECT * FROM (VALUES {SPEC_SQL}) t(parameter, lo, hi, slope_threshold)",
    "fx_visit_slots": "SELECT DISTINCT site, dt_round FROM fx_visits",
    "fx_flagged": """
SELECT s.*, nullif(concat_ws(';' || chr(10), CASE WHEN v.site IS NOT NULL THEN 'site visit' END,
    CASE WHEN s.mean IS NULL THEN 'missing data' END,
    CASE WHEN s.mean < p.lo OR s.mean > p.hi THEN 'outside of sensor specification range' END,
    CASE WHEN s.mean BETWEEN 60 AND 95 THEN 'drift' END), '') AS flag
FROM fx_series s JOIN fx_spec p USING (parameter)
LEFT JOIN fx_visit_slots v ON v.site = s.site AND v.dt_round = s.dt_round""",
    "fx_verification": """
SELECT *, CAST(year(dt_round) AS BIGINT) AS year, CAST((dayofyear(dt_round) - 1) // 7 + 1 AS BIGINT) AS week,
  CASE WHEN flag IS NULL THEN 'PASS' WHEN n_obs >= 3 THEN 'OMIT' ELSE 'FLAGGED' END AS verification_status,
  coalesce(spread > 60, false) AS brush_omit, site NOT IN ('s03', 's07') AS is_verified,
  site IN ('s01', 's03', 's05') AS is_finalized
FROM fx_flagged""",
    "fx_state": """
SELECT site, parameter, dt_round, mean, spread, n_obs, hv IS NOT NULL AS has_visit, og IS NOT NULL AS on_grid,
  coalesce(last_value(employed IGNORE NULLS) OVER w, 1) AS sonde_employed,
  last_value(CASE WHEN hv THEN dt_round END IGNORE NULLS) OVER w AS last_site_visit
FROM (SELECT *, true AS og FROM fx_series) s FULL JOIN (
  SELECT q.site, q.parameter, v.dt_round, v.employed, true AS hv FROM (SELECT DISTINCT site, parameter FROM fx_series) q
  JOIN (SELECT site, dt_round, CAST(max_by((sensor_pulled IS NOT NULL AND sensor_deployed IS NULL)::INT, start_dt) AS BIGINT) AS employed
    FROM fx_visits GROUP BY 1, 2) v USING (site)) p USING (site, parameter, dt_round)
WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round)""",
    "fx_pairs": """
SELECT a.site, b.site AS neighbour FROM fx_network a JOIN fx_network b ON abs(a.pos - b.pos) = 1""",
    "fx_drift": """
SELECT site, parameter, dt_round, mean, flag AS user_flag, verification_status, coalesce(contains(flag, 'drift'), false) AS drift,
  CASE WHEN verification_status IN ('FLAGGED', 'PASS') THEN mean END AS mean_analysis FROM fx_verification""",
    "fx_notes": """
SELECT site, parameter, start_dt AS note_dt, avg(pre_clean) AS pre_clean, CASE WHEN max(sensor_pulled) IS NOT NULL THEN avg(post_clean) END AS post_clean
FROM fx_visits GROUP BY 1, 2, 3""",
    "fx_steps": f"""
SELECT *, lag(mean) OVER w AS back1, lead(mean) OVER w AS front1 FROM fx_series
WINDOW w AS (PARTITION BY site, parameter ORDER BY dt_round)""",
}


class Tables:
    """The driver's tables and the sensor tables derived from them.

    ``stored`` and ``drift`` are written once per query, as the operators that read a series from
    several sides expect a table.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        zoned = {f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"}
        return df.withColumns(zoned) if zoned else df

    def stored(self, name: str) -> DataFrame:
        return materialise(getattr(self, name), name)

    @cached_property
    def events(self) -> DataFrame:
        e = self.table("events")
        site = F.concat(F.lit("s"), F.lpad((F.col("user_id") % 15).cast("string"), 2, "0"))
        parameter: Column = F.lit(None).cast("string")
        for event, name in PARAMETERS.items():
            parameter = F.when(F.col("event_type") == event, F.lit(name)).otherwise(parameter)
        return e.select(
            F.col("event_id").alias("id"),
            site.alias("site"),
            parameter.alias("parameter"),
            "value",
            "ts",
            "user_id",
            "event_type",
            F.get_json_object("props", "$.k").cast("long").alias("k"),
        )

    @cached_property
    def readings(self) -> DataFrame:
        return self.events.select("site", "id", "parameter", "ts", "value")

    @cached_property
    def slots(self) -> DataFrame:
        return grid.slot_aggregate(self.readings, S, "ts", "value")

    @cached_property
    def series(self) -> DataFrame:
        return grid.pad_grid(self.slots, S)

    @cached_property
    def visits(self) -> DataFrame:
        k = F.col("k")
        kind = (
            F.when(k == 0, "Sensor Cleaning or Check")
            .when(k == 1, "Sensor Calibration & Check")
            .when(k == 2, "Sensor malfunction")
            .otherwise("Other")
        )
        return self.events.filter(k < 4).select(
            F.col("id").alias("visit_id"),
            "site",
            F.col("ts").alias("start_dt"),
            tm.floor_slot("ts", STEP).alias("dt_round"),
            kind.alias("visit_type"),
            F.when(F.col("event_type").isin("click", "error"), F.col("parameter")).alias("sensor_pulled"),
            F.when(F.col("event_type").isin("error", "view"), F.col("parameter")).alias("sensor_deployed"),
            "parameter",
            F.col("value").alias("pre_clean"),
            (F.col("value") * 0.9).alias("post_clean"),
        )

    @cached_property
    def malfunctions(self) -> DataFrame:
        e = self.events.filter("k = 2")
        return e.select("id", "site", "parameter", F.col("ts").alias("start_dt"), tm.shift("ts", 12 * 3600).alias("end_dt"))

    @cached_property
    def calibrations(self) -> DataFrame:
        return self.events.filter("k between 5 and 9").select(
            "id",
            "site",
            "parameter",
            F.col("ts").alias("sensor_date"),
            (1 + (F.col("user_id") % 7) / 100.0).alias("slope"),
            ((F.col("user_id") % 5) / 10.0).alias("offset"),
        )

    @cached_property
    def windows(self) -> DataFrame:
        names = F.array(*[F.lit(s) for s in STRATEGIES])
        return self.events.filter("k = 10").select(
            F.col("id").alias("seq"),
            "site",
            "parameter",
            F.col("ts").alias("start_dt"),
            tm.shift("ts", 3 * 86400).alias("end_dt"),
            F.element_at(names, (F.col("user_id") % 6 + 1).cast("int")).alias("drift_type"),
            F.when(F.col("user_id") % 2 == 0, "additive").otherwise("multiplicative").alias("correction_type"),
        )

    @cached_property
    def boxes(self) -> DataFrame:
        return self.events.filter("k in (11, 12)").select(
            F.col("id").alias("seq"),
            "site",
            "parameter",
            tm.shift("ts", -86400).alias("dt_min"),
            tm.shift("ts", 86400).alias("dt_max"),
            (F.col("value") - 20).alias("mean_min"),
            (F.col("value") + 20).alias("mean_max"),
            F.element_at(F.array(F.lit("A"), F.lit("F"), F.lit("O")), (F.col("user_id") % 3 + 1).cast("int")).alias("action"),
            F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"),
        )

    @cached_property
    def sites(self) -> DataFrame:
        return self.readings.select("site").distinct()

    @cached_property
    def network(self) -> DataFrame:
        return self.sites.select(F.lit("main").alias("network"), F.substring("site", 2, 9).cast("long").alias("pos"), "site")

    @cached_property
    def metadata(self) -> DataFrame:
        def span(a, b, label):
            return F.struct(F.lit(a).cast("timestamp").alias("data_start"), F.lit(b).cast("timestamp").alias("data_end"), F.lit(label).alias("label"))

        spans = F.array(span("2024-01-01", "2024-01-15", "first"), span("2024-01-16", "2024-01-31", "second"))
        return self.sites.select("site", F.inline(spans))

    @cached_property
    def spec(self) -> DataFrame:
        rows = [(p, *v) for p, v in SPEC.items()]
        return self.spark.createDataFrame(rows, "parameter string, lo double, hi double, slope_threshold double")

    @cached_property
    def visit_slots(self) -> DataFrame:
        return self.visits.select("site", "dt_round").distinct()

    @cached_property
    def state(self) -> DataFrame:
        from sensorqc.operators import visits as vz

        return vz.attach_visits(self.series, self.visits, S)

    @cached_property
    def pairs(self) -> DataFrame:
        from sensorqc.operators import visits as vz

        return vz.neighbour_pairs(self.network)

    @cached_property
    def flagged(self) -> DataFrame:
        s = self.series.join(self.visit_slots.withColumn("_v", F.lit(True)), ["site", "dt_round"], "left")
        s = s.join(F.broadcast(self.spec), "parameter")
        flags = tokens.add_all(
            tokens.empty(),
            [
                (F.col("_v").isNotNull(), "site visit"),
                (F.col("mean").isNull(), "missing data"),
                ((F.col("mean") < F.col("lo")) | (F.col("mean") > F.col("hi")), "outside of sensor specification range"),
                (F.col("mean").between(60, 95), "drift"),
            ],
        )
        return s.select("site", "parameter", "dt_round", "mean", "spread", "n_obs", tokens.render(flags).alias("flag"))

    @cached_property
    def drift(self) -> DataFrame:
        from sensorqc.operators import drift as dr

        v = self.verification.select("site", "parameter", "dt_round", "mean", F.col("flag").alias("user_flag"), "verification_status")
        return materialise(dr.analysis_columns(v), "drift")

    @cached_property
    def notes(self) -> DataFrame:
        post = F.when(F.max("sensor_pulled").isNotNull(), F.avg("post_clean"))
        v = self.visits.groupBy("site", "parameter", F.col("start_dt").alias("note_dt"))
        return v.agg(F.avg("pre_clean").alias("pre_clean"), post.alias("post_clean"))

    @cached_property
    def verification(self) -> DataFrame:
        f = self.flagged
        return f.withColumns(
            {
                "year": F.year("dt_round").cast("long"),
                "week": tm.week_number("dt_round"),
                "verification_status": F.when(F.col("flag").isNull(), "PASS").when(F.col("n_obs") >= 3, "OMIT").otherwise("FLAGGED"),
                "brush_omit": F.coalesce(F.col("spread") > 60, F.lit(False)),
                "is_verified": ~F.col("site").isin("s03", "s07"),
                "is_finalized": F.col("site").isin("s01", "s03", "s05"),
            }
        )

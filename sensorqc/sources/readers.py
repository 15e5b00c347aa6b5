"""Reading of tables, logs, reports and telemetry text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorqc.functions import time as tm
from sensorqc.plans.joins import newest_per_key
from sensorqc.series import Series


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def scan_parquet(spark: SparkSession, folder: str, glob: str = "*.parquet", schema=None) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", glob)
    return (reader.schema(schema) if schema else reader).parquet(folder)


def scan_csv(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    return spark.read.options(header="true", **options).schema(schema).csv(path)


def parse_rational(text: Column | str) -> Column:
    """'1/15' or '0.25' to a double, without evaluating code."""
    parts = F.split(F.col(text) if isinstance(text, str) else text, "/")
    top = F.trim(parts[0]).try_cast("double")
    bottom = F.trim(F.try_element_at(parts, F.lit(2))).try_cast("double")
    return F.when(F.size(parts) == 1, top).when(bottom != 0, top / bottom)


def html_rows(df: DataFrame, html: str, row_tag: str = "tr", cell_tag: str = "t[dh]") -> DataFrame:
    """One output row per table row of every page: position and cell texts."""
    rows = F.regexp_extract_all(html, F.lit(rf"(?is)<{row_tag}(?:\s[^>]*)?>(.*?)</{row_tag}>"), 1)
    cells = F.regexp_extract_all("_row", F.lit(rf"(?is)<{cell_tag}(?:\s[^>]*)?>(.*?)</{cell_tag}>"), 1)
    text = F.transform(cells, lambda c: F.trim(F.regexp_replace(c, r"(?s)<[^>]*>", "")))
    out = df.select(*[c for c in df.columns if c != html], F.posexplode(rows).alias("row_no", "_row"))
    return out.withColumn("cells", text).drop("_row")


def instrument_log(df: DataFrame, html: str, header: str, fields: dict[int, str]) -> DataFrame:
    """Numeric rows below the header row of each log; ``fields`` maps cell positions (1-based)."""
    keep = [c for c in df.columns if c != html]
    rows = F.transform(
        F.regexp_extract_all(html, F.lit(r"(?is)<tr(?:\s[^>]*)?>(.*?)</tr>"), 1),
        lambda r: F.transform(
            F.regexp_extract_all(r, F.lit(r"(?is)<t[dh](?:\s[^>]*)?>(.*?)</t[dh]>"), 1),
            lambda c: F.trim(F.regexp_replace(c, r"(?s)<[^>]*>", "")),
        ),
    )
    firsts = F.transform("_rows", lambda r: F.try_element_at(r, F.lit(1)))
    start = F.array_position(firsts, F.lit(header))
    body = F.when(start > 0, F.slice("_rows", (start + 1).cast("int"), F.size("_rows")))
    out = df.withColumn("_rows", rows).select(*keep, F.posexplode(body).alias("row_no", "_r"))
    cells = [F.try_element_at("_r", F.lit(i)).try_cast("double").alias(n) for i, n in fields.items()]
    return out.select(*keep, "row_no", F.try_to_timestamp(F.try_element_at("_r", F.lit(1))).alias("dt"), *cells)


# Text before and after each value of a calibration report, blanks removed.
REPORT_FIELDS = {
    "rdo_slope": ("RDO", r"Slope\s*(.*?)\s*Offset"),
    "rdo_offset": ("RDO", r"Offset\s*(.*?)\s*mg/L"),
    "rdo_100": ("RDO", r"PreMeasurement\s*(.*?)\s*%SatPost"),
    "rdo_conc": ("RDO", r"Concentration\s*(.*?)\s*mg/LPreMeasurement"),
    "rdo_temp": ("RDO", r"Temperature\s*(.*?)\s*°C"),
    "rdo_pressure": ("RDO", r"Pressure\s*(.*?)\s*mbar"),
    "ph_slope_pre": ("pH/ORP", r"Offset1Slope\s*(.*?)\s*mV/pH"),
    "ph_offset_pre": ("pH/ORP", r"mV/pHOffset\s*(.*?)\s*mVSlopeandOffset2"),
    "ph_slope_post": ("pH/ORP", r"Offset2Slope\s*(.*?)\s*mV/pH"),
    "ph_offset_post": ("pH/ORP", r"Offset2Slope.*?mV/pHOffset\s*(.*?)\s*mVORPORP"),
    "ph_7": ("pH/ORP", r"PostMeasurementpH7\s*(.*?)\s*mVCal"),
    "ph_6": ("pH/ORP", r"PostMeasurementpH6\s*(.*?)\s*mVCal"),
    "orp_offset": ("pH/ORP", r"Zo[bB]ell'sOffset\s*(.*?)\s*mVTemperature"),
    "tds_conversion_ppm": ("Conductivity", r"TDSConversionFactor\s*(.*?)\s*CellConstant"),
    "cond_pre": ("Conductivity", r"PreMeasurementActual.*?SpecificConductivity\s*(.*?)\s*[µμ]S/cmPost"),
    "cond_post": ("Conductivity", r"PostMeasurementActual.*?SpecificConductivity\s*(.*?)\s*[µμ]S/cm"),
    "cond_cell_constant": ("Conductivity", r"CellConstant\s*(.*?)\s*ReferenceTemperature"),
    "ntu_slope": ("Turbidity", r"Slope\s*(.*?)\s*Offset"),
    "ntu_offset": ("Turbidity", r"Offset\s*(.*?)\s*NTU"),
    "ntu_10": ("Turbidity", r"CalibrationPoint1PreMeasurement\s*(.*?)\s*NTUPost"),
    "ntu_100": ("Turbidity", r"CalibrationPoint2PreMeasurement\s*(.*?)\s*NTUPost"),
}
# Characters of a label before the number; ph_6 stands in where a report has no ph_7.
REPORT_LABELS = {"ph_7": 9, "ph_6": 9, "tds_conversion_ppm": 5}
# A sensor without this field kept its factory calibration.
FACTORY_DEFAULT_FIELDS = {"Turbidity": "ntu_slope", "RDO": "rdo_slope", "pH": "ph_slope_post", "ORP": "orp_offset", "Conductivity": "cond_post"}


def calibration_reports(df: DataFrame, html: str) -> DataFrame:
    """Slopes and offsets of every report, one row per report.

    Each ``div`` is one section; a section is found by the sensor name it contains.
    """
    divs = F.regexp_extract_all(html, F.lit(r"(?is)<div(?:\s[^>]*)?>(.*?)</div>"), 1)
    sections = F.transform(divs, lambda d: F.regexp_replace(F.regexp_replace(d, r"(?s)<[^>]*>", ""), r"\s", ""))
    out = df.withColumn("_sections", sections)

    def section_of(sensor: str) -> Column:
        return F.try_element_at(F.filter("_sections", lambda s: s.contains(sensor)), F.lit(1))

    for name, (sensor, pattern) in REPORT_FIELDS.items():
        section = section_of(sensor)
        found = F.regexp_extract(section, pattern, 1)
        number = F.substr(found, F.lit(REPORT_LABELS[name] + 1)) if name in REPORT_LABELS else found
        out = out.withColumn(name, F.when(F.regexp_like(section, F.lit(pattern)), number).try_cast("double"))
    out = out.withColumn("ph_7", F.coalesce("ph_7", "ph_6")).drop("ph_6")
    missing = [F.when(F.col(field).isNull(), F.lit(sensor)) for sensor, field in FACTORY_DEFAULT_FIELDS.items()]
    return out.withColumn("factory_defaults", F.concat_ws(" ", *missing)).drop("_sections", html)


#: Site before the first underscore; date and minute at a fixed distance from the end of the name.
REPORT_SITE, REPORT_TIME = r"^([^_]*)", r"([0-9]{8}).([0-9]{4}).{9}$"


def report_files(df: DataFrame, html: str, name: Column | str = "_metadata.file_name", step: int = 900) -> DataFrame:
    """The reports' fields with ``site`` and ``dt`` (nearest slot) from the file name; equal reports once.

    A name that holds no time gives a null ``dt``.
    """
    at = F.concat_ws(" ", F.regexp_extract("_file", REPORT_TIME, 1), F.regexp_extract("_file", REPORT_TIME, 2))
    d = df.withColumn("_file", F.col(name) if isinstance(name, str) else name)
    d = d.withColumns({"site": F.regexp_extract("_file", REPORT_SITE, 1), "dt": tm.round_slot(F.try_to_timestamp(at, F.lit("yyyyMMdd HHmm")), step)})
    d = d.drop("_file", name) if isinstance(name, str) and name in df.columns else d.drop("_file")
    return calibration_reports(d, html).distinct()


def sensor_sections(lines: DataFrame, report: str, line: str, attr: str, value: str, attributes: list[str], marker: str = "Sensor") -> DataFrame:
    """Attribute lines of a report to one row per sensor; each ``marker`` line opens a sensor."""
    from sensorqc.plans.chunks import carry

    opens = F.when(F.col(attr) == marker, 1).otherwise(0).cast("long")
    numbered = carry(lines, [report], F.floor(F.col(line) / 4096), [line], sums={"sensor_port": opens})
    cells = [F.min_by(F.when(F.col(attr) == a, F.col(value)), F.when(F.col(attr) == a, F.col(line))).alias(a) for a in attributes]
    return numbered.groupBy(report, "sensor_port").agg(*cells)


FILE_NAME = r"^([A-Za-z0-9_]+)-([^_]+)_([0-9]{8}-[0-9]{6})_([0-9a-f]+)(?:\s?\(([0-9]+)\))?\.(\w+)$"


def file_name_fields(df: DataFrame, name: Column | str = "_metadata.file_name") -> DataFrame:
    """site-parameter_yyyymmdd-hhmmss_hash (n).ext"""
    c = F.col(name) if isinstance(name, str) else name

    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(c, FILE_NAME, i), F.lit(""))

    return df.withColumns(
        {
            "file_site": part(1),
            "file_parameter": part(2),
            "file_time": F.try_to_timestamp(part(3), F.lit("yyyyMMdd-HHmmss")),
            "file_hash": part(4),
            "file_copy": part(5).cast("long"),
        }
    )


# Readings the station sends for "no value".
SENTINELS = (-9999.0, 638.30)


def telemetry_rows(lines: DataFrame, go_live: DataFrame, spec: Series, text: str = "line") -> DataFrame:
    """'date time value' lines to means of the nearest slot.

    Unparsable rows drop; slots whose mean is a sentinel drop, as do slots up to go-live and sites without one.
    """
    parts = F.split(F.trim(F.col(text)), r"\s+")
    parsed = lines.select(
        *spec.keys,
        F.try_to_timestamp(F.concat_ws(" ", parts[0], F.try_element_at(parts, F.lit(2))), F.lit("MM/dd/yyyy HH:mm:ss")).alias("_t"),
        F.try_element_at(parts, F.lit(3)).try_cast("double").alias("_v"),
    ).filter(F.col("_t").isNotNull() & F.col("_v").isNotNull())
    slots = parsed.groupBy(*spec.keys, tm.round_slot("_t", spec.step).alias(spec.time)).agg(F.avg("_v").alias("value"))
    live = slots.filter(~F.col("value").isin(*SENTINELS)).join(go_live.select("site", "go_live"), "site")
    return live.filter(F.col(spec.time) > F.col("go_live")).drop("go_live")


def attach_dictionaries(df: DataFrame, *dims: tuple[DataFrame, str]) -> DataFrame:
    """Inner joins on id columns, ids dropped; the optimizer broadcasts a dictionary by its size."""
    for dim, key in dims:
        df = df.join(dim, key, "inner").drop(key)
    return df


def latest_version(df: DataFrame, keys: list[str], time: str, size: str, name: str) -> DataFrame:
    return newest_per_key(df, keys, [time, size, name])


def preferred_tier(tiers: list[DataFrame], block: list[str]) -> DataFrame:
    """Rows of the best tier that has any row for the block; ``tiers`` in falling preference."""
    stacked = None
    for rank, t in enumerate(tiers):
        t = t.withColumn("tier_rank", F.lit(rank).cast("long"))
        stacked = t if stacked is None else stacked.unionByName(t)
    best = stacked.groupBy(*block).agg(F.min("tier_rank").alias("tier_rank"))
    return stacked.join(best, [*block, "tier_rank"]).select(*stacked.columns)


def prefer_corrected(base: DataFrame, corrected: DataFrame, keys: list[str]) -> DataFrame:
    """Corrected rows plus the base rows of series that have no corrected row."""
    done = corrected.select(*keys).distinct()
    return corrected.unionByName(base.join(done, keys, "left_anti"), allowMissingColumns=True)


def content_hash(df: DataFrame, keys: list[str], columns: list[Column]) -> DataFrame:
    """Order-free fingerprint per series: row count and the sum of row digests."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in columns])
    digest = F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("decimal(38,0)")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(digest).cast("string").alias("content_hash"))


def normalise_upload(df: DataFrame, spec: Series = Series()) -> DataFrame:
    """Validated upload with merged flags, calendar parts and the initial review state."""
    require_columns(df, "site", "parameter", spec.time, "mean")
    optional = {c: F.lit(None).cast("string") for c in ("auto_flag", "mal_flag") if c not in df.columns}
    out = df.withColumns(optional) if optional else df
    flag = F.nullif(F.concat_ws(";", "auto_flag", "mal_flag"), F.lit(""))
    out = out.withColumns({"flag": flag, **{k: v for k, v in tm.calendar(spec.time).items() if k != "y_m"}})
    return out.withColumns(
        {
            "mean_verified": F.col("mean"),
            "is_verified": F.lit(False),
            "verification_status": F.lit(None).cast("string"),
            "user": F.lit(None).cast("string"),
            "user_flag": F.col("flag"),
            "brush_omit": F.lit(False),
            "final_status": F.lit(None).cast("string"),
            "week_decision": F.lit(None).cast("string"),
            "is_finalized": F.lit(False),
        }
    )

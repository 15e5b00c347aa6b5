"""Ingest normalisation: zones, names, units, clock offsets, shifts, reshaping."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from sensorqc.functions import time as tm
from sensorqc.plans.chunks import carry, time_chunk
from sensorqc.plans.joins import mark_covered, newest_per_key
from sensorqc.plans.segments import pick_winners
from sensorqc.series import Series
from sensorqc.session import materialise, ship_package


def localise(df: DataFrame, ts: str, step: int = 900, zone: str = "MST") -> DataFrame:
    local = tm.to_zone(ts, zone)
    out = df.withColumn("dt_round", tm.round_slot(local, step))
    return out.withColumn("dt_join", F.date_format("dt_round", "yyyy-MM-dd HH:mm:ss"))


# Names of devices and old years that are not part of the network.
EXCLUDED_NAMES = "vulink|virridy|2023|2024"


def exclude_names(df: DataFrame, name: str, pattern: str = EXCLUDED_NAMES) -> DataFrame:
    """Drop matching names, ignoring case; rows without a name stay."""
    return df.filter(~F.coalesce(F.lower(name).rlike(pattern), F.lit(False)))


def apply_aliases(df: DataFrame, aliases: DataFrame, column: str = "site") -> DataFrame:
    """``aliases`` has (alias, canonical)."""
    a = aliases.select(F.col("alias").alias(column), F.col("canonical").alias("_canonical"))
    return df.join(a, column, "left").withColumn(column, F.coalesce("_canonical", column)).drop("_canonical").select(*df.columns)


def move_sites(df: DataFrame, moves: DataFrame, time: str, bucket_seconds: int) -> DataFrame:
    """Rename a site inside date ranges; ``moves`` has (site, from_dt, to_dt, new_site, seq), last wins."""
    out = pick_winners(df, moves, ["site"], time, "from_dt", "to_dt", {"_new": (F.col("new_site"), F.col("seq"))}, bucket_seconds)
    return out.withColumn("site", F.coalesce("_new", "site")).drop("_new").select(*df.columns)


def merge_owner_suffix(df: DataFrame, rules: DataFrame, time: str, suffix: str = "_virridy", bucket_seconds: int = 86400 * 30, row_key: list[str] | None = None) -> DataFrame:
    """Drop the owner suffix inside rule windows for the listed parameters.

    ``rules`` has (site, parameter, from_dt, to_dt). Other suffixed rows inside a window of their
    site are removed, rows outside every window keep the suffix.
    """
    listed = mark_covered(df, rules, ["site", "parameter"], time, "from_dt", "to_dt", bucket_seconds, "_listed")
    inside = mark_covered(listed, rules.select("site", "from_dt", "to_dt"), ["site"], time, "from_dt", "to_dt", bucket_seconds, "_inside")
    suffixed = F.col("site").endswith(suffix)
    out = inside.filter(~(suffixed & F.col("_inside") & ~F.col("_listed")))
    bare = F.regexp_replace("site", suffix + "$", "")
    return out.withColumn("site", F.when(suffixed & F.col("_listed"), bare).otherwise(F.col("site"))).select(*df.columns)


def dedupe(df: DataFrame, keys: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Exact copies once; with keys, the first row by a total order (any number of copies per key)."""
    if not keys:
        return df.distinct()
    return newest_per_key(df, keys, order, newest=False)


def stack(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def to_long(df: DataFrame, ids: list[str], columns: list[str], variable: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(ids, columns, variable, value).filter(F.col(value).isNotNull())


# Fixed values: (variable, parameter, unit, factor).
UNIT_RULES = [
    ("Water_Temp_C", "Temperature", "C", 1.0),
    ("pH", "pH", "pH", 1.0),
    ("ORP_mV", "ORP", "V", 0.001),
    ("Specific_Conductivity_µS_cm", "Specific Conductivity", "µS/cm", 1.0),
    ("DO_ppm", "DO", "mg/L", 1.0),
    ("Turbidity_NTU", "Turbidity", "NTU", 1.0),
    ("Depth_ft", "Depth", "m", 0.3048),
    ("Chla_RFU", "Chl-a Fluorescence", "RFU", 1.0),
]


def convert_units(df: DataFrame, variable: str = "variable", value: str = "value", rules=None) -> DataFrame:
    rows = rules or UNIT_RULES
    d = df.sparkSession.createDataFrame(rows, "_var string, parameter string, units string, _factor double")
    out = df.join(F.broadcast(d), df[variable] == d["_var"], "inner")
    return out.withColumn(value, F.col(value) * F.col("_factor")).drop("_var", "_factor", variable)


def repair_clock(df: DataFrame, rules: DataFrame, ts: str, year: str = "year") -> DataFrame:
    """Add hours by (site, year); ``rules`` has (site, year, hours)."""
    keyed = df.withColumn("_y", F.year(ts).cast("long"))
    r = rules.select("site", F.col(year).cast("long").alias("_y"), "hours")
    out = keyed.join(r, ["site", "_y"], "left")
    return out.withColumn(ts, tm.shift(ts, F.coalesce("hours", F.lit(0)) * 3600)).select(*df.columns)


def clock_from_header(df: DataFrame, header: str, local: str, file: str) -> DataFrame:
    """Wall-clock text time to the fixed MST clock by what the log header says.

    The "telemetry device" form follows daylight saving of the newest row of the file.
    """
    newest = df.groupBy(file).agg(F.max(local).alias("_newest"))
    summer = F.to_utc_timestamp("_newest", "America/Denver") == tm.shift("_newest", 6 * 3600)
    h = F.col(header)
    hours = (
        F.when(h.contains("UTC"), -7)
        .when(h.contains("MST"), 0)
        .when(h.contains("Time Offset = -07:00:00"), 0)
        .when(h.contains("Time Offset = -06:00:00"), -1)
        .when(h.contains("in telemetry device's"), F.when(summer, -1).otherwise(0))
    )
    out = df.join(newest, file, "left")
    return out.withColumn("dt_mst", tm.shift(local, hours * 3600)).drop("_newest")


def drop_outages(df: DataFrame, outages: DataFrame, time: str, chunk_seconds: int, on=("site",), start: str = "start_dt", end: str = "end_dt") -> DataFrame:
    return mark_covered(df, outages, list(on), time, start, end, chunk_seconds).filter(~F.col("covered")).drop("covered")


def recode_maintenance(df: DataFrame, windows: DataFrame, time: str, chunk_seconds: int, text: str, value: str = "mean", on=("site",), start: str = "start_dt", end: str = "end_dt") -> DataFrame:
    m = mark_covered(df, windows, list(on), time, start, end, chunk_seconds)
    return m.withColumns({value: F.when(~F.col("covered"), F.col(value)), "flag": F.when(F.col("covered"), text).otherwise(F.col("flag"))}).drop("covered")


#: Offsets are sums of whole units of 10^-9, so what is added at a start goes in full at the end.
_UNIT = "decimal(27,9)"


def step_shifts(df: DataFrame, shifts: DataFrame, spec: Series, value: str = "value", bucket_seconds: int = 86400 * 30) -> DataFrame:
    """Add |v(anchor1) - v(anchor2)| inside each shift window [start, end); overlapping shifts add up.

    ``shifts`` has (keys, start_dt, end_dt, anchor1, anchor2, seq) with anchors on reading times; one without an end
    stays open, one without a start or ending at or before it holds no reading, one with an anchor that has no reading
    is left out. Shifts are made in the order of ``seq``, and an anchor has the value that earlier shifts have given it.
    Steps follow from each other only where windows and anchors lie over each other in time: such groups are found
    first, and each is folded in n log n (``_chained_steps``). The readings see the offsets as +/- events on their own
    time line, so no row-by-window pairs are formed and a long series is split by time.
    """
    keys = list(spec.keys)
    s = shifts.filter(F.col("start_dt").isNotNull() & (F.col("end_dt").isNull() | (F.col("start_dt") < F.col("end_dt"))))
    asked = s.select(*keys, F.explode(F.array("anchor1", "anchor2")).alias(spec.time)).distinct()
    anchors = materialise(df.join(asked, [*keys, spec.time], "left_semi").groupBy(*keys, spec.time).agg(F.avg(value).cast(_UNIT).alias("_v")).filter("_v is not null"), "anchors")
    for n in ("1", "2"):
        s = s.join(anchors.withColumnsRenamed({spec.time: f"anchor{n}", "_v": f"_v{n}"}), [*keys, f"anchor{n}"])
    at = {f"_{c}": F.unix_micros(F.col(c).cast("timestamp")) for c in ("start_dt", "end_dt", "anchor1", "anchor2")}
    s = s.withColumns(at).withColumns({"_lo": F.least("_start_dt", "_anchor1", "_anchor2"), "_hi": F.greatest(F.coalesce("_end_dt", F.lit(2**62)), "_anchor1", "_anchor2")})
    s = materialise(s, "shifts")
    chunk = time_chunk(F.timestamp_micros("_lo"), bucket_seconds)
    s = materialise(carry(s, keys, chunk, ["_lo", "seq"], maxes={"_before": F.col("_hi")}, exclusive=True), "shift-reach")
    fresh = F.col("_before").isNull() | (F.col("_before") < F.col("_lo"))
    s = carry(s, keys, chunk, ["_lo", "seq"], fills={"_group": F.when(fresh, F.col("_lo"))})
    steps = _chained_steps(s, keys, time_chunk(F.timestamp_micros("_group"), bucket_seconds))
    edges = steps.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col("start_dt").alias("_t"), F.lit(0).alias("_side"), F.col("step").alias("_d")),
                F.struct(F.col("end_dt").alias("_t"), F.lit(0).alias("_side"), (-F.col("step")).cast(_UNIT).alias("_d")),
            )
        ),
    ).filter("_t is not null")
    edges = materialise(edges, "shift-edges")
    rows = df.select(*keys, F.col(spec.time).alias("_t"), F.lit(1).alias("_side"), F.struct(*df.columns).alias("_l"))
    both = rows.unionByName(edges, allowMissingColumns=True)
    out = carry(both, keys, time_chunk("_t", bucket_seconds), ["_t", "_side"], sums={"_offset": F.coalesce("_d", F.lit(0).cast(_UNIT))})
    out = out.filter(F.col("_l").isNotNull()).select("_l.*", "_offset")
    return out.withColumn(value, F.when(F.col("_offset") == 0, F.col(value)).otherwise(F.col(value) + F.col("_offset").cast("double"))).drop("_offset")


def _chained_steps(s: DataFrame, keys: list[str], bundle: Column) -> DataFrame:
    """``keys``, start_dt, end_dt and step of every shift; groups that begin in one ``bundle`` share a call.

    Offsets are sums over a binary indexed tree of the anchors' times, in whole units of the ninth decimal.
    """
    ship_package(s.sparkSession)
    schema = T.StructType([*(s.schema[c] for c in [*keys, "start_dt", "end_dt"]), T.StructField("step", T._parse_datatype_string(_UNIT))])
    columns = [*keys, "start_dt", "end_dt"]

    def fold(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        order = ["seq", "_start_dt", "_end_dt", "_anchor1", "_anchor2", "_v1", "_v2"]
        table = table.take(pc.sort_indices(table, sort_keys=[(c, "ascending") for c in order], null_placement="at_start"))
        start, end, one, two = (table[f"_{c}"].to_pylist() for c in ("start_dt", "end_dt", "anchor1", "anchor2"))
        v1, v2 = ([int(x.scaleb(9)) for x in table[c].to_pylist()] for c in ("_v1", "_v2"))
        times = sorted({*one, *two})
        steps = chained_steps(times, start, end, one, two, v1, v2)
        return table.select(columns).append_column("step", pa.array([Decimal(x).scaleb(-9) for x in steps], pa.decimal128(27, 9)))

    picked = s.select(*keys, bundle.alias("_bundle"), "seq", "start_dt", "end_dt", "_start_dt", "_end_dt", "_anchor1", "_anchor2", "_v1", "_v2")
    return picked.groupBy(*keys, "_bundle").applyInArrow(fold, schema)


def chained_steps(times: list[int], start: list[int], end: list[int | None], one: list[int], two: list[int], v1: list[int], v2: list[int]) -> list[int]:
    """Steps of shifts in their order; ``times`` are the sorted times of all anchors."""
    tree = [0] * (len(times) + 1)

    def add(i: int, x: int) -> None:
        i += 1
        while i < len(tree):
            tree[i] += x
            i += i & -i

    def offset(at: int) -> int:
        i, total = bisect_right(times, at), 0
        while i:
            total += tree[i]
            i -= i & -i
        return total

    steps = []
    for a, e, t1, t2, x1, x2 in zip(start, end, one, two, v1, v2, strict=True):
        step = abs(x1 + offset(t1) - x2 - offset(t2))
        add(bisect_left(times, a), step)
        if e is not None:
            add(bisect_left(times, e), -step)
        steps.append(step)
    return steps


def drop_where_wide(df: DataFrame, ids: list[str], parameters: list[str], condition: str, value: str = "value") -> DataFrame:
    """Pivot to one column per parameter, drop the rows that match ``condition``, unpivot again."""
    wide = df.groupBy(*ids).pivot("parameter", parameters).agg(F.avg(value))
    kept = wide.filter(f"not coalesce({condition}, false)")
    return kept.unpivot(ids, parameters, "parameter", value).filter(F.col(value).isNotNull())


def wide_table(df: DataFrame, ids: list[str], parameters: list[str], value: str = "mean") -> DataFrame:
    return df.groupBy(*ids).pivot("parameter", parameters).agg(F.first(value, True))


def attach_metaparameters(df: DataFrame, source: DataFrame, ids: list[str], parameters: list[str], value: str = "mean") -> DataFrame:
    """Parameters such as temperature or battery of the same site and slot beside every row."""
    wide = wide_table(source.filter(F.col("parameter").isin(*parameters)), ids, parameters, value)
    return df.join(wide, ids, "left")


def clean_labels(df: DataFrame, site: str, site_other: str, kind: str, kind_other: str) -> DataFrame:
    other = "Other (please specify)"
    s = F.when(F.col(site) == other, F.lower(F.regexp_replace(site_other, " ", ""))).otherwise(F.col(site))
    k = F.regexp_replace(kind, r"\?\?\?", "Sensor Calibration or Check")
    k = F.when(F.contains(k, F.lit(other)), F.replace(k, F.lit(other), F.coalesce(kind_other, F.lit("")))).otherwise(k)
    return df.withColumns({site: s, kind: k})


def initials(names: Column | str) -> Column:
    c = F.col(names) if isinstance(names, str) else names
    c = F.regexp_replace(c, r"Other \(please specify\)", "Other")
    c = F.regexp_replace(c, r"([A-Z])[a-z]+", "$1")
    return F.regexp_replace(c, r"(?<=[A-Z])\s+(?=[A-Z])", "")


# Date layouts of the field notes.
NOTE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yy HH:mm", "MM/dd/yyyy HH:mm", "MMM dd yy HH:mm")


def parse_note_time(text: Column | str) -> Column:
    return tm.parse_any(text, NOTE_FORMATS)


def explode_pairs(df: DataFrame, left: str, right: str, pattern: str = r"\s*[;,]\s*") -> DataFrame:
    """Two lists in text cells side by side, one row per position (the shorter one is padded)."""
    n = F.greatest(F.size(F.split(left, pattern)), F.size(F.split(right, pattern)))
    others = [c for c in df.columns if c not in (left, right)]
    out = df.select("*", F.explode(F.sequence(F.lit(1), n)).alias("pos"))
    return out.select(*others, "pos", *[F.try_element_at(F.split(c, pattern), F.col("pos")).alias(c) for c in (left, right)])

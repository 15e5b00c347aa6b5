"""Field visits: selection, joins to the series, deployment state, audits and site networks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorqc.functions import time as tm
from sensorqc.plans.chunks import carry, carry_series, time_chunk
from sensorqc.plans.joins import newest_per_key
from sensorqc.series import Series

# Visit types that touch the sensors, and the malfunction type.
SENSOR_VISITS = "sensor cleaning or check|sensor calibration"
MALFUNCTION_VISIT = "sensor malfunction"


def select_visits(visits: DataFrame, pattern: str = SENSOR_VISITS) -> DataFrame:
    return visits.filter(F.lower("visit_type").rlike(pattern))


def deployment_state(pulled: str = "sensor_pulled", deployed: str = "sensor_deployed") -> Column:
    """1 when the sonde left the water at this visit, else 0."""
    out, back = F.col(pulled).isNotNull(), F.col(deployed).isNotNull()
    return F.when(out & ~back, 1).otherwise(0).cast("long")


def visit_slots(visits: DataFrame, time: str = "dt_round", order: str = "start_dt", columns: list[str] | None = None) -> DataFrame:
    """Newest visit of each (site, slot)."""
    cols = ["site", time, order, *[c for c in (columns or []) if c not in ("site", time, order)]]
    return newest_per_key(visits.select(*cols), ["site", time], [order, *[c for c in cols[3:]]])


def join_visits(series: DataFrame, slots: DataFrame, spec: Series) -> DataFrame:
    """Full outer join of every series with the visits of its site on the slot."""
    keys = series.select(*spec.keys).distinct()
    per_series = slots.join(keys, "site").withColumn("_visit", F.lit(True))
    out = series.withColumn("_row", F.lit(True)).join(per_series, [*spec.keys, spec.time], "full")
    marks = {"has_visit": F.coalesce("_visit", F.lit(False)), "on_grid": F.coalesce("_row", F.lit(False))}
    return out.withColumns(marks).drop("_visit", "_row")


def fill_state(joined: DataFrame, spec: Series, employed: str = "sonde_employed", extra: list[str] | None = None) -> DataFrame:
    """Carry the state of the last visit forward; before the first visit the sonde is not deployed."""
    visit = F.col("has_visit")
    fills = {
        "last_site_visit": F.when(visit, F.col(spec.time)),
        employed: F.when(visit, F.coalesce(F.col(employed), F.lit(0).cast("long"))),
        **{c: F.col(c) for c in extra or []},
    }
    out = carry_series(joined, spec, fills=fills)
    return out.withColumn(employed, F.coalesce(F.col(employed), F.lit(1).cast("long"))).filter(F.col("site").isNotNull())


def attach_visits(series: DataFrame, visits: DataFrame, spec: Series) -> DataFrame:
    """Series with ``sonde_employed`` and ``last_site_visit``."""
    state = visits.withColumn("sonde_employed", deployment_state())
    slots = visit_slots(state, columns=["sonde_employed"]).drop("start_dt")
    return fill_state(join_visits(series, slots, spec), spec)


def visit_state(series: DataFrame, visits: DataFrame, spec: Series, window_slots: int = 3) -> DataFrame:
    """Everything the flag pass needs to know about visits, from one carry.

    Adds ``sonde_employed``, ``last_site_visit``, ``has_visit``, ``in_sv_window``, ``visit_group``
    (rows since the same flagged visit row share it) and, if the visits carry it, ``depth_change``
    with ``sonde_moved``. Visit slots outside the series' grid act on the state only.
    """
    with_depth = "depth_change" in visits.columns
    extra = ["depth_change"] if with_depth else []
    state = visits.withColumn("sonde_employed", deployment_state())
    slots = visit_slots(state, columns=["sonde_employed", *extra]).drop("start_dt")
    joined = join_visits(series, slots, spec)
    visit, here = F.col("has_visit"), F.col(spec.time)
    employed = F.coalesce(F.col("sonde_employed"), F.lit(0).cast("long"))
    fills = {"_visit": F.when(visit, here), "_employed": F.when(visit, employed), **{f"_{c}": F.col(c) for c in extra}}
    d = carry_series(joined, spec, fills=fills, exclusive=True).filter("on_grid")
    reach = spec.step * window_slots
    d = d.withColumns(
        {
            "sonde_employed": F.when(visit, employed).otherwise(F.coalesce("_employed", F.lit(1).cast("long"))),
            "last_site_visit": F.when(visit, here).otherwise(F.col("_visit")),
            "in_sv_window": F.coalesce(tm.seconds_between(here, "_visit") <= reach, F.lit(False)),
            **{c: F.coalesce(c, f"_{c}") for c in extra},
        }
    )
    flagged = visit | F.col("in_sv_window")
    since = F.when(flagged, here).otherwise(tm.shift("last_site_visit", reach))
    d = d.withColumn("visit_group", F.coalesce(F.unix_seconds(since), F.lit(0).cast("long")))
    if with_depth:
        d = d.withColumn("sonde_moved", F.coalesce(F.col("depth_change") != 0, F.lit(False)))
    return d.drop("_visit", "_employed", "on_grid", *[f"_{c}" for c in extra])


def fill_down(df: DataFrame, spec: Series, columns: list[str]) -> DataFrame:
    return carry_series(df, spec, fills={c: F.col(c) for c in columns})


def measurements_long(visits: DataFrame, ids: list[str], columns: list[str], parameters: dict[str, str]) -> DataFrame:
    """Columns named <prefix>_<type> to (parameter, type, value); prefixes map to parameters."""
    long = visits.unpivot(ids, columns, "_name", "value").filter(F.col("value").isNotNull())
    prefix, kind = F.substring_index("_name", "_", 1), F.regexp_replace("_name", "^[^_]*_", "")
    name = F.lit(None).cast("string")
    for key, parameter in parameters.items():
        name = F.when(prefix == key, F.lit(parameter)).otherwise(name)
    return long.select(*ids, name.alias("parameter"), kind.alias("type"), "value")


def pre_post_pairs(long: DataFrame, ids: list[str], types=("pre_clean", "post_clean")) -> DataFrame:
    scaled = F.when(F.col("parameter") == "ORP", F.col("value") / 1000).otherwise(F.col("value"))
    wide = long.withColumn("value", scaled).groupBy(*ids, "parameter").pivot("type", list(types)).agg(F.first("value", True))
    return wide.filter(" and ".join(f"{t} is not null" for t in types))


def hours_since_cleaning(df: DataFrame, time: str = "dt_round") -> DataFrame:
    return df.withColumn("hours_since_cleaning", tm.seconds_between(time, "last_site_visit") / 3600)


def visit_groups(df: DataFrame, spec: Series, visit: Column, name: str = "visit_group") -> DataFrame:
    """Running number of visits; rows from one visit to the next share a number."""
    return carry_series(df, spec, sums={name: F.when(visit, 1).otherwise(0).cast("long")})


def malfunctions(visits: DataFrame) -> DataFrame:
    return visits.filter(F.lower("visit_type").contains(MALFUNCTION_VISIT))


def split_qc_samples(samples: DataFrame, metadata: DataFrame, kind: str = "sample_type", on: str = "site") -> DataFrame:
    """DUPLICATE and BLANK rows relabelled beside the normal ones, with site metadata."""
    qc = F.col(kind).isin("DUPLICATE", "BLANK")
    normal = samples.filter(~F.coalesce(qc, F.lit(False))).withColumn("label", F.col(on))
    extra = samples.filter(qc).withColumn("label", F.concat_ws("_", F.col(on), F.lower(kind)))
    return normal.unionByName(extra).join(metadata, on, "left")


def missing_artifacts(expected: DataFrame, present: DataFrame, name: str = "file_name", wanted: str = "collected") -> DataFrame:
    """Expected files that are not listed; 'user error' where the note says none was taken but one exists."""
    p = present.select(name).distinct().withColumn("_there", F.lit(True))
    out = expected.join(p, name, "left").withColumn("_there", F.coalesce("_there", F.lit(False)))
    took = F.coalesce(F.lower(wanted) == "yes", F.lit(False))
    status = F.when(took & ~F.col("_there"), "missing").when(~took & F.col("_there"), "user error")
    return out.withColumn("status", status).filter(F.col("status").isNotNull()).drop("_there")


def current_locations(reports: DataFrame, inventory: DataFrame, serial: str = "serial", lent: str = "owner") -> DataFrame:
    """Sensors of the newest report per site; inventory sensors in no report are in the lab or lent out."""
    newest = reports.groupBy("site").agg(F.max("report_time").alias("report_time"))
    placed = reports.join(newest, ["site", "report_time"]).select(serial, F.col("site").alias("location"))
    placed = placed.groupBy(serial).agg(F.max("location").alias("location"))
    found = inventory.join(placed, serial, "inner")
    lost = inventory.join(placed, serial, "left_anti")
    where = F.when(F.col(lent).isNotNull(), "Lent Out").otherwise("Lab")
    return found.unionByName(lost.withColumn("location", where))


def swap_audit(swaps: DataFrame, keys: list[str], time: str = "swap_time", removed: str = "removed", deployed: str = "deployed", chunk_seconds: int = 31_536_000) -> DataFrame:
    """Each swap with the serial that should have been there; ``mismatch`` marks broken chains."""
    out = carry(swaps, keys, time_chunk(time, chunk_seconds), [time, deployed], fills={"expected": F.col(deployed)}, exclusive=True)
    bad = F.col("expected").isNotNull() & ~F.col(removed).eqNullSafe(F.col("expected"))
    return out.withColumn("mismatch", bad)


def swap_history(audited: DataFrame, keys: list[str], time: str = "swap_time", deployed: str = "deployed", chunk_seconds: int = 31_536_000) -> DataFrame:
    """One row per deployed serial with its period; the open one is the current sensor."""
    out = carry(audited, keys, time_chunk(time, chunk_seconds), [time, deployed], fills={"until": F.col(time)}, backward=True, exclusive=True)
    return out.select(*keys, F.col(deployed).alias("serial"), F.col(time).alias("since"), "until", F.col("until").isNull().alias("is_current"))


def metadata_join(df: DataFrame, metadata: DataFrame, time: str, bucket_seconds: int, margin: int = 86400, start: str = "data_start", end: str = "data_end") -> DataFrame:
    """Left join to every metadata range of the site that holds the row, widened by a margin."""
    from sensorqc.plans.joins import interval_join

    m = metadata.withColumns({"_from": tm.shift(start, -margin), "_to": tm.shift(end, margin)})
    return interval_join(df, m, ["site"], time, "_from", "_to", bucket_seconds).drop("_from", "_to")


def media_slots(media: DataFrame, name: str, pattern: str, layout: str, step: int = 1800) -> DataFrame:
    """One picture per (site, slot) by the time in its name."""
    taken = F.try_to_timestamp(F.regexp_extract(name, pattern, 1), F.lit(layout))
    d = media.withColumn("taken", taken).filter(F.col("taken").isNotNull())
    return newest_per_key(d.withColumn("dt_round", tm.round_slot("taken", step)), ["site", "dt_round"], ["taken", name], newest=False)


def chain_neighbours(network: DataFrame) -> DataFrame:
    """Previous and next site of each ordered network (a network is a hand-made list)."""
    w = Window.partitionBy("network").orderBy("pos")
    return network.withColumns({"upstream": F.lag("site").over(w), "downstream": F.lead("site").over(w)})


def neighbour_pairs(network: DataFrame) -> DataFrame:
    """(site, neighbour) both ways, by equi-join on the neighbouring position."""
    a = network.select("network", F.col("pos"), "site")
    b = network.select("network", (F.col("pos") - 1).alias("pos"), F.col("site").alias("neighbour"))
    down = a.join(b, ["network", "pos"]).select("site", "neighbour")
    return down.unionByName(down.select(F.col("neighbour").alias("site"), F.col("site").alias("neighbour"))).distinct()


def gauge_slice(gauges: DataFrame, site_gauges: DataFrame, bounds: DataFrame, time: str, margin: int = 2 * 86400) -> DataFrame:
    """Gauge rows of each site's gauge between the site's first and last time, widened."""
    g = gauges.join(site_gauges, "gauge").join(bounds, "site")
    return g.filter(F.col(time).between(tm.shift("first_dt", -margin), tm.shift("last_dt", margin))).drop("first_dt", "last_dt")


def replicate_to_alias(visits: DataFrame, sites: list[str], year: int, suffix: str = "_virridy", time: str = "start_dt") -> DataFrame:
    copies = visits.filter(F.col("site").isin(*sites) & (F.year(time) == year))
    return visits.unionByName(copies.withColumn("site", F.concat("site", F.lit(suffix))))

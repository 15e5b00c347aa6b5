"""Slot arithmetic and calendar parts as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS = 1_000_000

# Month -> season as used by the threshold tables.
SEASON_MONTHS = {
    "winter_baseflow": (12, 1, 2, 3, 4),
    "snowmelt": (5, 6),
    "monsoon": (7, 8, 9),
    "fall_baseflow": (10, 11),
}

# Month -> season of the one-off seasonal report.
REPORT_SEASON_MONTHS = {
    "Nov-Apr": (11, 12, 1, 2, 3, 4),
    "May-Jun": (5, 6),
    "Jul-Aug": (7, 8),
    "Sep-Oct": (9, 10),
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_slot(ts: Column | str, step: int = 900) -> Column:
    micros = F.unix_micros(_col(ts))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(step * MICROS)))


def round_slot(ts: Column | str, step: int = 900) -> Column:
    """Nearest slot, exact halves go up."""
    micros = F.unix_micros(_col(ts)) + F.lit(step * MICROS // 2)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(step * MICROS)))


def slot_number(ts: Column | str, step: int = 900) -> Column:
    seconds = F.unix_seconds(_col(ts))
    return ((seconds - F.pmod(seconds, F.lit(step))) / F.lit(step)).cast("long")


def shift(ts: Column | str, seconds: Column | int) -> Column:
    offset = F.lit(seconds) if isinstance(seconds, (int, float)) else seconds
    return F.timestamp_micros(F.unix_micros(_col(ts)) + (offset.cast("double") * float(MICROS)).cast("long"))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    return (F.unix_micros(_col(later)) - F.unix_micros(_col(earlier))) / F.lit(float(MICROS))


def to_zone(ts: Column | str, zone: str) -> Column:
    """UTC instant as wall-clock time of a zone ('MST' is fixed at -07:00)."""
    return F.from_utc_timestamp(_col(ts), zone)


def week_number(ts: Column | str) -> Column:
    """Week of the year counted from January 1 in blocks of seven days (not ISO)."""
    return (F.floor((F.dayofyear(_col(ts)) - 1) / 7) + 1).cast("long")


def season(ts: Column | str, months: dict[str, tuple[int, ...]] | None = None) -> Column:
    month = F.month(_col(ts))
    out = F.lit(None).cast("string")
    for name, members in (months or SEASON_MONTHS).items():
        out = F.when(month.isin(*members), F.lit(name)).otherwise(out)
    return out


def water_year(ts: Column | str) -> Column:
    t = _col(ts)
    return (F.year(t) + F.when(F.month(t) >= 10, 1).otherwise(0)).cast("long")


def calendar(ts: Column | str) -> dict[str, Column]:
    t = _col(ts)
    year, week, day = F.year(t).cast("long"), week_number(t), F.dayofyear(t).cast("long")
    return {
        "year": year,
        "month": F.month(t).cast("long"),
        "week": week,
        "weekday": F.dayofweek(t).cast("long"),
        "day": day,
        "y_m": F.concat_ws(" - ", year, F.month(t)),
        "y_w": F.concat_ws(" - ", year, week),
        "y_d": F.concat_ws(" - ", year, day),
        "season": season(t),
    }


def parse_any(text: Column | str, formats: tuple[str, ...]) -> Column:
    """First format that parses wins; unparsable text gives NULL."""
    c = _col(text)
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])

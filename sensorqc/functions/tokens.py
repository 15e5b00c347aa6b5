"""Flag tokens: an ``array<string>`` inside, a ';\\n'-separated string at the edges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

SEPARATOR = ";\n"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty() -> Column:
    return F.array().cast("array<string>")


def parse(text: Column | str) -> Column:
    parts = F.transform(F.split(F.coalesce(_col(text), F.lit("")), ";"), lambda t: F.trim(F.regexp_replace(t, r"[\r\n]+", "")))
    return F.filter(parts, lambda t: t != "")


def render(flags: Column | str) -> Column:
    f = _col(flags)
    return F.when(F.size(f) > 0, F.array_join(f, SEPARATOR))


def has(flags: Column | str, token: str) -> Column:
    return F.coalesce(F.array_contains(_col(flags), token), F.lit(False))


def has_any(flags: Column | str, tokens) -> Column:
    return F.coalesce(F.arrays_overlap(_col(flags), F.array(*[F.lit(t) for t in tokens])), F.lit(False))


def add(flags: Column | str, condition: Column, token: str) -> Column:
    """Append where the condition is TRUE; NULL conditions leave the flags alone."""
    f = _col(flags)
    return F.when(condition, F.array_append(f, F.lit(token))).otherwise(f)


def add_all(flags: Column | str, rules: list[tuple[Column, str]]) -> Column:
    fired = F.array_compact(F.array(*[F.when(cond, F.lit(token)) for cond, token in rules]))
    return F.concat(_col(flags), fired)


def replace(flags: Column | str, condition: Column, old: str, new: str) -> Column:
    f = _col(flags)
    return F.when(condition, F.transform(f, lambda t: F.when(t == old, F.lit(new)).otherwise(t))).otherwise(f)


def remove(flags: Column | str, *tokens: str, when: Column | None = None) -> Column:
    f = _col(flags)
    kept = F.filter(f, lambda t: ~t.isin(*tokens) & (F.trim(t) != ""))
    return kept if when is None else F.when(when, kept).otherwise(f)


def equals_any_set(flags: Column | str, sets) -> Column:
    """TRUE when the distinct tokens are exactly one of the given sets."""
    have = F.array_sort(F.array_distinct(_col(flags)))
    tests = [have == F.array(*[F.lit(t) for t in sorted(s)]) for s in sets]
    return reduce(lambda a, b: a | b, tests)

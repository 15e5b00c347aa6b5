"""Registration of named queries and expansion of their check SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from sensorqc.catalog.fixtures import CTES, Tables
from sensorqc.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6

#: Rows of an Arrow batch in these queries, whatever other parts of the session have set.
ARROW_ROWS = 10_000


def emit(df: DataFrame) -> DataFrame:
    """Rounded doubles, 64-bit integers and zone-free timestamps, so both engines print alike."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(F.nanvl(c, F.lit(None).cast("double")), DIGITS)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _used(sql: str, seen: list[str]) -> list[str]:
    for name in re.findall(r"\bfx_\w+", sql):
        if name not in seen:
            _used(CTES[name], seen)
            seen.append(name)
    return seen


def expand(body: str) -> str:
    """Prepend the shared table expressions a check uses; ``@x`` stands for ``round(x, 6) AS x``."""
    body = re.sub(r"@(\w+)", rf"round(\1, {DIGITS}) AS \1", body)
    names = _used(body, [])
    ctes = ",\n".join(f"{n} AS ({CTES[n]})" for n in names)
    if not ctes:
        return body
    if body.lstrip().upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body.lstrip()[15:]}"
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes},\n{body.lstrip()[5:]}"
    return f"WITH {ctes}\n{body}"


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
            return emit(fn(Tables(spark, sf_dir)))

        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = expand(sql)
        return fn

    return register

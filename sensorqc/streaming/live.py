"""Structured Streaming forms of the ingest and alarm operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from sensorqc.functions import time as tm, tokens
from sensorqc.operators.reporting import suppress_alarms
from sensorqc.plans.chunks import time_chunk
from sensorqc.plans.joins import newest_per_key
from sensorqc.session import work_dir

WATERMARK = "24 hours"


def read_files(spark: SparkSession, path: str, schema: T.StructType, time: str = "ts", files_per_trigger: int = 1000) -> DataFrame:
    """File stream; zone-free times become instants, as watermarks need them."""
    d = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return d.withColumn(time, F.col(time).cast("timestamp"))


def run_to_table(stream: DataFrame, name: str, place: str | None = None) -> DataFrame:
    """Run over everything available and read the written table back.

    ``place`` is the folder of table and checkpoint; a run at the place of an earlier one goes on from there.
    """
    spark = stream.sparkSession
    place = place or work_dir(spark, name)
    out, state = f"{place}/table", f"{place}/state"
    q = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", state).trigger(availableNow=True).start(out)
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_updates(stream: DataFrame, name: str, keys: list[str], place: str | None = None) -> DataFrame:
    """Run over everything available in update mode; each key's newest state, so slots still open are there too.

    A batch writes its changed rows into a folder of its own, which a repeated batch overwrites. ``place`` is as in
    ``run_to_table``.
    """
    spark = stream.sparkSession
    place = place or work_dir(spark, name)
    out, state = f"{place}/table", f"{place}/state"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).start()
    q.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    return newest_per_key(spark.read.schema(schema).parquet(out), keys, ["batch_id"]).drop("batch_id")


def slot_stream(readings: DataFrame, step: int = 900, ts: str = "ts", value: str = "value", keys=("site", "parameter"), watermark: str = WATERMARK) -> DataFrame:
    """Tumbling slot statistics around the nearest slot; a slot is final once the watermark passed it."""
    half = step // 2
    d = readings.withColumn("_t", tm.shift(ts, half)).withWatermark("_t", watermark)
    v = F.col(value)
    agg = d.groupBy(*keys, F.window("_t", f"{step} seconds")).agg(F.avg(v).alias("mean"), (F.max(v) - F.min(v)).alias("spread"), F.count(v).alias("n_obs"))
    return agg.select(*keys, F.col("window.start").alias("dt_round"), "mean", "spread", "n_obs")


def dedupe_stream(readings: DataFrame, keys: list[str], ts: str = "ts", watermark: str = WATERMARK) -> DataFrame:
    return readings.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)


def session_stream(readings: DataFrame, gap: str, keys: list[str], ts: str = "ts", watermark: str = WATERMARK) -> DataFrame:
    d = readings.withWatermark(ts, watermark).groupBy(*keys, F.session_window(ts, gap)).agg(F.count(F.lit(1)).alias("n"))
    return d.select(*keys, F.col("session_window.start").alias("start_dt"), F.col("session_window.end").alias("end_dt"), "n")


def open_sessions(readings: DataFrame, done: DataFrame, gap: str, keys: list[str], ts: str = "ts") -> DataFrame:
    """Sessions that a finished run of ``session_stream`` still held in state, from the readings as a batch.

    ``done`` are the sessions it wrote; sessions close in the order of time, so a key's later rows are open.
    """
    last = done.groupBy(*keys).agg(F.max("end_dt").alias("_end"))
    rest = readings.withColumn(ts, F.col(ts).cast("timestamp")).join(last, keys, "left")
    rest = rest.filter(F.col("_end").isNull() | (F.col(ts) >= F.col("_end")))
    d = rest.groupBy(*keys, F.session_window(ts, gap)).agg(F.count(F.lit(1)).alias("n"))
    return d.select(*keys, F.col("session_window.start").alias("start_dt"), F.col("session_window.end").alias("end_dt"), "n")


def flag_stream(readings: DataFrame, limits: DataFrame, visits: DataFrame, step: int, value: str = "value", ts: str = "ts") -> DataFrame:
    """Stream rows against static limits and visit slots."""
    d = readings.withColumn("dt_round", tm.floor_slot(ts, step))
    d = d.join(limits.select("parameter", "lo", "hi"), "parameter", "left")
    d = d.join(visits.select("site", "dt_round").distinct().withColumn("_v", F.lit(True)), ["site", "dt_round"], "left")
    outside = (F.col(value) < F.col("lo")) | (F.col(value) > F.col("hi"))
    flags = tokens.add_all(tokens.empty(), [(F.col("_v").isNotNull(), "site visit"), (outside, "outside of sensor specification range")])
    return d.withColumn("flag", tokens.render(flags)).drop("_v", "lo", "hi")


def alarm_stream(readings: DataFrame, classify: Callable[[DataFrame], DataFrame], keys: list[str], order: list[str], name: str = "alarms", chunk_seconds: int = 86400) -> DataFrame:
    """Alarm suppression over micro-batches.

    The state is one row per key: its newest trigger. Each batch stacks that row before its own
    rows and uses the batch operator, so a hot key is still split by time. Output and state are
    written per batch id, which makes a repeated batch harmless.
    """
    spark = readings.sparkSession
    out, states, log = work_dir(spark, name), work_dir(spark, f"{name}-triggers"), work_dir(spark, f"{name}-state")
    chunk: Column = time_chunk(order[0], chunk_seconds)

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = classify(batch).withColumn("_fresh", F.lit(True))
        if batch_id > 0:
            rows = rows.unionByName(batch.sparkSession.read.parquet(f"{states}/batch={batch_id - 1}"), allowMissingColumns=True)
        done = suppress_alarms(rows, keys, order, chunk)
        done.filter("_fresh").drop("_fresh").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*order, "trigger"), F.struct(*order)).alias("_s"))
        newest.select(*keys, "_s.*", F.lit(False).alias("_fresh")).write.mode("overwrite").parquet(f"{states}/batch={batch_id}")

    q = readings.writeStream.foreachBatch(handle).option("checkpointLocation", log).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out).drop("batch")


def overlap_stream(readings: DataFrame, update: Callable[[DataFrame, int], None], name: str = "overlap") -> None:
    """Run a batch update (overlap combine, flag pass, restate tail) for every micro-batch."""
    log = work_dir(readings.sparkSession, f"{name}-state")
    readings.writeStream.foreachBatch(update).option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()

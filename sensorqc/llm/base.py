"""What the operators of this folder share: table access, settings, Arrow maps, word splitting."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from sensorqc.session import materialise, ship_package

#: Rows of one Arrow batch; whole texts travel in them, so they stay small.
BATCH_ROWS = 1000

#: Bytes of one Arrow batch; a batch ends with the row that passes them.
BATCH_BYTES = 4 << 20

#: Size of the id filter: 2^24 bits.
FILTER_BITS = 24

#: Word breaks: space and the five ASCII control characters tab to carriage return.
WORD_BREAKS = r"[ \t-\r]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that the Python parts rely on, and the package on every worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # joins are hashed instead of sorted where every partition of one side has turned out small
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow``, after which the worker, which Spark keeps for other tasks, gives its memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back_memory()

    return df.mapInArrow(run, schema)


def give_back_memory() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, empty for null."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Words as the contracts define them; ``bytes.split`` breaks at exactly the six ASCII white-space bytes."""
    return text.split()


def split_words(text) -> Column:
    """The same words as an array of strings, on the JVM side; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAKS), lambda w: w != "")


def _cells(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Word and bit of each id in the filter of ``id_filter``."""
    with np.errstate(over="ignore"):
        h = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - size)
    return (h >> np.uint64(6)).astype(np.int64), h & np.uint64(63)


def id_filter(ids: DataFrame, size: int = FILTER_BITS) -> Callable[[pa.Array], np.ndarray]:
    """A test that is true for every id of the one-column ``ids`` and for few others.

    It is a bit map of 2^size bits whatever the number of ids (2 MB, if not told otherwise), so it may be sent to all
    tasks; with very many ids it lets more through, and the join that follows does the rest. Nulls and
    ids that aren't integers always pass.
    """
    spark, (name,) = ids.sparkSession, ids.columns
    if ids.schema[name].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return lambda column: np.ones(len(column), bool)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (size - 6), np.uint64)
        for b in batches:
            word, bit = _cells(b.column(0).drop_null().to_numpy(zero_copy_only=False), size)
            np.bitwise_or.at(bits, word, np.uint64(1) << bit)
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits[at].view(np.int64))], ["word", "bits"])

    words = arrow_map(ids, mark, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    row = words.agg(F.collect_list("word").alias("word"), F.collect_list("bits").alias("bits")).first()
    bits = np.zeros(1 << (size - 6), np.uint64)
    bits[np.array(row["word"], np.int64)] = np.array(row["bits"], np.int64).view(np.uint64)
    shared = spark.sparkContext.broadcast(bits)

    def test(column: pa.Array) -> np.ndarray:
        values = column.fill_null(0).to_numpy(zero_copy_only=False)
        word, bit = _cells(values, size)
        return ((shared.value[word] >> bit) & np.uint64(1)).astype(bool) | column.is_null().to_numpy(zero_copy_only=False)

    return test


__all__ = ["BATCH_BYTES", "BATCH_ROWS", "WORD_BREAKS", "arrow_map", "id_filter", "materialise", "prepare", "split_words", "table", "texts_of", "words_of"]

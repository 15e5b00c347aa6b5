"""A history of series kept as Parquet, one partition per series and year, of which updates replace only what they touch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from sensorqc.functions import time as tm

_LOG = "batch string, phase string"


@dataclass(frozen=True)
class SeriesStore:
    """Rows of ``schema`` under ``path``, partitioned by ``keys`` and the year of ``time``.

    An update has a name. It first writes the whole new content of the partitions that it touches beside the store,
    notes that in a log, replaces those partitions (dynamic partition overwrite), and notes that it is done. So an
    update that is run again does nothing, one that broke off before its first note starts anew, and one that broke
    off later replaces the same partitions with the same content. Files of other partitions are never written.
    A partition that an update leaves without rows holds one row marked ``_gone``.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...] = ("site", "parameter")
    time: str = "dt_round"

    @property
    def parts(self) -> list[str]:
        return [*self.keys, "_year"]

    def _with_year(self, df: DataFrame) -> DataFrame:
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        return rows.withColumn("_year", F.year(self.time))

    def _stored(self) -> T.StructType:
        own = [f for f in self.schema if f.name not in self.keys]
        return T.StructType([*own, T.StructField("_gone", T.BooleanType()), *(self.schema[k] for k in self.keys), T.StructField("_year", T.IntegerType())])

    def create(self, rows: DataFrame) -> SeriesStore:
        self._write(self._with_year(rows).withColumn("_gone", F.lit(False)))
        self._note("", "created")
        return self

    def read(self) -> DataFrame:
        return self._rows().select(*self.schema.names)

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(self._stored()).parquet(f"{self.path}/data").filter(~F.col("_gone")).drop("_gone")

    def _write(self, rows: DataFrame) -> None:
        dealt = rows.repartition(*self.parts)  # a partition is one series and year: one file
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.parts).parquet(f"{self.path}/data")

    def _note(self, batch: str, phase: str) -> None:
        self.spark.createDataFrame([(batch, phase)], _LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/_log")

    def _noted(self, batch: str, phase: str) -> bool:
        log = self.spark.read.schema(_LOG).parquet(f"{self.path}/_log")
        return not log.filter((F.col("batch") == batch) & (F.col("phase") == phase)).isEmpty()

    def replace(self, batch: str, touched: DataFrame, content: DataFrame) -> None:
        """Replaces the partitions ``touched`` (``parts``) by ``content``, which has rows of those partitions only."""
        if self._noted(batch, "done"):
            return
        staged = f"{self.path}/_staged/batch={batch}"
        if not self._noted(batch, "staged"):
            rows = content.select(*self.schema.names, "_year", F.lit(False).alias("_gone"))
            empty = touched.select(*self.parts).distinct().join(content.select(*self.parts).distinct(), self.parts, "left_anti").withColumn("_gone", F.lit(True))
            rows.unionByName(empty, allowMissingColumns=True).write.mode("overwrite").parquet(staged)
            self._note(batch, "staged")
        self._write(self.spark.read.parquet(staged))
        self._note(batch, "done")

    def append(self, incoming: DataFrame, batch: str) -> None:
        """New rows, exact copies once."""
        new = self._with_year(incoming)
        touched = new.select(*self.parts).distinct()
        old = self._rows().join(touched, self.parts, "left_semi")
        self.replace(batch, touched, old.unionByName(new).distinct())

    def restate(self, reflagged: DataFrame, batch: str, overlap: int = 24 * 3600) -> None:
        """The last ``overlap`` seconds of every series in ``reflagged`` give way to its rows."""
        keys = list(self.keys)
        new = self._with_year(reflagged)
        series = new.select(*keys).distinct()
        old = self._rows().join(series, keys, "left_semi")
        edge = old.groupBy(*keys).agg(tm.shift(F.max(self.time), -overlap).alias("_edge"))
        old = old.join(edge, keys)
        changed = old.filter(F.col(self.time) >= F.col("_edge")).select(*self.parts)
        touched = changed.unionByName(new.select(*self.parts)).distinct()
        kept = old.filter(F.col(self.time) < F.col("_edge")).drop("_edge").join(touched, self.parts, "left_semi")
        self.replace(batch, touched, kept.unionByName(new))

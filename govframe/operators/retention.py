"""Retention by whole days (K-10): old days move by a catalogue entry, only the day that the cut divides is rewritten.

A ``DayLog`` keeps its rows in folders of one day each, ``data/<load>/day=<date>``, and a small catalogue,
one row per folder: the day, the number of rows, and whether the folder is live or archived.  Every
change writes the next version of the catalogue and nothing else, except that the day through which
the cut passes is written anew as two folders.  So a retention run over 100 TB costs one day of rows
whatever the length of the log.

* The catalogue is written last.  A run that dies before leaves folders that no version names; it can
  be run again.  Two runs on one version: the second fails on the version's folder, nothing is lost.
* Rows without a time are in the folder of the null day and are never archived.
* Rows repeat as often as they were written.  An empty log has an empty catalogue and reads as no rows.
* The catalogue on the driver has one row per day and load, never one per log row.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIVE, ARCHIVED = "live", "archived"
CATALOGUE = T.StructType([
    T.StructField("folder", T.StringType()), T.StructField("day", T.DateType()), T.StructField("state", T.StringType()),
    T.StructField("n", T.LongType()), T.StructField("rewritten", T.BooleanType()),
])
_DAY = "_day"  # the partition column of the folders, not a column of the log


@dataclass(frozen=True)
class DayLog:
    """One version of a log stored by day; ``schema`` is that of its rows."""

    root: str
    version: int
    time_col: str
    schema: T.StructType

    def catalogue(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(CATALOGUE).parquet(f"{self.root}/catalogue/v={self.version}")

    def read(self, spark: SparkSession, state: str = LIVE, since: _dt.date | None = None) -> DataFrame:
        """The rows in folders of ``state``; with ``since``, only folders of that day or later are opened."""
        entries = self.catalogue(spark).filter(F.col("state") == state)
        if since is not None:
            entries = entries.filter(F.col("day") >= F.lit(since))
        return self._rows(spark, [r.folder for r in entries.select("folder").collect()])  # one per day and load

    def append(self, rows: DataFrame) -> DayLog:
        """The next version, with ``rows`` in day folders of their own."""
        spark = rows.sparkSession
        added = self._write(rows, LIVE, rewritten=False)
        return self._commit(self.catalogue(spark).unionByName(added) if self.version else added)

    def retain(self, spark: SparkSession, as_of: str | _dt.datetime, days: int) -> DayLog:
        """The next version, in which rows before ``as_of`` less ``days`` are archived."""
        cut = (_dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of) - _dt.timedelta(days=days)
        cut_day = cut.date()
        divided = cut != _dt.datetime.combine(cut_day, _dt.time())
        entries = self.catalogue(spark)
        on_cut = F.coalesce((F.col("day") == F.lit(cut_day)) & (F.col("state") == LIVE), F.lit(False)) & F.lit(divided)
        old = F.coalesce(F.col("day") < F.lit(cut_day), F.lit(False))
        after = entries.filter(~on_cut).withColumn("state", F.when(old, F.lit(ARCHIVED)).otherwise(F.col("state")))
        folders = [r.folder for r in entries.filter(on_cut).select("folder").collect()]  # the loads of one day
        if folders:
            rows = self._rows(spark, folders)
            before = F.col(self.time_col) < F.lit(cut).cast("timestamp_ntz")
            after = after.unionByName(self._write(rows.filter(before), ARCHIVED, rewritten=True))
            after = after.unionByName(self._write(rows.filter(~before), LIVE, rewritten=True))
        return self._commit(after)

    def _rows(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def _write(self, rows: DataFrame, state: str, rewritten: bool) -> DataFrame:
        """Write ``rows`` by day, ordered by time inside a file, and return their catalogue entries."""
        spark = rows.sparkSession
        load = f"data/{uuid.uuid4().hex}"
        named = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema], F.to_date(self.time_col).alias(_DAY))
        # by day and time: a task writes few days, and a day with a third of the rows is written by several tasks
        (named.repartitionByRange(_DAY, self.time_col).sortWithinPartitions(_DAY, self.time_col)
         .write.partitionBy(_DAY).parquet(f"{self.root}/{load}"))
        written = spark.read.schema(T.StructType([T.StructField(_DAY, T.DateType())])).parquet(f"{self.root}/{load}")
        folder = F.concat(F.lit(f"{load}/{_DAY}="), F.coalesce(F.col(_DAY).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
        return written.groupBy(_DAY).agg(F.count(F.lit(1)).alias("n")).select(
            folder.alias("folder"), F.col(_DAY).alias("day"), F.lit(state).alias("state"), "n", F.lit(rewritten).alias("rewritten"))

    def _commit(self, entries: DataFrame) -> DayLog:
        following = DayLog(self.root, self.version + 1, self.time_col, self.schema)
        # one file: the catalogue has a row per day and load
        entries.select(*CATALOGUE.names).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/catalogue/v={following.version}")
        return following


def write_day_log(rows: DataFrame, root: str, time_col: str) -> DayLog:
    """Store ``rows`` as the first version of a log by day."""
    if _DAY in rows.columns:
        raise ValueError(f"{_DAY} names the folders of a day log and can be no column of it")
    return DayLog(root.rstrip("/"), 0, time_col, rows.schema).append(rows)

"""Counts per key kept by a change feed (L-5): signed deltas by batch id, safe to replay.

A feed is a folder: ``base`` holds versions of the counts, ``v=<n>`` with all batches up to n in them;
``deltas`` holds one folder ``batch=<n>`` for each batch since.  A batch that comes again, as Structured
Streaming sends it after a failure, overwrites its own folder, or, if it is in the base already, nothing.  So the
counts do not depend on how often a batch is sent.  ``compact`` folds the deltas into a new base version; it
leaves the folders it has read where they are, and readers go by the newest version.

Work follows the batch: each is pre-aggregated to a row per key, and the stored counts are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

#: Version of the first base: smaller than any batch id.
START = -1


@dataclass(frozen=True)
class CountFeed:
    """A feed in ``path``; ``key``: fields of the key; the sign column of a change is +1 (inserted) or -1 (deleted)."""

    path: str
    key: T.StructType
    sign: str = "sign"
    total: str = "total"

    @property
    def names(self) -> Sequence[str]:
        return self.key.names

    def create(self, counts: DataFrame) -> None:
        """Start a feed from counts (key, total)."""
        self._rows(counts).write.mode("errorifexists").parquet(f"{self.path}/base/v={START}")

    def _rows(self, counts: DataFrame) -> DataFrame:
        return counts.select(*self.names, F.col(self.total).cast("long").alias(self.total))

    def _stored(self, spark: SparkSession, part: str, by: str) -> DataFrame:
        schema = T.StructType([*self.key.fields, T.StructField(self.total, T.LongType()), T.StructField(by, T.LongType())])
        return spark.read.schema(schema).option("basePath", f"{self.path}/{part}").parquet(f"{self.path}/{part}")

    def folded(self, spark: SparkSession) -> int:
        """The last batch that is in the base, from folder names."""
        return max((int(f.rpartition("=")[2]) for f in self._folders(spark, "base")), default=START)

    def _folders(self, spark: SparkSession, part: str) -> list[str]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []

    def write_batch(self, changes: DataFrame, batch_id: int) -> None:
        """Store the deltas of one batch of changes (key columns and sign); the form that ``foreachBatch`` calls."""
        if batch_id <= self.folded(changes.sparkSession):
            return  # folded already
        deltas = changes.groupBy(*self.names).agg(F.sum(F.col(self.sign).cast("long")).alias(self.total)).filter(F.col(self.total) != 0)
        self._rows(deltas).write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch_id}")

    def _summed(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        newest = self.folded(spark)
        all_rows = self._stored(spark, "base", "v").filter(F.col("v") == newest).drop("v")
        if self._folders(spark, "deltas"):
            later = self._stored(spark, "deltas", "batch").filter(F.col("batch") > newest)
            all_rows = all_rows.unionByName((later.filter(F.col("batch") <= upto) if upto is not None else later).drop("batch"))
        return all_rows.groupBy(*self.names).agg(F.sum(self.total).cast("long").alias(self.total)).filter(F.col(self.total) != 0)

    def counts(self, spark: SparkSession) -> DataFrame:
        """Keys with a positive count."""
        return self._summed(spark).filter(F.col(self.total) > 0)

    def negative(self, spark: SparkSession) -> DataFrame:
        """Keys of which more rows went than ever came: a fault of the feed, reported and not hidden by ``compact``."""
        return self._summed(spark).filter(F.col(self.total) < 0)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold the batches up to ``upto`` into the base."""
        if upto > self.folded(spark):
            self._summed(spark, upto).write.mode("errorifexists").parquet(f"{self.path}/base/v={upto}")

    def start(self, changes: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Keep the counts from a stream of changes."""
        return changes.writeStream.foreachBatch(self.write_batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()

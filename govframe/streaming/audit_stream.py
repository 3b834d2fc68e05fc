"""Structured Streaming forms of the append-only logs (re-aim of SURVEY §M).

* ``action_summary_stream`` -- the per-user, per-action summary (count,
  first, last) over event-time windows with a watermark, so state for old
  windows is dropped and late rows beyond the watermark are ignored.
* ``start_session_stream`` -- the session table kept up to date from a
  stream of LOGIN / LOGOUT events.  Each micro-batch is applied with the
  same ``apply_session_events`` operator as the batch job and written as
  partition ``v=<batch id>`` of a Parquet table in the shared folder;
  re-running a batch after a failure overwrites only its own partition,
  so the sink is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from govframe.operators.security import apply_session_events


def read_log_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None,
                    max_files_per_trigger: int | None = 64) -> DataFrame:
    """A Parquet directory as an append-only stream (explicit schema, no inference).

    ``max_files_per_trigger`` bounds a micro-batch, so a long log is not read as one; ``None`` lifts it.
    """
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def action_summary_stream(stream: DataFrame, keys: list[str], time_col: str, window: str = "1 day",
                          watermark: str = "1 hour") -> DataFrame:
    """Windowed ``count / min / max`` per key with a watermark on event time.

    Watermarks need a zoned TIMESTAMP: a ``timestamp_ntz`` event time is
    cast in the session zone (UTC in ``build_session``) for the watermark
    and the window only; the reported times keep the input type.
    """
    et = "_event_time"
    return (
        stream.withColumn(et, F.col(time_col).cast("timestamp"))
        .withWatermark(et, watermark)
        .groupBy(F.window(et, window).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n_events"), F.min(time_col).alias("first_at"), F.max(time_col).alias("last_at"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
                "n_events", "first_at", "last_at")
    )


def latest_sessions(spark: SparkSession, table_dir: str, before_version: int | None = None, required: bool = False) -> DataFrame | None:
    """The newest version of the session table (``None`` when nothing was written yet).

    With ``required`` a table that cannot be read is an error: after the first batch a missing folder means
    that stored sessions would be lost.
    """
    try:
        table = spark.read.parquet(table_dir)
    except AnalysisException:
        if required:
            raise
        return None
    older = table if before_version is None else table.filter(F.col("v") < before_version)
    newest = older.agg(F.max("v")).scalar()
    return older.filter(F.col("v") == newest).drop("v")


def start_session_stream(events: DataFrame, people: DataFrame, people_key: str, table_dir: str, log_dir: str,
                         checkpoint: str) -> StreamingQuery:
    """Keep the session table current from a stream of session events."""
    spark = events.sparkSession

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        state = latest_sessions(spark, table_dir, before_version=batch_id, required=batch_id > 0)
        sessions, log, _rejected = apply_session_events(state, batch, people, people_key)
        (sessions.withColumn("v", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("v").parquet(table_dir))
        (log.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(log_dir))

    return (events.writeStream.foreachBatch(apply_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())

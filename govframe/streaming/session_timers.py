"""Sessions with a life of their own (J-1 to J-3): event-time timers expire and purge them in the state store.

The rules for events are those of ``session_state``.  In addition each user has at most one timer:

* an active session with an expiry: when the watermark passes it, an ``EXPIRED`` row is emitted.  The
  session stays as it is, because an expired session is told by its time, as in ``usable_sessions``;
* a closed session: when the watermark passes its end by the retention, a ``PURGED`` row is emitted and
  the user's state and timer are gone.  The store therefore holds live and recently closed sessions,
  not every user that ever was.

At a watermark W the table equals ``purge_sessions(batch sessions, W, days)``.  Events older than the
watermark are dropped by Spark.  Users that neither log in nor reach a timer cost nothing in a batch.
Rows go to a change log, one ``batch=<id>`` partition per micro-batch, overwritten on retry.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from govframe.streaming.session_state import fold_events, valid_events

CHANGE_SCHEMA = ("usuario string, subject bigint, active boolean, started_at timestamp_ntz, expires_at timestamp_ntz, "
                 "change string, step int")
CHANGED, EXPIRED, PURGED = "CHANGED", "EXPIRED", "PURGED"
_COLUMNS = ["usuario", "subject", "active", "started_at", "expires_at", "change", "step"]
_EPOCH = _dt.datetime(1970, 1, 1)
_MICRO = _dt.timedelta(microseconds=1)
_DAY_MS = 86_400_000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _micros(t) -> int | None:
    return None if t is None else (pd.Timestamp(t).to_pydatetime() - _EPOCH) // _MICRO


def _time(micros: int | None):
    return None if micros is None else pd.Timestamp(_EPOCH + micros * _MICRO)


class SessionTimers(StatefulProcessor):
    """One user's session and its timer; times are kept as microseconds."""

    def __init__(self, days: int) -> None:
        self._days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._session = handle.getValueState("session", "subject bigint, active boolean, started bigint, expires bigint")

    def _stored(self) -> tuple | None:
        if not self._session.exists():
            return None
        subject, active, started, expires = self._session.get()
        return subject, active, _time(started), _time(expires)

    def _row(self, key: tuple, session: tuple, change: str, step: int) -> pd.DataFrame:
        frame = pd.DataFrame([(*key, *session, change, step)], columns=_COLUMNS)
        return frame.astype({"started_at": "datetime64[us]", "expires_at": "datetime64[us]"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        session = fold_events(self._stored(), rows)
        if session is None:
            return
        subject, active, started, expires = session
        self._session.update((subject, active, _micros(started), _micros(expires)))
        for timer in list(self._handle.listTimers()):  # at most one
            self._handle.deleteTimer(timer)
        if expires is not None:
            self._handle.registerTimer(_micros(expires) // 1000 + (0 if active else self._days * _DAY_MS))
        yield self._row(key, session, CHANGED, 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        session = self._stored()
        if session is None:
            return
        if session[1]:
            yield self._row(key, session, EXPIRED, 1)
        else:
            self._session.clear()
            yield self._row(key, session, PURGED, 1)

    def close(self) -> None:
        pass


def timed_session_stream(events: DataFrame, people: DataFrame, people_key: str, days: int = 30, watermark: str = "1 hour") -> DataFrame:
    """Streaming frame of session changes, expiries and purges.  ``days``: how long a closed session is kept.

    The session's state store must be RocksDB, as Spark's timers need; ``start_timed_sessions`` sees to it.
    """
    # watermarks need a zoned TIMESTAMP: cast in the session zone (UTC in ``build_session``)
    timed = events.withColumn("_event_time", F.col("event_at").cast("timestamp")).withWatermark("_event_time", watermark)
    return valid_events(timed, people, people_key).groupBy("usuario").transformWithStateInPandas(
        SessionTimers(days), CHANGE_SCHEMA, "update", "EventTime")


def start_timed_sessions(events: DataFrame, people: DataFrame, people_key: str, changes_dir: str, checkpoint: str,
                         days: int = 30, watermark: str = "1 hour") -> StreamingQuery:
    """Run the stream over what is there into a change log partitioned by batch id."""
    spark = events.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(changes_dir))

    stream = timed_session_stream(events, people, people_key, days, watermark)
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)  # the query copies the session's settings when it starts
    try:
        return (stream.writeStream.outputMode("update").foreachBatch(write)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def current_timed_sessions(changes: DataFrame) -> DataFrame:
    """The session table: the latest change per user that is no purge (partial aggregate, no window)."""
    latest = changes.groupBy("usuario").agg(
        F.max_by(F.struct("subject", "active", "started_at", "expires_at", "change"), F.struct("batch", "step")).alias("s"))
    return latest.filter(F.col("s.change") != PURGED).select("usuario", "s.subject", "s.active", "s.started_at", "s.expires_at")

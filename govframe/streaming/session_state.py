"""Session table as a stateful stream (``applyInPandasWithState``).

Each user's session lives in the state store; a micro-batch brings the
user's new LOGIN / LOGOUT events and the function applies the same rules
as the batch operator ``apply_session_events``:

* a LOGIN replaces the session with an active one (subject must exist --
  checked by a stream-static semi-join before grouping);
* the first LOGOUT after the latest LOGIN closes it at the LOGOUT time;
* a LOGOUT without an active session changes nothing.

Only users touched by a batch emit a row (output mode ``update``), so the
cost per batch follows the batch, not the number of users.  The rows go to
a change log (one ``batch=<id>`` partition per micro-batch, overwritten on
retry); the current table is the latest change per user.  The per-user
function works on that user's events of one micro-batch, a slice bounded
by the trigger size even for a very hot user.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from govframe.operators.security import LOGIN, LOGOUT

SESSION_SCHEMA = "usuario string, subject bigint, active boolean, started_at timestamp_ntz, expires_at timestamp_ntz"
STATE_SCHEMA = "subject bigint, active boolean, started_at timestamp_ntz, expires_at timestamp_ntz"


def _nat_to_none(v):
    return None if v is None or pd.isna(v) else v


def fold_events(old: tuple | None, batches: Iterator[pd.DataFrame]) -> tuple | None:
    """A user's session ``(subject, active, started_at, expires_at)`` after new events; ``None`` while there is none."""
    last, ends = None, []  # the latest login, and the logouts that are not before it
    for batch in batches:
        logins = batch[batch["kind"] == LOGIN]
        if old is not None:  # events older than the stored session's start are late
            logins = logins[logins["event_at"] >= old[2]]
        if len(logins):
            top = logins.sort_values(["event_at", "seq"]).iloc[-1]
            if last is None or (top["event_at"], top["seq"]) > (last["event_at"], last["seq"]):
                last = top
        logouts = batch[batch["kind"] == LOGOUT]
        if last is None and old is not None:
            logouts = logouts[logouts["event_at"] >= old[2]]
        ends += zip(logouts["event_at"], logouts["seq"])
        if last is not None:
            ends = [e for e in ends if e > (last["event_at"], last["seq"])]
    if last is not None:
        subject, started = int(last["subject"]), last["event_at"]
        active, expires = (False, min(ends)[0]) if ends else (True, _nat_to_none(last["expires_at"]))
    elif old is not None:
        subject, active, started, expires = old
        if active and ends:
            active, expires = False, min(ends)[0]
    else:
        return None  # logouts of a user without a session change nothing
    return subject, bool(active), started, _nat_to_none(expires)


def _apply_user_events(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    (usuario,) = key
    session = fold_events(state.get if state.exists else None, batches)
    if session is None:
        return
    state.update(session)
    yield pd.DataFrame([(usuario, *session)], columns=["usuario", "subject", "active", "started_at", "expires_at"])


def valid_events(events: DataFrame, people: DataFrame, people_key: str) -> DataFrame:
    """The logins whose subject exists, and all logouts."""
    keys = people.select(F.col(people_key).alias("subject"))
    logins = events.filter(F.col("kind") == LOGIN).join(keys, "subject", "left_semi")
    return logins.unionByName(events.filter(F.col("kind") == LOGOUT))


def session_changes_stream(events: DataFrame, people: DataFrame, people_key: str) -> DataFrame:
    """Streaming frame of session rows changed by each micro-batch.

    The subject check is a stream-static semi-join: Spark broadcasts the
    people keys when they fit and otherwise joins them again for every
    micro-batch.  For a very large people table prefer
    ``start_session_stream`` (foreachBatch), whose check only probes the
    distinct subjects of each batch.
    """
    return valid_events(events, people, people_key).groupBy("usuario").applyInPandasWithState(
        _apply_user_events, SESSION_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout)


def start_session_changes(events: DataFrame, people: DataFrame, people_key: str, changes_dir: str,
                          checkpoint: str) -> StreamingQuery:
    """Run the stateful stream into a change log partitioned by batch id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(changes_dir))

    return (session_changes_stream(events, people, people_key).writeStream.outputMode("update")
            .foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def current_sessions(changes: DataFrame) -> DataFrame:
    """The session table: the latest change per user (partial aggregate, no window)."""
    latest = changes.groupBy("usuario").agg(
        F.max_by(F.struct("subject", "active", "started_at", "expires_at"), F.col("batch")).alias("s"))
    return latest.select("usuario", "s.subject", "s.active", "s.started_at", "s.expires_at")
